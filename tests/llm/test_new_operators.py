"""Resampling, language and alignment on small tables, against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from coursegrain.llm import alignment, bpe, language, resampling
from coursegrain.llm.quality import held_out

SF = "/root/testdata/sf0.001"
FILE_A, FILE_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
CLASH = "doc_id long, text string, lang string, id string, rank string, score string, weight string, _row string, batch string"


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, lang, "a", "b", "c", "d", "e", "f") for i, t, lang in rows], CLASH)


def odd_rows():
    long_text = "lörem ipsum 42 " * 20_000
    return [(1, None, "en"), (2, "", "en"), (3, long_text, "fr"), (3, long_text, "fr"), (None, "some words here " * 9, "en"), (4, " \t\n ", None), (5, "...", "de"), (6, "one", "de")]


# resampling


def plain_draw(rows, target, buckets=10_000, least=20, share=25):
    """Rank by the definition, in plain Python; equal rows take consecutive ranks."""

    def grams(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        return len(words), [zlib.crc32(g.encode()) % buckets for g in found]

    have = [(i, *grams(t)) for i, t in rows]
    source, aim = Counter(b for _, _, g in have for b in g), Counter(b for t in target for b in grams(t)[1])
    s_all, t_all = sum(source.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + buckets) / ((source[b] + 1) * (t_all + buckets)))) for b in source}
    scored = []
    for i, n, g in have:
        weight = sum(gain[b] for b in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((x for x in scored if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    drawn = [(*x[:4], r + 1) for r, x in enumerate(able[: len(able) * share // 100])]
    return Counter(drawn + [(*x[:4], None) for x in able[len(drawn) :]] + [(*x[:4], None) for x in scored if x[4] < least])


def test_resampling_equals_plain_draw(spark):
    docs, target = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = resampling.resample(docs, target).drop("n_words").collect()
    assert Counter(tuple(r) for r in got) == plain_draw(rows, [r["text"] for r in target.collect()])


def test_resampling_odd_rows(spark):
    rows = odd_rows() + [(9, "same words again " * 10, "en")] * 30
    aim = spark.createDataFrame([("words here", 1), (None, 2)], "text string, doc_id int")
    docs = clashing(spark, rows)
    want = plain_draw([(i, t) for i, t, _ in rows], ["words here", None], share=50)
    got = resampling.resample(docs, aim, share=50)
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert Counter(tuple(r) for r in got.drop("n_words").collect()) == want
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, sum(n for k, n in want.items() if k[4]) + 1))
    assert resampling.resample(docs.limit(0), aim).count() == 0
    assert resampling.resample(docs, aim.limit(0)).count() == len(rows)


def test_n_gram_scan_of_any_length(spark):
    words, found = resampling.scan("A-b\x00c  É9 d", [resampling.n_gram(2), resampling.n_gram(3)])
    grams = ["a", "b", "c", "É9", "d", "a b", "b c", "c É9", "É9 d", "a b c", "b c É9", "c É9 d"]
    assert words == 5 and found.tolist() == [zlib.crc32(g.encode()) for g in grams]


# language


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.predict(docs, language.train(docs))
    rows = found.filter(held_out(F.col("doc_id")) & F.col("lang").isNotNull()).collect()
    right = [r["lang"] == r["lang_pred"] for r in rows]
    assert len(rows) > 100 and sum(right) >= 0.97 * len(right)
    assert all(0 <= r["score"] <= 1 for r in rows)
    sure = [r["lang"] == r["lang_pred"] for r in rows if r["confident"]]
    assert len(sure) > 0.8 * len(rows) and sum(sure) >= 0.98 * len(sure)


def test_language_learns_only_from_text_and_training_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # labels of held-out rows, sources and other columns change nothing
    twisted = docs.withColumn("lang", F.when(held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.col("lang"))
    one, other = language.train(docs), language.train(twisted)
    assert one["names"] == other["names"] and np.array_equal(one["parts"], other["parts"]) and one["heat"] == other["heat"]


def test_language_odd_rows(spark):
    docs = clashing(spark, odd_rows() + [(n, "the and of in to " * 3, "en") for n in range(10, 40)] + [(n, "être où déjà là çà " * 3, "fr") for n in range(40, 70)])
    found = language.predict(docs.withColumn("lang_pred", F.lit("gone")), language.train(docs))
    assert found.columns == [*[c for c in docs.columns if c != "score"], "lang_pred", "score", "confident"]
    rows = found.collect()
    assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", r["text"] or "")) for r in rows)
    assert all(r["score"] == 0 and not r["confident"] for r in rows if r["lang_pred"] == "und")
    assert {r["lang_pred"] for r in rows if r["doc_id"] in range(10, 40)} == {"en"} and {r["lang_pred"] for r in rows if r["doc_id"] in range(40, 70)} == {"fr"}
    assert language.predict(docs.limit(0), language.train(docs)).count() == 0
    nothing = language.train(docs.limit(0))
    assert nothing["names"] == [] and {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}
    single = language.train(docs.filter("lang = 'en'"))
    assert single["names"] == ["en"] and {r["lang_pred"] for r in language.predict(docs, single).collect()} == {"en", "und"}


def test_language_sample_is_bounded(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("lang"))
    counts = dict(language._sampled(docs, 100).groupBy("lang").count().collect())
    assert counts == {"a": 100, "b": 100}
    same = spark.range(2000).select(F.lit(3).alias("doc_id"), F.lit("one text").alias("text"), F.lit("a").alias("lang"))
    assert language._sampled(same, 100).count() <= 1


def test_subwords_are_those_of_each_word():
    numbers, found = language.subwords(["Hello, world", "", "12 - 3", "hello", "hello"])
    assert np.bincount(numbers, minlength=5).tolist()[1:3] == [0, 0]
    one, two = (sorted(found[numbers == n].tolist()) for n in (3, 4))
    assert one == two and len(one) == 5 + 6 + 5 + 4 + 1 and set(one) <= set(found[numbers == 0].tolist())


# alignment


def plain_groups(a, b, size_a, size_b):
    ends_a, ends_b = np.cumsum([size_a[x] for x in a]).tolist(), np.cumsum([size_b[x] for x in b]).tolist()
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        x, y = ends_a.index(cut) + 1, ends_b.index(cut) + 1
        groups.append((a[i:x], b[j:y]))
        i, j = x, y
    return groups


def plain_alignment(texts):
    """Per text: tokens of both libraries over the whole text, groups by set intersection, corpus-wide counts."""
    tokenizer, pieces = Tokenizer.from_file(FILE_A), sentencepiece.SentencePieceProcessor(model_file=FILE_B)
    tokenizer.encode_special_tokens = True
    letters = {letter: byte for byte, letter in bpe.byte_letters().items()}
    bytes_of = lambda i: bytes(letters[c] for c in tokenizer.id_to_token(i))
    piece_of = lambda i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
    aligned = []
    for text in texts:
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if b"".join(map(bytes_of, a)) != raw or b"".join(map(piece_of, b)) != raw:
            a = b = []
        groups = plain_groups(a, b, {x: len(bytes_of(x)) for x in a}, {x: len(piece_of(x)) for x in b})
        aligned.append((a, b, groups, Counter((x, y) for left, right in groups for x in left for y in right)))
    counts = Counter(pair for *_, links in aligned for pair in links)
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    rows = []
    for a, b, groups, links in aligned:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        top = sum(n for p, n in links.items() if counts[p] == best[p[0]])
        rows.append((len(a), len(b), len(groups), sum(links.values()), top, sum(n * counts[p] for p, n in links.items()), hashlib.sha256(written.encode()).hexdigest() if a else "", written))
    return rows, counts, best


def odd_texts():
    turns = random.Random(8)
    signs = [*"ab cd  \n\t\r '12.,é▁中文字😀\x00\x1c\x85\xa0ß_|", "<s>", "</s>", "<unk>", "<|endoftext|>", "aaaa", "    ", "\n\n", "'s", " ", "​", "ﬁ"]
    mixed = ["".join(turns.choice(signs) for _ in range(turns.randrange(60))) for _ in range(400)]
    return [None, "", " ", "a", " a", "\n", "aaaa" * 3000, "ab" * 5000 + " c", "中" * 3000, "😀" * 2000, *mixed]


def test_alignment_equals_plain_version(spark, monkeypatch):
    monkeypatch.setattr(alignment, "BATCH_ENTRIES", 3000)
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()] + odd_texts()
    rows = [(n, t) for n, t in enumerate(texts)] + [(7, "one two"), (7, "one two"), (None, "one two")]
    docs = clashing(spark, [(i, t, "en") for i, t in rows]).repartition(5)
    got = alignment.align(docs, FILE_A, FILE_B, with_groups=True)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    want, counts, best = plain_alignment([t for _, t in rows])
    assert Counter(tuple(r) for r in got.collect()) == Counter((i, *w) for (i, _), w in zip(rows, want, strict=True))
    pairs = alignment.pair_counts(alignment.batches_of(docs.select(F.col("doc_id").alias("id"), "text"), FILE_A, FILE_B)).collect()
    assert {(r["a"], r["b"]): (r["docs"], r["best"]) for r in pairs} == {p: (n, n == best[p[0]]) for p, n in counts.items()}
    assert alignment.align(docs.limit(0), FILE_A, FILE_B).count() == 0


def test_words_and_ranks_give_the_libraries_ids():
    assert alignment.by_ranks(FILE_A)
    pair = alignment.Pair(FILE_A, FILE_B, True)
    assert pair.by_word and pair.ranks is not None
    tokenizer = Tokenizer.from_file(FILE_A)
    tokenizer.encode_special_tokens = True
    signs = [f"a{chr(c)}{chr(c)}b {chr(c)}1 {chr(c)} " for c in range(0x3400) if not 0xD800 <= c < 0xE000]
    assert [pair.ranks.encode_ordinary(" " + s) for s in signs] == [e.ids for e in tokenizer.encode_batch([" " + s for s in signs], add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(4))
def test_cuts_by_divide_and_conquer(seed):
    turns = np.random.default_rng(seed)
    ends_a, ends_b, first, last, want, at = [], [], [], [], set(), 0
    for size in (1, 2, 7, 40, 900, 3000):
        a, b = (np.cumsum(turns.integers(1, 4, size)) for _ in range(2))
        if seed == 3:  # one long stretch without a cut
            a, b = np.arange(2, 2 * size + 1, 2), np.arange(1, 2 * size, 2)
        stop = max(a[-1], b[-1]) + 1
        a, b = np.append(a[a < stop], stop), np.append(b[b < stop], stop)
        first.append(len(ends_a))
        want |= {len(ends_a) + i for i, e in enumerate(a) if e in set(b.tolist())}
        ends_a += (a + at).tolist()
        ends_b += (b + at).tolist()
        last.append(len(ends_a) - 1)
        at += stop
    cut = alignment.shared_cuts(np.array(ends_a), np.array(ends_b), np.array(first), np.array(last))
    assert set(np.flatnonzero(cut).tolist()) == want


def test_wide_groups_are_counted_by_their_ids(monkeypatch):
    pair = alignment.Pair(FILE_A, FILE_B, True)
    texts = ["word " * 50, "x"]
    narrow = [x.tolist() for x in alignment.Slice(pair, texts).entries()]
    monkeypatch.setattr(alignment, "WIDE", 0)
    assert [x.tolist() for x in alignment.Slice(pair, texts).entries()] == narrow
