"""Alignment of two tokenizers on the same texts.

Both tokenizers cut a text into byte ranges.  Offsets where tokens of both end
are shared cuts; between two of them lies one group, whose tokens of either side
are linked with each other.  The cuts are found by divide and conquer: from the
middle of an interval the nearest shared ends to the left and to the right are
looked for (is this end of A among the ends of B? by bisection), what lies
between them has no cut and becomes a leaf group, and both remaining sides are
divided on.  All intervals of one depth, of many texts, are divided together.

A pair of ids counts once per document.  Tasks work on batches of texts and sum
the pairs of a batch first, so that the corpus-wide counts are added up from a
row per batch and pair; the counts then go back to each batch for its own pairs
only.  No table of all pairs is ever sent to a task.

Words repeat a lot, and neither tokenizer joins bytes across the space before a
word, so a worker keeps the tokens of up to ``CACHE_WORDS`` words of both sides.
Where a tokenizer's file doesn't promise that, whole texts are tokenized.  Where
every merged token of A is what BPE makes of its own bytes, its merges are told by
their results alone, and the faster encoder that works by ranks gives the same ids.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ..session import shared_folder
from .base import chunks
from .bpe import PATTERN, byte_letters

#: Words kept per worker, none longer than CACHE_CHARS, and their tokens; when there are more, it starts anew.
CACHE_WORDS = 400_000
CACHE_CHARS = 48
CACHE_TOKENS = 1 << 24
#: Texts are aligned in slices of about this many characters, a longer text in one of its own.
SLICE_CHARS = 1 << 18
#: A batch is closed at this many (document, pair) entries.
BATCH_ENTRIES = 1_000_000
#: Groups of more links than this are counted by their distinct ids.
WIDE = 1 << 12

#: A word with the spaces before it: it starts at a space after a visible character and ends before the next such space.
WORD = re.compile(r" [^ ]*(?:(?<=\s) [^ ]*)*")
#: Where there is none of these, every space begins a word.
INNER = re.compile(r"\s ")
SPACE = "▁"


class Pair:
    """Both tokenizers, the bytes of their tokens and the words seen so far."""

    def __init__(self, file_a: str, file_b: str, ranked: bool = False) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        with open(file_a, encoding="utf-8") as source:
            model = json.load(source)
        letters, vocab = {letter: b for b, letter in byte_letters().items()}, model["model"]["vocab"]
        self.a = None
        if not ranked:
            self.a = Tokenizer.from_file(file_a)
            self.a.encode_special_tokens = True
            self.a.no_truncation()
            self.a.no_padding()
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, no in vocab.items():
            self.bytes_a[no] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        self.space = self.b.piece_to_id(SPACE)
        split = model.get("pre_tokenizer") or {}
        self.by_word = (
            split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not model.get("normalizer")
            and not any(SPACE in p.lstrip(SPACE) for p in pieces) and self.b.encode(" a") == [self.space, *self.b.encode("a")]
        )
        #: "id," "id;" and "id|" of either side, as the digest text has them
        self.written = np.array([f"{i}{end}" for ids in (len(self.bytes_a), len(self.bytes_b)) for end in ",|;" for i in range(ids)], dtype=object)
        self.ranks = None
        if ranked:
            used = {vocab[x] for x in letters} | {vocab[x] for x in _merged(model)}
            self.ranks = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={self.bytes_a[i]: i for i in used}, special_tokens={})
        self._forget()

    def _both(self, words: list[str]) -> tuple[list, list, list[bool]]:
        """Per word, which has a space before it: ids of A, ids of B, and whether both give its bytes again."""
        parts = [" " + w for w in words]
        if self.ranks is not None:
            side_a = list(map(self.ranks.encode_ordinary, parts))
        else:
            side_a = [e.ids for e in self.a.encode_batch_fast(parts, add_special_tokens=False)]
        side_b = [ids if w else [self.space] for w, ids in zip(words, self.b.encode(words, num_threads=1), strict=True)]
        raw = [p.encode("utf-8") for p in parts]
        again = lambda table, ids: b"".join(map(table.__getitem__, ids))
        # Nearly always all of them do; only else each is looked at.
        if all(again(table, chain.from_iterable(side)) == b"".join(raw) for table, side in ((self.bytes_a, side_a), (self.bytes_b, side_b))):
            return side_a, side_b, [True] * len(words)
        return side_a, side_b, [again(self.bytes_a, x) == r and again(self.bytes_b, y) == r for x, y, r in zip(side_a, side_b, raw, strict=True)]

    def _words(self, text: str) -> list[str]:
        """Words without the space that each has before it."""
        if not text or not self.by_word:
            return [text] if text else []
        spaced = " " + text
        return [w[1:] for w in WORD.findall(spaced)] if INNER.search(spaced) else text.split(" ")

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids_a, self.ids_b, self.broken = Rows(), Rows(), np.zeros(0, np.int64)

    def tokens(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All ids of A and of B, and per text how many; a text that either side doesn't give again has none."""
        if self.ids_a.size > CACHE_WORDS or self.ids_a.used + self.ids_b.used > CACHE_TOKENS:
            self._forget()
        cut = [self._words(t) for t in texts]
        words = list(chain.from_iterable(cut))
        found = list(map(self.known.get, words))
        fresh = list({w for w, f in zip(words, found, strict=True) if f is None})
        if fresh:
            side_a, side_b, same = self._both(fresh)
            number = dict(zip(fresh, range(self.ids_a.size, self.ids_a.size + len(fresh)), strict=True))
            self.broken = np.concatenate([self.broken, self.ids_a.size + np.flatnonzero(~np.array(same, bool))])
            self.ids_a.add(side_a)
            self.ids_b.add(side_b)
            found = [number[w] if f is None else f for w, f in zip(words, found, strict=True)]
            self.known.update((w, n) for w, n in number.items() if len(w) < CACHE_CHARS)
        numbers = np.fromiter(found, np.int64, len(found))
        owner = np.repeat(np.arange(len(cut)), np.fromiter(map(len, cut), np.int64, len(cut)))
        if len(self.broken):
            good = np.ones(len(cut), bool)
            good[owner[np.isin(numbers, self.broken)]] = False
            numbers, owner = numbers[good[owner]], owner[good[owner]]
        counts = [np.bincount(owner, side.counts[numbers], len(cut)).astype(np.int64) for side in (self.ids_a, self.ids_b)]
        return self.ids_a.of(numbers), self.ids_b.of(numbers), *counts


def _roomy(array: np.ndarray, used: int, more: int) -> np.ndarray:
    """The same array with room for ``more`` behind what is used; it doubles, so that adding copies little."""
    return array if used + more <= len(array) else np.concatenate([array[:used], np.zeros(used + 2 * more, array.dtype)])


class Rows:
    """Lists of numbers one after another in one array."""

    def __init__(self) -> None:
        self.values, self.used = np.zeros(1 << 16, np.int32), 0
        self.starts, self.counts, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64), 0

    def add(self, rows: list) -> None:
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        total, first, last = int(counts.sum()), self.size, self.size + len(rows)
        self.values = _roomy(self.values, self.used, total)
        self.starts, self.counts = _roomy(self.starts, first, len(rows)), _roomy(self.counts, first, len(rows))
        self.values[self.used : self.used + total] = np.fromiter(chain.from_iterable(rows), np.int32, total)
        self.starts[first:last], self.counts[first:last] = self.used + np.cumsum(counts) - counts, counts
        self.used, self.size = self.used + total, last

    def of(self, numbers: np.ndarray) -> np.ndarray:
        """The lists of these numbers, one after another."""
        counts = self.counts[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.values[np.repeat(self.starts[numbers] - ends + counts, counts) + np.arange(total)].astype(np.int64)


def _merged(model: dict) -> list[str]:
    """The tokens that merges make, in their order."""
    return ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["model"]["merges"]]


def by_ranks(file_a: str) -> bool:
    """Ids of merged tokens grow with their merges, and BPE makes each of them from its own bytes.

    Then two neighbouring tokens that together spell a token are always its own
    last merge: whatever BPE does inside those bytes, it does to the token alone.
    """
    with open(file_a, encoding="utf-8") as source:
        model = json.load(source)
    split, bpe = model.get("pre_tokenizer") or {}, model["model"]
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") and not model.get("normalizer")
    if not plain or bpe.get("type") != "BPE" or any(bpe.get(x) for x in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix")):
        return False
    vocab, merged = bpe["vocab"], _merged(model)
    ids = [vocab[x] for x in merged]
    tokenizer = Tokenizer.from_file(file_a)
    return all(x in vocab for x in byte_letters().values()) and ids == sorted(set(ids)) and all([t.id for t in tokenizer.model.tokenize(x)] == [vocab[x]] for x in merged)


@lru_cache(maxsize=2)
def loaded(file_a: str, file_b: str, ranked: bool) -> Pair:
    """One pair per worker process."""
    return Pair(file_a, file_b, ranked)


def _nearest(ends_a: np.ndarray, ends_b: np.ndarray, start: np.ndarray, stop: np.ndarray, way: int) -> np.ndarray:
    """From ``start`` towards ``stop``, the first token of A whose end is an end of B; ``stop`` where there is none before it."""
    at, found, width = start.copy(), stop.copy(), 1
    active = np.flatnonzero(start != stop)
    while len(active):
        if width == 1:
            here = at[active]
            end = ends_a[here]
            hit = ends_b[np.searchsorted(ends_b, end)] == end
            found[active[hit]] = here[hit]
            active, here = active[~hit], here[~hit] + way
            at[active] = here
            active = active[here != stop[active]]
            if len(active) < 1 << 12:
                width = 4
            continue
        tried = at[active, None] + way * np.arange(width)
        inside = (tried - stop[active, None]) * way < 0
        tried = np.where(inside, tried, stop[active, None])
        end = ends_a[np.maximum(tried, 0)]
        hit = inside & (ends_b[np.searchsorted(ends_b, end)] == end)
        where = hit.argmax(axis=1)
        got = hit[np.arange(len(active)), where]
        found[active[got]] = tried[np.arange(len(active)), where][got]
        at[active] += way * width
        active = active[~got & inside[:, -1]]
        active = active[at[active] != stop[active]]
        if 2 * width * len(active) < 1 << 16:  # few long stretches without a cut: test more ends at a time
            width *= 2
    return found


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each token of A, whether a group ends with it.

    Ends grow over all texts; text i has the tokens ``first[i]`` to ``last[i]`` of A,
    and the last of them ends where B ends, too.
    """
    cut = np.zeros(len(ends_a), bool)
    cut[last] = True
    low, high = first, last
    while len(low):
        longer = low < high
        low, high = low[longer], high[longer]
        middle = (low + high) // 2
        left = _nearest(ends_a, ends_b, middle, low - 1, -1)
        right = _nearest(ends_a, ends_b, np.minimum(middle + 1, high), high, 1)
        inner = left >= low
        cut[left[inner]] = True
        cut[right] = True
        more = right < high
        low, high = np.concatenate([low[inner], right[more] + 1]), np.concatenate([left[inner], high[more]])
    return cut


class Slice:
    """Aligned texts: tokens, groups and linked pairs of each."""

    def __init__(self, pair: Pair, texts: list[str]) -> None:
        ids_a, ids_b, n_a, n_b = pair.tokens(texts)
        self.pair, self.count = pair, len(texts)
        self.a, self.b = ids_a, ids_b
        self.n_a, self.n_b = n_a, n_b
        self.stop_a = np.cumsum(self.n_a)
        ends_a, ends_b = np.cumsum(pair.size_a[self.a]), np.cumsum(pair.size_b[self.b])
        full = np.flatnonzero(self.n_a)
        cut = np.flatnonzero(shared_cuts(ends_a, ends_b, (self.stop_a - self.n_a)[full], self.stop_a[full] - 1)) if len(full) else np.zeros(0, np.int64)
        #: per group: first token and number of tokens of either side, and the text it lies in
        self.end_a, self.end_b = cut + 1, np.searchsorted(ends_b, ends_a[cut]) + 1
        self.from_a, self.from_b = (np.concatenate(([0], e[:-1])) if len(e) else e for e in (self.end_a, self.end_b))
        self.wide_a, self.wide_b = self.end_a - self.from_a, self.end_b - self.from_b
        self.text = np.searchsorted(self.stop_a, cut, side="right")
        self.n_groups = np.bincount(self.text, minlength=self.count)

    def n_links(self) -> np.ndarray:
        total = np.zeros(self.count, np.int64)
        np.add.at(total, self.text, self.wide_a * self.wide_b)
        return total

    def written(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each text, empty without tokens."""
        size_a, size_b = len(self.pair.bytes_a), len(self.pair.bytes_b)
        out = np.zeros(len(self.a) + len(self.b), np.int64)
        # a group's tokens of A stand before its tokens of B; the token that ends a side has the other sign after it
        group_a, group_b = np.repeat(np.arange(len(self.end_a)), self.wide_a), np.repeat(np.arange(len(self.end_b)), self.wide_b)
        at_a, at_b = np.arange(len(self.a)) + self.from_b[group_a], np.arange(len(self.b)) + self.end_a[group_b]
        out[at_a], out[at_b] = self.a, self.b + 3 * size_a
        out[self.end_a - 1 + self.from_b] += size_a
        out[self.end_b - 1 + self.end_a] += 2 * size_b
        words = self.pair.written[out].tolist()
        stops = np.cumsum(self.n_a + self.n_b)
        return ["".join(words[stop - n : stop])[:-1] for stop, n in zip(stops.tolist(), (self.n_a + self.n_b).tolist(), strict=True)]

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, links), each pair of a text once and in order; a pair is id of A << 32 | id of B."""
        links = self.wide_a * self.wide_b
        few = np.flatnonzero(links <= WIDE)
        texts, pairs, weights = [], [], []
        # pairs of all groups of few links: every token of A as often as its group has tokens of B
        owner = np.repeat(few, links[few])
        no = np.arange(len(owner)) - np.repeat(np.cumsum(links[few]) - links[few], links[few])
        a, b = self.a[self.from_a[owner] + no // self.wide_b[owner]], self.b[self.from_b[owner] + no % self.wide_b[owner]]
        texts.append(self.text[owner])
        pairs.append(a << 32 | b)
        weights.append(np.ones(len(owner), np.int64))
        for g in np.flatnonzero(links > WIDE):
            a, times_a = np.unique(self.a[self.from_a[g] : self.end_a[g]], return_counts=True)
            b, times_b = np.unique(self.b[self.from_b[g] : self.end_b[g]], return_counts=True)
            pairs.append((a[:, None] << 32 | b[None, :]).ravel())
            weights.append((times_a[:, None] * times_b[None, :]).ravel())
            texts.append(np.full(len(a) * len(b), self.text[g]))
        text, pair, weight = np.concatenate(texts), np.concatenate(pairs), np.concatenate(weights)
        order = np.lexsort((pair, text))
        text, pair, weight = text[order], pair[order], weight[order]
        start = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1])))) if len(text) else np.zeros(0, np.int64)
        return text[start], pair[start], np.add.reduceat(weight, start) if len(start) else weight


_BATCH = "batch bigint, ids array<{id}>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, n_links array<bigint>, digests array<string>, written array<string>, pairs binary, docs binary, sizes binary, entries binary, links binary"


def batches_of(docs: DataFrame, file_a: str, file_b: str, with_groups: bool = False) -> DataFrame:
    """(id, text) -> a row per batch of aligned texts, stored.

    ``pairs``: the distinct pairs of the batch, the most frequent first, and ``docs``:
    in how many of its texts each stands.  ``sizes``: distinct pairs of each text,
    ``entries``: their places in ``pairs``, ``links``: how often each is linked.
    """
    id_type = docs.schema["id"].dataType
    schema = _BATCH.format(id=id_type.simpleString())
    ranked = by_ranks(file_a)

    def aligned(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair = loaded(file_a, file_b, ranked)
        made, number = [], TaskContext.get().partitionId() << 32
        for part, texts in chunks(parts, 1):
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= SLICE_CHARS):
                    size += len(texts[end])
                    end += 1
                found = Slice(pair, texts[begin:end])
                text, pairs, links = found.entries()
                written = found.written()
                digests = [hashlib.sha256(w.encode()).hexdigest() if w else "" for w in written]
                made.append((part.column(0).slice(begin, end - begin), found.n_a, found.n_b, found.n_groups, found.n_links(), digests,
                             written if with_groups else None, np.bincount(text, minlength=end - begin), pairs, links))
                begin = end
                if sum(len(m[8]) for m in made) >= BATCH_ENTRIES:
                    yield _batch(number, made, id_type)
                    made, number = [], number + 1
        if made:
            yield _batch(number, made, id_type)

    folder = shared_folder(docs.sparkSession, "aligned-batches")
    docs.select("id", "text").mapInArrow(aligned, schema).write.option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(schema).parquet(folder)


def _batch(number: int, made: list[tuple], id_type) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_type

    pairs, place, docs = np.unique(np.concatenate([m[8] for m in made]), return_inverse=True, return_counts=True)
    order = np.argsort(-docs, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    whole = lambda n: np.concatenate([m[n] for m in made]).tolist()
    raw = lambda values: pa.array([np.ascontiguousarray(values).tobytes()], pa.large_binary()).cast(pa.binary())
    ids = [x for m in made for x in m[0].to_pylist()]
    numbers = [pa.array([whole(n)], pa.list_(pa.int64())) for n in range(1, 5)]
    written = [w for m in made for w in m[6] or ()] if made[0][6] is not None else None
    columns = [
        pa.array([number], pa.int64()), pa.array([ids], pa.list_(to_arrow_type(id_type))), *numbers, pa.array([[d for m in made for d in m[5]]], pa.list_(pa.string())),
        pa.array([written], pa.list_(pa.string())), raw(pairs[order].astype("<i8")), raw(docs[order].astype("<i4")), raw(np.concatenate([m[7] for m in made]).astype("<i4")),
        raw(rank[place].astype("<u4")), raw(np.concatenate([m[9] for m in made]).astype("<i8")),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split(" ")[0] for c in _BATCH.split(", ")])


def _batch_pairs(batches: DataFrame) -> DataFrame:
    """(batch, place, a, b, docs): the distinct pairs of every batch."""

    def listed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for batch, pairs, docs in zip(*(c.to_pylist() for c in part.columns), strict=True):
                pairs = np.frombuffer(pairs, "<i8")
                columns = [np.full(len(pairs), batch), np.arange(len(pairs), dtype=np.int32), (pairs >> 32).astype(np.int32), (pairs & 0xFFFFFFFF).astype(np.int32), np.frombuffer(docs, "<i4")]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["batch", "place", "a", "b", "docs"])

    return batches.select("batch", "pairs", "docs").mapInArrow(listed, "batch bigint, place int, a int, b int, docs int")


def pair_counts(batches: DataFrame) -> DataFrame:
    """(a, b, docs, best): in how many documents the ids are linked, and whether no other id of B reaches that with this id of A.

    An id of A has at most as many rows as B has ids, so its window is bounded.
    """
    counts = _batch_pairs(batches).groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    return counts.withColumn("best", F.col("docs") == F.max("docs").over(W.partitionBy("a")))


def align(docs: DataFrame, file_a: str, file_b: str, doc_id: str = "doc_id", text: str = "text", with_groups: bool = False) -> DataFrame:
    """A row per document: its id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, and with ``with_groups`` the groups.

    A is a byte-level tokenizer file of the ``tokenizers`` library, applied to space + text; B a
    ``sentencepiece`` model, which adds that space itself; both files must be readable
    where tasks run.  Strings of special tokens in a text are plain text.  Texts that are null or
    empty, or that either side doesn't give again byte by byte, have no tokens: zeros and
    empty strings.  Rows are independent, so a repeated row is another document and
    counts again.  Other columns of the input are not read.
    """
    batches = batches_of(docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")), file_a, file_b, with_groups)
    sums = _batch_pairs(batches).drop("docs").join(pair_counts(batches), ["a", "b"]).select("batch", "place", "docs", "best")
    id_type = batches.schema["ids"].dataType.elementType
    schema = f"id {id_type.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string, groups string"

    def finished(batch: pa.Table, found: pa.Table) -> pa.Table:
        """One batch with the corpus-wide counts of its pairs."""
        row = batch.to_pylist()[0]
        place = found.column("place").to_numpy()
        docs, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        docs[place], best[place] = found.column("docs").to_numpy(), found.column("best").to_numpy(zero_copy_only=False)
        entries, links, sizes = np.frombuffer(row["entries"], "<u4"), np.frombuffer(row["links"], "<i8"), np.frombuffer(row["sizes"], "<i4")
        owner = np.repeat(np.arange(len(sizes)), sizes)
        totals = []
        for value in (best, docs):
            total = np.zeros(len(sizes), np.int64)
            np.add.at(total, owner, links * value[entries])
            totals.append(total)
        written = row["written"] if row["written"] is not None else [None] * len(sizes)
        columns = [batch.column("ids").combine_chunks().flatten(), *(pa.array(row[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")), *map(pa.array, totals), pa.array(row["digests"], pa.string()), pa.array(written, pa.string())]
        return pa.Table.from_arrays(columns, ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"])

    rows = batches.drop("pairs", "docs").groupBy("batch").cogroup(sums.groupBy("batch")).applyInArrow(finished, schema)
    return rows.select(F.col("id").alias(doc_id), *[c for c in rows.columns if c not in ("id", "groups")], *["groups"] * with_groups)
