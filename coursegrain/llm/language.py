"""Language identification by averaged subword embeddings.

A text is the mean of the embeddings of its subwords: hashed runs of one to four
signs of each word with its borders, and the word itself, in lower case.  A linear
softmax layer over that mean names the language.  Both are trained together by
stochastic gradient descent in numpy.  A temperature fitted on documents that the
descent did not see turns outputs into probabilities, and the lowest probability
above which those documents are named rightly often enough is the line below
which an answer is rejected.

The fit uses at most ``PER_LANGUAGE`` labelled documents of each language, those of
the smallest hash, each as a whole text and as a few short passages: a bounded
sample, so it runs in one task on feature counts that many tasks have made.
Prediction is a map over the documents.  Because a mean and a linear layer can
change places, each subword's part in the outputs is worked out beforehand.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import hash60, packed, stored, unpacked
from .ngrams import slices
from .quality import held_out

#: Labelled documents of each language that the fit uses at most.
PER_LANGUAGE = 1000
#: Hashed subwords, and numbers of an embedding.
BITS = 16
WIDTH = 16
LONGEST = 4
#: Lengths in words of the passages that a training document gives beside its whole text.
PASSAGES = (1, 3, 8)
EPOCHS = 5
RATE = 0.5
#: One document in so many is kept from the descent for the calibration.
CALIBRATED = 5
#: Share of the answers over the line that shall be right.
TRUSTED = 0.99
UNKNOWN = "und"

_TABLES: list[np.ndarray] = []
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _signs(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts as numbers, 0 for whatever stands between words, and the place after each text."""
    if not _TABLES:
        every = [chr(c) if not 0xD800 <= c < 0xE000 else " " for c in range(0x110000)]
        _TABLES.append(np.array([(ord(x.lower()) if len(x.lower()) == 1 else ord(x)) if x.isalpha() else 0 for x in every], dtype=np.uint64))
    codes = np.frombuffer("".join(f" {t} " for t in texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _TABLES[0][codes], np.cumsum(np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts)))


def subwords(texts: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hashed subword) for every subword, repeats included, of one slice of texts."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    signs, stops = _signs(texts)
    blank = signs == 0
    gaps = np.concatenate(([0], np.cumsum(blank)))
    places, hashes = [], []
    rolled = signs.copy()
    for n in range(1, LONGEST + 1):
        size = len(signs) - n + 1
        if n > 1:
            rolled = rolled[:size] * _STEP + signs[n - 1 :]
        # borders may stand at the ends of a run only, and a run holds a letter
        inner = gaps[n - 1 : n - 1 + size] - gaps[1 : 1 + size] if n > 2 else 0
        fits = ~blank if n == 1 else ~(blank[:size] & blank[1:]) if n == 2 else inner == 0
        at = np.flatnonzero(fits)
        places.append(at)
        hashes.append(rolled[at] + np.uint64(n))
    edge = np.flatnonzero(np.diff(blank.astype(np.int8)))  # a word starts after an even, ends at an odd one
    starts, ends = edge[::2] + 1, edge[1::2] + 1
    if len(starts):
        power = np.full(len(signs) + 1, _STEP, np.uint64)
        power[0] = 1
        np.cumprod(power, out=power)
        mixed = (signs ^ (signs >> np.uint64(7))) * _MIX
        inside = np.arange(len(signs)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(signs)]))))
        parts = np.where(blank, np.uint64(0), mixed * power[inside])
        places.append(starts)
        hashes.append(np.add.reduceat(parts, np.ravel(np.column_stack([starts, ends])))[::2] + np.uint64(97))
    place, value = np.concatenate(places), np.concatenate(hashes)
    value = (value ^ (value >> np.uint64(32))) * _MIX
    value = (value ^ (value >> np.uint64(29))) * _STEP
    return np.searchsorted(stops, place, side="right"), (value >> np.uint64(64 - bits)).astype(np.int64)


def passages(text: str, lengths: tuple[int, ...] = PASSAGES) -> list[str]:
    """The whole text, and a passage of each length at a place that the text's own length and the passage's choose."""
    words = text.split()
    cuts = [len(text) * 7919 * (n + 1) % max(1, len(words) - n) for n in lengths]
    return [text, *(" ".join(words[at : at + n]) for at, n in zip(cuts, lengths, strict=True) if len(words) > n)]


class Model:
    """Embeddings and softmax layer of the languages named, from items (subwords, their shares, language number)."""

    def __init__(self, items: list[tuple[np.ndarray, np.ndarray, int]], languages: int, bits: int = BITS) -> None:
        turns = np.random.default_rng(11)
        table = turns.uniform(-1 / WIDTH, 1 / WIDTH, (1 << bits, WIDTH)).astype(np.float32)
        layer, bias = np.zeros((WIDTH, languages), np.float32), np.zeros(languages, np.float32)
        steps, done = max(1, EPOCHS * len(items)), 0
        # languages of few items weigh as much as the others
        held = np.bincount([language for _, _, language in items], minlength=languages)
        weigh = len(items) / np.maximum(held, 1) / max(1, (held > 0).sum())
        for _ in range(EPOCHS):
            for i in turns.permutation(len(items)):
                found, share, language = items[i]
                rate = np.float32(RATE * (1 - done / steps) * min(weigh[language], 4.0))
                done += 1
                rows = table[found]
                mean = share @ rows
                slope = softmax(mean @ layer + bias)
                slope[language] -= 1
                back = layer @ slope
                layer -= rate * np.outer(mean, slope)
                bias -= rate * slope
                table[found] = rows - rate * np.outer(share * len(share), back / np.float32(max(1.0, len(share) ** 0.5)))
        #: per subword, what it adds to the outputs of a text of which it is all
        self.parts = (table @ layer).astype(np.float32)
        self.bias = bias.astype(np.float32)


def softmax(outputs: np.ndarray) -> np.ndarray:
    lifted = np.exp(outputs - outputs.max(axis=-1, keepdims=True))
    return lifted / lifted.sum(axis=-1, keepdims=True)


def outputs(parts: np.ndarray, bias: np.ndarray, numbers: np.ndarray, found: np.ndarray, count: int) -> np.ndarray:
    """Outputs of each text from its (text number, subword) pairs; a text without subwords has the bias alone."""
    total = np.stack([np.bincount(numbers, parts[found, k], minlength=count) for k in range(parts.shape[1])], axis=1)
    return total / np.maximum(np.bincount(numbers, minlength=count), 1)[:, None] + bias


def calibrated(raw: np.ndarray, right: np.ndarray) -> tuple[float, float]:
    """Temperature of the least log loss, and the score from which on a share of TRUSTED of the answers is right."""
    if not len(raw):
        return 1.0, 0.0
    losses = {t: -np.log(softmax(raw / t)[np.arange(len(raw)), right] + 1e-12).mean() for t in np.exp(np.linspace(np.log(0.05), np.log(20), 121))}
    heat = float(min(losses, key=losses.get))
    chance = softmax(raw / heat)
    best, good = chance.max(axis=1), chance.argmax(axis=1) == right
    order = np.argsort(-best, kind="stable")
    shares = np.cumsum(good[order]) / np.arange(1, len(order) + 1)
    trusted = np.flatnonzero(shares >= TRUSTED)
    if len(trusted) and trusted[-1] == len(order) - 1:
        return heat, 0.0
    return heat, float(best[order[trusted[-1]]]) if len(trusted) else 1.0


def _sampled(docs: DataFrame, per_language: int) -> DataFrame:
    """(lang, doc_id, text) of at most ``per_language`` labelled documents a language; equal rows count once.

    A threshold on the hash leaves few more than wanted before any language's rows meet.
    """
    known = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    keys = known.select("doc_id", "lang", F.xxhash64("text").alias("_text")).distinct()
    keys = stored(keys.withColumn("_hash", hash60(F.concat_ws(":", F.col("doc_id").cast("string"), "_text"), "lang:")), "language-keys")
    # A row per language: sent to all tasks, so that the others' rows needn't be dealt out by language before the threshold has thinned them.
    counts = F.broadcast(keys.groupBy("lang").agg(F.count("*").alias("_rows")))
    few = keys.join(counts, "lang").filter(F.col("_hash") < F.lit(float(1 << 60)) * (1.3 * per_language + 50) / F.col("_rows"))
    first = W.partitionBy("lang").orderBy("_hash", "doc_id", "_text")
    chosen = few.withColumn("_no", F.row_number().over(first)).filter(F.col("_no") <= per_language).select("doc_id", "lang", "_text")
    joined = known.withColumn("_text", F.xxhash64("text")).join(stored(chosen, "language-sample"), ["doc_id", "lang", "_text"])
    return joined.groupBy("lang", "doc_id", "_text").agg(F.min("text").alias("text"))


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> dict:
    """A small model from doc_id, text and lang of the documents that are not held out.

    Rows with a null id, text or lang are left out.  Without any, the model names no
    language.  A language needs no least number of rows.  The sample holds
    ``per_language`` documents for each value of ``lang``, which is taken to have few.
    """
    sample = _sampled(docs.select("doc_id", "text", "lang"), per_language)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                items = passages(row.text)
                for no, item in enumerate(items):
                    _, found = subwords([item])
                    kinds, times = np.unique(found, return_counts=True)
                    if len(kinds):
                        yield pd.DataFrame({"lang": [row.lang], "doc_id": [str(row.doc_id)], "no": [no], "found": [kinds.astype("<i4").tobytes()], "times": [times.astype("<i4").tobytes()]})

    items = sample.mapInPandas(counted, "lang string, doc_id string, no int, found binary, times binary")

    def fitted(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "lang", "no", "found"])
        names = sorted(set(rows["lang"]))
        seen, unseen = [], []
        order = {d: n for n, d in enumerate(dict.fromkeys(rows["doc_id"]))}
        for row in rows.itertuples(index=False):
            times = np.frombuffer(row.times, "<i4").astype(np.float32)
            item = (np.frombuffer(row.found, "<i4").astype(np.int64), times / times.sum(), names.index(row.lang))
            (unseen if order[row.doc_id] % CALIBRATED == 0 and len(order) > CALIBRATED else seen).append(item)
        model = Model(seen, len(names))
        raw = np.array([share @ model.parts[found] + model.bias for found, share, _ in unseen]).reshape(len(unseen), len(names))
        heat, line = calibrated(raw, np.array([language for _, _, language in unseen], np.int64))
        return pd.DataFrame({"names": [names], "parts": [model.parts.tobytes()], "bias": [model.bias.tobytes()], "heat": [heat], "line": [line]})

    # A bounded sample: at most ``per_language`` documents of each language meet in this one task, as counts of hashed subwords.
    found = items.groupBy(F.lit(1).alias("one")).applyInPandas(fitted, "names array<string>, parts binary, bias binary, heat double, line double").collect()
    if not found:
        return {"names": []}
    row = found[0]
    names = list(row["names"])
    return {"names": names, "parts": np.frombuffer(row["parts"], np.float32).reshape(-1, len(names)), "bias": np.frombuffer(row["bias"], np.float32), "heat": row["heat"], "line": row["line"]}


def predict(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """All rows and columns plus lang_pred, score and confident.

    ``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, and
    everywhere if the model names no language; else the likeliest language with its
    calibrated probability.  ``confident`` is false for ``und`` and below the model's
    line.  Whole texts count, however long.  Rows are independent, so repeated
    rows get equal results.  Input columns named like an output are replaced.
    """

    @F.pandas_udf("struct<lang_pred:string,score:double,confident:boolean>")
    def named(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = np.array([*model["names"], UNKNOWN], dtype=object)
        for batch in batches:
            texts = batch.fillna("").tolist()
            best, score = np.full(len(texts), len(names) - 1), np.zeros(len(texts))
            for begin, end in slices(texts) if model["names"] else ():
                numbers, found = subwords(texts[begin:end])
                chance = softmax(outputs(model["parts"], model["bias"], numbers, found, end - begin) / model["heat"])
                some = np.bincount(numbers, minlength=end - begin) > 0
                best[begin:end][some] = chance.argmax(axis=1)[some]
                score[begin:end][some] = chance.max(axis=1)[some]
            yield pd.DataFrame({"lang_pred": names[best], "score": score, "confident": (best < len(names) - 1) & (score >= model.get("line", 0.0))})

    found = packed(docs, _text=F.col(f"`{text}`")).withColumn("_made", named("_text"))
    return unpacked(found.select("_row", "_made.*"), docs.columns, "lang_pred", "score", "confident")
