"""Importance resampling towards a target distribution.

Texts become bags of hashed n-grams.  A bucket's gain is the log ratio of its
smoothed shares in the target texts and in all documents; a document's weight is
the mean gain of its n-grams.  Adding Gumbel noise that the document's id fixes
and taking the highest sums draws documents without replacement in proportion to
their importance.

N-grams are found by overlapped scanning: separators collapse to single spaces,
then one regular expression per n, between lookarounds for word borders, is
iterated with ``overlapped=True``; every match is the span of one n-gram and goes
straight into the CRC (single words can't overlap and are taken as they stand
between the spaces).  A text is scanned once: its bucket numbers (two bytes each
while they fit) are stored and read for the counts and for the weights.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.scan import null_safe_join
from .base import chunks, stored

BUCKETS = 10_000
LONGEST = 2
#: Documents with fewer words aren't drawn.
LEAST_WORDS = 20
#: Percent of the documents with enough words that is drawn.
SHARE = 25
SEED = 7
#: Parts that the repeats of one row are counted in.
SALTS = 4096

#: Bytes of a word: digits, letters and whatever is not ASCII; A-Z become a-z, the others separate words.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def n_gram(n: int) -> regex.Pattern:
    """``n`` consecutive words from a word's first to a word's last byte."""
    return regex.compile(rb"(?<![^ ])(?:[^ ]++ ){%d}[^ ]++(?![^ ])" % (n - 1))


def scan(text: str, patterns: list[regex.Pattern]) -> tuple[int, np.ndarray]:
    """Number of words, and the CRC of every word and of every match of ``patterns``."""
    words = text.encode("utf-8").translate(_FOLDED).split()
    line = b" ".join(words)
    found = [np.fromiter((crc32(m[0]) for m in p.finditer(line, overlapped=True)), np.uint32) for p in patterns]
    return len(words), np.concatenate([np.fromiter(map(crc32, words), np.uint32, len(words)), *found])


def features(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(id, text) -> (id, n_words, n_features, buckets): the bucket of every n-gram as little-endian numbers.  Null text counts as empty."""
    patterns, kind = [n_gram(n) for n in range(2, longest + 1)], _kind(buckets)
    id_type = texts.schema["id"].dataType

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, whole in chunks(batches, 1):
            rows = [scan(t, patterns) for t in whole]
            found = [(crcs % np.uint32(buckets)).astype(kind).tobytes() for _, crcs in rows]
            sizes = pa.array([len(crcs) for _, crcs in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([n for n, _ in rows], pa.int64()), sizes, pa.array(found, pa.binary())], ["id", "n_words", "n_features", "buckets"])

    return texts.select("id", "text").mapInArrow(scanned, f"id {id_type.simpleString()}, n_words bigint, n_features bigint, buckets binary")


def _kind(buckets: int) -> str:
    return "<u2" if buckets <= 1 << 16 else "<u4"


def counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many n-grams each bucket holds.  Tasks send a row per bucket, the driver gets at most ``buckets`` rows."""
    kind = _kind(buckets)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                total += np.bincount(np.frombuffer(value.as_buffer(), kind), minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], ["bucket", "n"])

    rows = scanned.select("buckets").mapInArrow(summed, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(buckets, np.int64)
    for row in rows:
        total[row["bucket"]] = row["n"]
    return total


def gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """Per bucket, thousandths of the log ratio of its smoothed shares, rounded down."""
    n, all_target, all_source = len(source), float(target.sum() + len(target)), float(source.sum() + len(source))
    return np.array([math.floor(1000 * math.log((float(target[i]) + 1) * all_source / ((float(source[i]) + 1) * all_target))) for i in range(n)], np.int64)


def _weights(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    kind, id_type = _kind(len(gain)), scanned.schema["id"].dataType

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = [int(gain[np.frombuffer(v.as_buffer(), kind)].sum()) for v in batch.column(3)]
            mean = [s // n if n else 0 for s, n in zip(sums, batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(mean, pa.int64())], ["id", "n_words", "n_features", "weight"])

    return scanned.select("id", "n_words", "n_features", "buckets").mapInArrow(weighed, f"id {id_type.simpleString()}, n_words bigint, n_features bigint, weight bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from eight hex digits of a digest over seed and id; a null id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _ranked(scored: DataFrame, share: int) -> DataFrame:
    """Adds rank to the rows drawn: by score from the highest, then by id, null last.

    Equal rows are counted first (in ``SALTS`` parts), so repeats of one row meet
    as a few numbers.  Rows per score are summed and only these totals - scores
    are whole thousandths of logarithms, some ten thousand values at any size -
    get a running sum in one task; inside a score a window goes by id.
    """
    columns = scored.columns
    # The rows come from a stored table, so their numbers stay the same when a task runs again.
    salted = scored.withColumn("_salt", F.monotonically_increasing_id() % SALTS)
    rows = salted.groupBy(*columns, "_salt").agg(F.count("*").alias("_n"))
    totals = stored(rows.filter("can").groupBy("score").agg(F.sum("_n").alias("_rows")), "score-totals")
    wanted = (totals.agg(F.sum("_rows")).first()[0] or 0) * share // 100
    before = W.orderBy(F.col("score").desc()).rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).filter(F.col("_before") < wanted).drop("_rows")
    inside = W.partitionBy("score", "can").orderBy(F.col("id").asc_nulls_last(), *[c for c in columns if c not in ("id", "score", "can")], "_salt").rowsBetween(W.unboundedPreceding, -1)
    placed = null_safe_join(rows, offsets, ["score"], "left").withColumn("_at", F.col("_before") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    each = placed.select(*columns, "_at", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_no"))
    rank = F.col("_at") + F.col("_no")
    return each.withColumn("rank", F.when(F.col("can") & (rank <= wanted), rank)).drop("_at", "_no")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST,
             least_words: int = LEAST_WORDS, share: int = SHARE, seed: int = SEED) -> DataFrame:
    """A row per document: its id, n_words, n_features, weight, score, and rank where it is drawn.

    ``target`` needs the column ``text`` only.  Null and empty texts have no
    features and weight 0; they are never drawn unless ``least_words`` is 0.  A null
    id has the noise of an empty one and stands last among equal scores.  Repeated
    rows are rows of their own and take consecutive ranks.  Without documents the
    result is empty, without target texts all gains come from the documents alone.
    Other columns of the input are not read.
    """
    scanned = stored(features(docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")), buckets, longest), "n-gram-buckets")
    aimed = features(target.select(F.lit(0).alias("id"), "text"), buckets, longest)
    gain = gains(counts(aimed, buckets), counts(scanned, buckets))
    weighed = _weights(scanned, gain)
    scored = weighed.withColumns({"score": F.col("weight") + noise(F.col("id"), seed), "can": F.col("n_words") >= least_words})
    return _ranked(scored, share).select(F.col("id").alias(doc_id), "n_words", "n_features", "weight", "score", "rank")
