"""Mixing sources to target weights: hash-random order, prefix sums, exact cuts.

Every document gets a hash-random key.  A source's documents are range-sorted by
that key: the key space is cut into ``CHUNKS`` equal ranges, so a source with a
third of all rows is spread over as many groups.  Words per (source, range) are
summed first; prefix sums over those totals (at most ``CHUNKS`` rows a source)
give each range its offset and a window inside the range gives each document its
own.  A range crowded by rows of one id is cut further, by size and by a hash of
the row, in the order of the mix.  A source whose target is ``e`` times its size plus a rest takes every
document ``e`` times and, in key order, words up to the rest once more; the
document on the cut is taken in part, so that each source meets its rounded
target exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.scan import null_safe_join
from .base import WORD, hash60, packed, replaced, stored, unpacked

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Equal ranges of the random key within one source.
CHUNKS = 4096
#: A range of more rows than this and than CROWDED times its source's mean is cut further.
CROWD_ROWS = 10_000
CROWDED = 4
SEED = "mix:"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) -> with target.

    Sources in code point order (null last) take the weights in turn and share
    the sum of all sizes by weight.  A target stops at ``max_epochs`` times its
    source's size and the excess is shared anew by weight until none is above.
    That fixed point is ``least(cap, level * weight)``; with the sources ordered
    by cap / weight, ``level`` is the largest of (words left) / (weight left).
    One row per source is windowed here, never one per document.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy(F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    left = lambda c: F.sum(c).over(everything) - F.coalesce(F.sum(c).over(before), F.lit(0))
    return (
        totals.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), turn + 1).cast("long"))
        .withColumn("_cap", F.col("source_size") * max_epochs)
        .withColumn("_words_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_weight_left", left("_weight"))
        .withColumn("_level", F.max(F.col("_words_left") / F.col("_weight_left")).over(everything))
        .withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_weight")))
        .select("source", "source_size", "target")
    )


def _parts(sized: DataFrame, chunks: DataFrame, offsets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``sized`` and ``offsets`` by source, chunk and part: the whole of a range, or of a crowded one rows of equal key and size in 256 ranges of the row's hash.

    A crowded range gives at most 256 totals for each size of an id, and the
    ranges of the hash follow the order of rows inside it.
    """
    mean = chunks.groupBy("source").agg((F.sum("rows") / CHUNKS).alias("mean"))
    crowded = null_safe_join(chunks, mean, ["source"]).filter((F.col("rows") > CROWD_ROWS) & (F.col("rows") > CROWDED * F.col("mean")))
    crowded = stored(crowded.select("source", "chunk", F.lit(True).alias("crowded")), "mix-crowded")
    if crowded.isEmpty():
        return sized.withColumn("part", F.lit(0)), offsets.withColumn("part", F.lit(0))
    part = F.when(F.col("crowded"), F.struct("pos", "key", "size", F.shiftright("row_hash", 56).alias("range")))
    sized = null_safe_join(sized, crowded, ["source", "chunk"], "left").withColumn("part", part).drop("crowded")
    totals = stored(sized.groupBy("source", "chunk", "part").agg(F.sum("size").alias("words")), "mix-parts")
    earlier = W.partitionBy("source", "chunk").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    inside = totals.withColumn("_inside", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words")
    offsets = null_safe_join(inside, offsets, ["source", "chunk"])
    return sized, offsets.withColumn("_before", F.col("_before") + F.col("_inside")).drop("_inside")


def mix(
    docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED, words: str | None = None,
) -> DataFrame:
    """All rows and columns of ``docs`` plus size, source_size, target and taken.

    ``words`` names a column of word counts; without it the words of ``text`` are
    counted and ``docs`` is read twice as a whole.

    ``size`` counts words (null or blank text: 0, never taken), ``taken`` the
    words the mix takes from the row, repeats counted.  Null sources are a source
    of their own.  Rows that repeat an id are mixed one by one; ties of the key
    fall to id, size and a hash of the row.  The keys are a function of the id, so reruns
    agree.  Input columns named like an output are replaced.
    """
    sized = packed(
        docs, source=F.col(f"`{source}`"), size=word_count(F.col(f"`{text}`")) if words is None else F.coalesce(F.col(f"`{words}`"), F.lit(0)).cast("long"),
        pos=hash60(F.col(f"`{key}`"), seed), key=F.col(f"`{key}`"), row_hash=F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]),
    ).withColumn("chunk", F.shiftright("pos", 60 - CHUNKS.bit_length() + 1).cast("int"))

    chunks = stored(sized.groupBy("source", "chunk").agg(F.sum("size").alias("words"), F.count("*").alias("rows")), "mix-chunks")
    goals = targets(chunks.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    budget = F.round("target").cast("long")
    goals = goals.withColumn("_epochs", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long"))
    goals = goals.withColumn("_rest", budget - F.col("_epochs") * F.col("source_size"))
    earlier = W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    offsets = null_safe_join(chunks.withColumn("_before", F.coalesce(F.sum("words").over(earlier), F.lit(0))).drop("words", "rows"), goals, ["source"])

    sized, offsets = _parts(sized, chunks, offsets)
    joined = null_safe_join(sized, offsets, ["source", "chunk", "part"])
    order = W.partitionBy("source", "chunk", "part").orderBy("pos", "key", "size", "row_hash").rowsBetween(W.unboundedPreceding, -1)
    before = F.col("_before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    once_more = F.greatest(F.lit(0), F.least(F.col("size"), F.col("_rest") - before))
    taken = joined.withColumn("taken", (F.col("_epochs") * F.col("size") + once_more).cast("long"))
    return unpacked(taken, docs.columns, "size", "source_size", "target", "taken")


def mixed_rows(
    docs: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", n_chars: str = "n_chars", **options,
) -> DataFrame:
    """The mixed corpus itself: a row per copy taken, columns as in ``docs``.

    The row on a source's cut keeps the leading words that the budget allows,
    with the white space between them.
    """
    whole = F.col(f"`{text}`")
    plan = mix(packed(docs, text=whole, doc_id=F.col(f"`{key}`"), source=F.col(f"`{source}`"), words=word_count(whole)), words="words", **options)
    copies = F.ceil(F.col("taken") / F.col("size"))
    rows = plan.filter("taken > 0").withColumn("no", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
    words = F.least(F.col("size"), F.col("taken") - (F.col("no") - 1) * F.col("size"))
    pieces = F.regexp_extract_all("text", F.lit(rf"[\x20\x09-\x0D]*{WORD}"), F.lit(0))
    cut = F.array_join(F.slice(pieces, F.lit(1), words.cast("int")), "")
    rows = rows.withColumn("text", F.when(words == F.col("size"), F.col("text")).otherwise(cut))
    return replaced(rows, docs, text, n_chars)
