"""Ordered operators that stay parallel inside one huge group.

A plain ``Window.partitionBy(export_id).orderBy(pos)`` puts a whole package in
one task.  ``prefix_scan`` cuts each group into position ranges, scans the
ranges in parallel, scans only the per-range totals (one row per range) and adds
the carry back through a join.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

RANGE = 1 << 16

_FOLD = {
    "sum": (F.sum, lambda carry, own: F.coalesce(carry, F.lit(0)) + own),
    "max": (F.max, lambda carry, own: F.greatest(carry, own)),
    "min": (F.min, lambda carry, own: F.least(carry, own)),
}


def prefix_scan(
    df: DataFrame,
    keys: list[str],
    pos: str,
    out: dict[str, tuple[str, Column]],
    chunk: Column | None = None,
    in_place: bool = False,
    unmoved: DataFrame | None = None,
) -> DataFrame:
    """Running ``sum``/``max``/``min`` over ``pos`` within ``keys``, current row included.

    ``out`` maps a new column to (fold, value).  ``chunk`` must grow with ``pos``;
    by default it is ``pos`` in ranges of 65,536.

    With ``in_place`` the carry is joined by plain equality, so the rows stay where
    the scan has them, and rows that are together by a part of ``keys`` aren't moved
    at all; a group whose key holds a NULL is one range then.  Ranges that ``df`` brings
    along from ``ranged`` are taken as they are.  ``unmoved`` gives the same rows as they
    were before they moved: their totals are made there and a second copy needn't move.
    """
    if in_place and "_chunk" in df.columns:
        staged = df
    else:
        staged = df.withColumn("_chunk", _range(keys, pos, chunk) if in_place else _range([], pos, chunk))
    values = {f"_v_{n}": v for n, (_, v) in out.items()}
    staged = staged.withColumns(values)
    local = W.partitionBy(*keys, "_chunk").orderBy(pos).rowsBetween(W.unboundedPreceding, 0)
    scanned = staged.withColumns({f"_l_{n}": _FOLD[f][0](f"_v_{n}").over(local) for n, (f, _) in out.items()})

    totals = (staged if unmoved is None else unmoved.withColumns(values)).groupBy(*keys, "_chunk").agg(*[_FOLD[f][0](f"_v_{n}").alias(f"_t_{n}") for n, (f, _) in out.items()])
    before = W.partitionBy(*keys).orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(*keys, "_chunk", *[_FOLD[f][0](f"_t_{n}").over(before).alias(f"_c_{n}") for n, (f, _) in out.items()])
    carried = carry.filter(reduce(lambda a, b: a | b, [F.col(f"_c_{n}").isNotNull() for n in out]))

    joined = scanned.join(carried, [*keys, "_chunk"], "left") if in_place else null_safe_join(scanned, carry, [*keys, "_chunk"])
    result = joined.withColumns(
        {n: _FOLD[f][1](F.col(f"_c_{n}"), F.col(f"_l_{n}")) for n, (f, _) in out.items()}
    )
    return result.select(*df.columns, *out)


def _range(keys: list[str], pos: str, chunk: Column | None) -> Column:
    part = F.floor(F.col(pos) / RANGE) if chunk is None else chunk
    return F.when(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]), part) if keys else part


def ranged(df: DataFrame, keys: list[str], pos: str, chunk: Column | None = None) -> DataFrame:
    """``df`` with its position ranges (``_chunk``), moved once: all rows of a range in one task, the ranges of a group in many.

    Scans ``in_place`` by ``keys`` and whatever else move only the totals of the ranges then.
    """
    return together(with_ranges(df, keys, pos, chunk), *keys, "_chunk")


def with_ranges(df: DataFrame, keys: list[str], pos: str, chunk: Column | None = None) -> DataFrame:
    return df.withColumn("_chunk", _range(keys, pos, chunk))


def together(df: DataFrame, *keys: str) -> DataFrame:
    """All rows of a key in one task: joins, windows and groups by these and further columns need no exchange of their own.

    Without it rows follow the finer keys of each step, at an exchange a step.  Spark
    lets joins use the coarser layout only if the session doesn't ask for all keys.
    """
    df.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return df.repartition(*keys)


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on keys that may be NULL; the right-hand key columns are dropped."""
    renamed = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def first_per(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """First row of each group in a total order.

    The rank filter lets Spark prune each task to one row per group before the
    shuffle, so a group holding most of the table still moves few rows.
    """
    return top_per(df, keys, order, 1).drop("rank_no")


def top_per(df: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    """First ``k`` rows of each group with their rank (a top-k report)."""
    ranked = df.withColumn("rank_no", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank_no") <= k)


def previous(df: DataFrame, keys: list[str], ordinal: str, columns: dict[str, str]) -> DataFrame:
    """Columns of the row with the preceding ordinal, by a join on ordinal + 1.

    Ordinals are consecutive, so this replaces ``lag`` without sorting a group in one task.
    """
    shifted = df.select(*keys, (F.col(ordinal) + 1).alias(ordinal), *[F.col(c).alias(n) for c, n in columns.items()])
    return df.join(shifted, [*keys, ordinal], "left")
