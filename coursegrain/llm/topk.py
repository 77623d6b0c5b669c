"""Exact top-k by inner product with norm-bucketed retrieval.

Vectors are grouped by length into bands, longest first; a band too large for one
task is cut by hash.  Every query first meets a part of the longest band: its k-th
score there is a lower bound for the final one.  With it, a bucket of greatest
length ``l`` can hold an answer only if the cosine reaches bound / (|q| l), the
local threshold.  A query visits only bands where that is at most one.  Inside a
bucket each query picks the cheaper pruning: by length (the prefix of vectors long
enough) or by coordinate (sorted lists of the normalised coordinates; on the
query's largest coordinates a vector must lie within an interval that follows from
the threshold).  What is left is verified with the exact integer product.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import stored

K = 5
SCALE = 256
BANDS = 16
#: Candidates and queries that meet in one task at most (about, as they are cut by hash).
BUCKET_ROWS = 16384
QUERY_ROWS = 4096
#: Coordinates of a query that the coordinate pruning looks at.
FOCUS = 4
#: Guards the pruning against rounding.
SLACK = 1e-9
#: Products below this size are exact in double precision.
SAFE = 2.0**52

_FOUND = "query_id long, vec_id long, score long"


def sound(vector: Column) -> Column:
    """Neither null nor holding null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, ints, norm) of the vectors that take part.  Rows that repeat an id count once, with the smallest vector; null ids take no part."""
    whole = F.transform(F.col(f"`{embedding}`"), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.filter(sound(F.col(f"`{embedding}`")) & F.col(f"`{vec_id}`").isNotNull()).select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), whole.alias("ints"))
    norm = F.sqrt(F.aggregate("ints", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return rows.groupBy("vec_id").agg(F.min("ints").alias("ints")).withColumn("norm", norm)


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    """Integer rows; shorter vectors are filled up with zeros."""
    out = np.zeros((len(rows), width), dtype=np.int64)
    for n, row in enumerate(rows):
        out[n, : len(row)] = row
    return out


class Bucket:
    """Candidates by descending length, with sorted lists of their normalised coordinates."""

    def __init__(self, ids: np.ndarray, ints: np.ndarray, norms: np.ndarray) -> None:
        order = np.lexsort((ids, -norms))
        self.ids, self.ints, self.norms = ids[order], ints[order], norms[order]
        self.exact = self.ints.astype(np.float64)
        unit = self.exact / np.where(self.norms > 0, self.norms, 1.0)[:, None]
        self.unit = unit
        self.lists = np.argsort(unit, axis=0, kind="stable")
        self.values = np.take_along_axis(unit, self.lists, axis=0)

    def candidates(self, query: np.ndarray, norm: float, bound: float) -> np.ndarray | slice | None:
        """Positions that may reach ``bound``; a slice where length pruning is the better one."""
        if not bound > 0 or norm == 0:
            return slice(None)
        local = bound / (norm * self.norms[0]) - SLACK if self.norms[0] > 0 else 2.0
        if local > 1:
            return None
        enough = int(np.searchsorted(-self.norms, -(bound / norm) * (1 - SLACK), side="right"))
        if enough == 0:
            return None
        if local <= 0:
            return slice(0, enough)
        unit = query / norm
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        spread = np.arccos(min(local, 1.0)) + SLACK
        angle = np.arccos(np.clip(unit[focus], -1, 1))
        low = np.where(angle + spread >= np.pi, -1.1, np.cos(np.minimum(angle + spread, np.pi))) - SLACK
        high = np.where(angle - spread <= 0, 1.1, np.cos(np.maximum(angle - spread, 0))) + SLACK
        ends = [(np.searchsorted(self.values[:, f], a), np.searchsorted(self.values[:, f], b, side="right")) for f, a, b in zip(focus, low, high, strict=True)]
        sizes = [b - a for a, b in ends]
        best = int(np.argmin(sizes))
        if 2 * sizes[best] >= enough:
            return slice(0, enough)
        at = self.lists[ends[best][0] : ends[best][1], focus[best]]
        at = at[at < enough]
        for n, f in enumerate(focus):
            if n != best:
                at = at[(self.unit[at, f] >= low[n]) & (self.unit[at, f] <= high[n])]
        return at

    def search(self, query_id: int, query: np.ndarray, norm: float, bound: float, k: int) -> tuple[np.ndarray, np.ndarray]:
        at = self.candidates(query.astype(np.float64), norm, bound)
        if at is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if norm * self.norms[0] < SAFE:
            scores = np.rint(self.exact[at] @ query.astype(np.float64)).astype(np.int64)
        else:
            scores = self.ints[at] @ query
        ids = self.ids[at]
        good = ids != query_id
        if bound > -np.inf:
            good &= scores >= bound
        ids, scores = ids[good], scores[good]
        if len(ids) > 8 * k:
            least = np.partition(scores, len(scores) - k)[len(scores) - k]
            ids, scores = ids[scores >= least], scores[scores >= least]
        first = np.lexsort((ids, -scores))[:k]
        return ids[first], scores[first]


def _meet(queries: DataFrame, candidates: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of each query in each bucket; both sides carry (bucket, block)."""

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(left) and len(right):
            width = max(left["q_ints"].map(len).max(), right["ints"].map(len).max(), 1)
            bucket = Bucket(right["vec_id"].to_numpy(), _matrix(right["ints"], width), right["norm"].to_numpy())
            for query_id, query, norm, bound in zip(left["q_id"], _matrix(left["q_ints"], width), left["q_norm"], left["bound"], strict=True):
                ids, scores = bucket.search(query_id, query, norm, bound, k)
                rows.append(pd.DataFrame({"query_id": query_id, "vec_id": ids, "score": scores}))
        return pd.concat(rows) if rows else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    return queries.groupBy("bucket", "block").cogroup(candidates.groupBy("bucket", "block")).applyInPandas(search, _FOUND)


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``quantised`` vectors -> query_id, rank, vec_id, score: the ``k`` largest products of each query, ties to the smaller id.

    Candidates are all vectors but the query's own.  The driver sees the bands only
    (at most ``BANDS`` rows).  Shorter vectors count as filled up with zeros.
    """
    vectors = stored(vectors, "topk-vectors")
    edges = vectors.agg(F.percentile_approx("norm", [n / BANDS for n in range(1, BANDS)], 10000).alias("e")).first()["e"] or []
    band = F.size(F.filter(F.array(*[F.lit(float(e)) for e in sorted(set(edges))]), lambda e: e > F.col("norm"))) if edges else F.lit(0)
    vectors = vectors.withColumns({"band": band, "is_query": is_query})
    bands = {r["band"]: r for r in vectors.groupBy("band").agg(F.count("*").alias("n"), F.max("norm").alias("longest"), F.sum(F.col("is_query").cast("long")).alias("queries")).collect()}
    blocks = max(1, -(-sum(r["queries"] for r in bands.values()) // QUERY_ROWS))
    pieces = {b: -(-r["n"] // BUCKET_ROWS) for b, r in bands.items()}
    numbers = {b: n for n, b in enumerate(sorted(bands))}
    start = {b: sum(pieces[c] for c in numbers if c < b) for b in numbers}
    of = lambda table, key: F.get(F.array(*[F.lit(table.get(n, 0)) for n in range(max(table, default=0) + 1)]), key)
    hashed = F.xxhash64("vec_id")
    bucket = of(start, F.col("band")) + F.pmod(hashed, F.greatest(of(pieces, F.col("band")), F.lit(1))).cast("int")
    candidates = vectors.withColumn("bucket", bucket).select("bucket", "vec_id", "ints", "norm", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    queries = vectors.filter("is_query").withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int"))
    queries = queries.select("block", F.col("vec_id").alias("q_id"), F.col("ints").alias("q_ints"), F.col("norm").alias("q_norm"))

    first = candidates.filter(F.col("bucket") == 0)
    seeds = _meet(queries.withColumns({"bucket": F.lit(0), "bound": F.lit(float("-inf"))}), first, k)
    bounds = seeds.groupBy("query_id").agg(F.min("score").alias("least"), F.count("*").alias("n")).filter(F.col("n") >= k).select("query_id", F.col("least").cast("double").alias("seed"))
    bounded = queries.join(bounds, F.col("q_id") == F.col("query_id"), "left").withColumn("bound", F.coalesce("seed", F.lit(float("-inf")))).drop("query_id", "seed")
    options = [F.struct(F.lit(start[b]).alias("start"), F.lit(pieces[b]).alias("pieces"), F.lit(float(bands[b]["longest"])).alias("longest")) for b in numbers]
    if not options:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    reach = F.filter(F.array(*options), lambda o: (F.col("bound") <= 0) | (F.col("q_norm") * o["longest"] * (1 + SLACK) >= F.col("bound")))
    visits = bounded.withColumn("visit", F.explode(F.flatten(F.transform(reach, lambda o: F.sequence(o["start"], o["start"] + o["pieces"] - 1))))).withColumnRenamed("visit", "bucket")
    found = _meet(visits, candidates, k)
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
