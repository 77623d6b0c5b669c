"""Approximate nearest neighbours with balanced posting lists.

Centroids are fitted on a bounded sample of directions: k-means with a size
penalty, so that lists come out balanced.  They are held in memory with a graph of
near centroids, which is walked best-first to find the centroids next to a vector.
Every vector goes to its nearest centroid's list and, if it lies near a border, to
further ones: those at most ``BORDER`` times as far as the nearest.  A query reads
the lists of its nearest centroids, of those only what is at most ``REACH`` times,
or a margin, further than its nearest one (more where these hold too few vectors
for an answer); the vectors there are scored exactly.  How many lists and which
margin are set per run: for up to ``CALIBRATION`` queries all vectors are scored,
and from ``PROBES`` lists on both grow, up to all lists, until ``TARGET`` of these
queries' neighbours are in the lists read.  A list too long for one task is cut by hash and read piece by piece.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .base import stored
from .topk import sound

K = 5
#: Rows that the centroids are fitted on at most.
SAMPLE_ROWS = 20_000
#: Vectors per centroid aimed at, up to MOST_LISTS centroids.
LIST_ROWS = 256
MOST_LISTS = 4096
COPIES = 6
BORDER = 1.15
#: Lists that a query reads at least, if they are within reach.
PROBES = 40
REACH = 1.2
#: Queries at most whose exact neighbours set the lists that all queries read, and the share of them to be found.
CALIBRATION = 200
TARGET = 0.97
#: Queries that are scored against a list's piece at a time, and pairs whose final scores are taken at a time.
QUERY_ROWS = 256
PAIR_ROWS = 65536
#: Vectors of a list that one task scores at most (about).
PIECE_ROWS = 8192
DEGREE = 16
ROUNDS = 10
PENALTY = 0.05


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the vectors that take part: finite, not null and not zero.  Rows that repeat an id count once, with the smallest vector; null ids take no part."""
    vector = F.col(f"`{embedding}`")
    some = F.exists(vector, lambda x: x != 0)
    rows = vectors.filter(sound(vector) & some & F.col(f"`{vec_id}`").isNotNull())
    return rows.groupBy(F.col(f"`{vec_id}`").cast("long").alias("vec_id")).agg(F.min(F.transform(vector, lambda x: x.cast("double"))).alias("vector"))


def _matrix(rows: pd.Series, width: int | None = None) -> np.ndarray:
    """Rows as a matrix; shorter ones filled up with zeros, longer ones cut at ``width``, which only the choice of lists uses."""
    width = width or max(map(len, rows))
    out = np.zeros((len(rows), width))
    for n, row in enumerate(rows):
        out[n, : len(row)] = row[:width]
    return out


def _directions(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so that no square overflows or vanishes."""
    rows = rows / np.maximum(np.abs(rows).max(axis=1, keepdims=True, initial=0), np.finfo(float).tiny)
    return rows / np.maximum(np.sqrt((rows * rows).sum(axis=1, keepdims=True)), np.finfo(float).tiny)


def fit_centroids(rows: np.ndarray, count: int) -> np.ndarray:
    """Lloyd's rounds with a penalty on full lists; a list that ran empty restarts beside the fullest."""
    turns = np.random.default_rng(11)
    centroids = rows[turns.choice(len(rows), count, replace=False)].copy()
    load = np.zeros(count)
    for _ in range(ROUNDS):
        cost = (centroids * centroids).sum(axis=1) - 2 * rows @ centroids.T + PENALTY * load * count / len(rows)
        owner = np.argmin(cost, axis=1)
        load = np.bincount(owner, minlength=count).astype(float)
        sums = np.zeros_like(centroids)
        np.add.at(sums, owner, rows)
        filled = load > 0
        centroids[filled] = sums[filled] / load[filled, None]
        for gap in np.flatnonzero(~filled):
            members = np.flatnonzero(owner == np.argmax(load))
            centroids[gap] = rows[turns.choice(members)]
    return np.unique(centroids, axis=0)


class Graph:
    """Centroids linked with their nearest ones and a few others."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        count = len(centroids)
        self.squares = (centroids * centroids).sum(axis=1)
        degree = min(DEGREE, count - 1)
        near = np.empty((count, degree), dtype=np.int64)
        for begin in range(0, count, 1024):
            part = slice(begin, min(begin + 1024, count))
            far = self.squares - 2 * centroids[part] @ centroids.T
            far[np.arange(part.stop - begin), np.arange(begin, part.stop)] = np.inf
            near[part] = np.argsort(far, axis=1, kind="stable")[:, :degree]
        distant = np.random.default_rng(13).integers(0, count, (count, 4))
        self.links = np.concatenate([near, distant], axis=1)
        self.entries = np.unique(np.linspace(0, count - 1, min(count, 24)).astype(np.int64))

    def search(self, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Per row the ``width`` nearest centroids that a best-first walk finds, and their distances, nearest first.

        All rows walk at once: each step opens every row's nearest centroid not
        opened yet, until none is left in its pool.
        """
        count, total = len(rows), len(self.centroids)
        width = min(width, total)
        if width == total or (width > PROBES and width * self.links.shape[1] >= total):
            return self._ranked(rows, width)
        keep = min(total, max(width, 24))
        own = (rows * rows).sum(axis=1)

        def distance(at: np.ndarray) -> np.ndarray:
            found = self.centroids[at]
            return self.squares[at] - 2 * np.einsum("nkd,nd->nk", found, rows) + own[:, None][: len(at)]

        seen = np.zeros((count, total), dtype=bool)
        pool = np.tile(self.entries, (count, 1))
        seen[:, self.entries] = True
        far = distance(pool)
        opened = np.zeros(pool.shape, dtype=bool)
        lines = np.arange(count)[:, None]
        while True:
            waiting = np.where(opened, np.inf, far)
            next_at = np.argmin(waiting, axis=1)
            if not np.isfinite(waiting[lines[:, 0], next_at]).any():
                break
            active = np.isfinite(waiting[lines[:, 0], next_at])
            opened[lines[active, 0], next_at[active]] = True
            fresh = self.links[pool[lines[:, 0], next_at]]
            new = ~seen[lines, fresh] & active[:, None]
            order = np.argsort(fresh, axis=1, kind="stable")  # a link listed twice counts once
            ranked = np.take_along_axis(fresh, order, axis=1)
            twice = np.zeros(new.shape, dtype=bool)
            np.put_along_axis(twice, order, np.concatenate([np.zeros((count, 1), bool), ranked[:, 1:] == ranked[:, :-1]], axis=1), axis=1)
            new &= ~twice
            seen[lines.repeat(fresh.shape[1], 1)[new], fresh[new]] = True
            pool = np.concatenate([pool, fresh], axis=1)
            far = np.concatenate([far, np.where(new, distance(fresh), np.inf)], axis=1)
            opened = np.concatenate([opened, ~new], axis=1)
            best = np.argsort(far, axis=1, kind="stable")[:, :keep]
            pool, far, opened = (np.take_along_axis(x, best, axis=1) for x in (pool, far, opened))
        order = np.argsort(far, axis=1, kind="stable")[:, :width]
        return np.take_along_axis(pool, order, axis=1), np.sqrt(np.maximum(np.take_along_axis(far, order, axis=1), 0))


    def _ranked(self, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``search`` by the distances to all centroids, for a width at which the walk would look at most of them."""
        found = [np.zeros((0, width), dtype=np.int64)], [np.zeros((0, width))]
        for begin in range(0, len(rows), 256):
            part = rows[begin : begin + 256]
            far = self.squares - 2 * part @ self.centroids.T + (part * part).sum(axis=1)[:, None]
            at = np.argsort(far, axis=1, kind="stable")[:, :width]
            found[0].append(at)
            found[1].append(np.sqrt(np.maximum(np.take_along_axis(far, at, axis=1), 0)))
        return np.concatenate(found[0]), np.concatenate(found[1])


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _scored(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest of ``right`` (vec_id, vector) for each of ``left`` (query_id, query), none a query itself."""
    parts = [pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})]
    if len(left) and len(right):
        width = max(left["query"].map(len).max(), right["vector"].map(len).max())
        ids, rows = right["vec_id"].to_numpy(), _directions(_matrix(right["vector"], width))
        for begin in range(0, len(left), QUERY_ROWS):
            part = left.iloc[begin : begin + QUERY_ROWS]
            own, asked = part["query_id"].to_numpy(), _directions(_matrix(part["query"], width))
            cosine = asked @ rows.T
            cosine[own[:, None] == ids] = -np.inf
            least = np.partition(cosine, max(len(ids) - k, 0), axis=1)[:, max(len(ids) - k, 0)]
            # Equal vectors may differ in the last digits of a product of matrices, so what is near the k-th is scored again alike.
            q, v = np.nonzero((cosine >= least[:, None] - 1e-12) & (cosine > -np.inf))
            score = np.concatenate([np.zeros(0), *(np.einsum("nd,nd->n", asked[q[i : i + PAIR_ROWS]], rows[v[i : i + PAIR_ROWS]]) for i in range(0, len(q), PAIR_ROWS))])
            order = np.lexsort((ids[v], -score, q))
            q, v, score = q[order], v[order], score[order]
            first = np.arange(len(q)) - np.searchsorted(q, q) < k
            parts.append(pd.DataFrame({"query_id": own[q[first]], "vec_id": ids[v[first]], "score": score[first]}))
    return pd.concat(parts)


def _calibrated(vectors: DataFrame, queries: DataFrame, index: DataFrame, graph: Graph, k: int) -> tuple[int, float]:
    """(number of lists, margin) with which a bounded set of queries finds ``TARGET`` of its exact neighbours.

    The driver sees these queries and the lists of their neighbours.
    """
    asked = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(CALIBRATION).toPandas()
    if not len(asked):
        return PROBES, 0.0
    left = asked.set_axis(["query_id", "query"], axis=1)

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for begin in range(0, len(batch), PIECE_ROWS):
                found = _scored(left, batch.iloc[begin : begin + PIECE_ROWS], k)
                held = found if held is None else pd.concat([held, found]).sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True]).groupby("query_id").head(k)
        if held is not None:
            yield held

    truth = _best(vectors.select("vec_id", "vector").mapInPandas(exact, "query_id long, vec_id long, score double"), k).select("query_id", "vec_id")
    near = index.select("vec_id", "list").join(F.broadcast(truth), "vec_id").groupBy("query_id", "vec_id").agg(F.collect_set("list").alias("lists")).collect()
    if not near:
        return PROBES, 0.0
    rows = _directions(_matrix(left["query"], graph.centroids.shape[1]))
    line = {q: n for n, q in enumerate(left["query_id"])}
    most = PROBES
    while True:
        at, far = graph.search(rows, most)
        missing = np.full((len(rows), len(graph.centroids)), np.inf)
        np.put_along_axis(missing, at, np.where(far <= REACH * far[:, :1], 0, far - far[:, :1]), axis=1)
        margins = np.sort([missing[line[r["query_id"]], r["lists"]].min() for r in near])
        margin = margins[int(np.ceil(TARGET * len(margins))) - 1]
        if np.isfinite(margin):
            return most, float(margin)
        most *= 2


def _lists(vectors: DataFrame, graph: Graph, most: int, ratio: float, sizes: np.ndarray | None = None, least: int = 0, margin: float = 0.0) -> DataFrame:
    """``vectors`` plus lists: the centroids whose distance is within ``ratio`` of the nearest one's, or at most ``margin`` more.

    With list sizes, further lists follow until they hold ``least`` entries; where
    the walk's lists hold fewer, all lists are taken.
    """
    width = graph.centroids.shape[1]

    @F.pandas_udf("array<int>")
    def near(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = []
            for begin in range(0, len(batch), 1024):
                rows = _directions(_matrix(batch.iloc[begin : begin + 1024], width))
                at, far = graph.search(rows, most)
                within = (far <= ratio * far[:, :1]) | (far - far[:, :1] <= margin)
                chosen = [a[w] for a, w in zip(at, within, strict=True)]
                if sizes is not None:
                    held = np.cumsum(sizes[at], axis=1)
                    within |= held - sizes[at] < least
                    chosen = [a[w] if h[-1] >= least else np.arange(len(sizes)) for a, w, h in zip(at, within, held, strict=True)]
                found += [c.astype(np.int32) for c in chosen]
            yield pd.Series(found, dtype=object)

    return vectors.withColumn("lists", near("vector"))


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``usable`` vectors -> query_id, rank, vec_id, score: nearest by cosine first, ties to the smaller id.

    Every vector is indexed.  Candidates are all vectors but the query's own.  The
    driver sees the sample's size, the centroids, the list sizes and the calibration only.  Vectors
    of other dimensions count as filled up with zeros.
    """
    vectors = stored(vectors, "neighbour-vectors")
    spark = vectors.sparkSession
    total = vectors.count()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not total:
        return empty
    share = min(1.0, SAMPLE_ROWS / total)
    count = int(min(max(total / LIST_ROWS, 1), MOST_LISTS))
    chosen = vectors.filter(F.xxhash64("vec_id").cast("double") / 2.0**64 + 0.5 <= share)

    def fitted(_: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        unit = np.unique(_directions(_matrix(rows.sort_values("vec_id")["vector"])), axis=0)
        found = fit_centroids(unit, min(count, len(unit)))
        return pd.DataFrame({"width": [found.shape[1]], "centroids": [found.tobytes()]})

    # A bounded sample: about SAMPLE_ROWS rows meet in this one task.
    model = chosen.groupBy(F.lit(1).alias("one")).applyInPandas(fitted, "width int, centroids binary").collect() or vectors.orderBy("vec_id").limit(1).groupBy(F.lit(1).alias("one")).applyInPandas(fitted, "width int, centroids binary").collect()
    graph = Graph(np.frombuffer(model[0]["centroids"]).reshape(-1, model[0]["width"]))

    index = stored(_lists(vectors, graph, COPIES, BORDER).select("vec_id", "vector", F.explode("lists").alias("list")), "neighbour-lists")
    sizes = {r["list"]: r["n"] for r in index.groupBy("list").agg(F.count("*").alias("n")).collect()}
    pieces = F.array(*[F.lit(-(-sizes.get(n, 0) // PIECE_ROWS)) for n in range(len(graph.centroids))])
    cut = index.withColumn("piece", F.pmod(F.xxhash64("vec_id"), F.greatest(F.get(pieces, F.col("list")), F.lit(1))).cast("int"))
    most, margin = _calibrated(vectors, vectors.filter(is_query), index, graph, k)
    held = np.array([sizes.get(n, 0) for n in range(len(graph.centroids))])
    queries = _lists(vectors.filter(is_query), graph, most, REACH, held, COPIES * (k + 1), margin)
    queries = queries.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.explode("lists").alias("q_list"))
    queries = queries.withColumn("q_piece", F.explode(F.sequence(F.lit(0), F.greatest(F.get(pieces, F.col("q_list")), F.lit(1)) - 1)))

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _scored(left, right, k)

    found = queries.groupBy("q_list", "q_piece").cogroup(cut.groupBy("list", "piece")).applyInPandas(score, "query_id long, vec_id long, score double")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return _best(once, k)
