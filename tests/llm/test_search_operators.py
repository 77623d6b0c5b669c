"""Set join, exact and approximate search and the pipeline on small tables, against brute force."""

import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from coursegrain.llm import graph, neighbours, setjoin, topk

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def classes(rows):
    """Row number -> (number of shingles, smallest linked id)."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * len(a) <= 5 * len(b) and 4 * len(b) <= 5 * len(a) and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (no, _) in enumerate(rows):
        ids[find(i)].append(no)
    least = {r: min((i for i in v if i is not None), default=None) for r, v in ids.items()}
    return [(no, len(sets[i]), least[find(i)] if sets[i] else no) for i, (no, _) in enumerate(rows)]


def near_copies(turns, base, count, edits):
    out = []
    for _ in range(count):
        words = base.split()
        for _ in range(turns.randint(0, edits)):
            words[turns.randrange(len(words))] = f"w{turns.randrange(10**6)}"
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def texts():
    turns = random.Random(8)
    word = lambda: "".join(turns.choice("abcdefgh") for _ in range(5))
    shared = " ".join(word() for _ in range(40))
    rows = near_copies(turns, " ".join(word() for _ in range(120)), 130, 4)  # a family over the size of a short list
    rows += near_copies(turns, " ".join(word() for _ in range(60)), 20, 2)
    rows += [" ".join(word() for _ in range(turns.randint(5, 80))) + " " + shared for _ in range(90)]
    rows += ["x", "X", "x y z", "x  Y\tz", "", None, "  ", "é É", "a b c d e f", "A b c d e f", "a b c d e g", "  q"]
    rows += [" ".join(word() for _ in range(30_000))] * 2
    made = [(n * 3 % 1000 if n != 5 else None, t) for n, t in enumerate(rows)]
    return [*made, made[0], made[-1], (None, rows[140]), (7, "x")]


def test_set_join_against_brute_force(spark, texts, monkeypatch):
    docs = spark.createDataFrame([(i, t, "c") for i, t in texts], "doc_id long, text string, component_id string").repartition(5)
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in setjoin.link(docs).collect())
    assert got == Counter(classes(texts))
    monkeypatch.setattr(setjoin, "BLOCK_SETS", 40)  # many blocks meet
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in setjoin.link(docs).collect()) == got


def test_set_join_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = classes([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in setjoin.link(docs).collect()) == Counter(want)
    assert setjoin.link(docs.limit(0)).count() == 0


def test_one_document_of_each_class(spark, texts):
    docs = spark.createDataFrame([(i, t, "c") for i, t in texts], "doc_id long, text string, component string")
    kept = setjoin.distinct_documents(docs)
    want = classes(texts)
    whole = {(c, s > 0) for _, s, c in want if s}
    assert kept.columns == docs.columns
    assert kept.filter("text rlike '[^\\\\x20\\\\x09-\\\\x0D]'").count() >= len(whole) and kept.filter("text is null").count() == 1
    again = setjoin.link(kept).filter("n_shingles > 0")
    assert again.groupBy("component").count().filter("count > 1").count() == 0


def test_components(spark):
    turns = random.Random(1)
    edges = [(turns.randrange(300), turns.randrange(300)) for _ in range(220)] + [(n, n + 1) for n in range(400, 460)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {i: find(i) for i in root if find(i) != i}


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rank string")


def vector_rows():
    turns = np.random.default_rng(2)
    base = turns.normal(size=(400, 8)) * turns.uniform(0.01, 3, (400, 1))
    rows = [(n, [float(np.float32(x)) for x in v]) for n, v in enumerate(base)]
    rows += [(n, rows[50][1]) for n in range(400, 460)] + [(460, None), (461, [1.0, None] + [0.0] * 6), (462, [float("nan")] * 8), (463, [float("inf")] * 8), (464, [0.0] * 8), (None, [1.0] * 8)]
    return [*rows, rows[3]]


def usable_rows(zero):
    return {i: np.array(v) for i, v in vector_rows() if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))}


def best(scores, k=5):
    return [(i, s) for i, s in sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]]


@pytest.mark.parametrize("rows_in_a_bucket", [16384, 30])
def test_top_k_against_brute_force(spark, monkeypatch, rows_in_a_bucket):
    monkeypatch.setattr(topk, "BUCKET_ROWS", rows_in_a_bucket)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    ints = {i: np.floor(256 * v).astype(np.int64) for i, v in usable_rows(True).items()}
    want = {(q, n + 1, i, int(s)) for q in ints if q % 10 == 0 for n, (i, s) in enumerate(best({i: int(v @ ints[q]) for i, v in ints.items() if i != q}))}
    got = topk.top_k(topk.quantised(vectors(spark, vector_rows())), F.col("vec_id") % 10 == 0)
    assert {tuple(r) for r in got.collect()} == want
    few = topk.top_k(topk.quantised(vectors(spark, vector_rows()[:3])), F.col("vec_id") % 2 == 0)
    assert few.count() == 4
    assert topk.top_k(topk.quantised(vectors(spark, [])), F.col("vec_id") % 2 == 0).count() == 0


def test_neighbours_recall_and_scores(spark):
    known = usable_rows(False)
    unit = {i: v / np.linalg.norm(v) for i, v in known.items()}
    got = defaultdict(list)
    for r in neighbours.nearest(neighbours.usable(vectors(spark, vector_rows())), F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        assert abs(r["score"] - unit[r["query_id"]] @ unit[r["vec_id"]]) < 1e-12
        got[r["query_id"]].append(r["vec_id"])
    queries = [q for q in known if q % 10 == 0]
    hits = sum(len(set(got[q]) & {i for i, _ in best({i: v @ unit[q] for i, v in unit.items() if i != q})}) for q in queries if not np.allclose(unit[q], unit[50]))
    assert all(len(got[q]) == 5 for q in queries) and hits >= 0.9 * 5 * sum(not np.allclose(unit[q], unit[50]) for q in queries)
    few = neighbours.nearest(neighbours.usable(vectors(spark, vector_rows()[:3])), F.col("vec_id") % 2 == 0)
    assert few.count() == 4
    assert neighbours.nearest(neighbours.usable(vectors(spark, [])), F.col("vec_id") % 2 == 0).count() == 0


def test_neighbours_recall_on_the_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = table.orderBy("vec_id").toPandas()
    unit = np.array(rows["embedding"].tolist(), dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    got = neighbours.nearest(neighbours.usable(table), F.col("vec_id") % 50 == 0).toPandas().groupby("query_id")["vec_id"].apply(set)
    hits = 0
    for q in range(0, len(rows), 50):
        near = unit @ unit[q]
        near[q] = -2
        hits += len(got[q] & set(np.argsort(-near)[:5]))
    assert hits >= 0.9 * 5 * len(got)


def test_neighbours_recall_with_many_lists(spark, monkeypatch):
    """40 of 2,000 lists hold too few of the neighbours here."""
    monkeypatch.setattr(neighbours, "LIST_ROWS", 4)
    turns = np.random.default_rng(5)
    rows = turns.normal(size=(8000, 64)) + 0.5 * turns.normal(size=(10, 64))[turns.integers(0, 10, 8000)]
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    got = defaultdict(set)
    for r in neighbours.nearest(neighbours.usable(vectors(spark, enumerate(rows.tolist()))), F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q in range(0, 8000, 20):
        near = unit @ unit[q]
        near[q] = -2
        hits += len(got[q] & set(np.argsort(-near)[:5].tolist()))
    assert hits >= 0.9 * 5 * 400


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    counts = [docs.count()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SF)
        if number < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == columns
            docs = spark.createDataFrame(made.collect(), made.schema)
            counts.append(docs.count())
    assert made.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and made.count() == counts[-1]
    assert counts[0] > counts[1] > counts[2] == counts[3]
    odd = spark.createDataFrame([(None,) * 5, (1, "", "en", None, 0), (1, "", "en", None, 0)], docs.schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), SF).count() == 0
        stage(spark, odd, SF).collect()


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent / "coursegrain"
    assert not [p for p in root.rglob("*.py") if p.parent.name != "llm" and re.search(r"\bllm\b", p.read_text())]
    assert "coursegrain.llm" in sys.modules
