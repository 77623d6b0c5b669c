"""Ordered operators across range borders, with one group holding most of the rows."""

import random
import re

from pyspark.sql import functions as F

from coursegrain.operators import activities, duplicates, tree
from coursegrain.operators.scan import first_per, prefix_scan, together
from coursegrain.sources import sinks


def test_prefix_scan_crosses_ranges(spark):
    random.seed(3)
    rows = [("hot" if i % 10 else f"k{i}", i, random.randint(-5, 5)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, pos bigint, v bigint")
    out = prefix_scan(df, ["k"], "pos", {"s": ("sum", F.col("v")), "m": ("max", F.col("v"))}, chunk=F.floor(F.col("pos") / 37))
    got = {(r.k, r.pos): (r.s, r.m) for r in out.collect()}
    total, top = {}, {}
    for k, pos, v in rows:
        total[k], top[k] = total.get(k, 0) + v, max(top.get(k, v), v)
        assert got[(k, pos)] == (total[k], top[k])


def test_tree_over_small_ranges(spark):
    tokens = [("p", 0, 1), ("p", 1, 1), ("p", 2, 1), ("p", 3, -1), ("p", 4, -1), ("p", 5, 1), ("p", 6, -1), ("p", 7, -1), ("p", 8, 1), ("p", 9, -1)]
    df = spark.createDataFrame(tokens, "export_id string, pos bigint, delta int")
    nodes = tree.depths(df, chunk=F.floor(F.col("pos") / 2))
    pairs = tree.closure(nodes, chunk=F.floor(F.col("pos") / 2))
    linked = {r.pos: (r.depth, r.parent_pos) for r in tree.parents(nodes, pairs).collect()}
    assert linked == {0: (1, None), 1: (2, 0), 2: (3, 1), 5: (2, 0), 8: (1, None)}


def random_tree(seed, size, name):
    """Tokens of a random forest, and per node its depth, parent, end, descendants, titles from the root and whether it is hidden."""
    turns = random.Random(seed)
    tokens, open_nodes, facts, pos = [], [], {}, 0

    def close(pos):
        at = open_nodes.pop()
        facts[at][2], facts[at][3] = pos, sum(1 for n in facts if n > at)
        tokens.append((name, pos, -1, "", False))

    while len(facts) < size or open_nodes:
        if open_nodes and (len(facts) >= size or turns.random() < 0.5):
            close(pos)
        else:
            title, hidden = turns.choice(["", "a", "b", "Week 1"]), turns.random() < 0.15
            up = open_nodes[-1] if open_nodes else None
            trail, covered = (facts[up][4], facts[up][5]) if open_nodes else ([], False)
            facts[pos] = [len(open_nodes) + 1, up, None, None, [*trail, title], hidden or covered]
            open_nodes.append(pos)
            tokens.append((name, pos, 1, title, hidden))
        pos += 1
    return tokens, facts


def test_interval_labels_equal_a_walk(spark):
    forests = {f"p{n}": random_tree(n, size, f"p{n}") for n, size in enumerate((1, 2, 40, 200))}
    rows = [t for tokens, _ in forests.values() for t in tokens]
    df = spark.createDataFrame(rows, "export_id string, pos bigint, delta int, title string, self_hidden boolean")
    chunk = F.floor(F.col("pos") / 7)
    nodes = tree.labels(df, chunk).cache()
    got = {(r.export_id, r.pos): (r.depth, r.parent_pos, r.last_pos, r.descendants) for r in nodes.collect()}
    assert got == {(p, n): tuple(f[:4]) for p, (_, facts) in forests.items() for n, f in facts.items()}
    hidden = {(r.export_id, r.pos): r.is_hidden for r in tree.inherited_hidden(nodes, chunk).collect()}
    assert hidden == {(p, n): f[5] for p, (_, facts) in forests.items() for n, f in facts.items()}
    found = {(r.export_id, r.pos): r.path for r in tree.paths(nodes, "/", chunk).collect()}
    assert found == {(p, n): "/".join(filter(None, f[4])) for p, (_, facts) in forests.items() for n, f in facts.items()}
    counts = {(r.export_id, r.pos): r.descendants for r in tree.descendant_counts(nodes.drop("descendants"), chunk).collect()}
    assert counts == {k: v[3] for k, v in got.items()}
    heads = nodes.filter("depth = 1 and title <> ''").select("export_id", "pos", "title", F.lit("week").alias("role"), F.lit(1).alias("week_no"))
    members = {(r.export_id, r.pos): r.module_pos for r in tree.module_members(heads, nodes, chunk).collect()}
    root = lambda facts, n: n if facts[n][1] is None else root(facts, facts[n][1])
    assert members == {(p, n): root(facts, n) for p, (_, facts) in forests.items() for n in facts if facts[root(facts, n)][4][0] != ""}
    assert tree.labels(df.limit(0)).count() == 0


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[: plan.find("+- == Initial Plan ==")] if "Initial Plan" in plan else plan


def test_trees_are_read_few_times(spark):
    from coursegrain.catalog import QUERIES

    placed, keys = (final_plan(QUERIES[q](spark, "/root/testdata/sf0.001")) for q in ("placement", "structure_keys"))
    assert placed.count("FileScan") <= 6
    assert len(re.findall(r"[-+] Exchange ", keys)) <= 6


def test_duplicate_ordinals_are_dense(spark):
    edges = spark.createDataFrame([("e", "quiz", "c", "rubric", "r", "yes", i) for i in range(50)], "export_id string, source_kind string, source_code string, join_type string, target string, resolved string, pos bigint")
    got = sorted(r.duplicate_ordinal for r in activities.duplicate_ordinals(edges, "pos", F.floor(F.col("pos") / 7)).collect())
    assert got == list(range(50))


def test_rank_filter_prunes_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = first_per(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_containment_equals_brute_force(spark):
    random.seed(5)
    words = [f"w{i:02d}x" for i in range(60)]
    base = random.sample(words, 40)
    docs = []
    for i in range(40):
        own = [w for w in base if random.random() > 0.03] if i % 2 else random.sample(words, 35)
        docs.append(("e", i, "T", " ".join(own)))
    docs += [("e", 100 + i, "T", " ".join(base)) for i in range(10)]  # a group of exact copies
    df = spark.createDataFrame(docs, "export_id string, topic_no int, title string, body string").withColumn("href", F.lit(""))
    sets = duplicates.token_sets(df)
    early = sets.filter("topic_no % 3 = 0")
    got = {r.topic_no: r.before_topic_no for r in duplicates.containment_matches(sets, early).collect()}
    bags = {d[1]: set(d[3].split()) for d in docs if len(d[3]) >= 160}
    want = {}
    for a, x in bags.items():
        hits = [b for b, y in bags.items() if b % 3 == 0 and len(x & y) / min(len(x), len(y)) >= 0.92]
        if hits:
            want[a] = min(hits)
    assert got == want


def test_containment_moves_numbers(spark):
    """Words and pairs of sets carry no texts; equal words of other titles and packages, or of none, do not meet."""
    body = " ".join(f"w{i:02d}xyz" for i in range(40))
    docs = [("e", 1, "T", body), ("e", 2, "T", body + " more"), ("e", 3, "U", body), ("f", 4, "T", body), (None, 5, "T", body), (None, 6, "T", body + " more")]
    sets = duplicates.token_sets(spark.createDataFrame(docs, "export_id string, topic_no int, title string, body string"))
    found = duplicates.containment_matches(sets, sets)
    assert sorted((r.topic_no, r.before_topic_no) for r in found.collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]
    counts = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Aggregate [" in line and "count(1)" in line]
    assert counts and not any("title" in line or "export_id" in line for line in counts)


def test_table_sink_and_changes(spark, tmp_path):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "export_id string, k int, v string")
    sinks.write_table(old, str(tmp_path / "t"), "items/1", "run-1")
    back = spark.read.parquet(str(tmp_path / "t"))
    assert back.count() == 2 and set(back.columns) >= {"schema_id", "run_id", "export_bucket"}
    new = spark.createDataFrame([("a", 1, "x"), ("b", 2, "z"), ("c", 3, "w")], "export_id string, k int, v string")
    changed = sinks.changed_rows(new, back.select("export_id", "k", "v"), ["export_id", "k"])
    assert sorted(r.k for r in changed.collect()) == [2, 3]


def test_unchanged_buckets_are_not_rewritten(spark, tmp_path):
    import os

    path = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1, "x", 0), ("b", 2, "y", 1)], "export_id string, k int, v string, export_bucket int")
    rows.write.partitionBy("export_bucket").parquet(path)
    before = {b: sorted(os.listdir(f"{path}/export_bucket={b}")) for b in (0, 1)}
    new = spark.createDataFrame([("a", 1, "x", 0), ("b", 2, "z", 1)], rows.schema)
    sinks.write_if_changed(spark, new, path, ["export_id", "k"])
    after = {b: sorted(os.listdir(f"{path}/export_bucket={b}")) for b in (0, 1)}
    assert after[0] == before[0] and after[1] != before[1]
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == ["x", "z"]


def test_scans_of_rows_together_move_nothing(spark):
    rows = spark.range(300).selectExpr("cast(id % 3 as string) as k", "cast(id % 2 as string) as l", "id as pos")
    out = prefix_scan(together(rows, "k"), ["k", "l"], "pos", {"n": ("sum", F.lit(1))}, F.floor(F.col("pos") / 7), in_place=True)
    moved = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", final_plan(out))
    assert moved and all(re.fullmatch(r"k#\d+", m) for m in moved)


def test_prefix_scan_of_null_keys_and_places(spark):
    rows = [(k, pos) for k in ("a", None) for pos in [None, *range(40)]]
    df = spark.createDataFrame(rows, "k string, pos bigint")
    for in_place in (False, True):
        out = prefix_scan(df, ["k"], "pos", {"n": ("sum", F.lit(1))}, F.floor(F.col("pos") / 7), in_place)
        assert {(r.k, r.pos): r.n for r in out.collect()} == {(k, p): 1 if p is None else p + 2 for k, p in rows}


def test_edges_of_a_package_move_once(spark):
    from coursegrain.catalog import QUERIES

    moved = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", final_plan(QUERIES["activities_union"](spark, "/root/testdata/sf0.001")))
    assert moved and not any(re.fullmatch(r"export_id#\d+, \w+#\d+", m) for m in moved)


def moved_bytes(df):
    """Bytes of all rows that a query moved, each exchange once."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    seen, todo, total = set(), [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        if name == "Exchange" and node.id() not in seen:
            seen.add(node.id())
            total += node.metrics().apply("dataSize").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


def test_nodes_of_a_tree_are_moved_once(spark):
    tokens, _ = random_tree(7, 300, "p")
    rows = [(n, p, d, t and t * 1000, h) for n, p, d, t, h in tokens]
    size = sum(len(t or "") for _, _, _, t, _ in rows)
    df = spark.createDataFrame(rows, "export_id string, pos bigint, delta int, title string, self_hidden boolean")
    chunk = F.floor(F.col("pos") / 100)
    narrow = 200 * len(rows)
    assert moved_bytes(tree.labels(df, chunk)) < 1.2 * size + 6 * narrow
    assert moved_bytes(tree.paths(tree.labels(df, chunk))) < 2.5 * size + 12 * narrow
    flat = tree.labels(df, chunk, above={"up_title": F.col("title")}).collect()
    titles = {r.pos: r.title for r in flat}
    assert all(r.up_title == (None if r.parent_pos is None else titles[r.parent_pos]) for r in flat)


def test_trees_of_no_package_are_one_range(spark):
    tokens, facts = random_tree(3, 40, None)
    df = spark.createDataFrame(tokens, "export_id string, pos bigint, delta int, title string, self_hidden boolean")
    chunk = F.floor(F.col("pos") / 7)
    nodes = tree.labels(df, chunk)
    assert {r.pos: (r.depth, r.parent_pos, r.last_pos, r.descendants) for r in nodes.collect()} == {n: tuple(f[:4]) for n, f in facts.items()}
    assert {r.pos: r.path for r in tree.paths(nodes, "/").collect()} == {n: "/".join(filter(None, f[4])) for n, f in facts.items()}
