"""Versioned tables: what a version holds, what a second writer meets, what a comparison reads."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from coursegrain.sources import versions

ROWS = "export_id string, k int, v string"


def table(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_versions_are_read_as_they_were(spark, tmp_path):
    root = str(tmp_path / "t")
    one = [(f"p{n}", n, "x") for n in range(40)] + [(None, 1, None), ("p1", 1, "x"), ("p1", 1, "x")]
    two = [r for r in one if r[0] != "p3"] + [("p4", 4, "new")]
    assert versions.write(table(spark, one), root, "t/1", "r1", buckets=8) == 1
    assert versions.write(table(spark, one[::-1]), root, "t/1", "r2") == 1  # equal content, another order
    assert versions.write(table(spark, two), root, "t/1", "r3", expected=1) == 2
    assert versions.write(table(spark, []), root, "t/1", "r4") == 3
    assert content(versions.read(spark, root, 1)) == sorted(one, key=str) and content(versions.read(spark, root, 2)) == sorted(two, key=str)
    assert content(versions.read(spark, root)) == []
    log = versions.history(spark, root).orderBy("version").collect()
    assert [(r["version"], r["run_id"], r["rows"]) for r in log] == [(1, "r1", len(one)), (2, "r3", len(two)), (3, "r4", 0)]
    assert log[1]["changed"] <= 2  # only the buckets of p3 and p4 were written
    with pytest.raises(ValueError, match="no version 9"):
        versions.read(spark, root, 9)
    # a new column is a new shape
    wider = table(spark, two).withColumn("w", F.lit(1))
    assert versions.write(wider, root, "t/2", "r5") == 4 and versions.read(spark, root).columns == ["export_id", "k", "v", "w"]


def test_of_two_writers_one_loses_cleanly(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    versions.write(table(spark, [("a", 1, "x")]), root, "t/1", "r0", buckets=4)
    ready, outcome = threading.Barrier(2), {}
    put = versions._Store.put_if_absent

    def together(self, name, text):
        ready.wait(60)  # both have written their data and go for the same version
        return put(self, name, text)

    monkeypatch.setattr(versions._Store, "put_if_absent", together)

    def writer(name):
        try:
            outcome[name] = versions.write(table(spark, [("a", 1, name)]), root, "t/1", name, expected=1)
        except versions.Conflict:
            outcome[name] = "lost"

    threads = [threading.Thread(target=writer, args=(n,)) for n in ("one", "two")]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert sorted(map(str, outcome.values())) == ["2", "lost"]
    winner = next(n for n, v in outcome.items() if v == 2)
    assert content(versions.read(spark, root)) == [("a", 1, winner)]
    assert len(os.listdir(tmp_path / "t" / "data")) == 2 and not [n for n in os.listdir(tmp_path / "t" / "log") if not n.endswith((".json", ".crc"))]
    with pytest.raises(versions.Conflict):
        versions.write(table(spark, []), root, "t/1", "late", expected=1)


def test_changes_open_differing_buckets_only(spark, tmp_path):
    root = str(tmp_path / "t")
    one = [(f"p{n}", n, "x") for n in range(60)]
    two = [(e, k, "y" if k == 5 else v) for e, k, v in one if k != 7] + [("p99", 99, "x"), ("p99", 99, "x")]
    versions.write(table(spark, one), root, "t/1", "r1", buckets=32)
    versions.write(table(spark, two), root, "t/1", "r2")
    first, last = versions.entry(spark, root, 1), versions.entry(spark, root, 2)
    same = [b["folder"] for n, b in first["buckets"].items() if last["buckets"].get(n, {}).get("digest") == b["digest"]]
    assert len(same) > 20
    for folder in same:  # what isn't read may be broken
        for name in os.listdir(f"{root}/{folder}"):
            if name.endswith(".parquet"):
                with open(f"{root}/{folder}/{name}", "wb") as broken:
                    broken.write(b"broken")
    assert content(versions.changes(spark, root, 1, 2, ["export_id", "k"])) == [("p5", 5, "changed"), ("p7", 7, "removed"), ("p99", 99, "added")]
    assert content(versions.changes(spark, root, 2, 2, ["k"])) == []


def test_clearing_keeps_what_the_last_versions_need(spark, tmp_path):
    root = str(tmp_path / "t")
    for n in range(4):
        versions.write(table(spark, [("a", n, "x"), ("b", 0, "x"), ("c", n // 2, "x")]), root, "t/1", f"r{n}", buckets=16)
    assert versions.clear(spark, root, keep=2) > 0
    assert content(versions.read(spark, root, 4)) == [("a", 3, "x"), ("b", 0, "x"), ("c", 1, "x")] and content(versions.read(spark, root, 3))[0] == ("a", 2, "x")
    assert [r["version"] for r in versions.history(spark, root).collect()] == [3, 4] and versions.clear(spark, root, keep=2) == 0
    assert versions.write(table(spark, []), root, "t/1", "r9") == 5
