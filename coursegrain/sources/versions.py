"""Versioned tables: data that is never overwritten, and a log that says which of it is a version.

Rows lie in buckets by a hash of their package.  A version names for each bucket one
folder of data files with its number of rows and a digest, so an entry of the log
is as small as the number of buckets, however large the table.  Writing compares
digests first: buckets that are the same keep their folder, equal content makes no
version.  An entry is put in place only if there is none of its number yet: of two
writers that start from one version, one gets an error and nothing of it shows.

    data/<commit>/export_bucket=<n>/part-*.parquet      log/<version>.json
"""

from __future__ import annotations

import json
import os
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 256
#: Files that one bucket is spread over at most in one write, so that a large package is no single task.
SPREAD = 64


class Conflict(RuntimeError):
    """Another writer made the version first."""


class _Store:
    """The few file operations of a table's folder, on any store that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.system = self.path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        at = self.path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self.system.listStatus(at)) if self.system.exists(at) else []

    def read(self, name: str) -> str:
        source = self.system.open(self.path(f"{self.root}/{name}"))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def put_if_absent(self, name: str, text: str) -> bool:
        """The whole text under this name, or false if the name is taken.

        The text is written aside and then given its name: by a hard link on a local
        or mounted disk, else by the store's own rename, which must fail where the name
        is taken, as that of HDFS does.
        """
        final, draft = self.path(f"{self.root}/{name}"), self.path(f"{self.root}/{name}.{uuid.uuid4().hex}")
        sink = self.system.create(draft, False)
        sink.write(bytearray(text.encode("utf-8")))
        sink.close()
        try:
            if self.system.getScheme() == "file":
                os.link(draft.toUri().getPath(), final.toUri().getPath())
                return True
            return bool(not self.system.exists(final) and self.system.rename(draft, final))
        except FileExistsError:
            return False
        finally:
            self.system.delete(draft, False)

    def drop(self, folder: str) -> None:
        self.system.delete(self.path(f"{self.root}/{folder}"), True)


def _numbers(store: _Store) -> list[int]:
    return [int(n.removesuffix(".json")) for n in store.names("log") if n.endswith(".json") and n.removesuffix(".json").isdigit()]


def entry(spark: SparkSession, root: str, version: int | None = None) -> dict[str, Any] | None:
    """The log entry of a version, by default the latest; none for a table that isn't there yet."""
    store = _Store(spark, root)
    numbers = _numbers(store)
    if version is None:
        version = max(numbers, default=None)
        if version is None:
            return None
    elif version not in numbers:
        raise ValueError(f"{root} has no version {version}")
    return json.loads(store.read(f"log/{version:020d}.json"))


def _bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    return df.withColumn("export_bucket", F.pmod(F.hash(F.col(f"`{key}`")), F.lit(buckets)).cast("int"))


def _digests(bucketed: DataFrame) -> dict[int, dict[str, Any]]:
    """Per bucket: rows, and sums of two hashes of every row, which don't depend on the order.  At most a row per bucket reaches the driver."""
    columns = sorted(c for c in bucketed.columns if c != "export_bucket")
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    total = lambda c: F.sum(c.cast("decimal(20,0)")).cast("string")
    rows = bucketed.select("export_bucket", F.md5(text).alias("_d")).select("export_bucket", F.conv(F.substring("_d", 1, 15), 16, 10).alias("a"), F.conv(F.substring("_d", 17, 15), 16, 10).alias("b"))
    found = rows.groupBy("export_bucket").agg(F.count("*").alias("rows"), total(F.col("a")).alias("a"), total(F.col("b")).alias("b")).collect()
    return {r["export_bucket"]: {"rows": r["rows"], "digest": f"{r['rows']}:{r['a']}:{r['b']}"} for r in found}


def write(df: DataFrame, root: str, schema_id: str, run_id: str, key: str = "export_id", expected: int | None = None, buckets: int = BUCKETS) -> int:
    """Make ``df`` the table's content; returns its version.

    Equal content of the same contract makes no new version, so a repeated run changes nothing.
    ``expected`` is the version that the writer has read; another one there, or one that comes
    in the meantime, raises ``Conflict`` and leaves no data.  Null keys have a bucket
    like any other; an empty table is a version without buckets.
    """
    spark = df.sparkSession
    store, before = _Store(spark, root), entry(spark, root)
    at = before["version"] if before else 0
    if expected is not None and expected != at:
        raise Conflict(f"{root} is at version {at}, not {expected}")
    if before and before["key"] == key:
        buckets = before["bucket_count"]
    rows = _bucketed(df, key, buckets)
    made, old = _digests(rows), before["buckets"] if before else {}
    shape = df.schema.json()
    same = {b for b, d in made.items() if before and before["shape"] == shape and old.get(str(b), {}).get("digest") == d["digest"]}
    changed = sorted(set(made) - same)
    if before and not changed and len(made) == len(old) and before["schema_id"] == schema_id:
        return at
    commit = uuid.uuid4().hex
    if changed:
        part = F.pmod(F.xxhash64(F.to_json(F.struct(*df.columns))), F.lit(SPREAD))
        fresh = rows.filter(F.col("export_bucket").isin(changed)).repartition("export_bucket", part)
        fresh.write.partitionBy("export_bucket").parquet(f"{store.root}/data/{commit}")
    places = {str(b): made[b] | {"folder": old[str(b)]["folder"] if b in same else f"data/{commit}/export_bucket={b}"} for b in sorted(made)}
    text = json.dumps({
        "version": at + 1, "schema_id": schema_id, "run_id": run_id, "key": key, "bucket_count": buckets, "shape": shape, "commit": commit, "changed": changed, "buckets": places,
    })
    if not store.put_if_absent(f"log/{at + 1:020d}.json", text):
        store.drop(f"data/{commit}")
        raise Conflict(f"another writer made version {at + 1} of {root}")
    return at + 1


def _opened(spark: SparkSession, root: str, found: dict[str, Any], wanted: set[str] | None = None) -> DataFrame:
    from pyspark.sql.types import StructType

    shape = StructType.fromJson(json.loads(found["shape"]))
    folders = [f"{root.rstrip('/')}/{b['folder']}" for n, b in found["buckets"].items() if wanted is None or n in wanted]
    return spark.read.schema(shape).parquet(*folders) if folders else spark.createDataFrame([], shape)


def read(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The table as of a version, by default the latest."""
    found = entry(spark, root, version)
    if found is None:
        raise ValueError(f"{root} has no version")
    return _opened(spark, root, found)


def history(spark: SparkSession, root: str) -> DataFrame:
    """A row per version: schema_id, run_id, rows, number of buckets and of those that it wrote."""
    store = _Store(spark, root)
    entries = [json.loads(store.read(f"log/{n:020d}.json")) for n in _numbers(store)]
    rows = [(e["version"], e["schema_id"], e["run_id"], sum(b["rows"] for b in e["buckets"].values()), len(e["buckets"]), len(e["changed"])) for e in entries]
    return spark.createDataFrame(rows, "version bigint, schema_id string, run_id string, rows bigint, buckets int, changed int")


def changes(spark: SparkSession, root: str, old: int, new: int, keys: list[str]) -> DataFrame:
    """``keys`` and change (added, removed, changed) between two versions.

    Buckets of one digest are equal and aren't read.  In the others rows are
    compared by digest of their whole content; repeated keys are compared as bags.
    """
    before, after = entry(spark, root, old), entry(spark, root, new)
    if (before["key"], before["bucket_count"]) != (after["key"], after["bucket_count"]):
        raise ValueError("the versions are cut into different buckets")
    names = set(before["buckets"]) | set(after["buckets"])
    differ = {n for n in names if before["shape"] != after["shape"] or before["buckets"].get(n, {}).get("digest") != after["buckets"].get(n, {}).get("digest")}

    def bags(found: dict[str, Any], name: str) -> DataFrame:
        rows = _opened(spark, root, found, differ)
        others = sorted(c for c in rows.columns if c not in keys)
        digest = F.sha2(F.to_json(F.struct(*others), {"ignoreNullFields": "false"}), 256) if others else F.lit("")
        counted = rows.select(*keys, digest.alias("_digest")).groupBy(*keys, "_digest").agg(F.count("*").alias("_n"))
        return counted.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("_digest", "_n"))).alias(name))

    a, b = bags(before, "_a"), bags(after, "_b")
    other = b.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_b")
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    both = a.join(other, on, "full_outer").filter(~F.col("_a").eqNullSafe(F.col("_b")))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").otherwise("changed")
    return both.select(*[F.when(F.col("_b").isNull(), F.col(k)).otherwise(F.col(f"_k{i}")).alias(k) for i, k in enumerate(keys)], change.alias("change"))


def clear(spark: SparkSession, root: str, keep: int = 1) -> int:
    """Drop all but the last ``keep`` versions and the data that only they used; returns the number of folders dropped.

    A commit that is being written counts as unused: clear when no writer is at work.
    """
    store = _Store(spark, root)
    numbers = sorted(_numbers(store))
    kept = [json.loads(store.read(f"log/{n:020d}.json")) for n in numbers[-keep:]]
    used = {b["folder"] for e in kept for b in e["buckets"].values()}
    for n in numbers[:-keep]:
        store.drop(f"log/{n:020d}.json")
    dropped = 0
    for commit in store.names("data"):
        parts = [f"data/{commit}/{p}" for p in store.names(f"data/{commit}") if p.startswith("export_bucket=")]
        unused = [p for p in parts if p not in used]
        for folder in [f"data/{commit}"] if len(unused) == len(parts) else unused:
            store.drop(folder)
        dropped += len(unused)
    return dropped
