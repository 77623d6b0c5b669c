"""Lineage, snapshots and receipts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import scoped_key
from ..operators import contracts, identity, runs
from ..session import shared_folder, stored_table
from ..sources import artifacts, versions
from .registry import Tables, query
from .structure import export_names, orgunit_rows

_NAMES = r"""
    p AS (SELECT cast(o_orderkey AS string) AS export_id, CASE WHEN o_orderstatus = 'P' THEN 'Course backup ' || o_orderkey ELSE 'D2LExport_' || o_custkey || '_' || replace(o_orderpriority, '-', '_') || '_' || strftime(o_orderdate, '%Y%m%d') || '_x.zip' END AS source_name,
                 o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AS bad, o_orderkey FROM {orders}),
    u AS (SELECT cast(c_custkey AS string) AS export_id, 'ou-' || c_custkey AS ou FROM {customer}),
    i AS (SELECT p.*, ou, nullif(regexp_extract(source_name, '(?i)D2LExport_(\d+)_(.+?)_(\d{8,14})(?:_|$|\.)', 1), '') AS org_unit_id, sha256('content ' || source_name) AS digest, sha256('zip ' || source_name) AS transport FROM p LEFT JOIN u ON p.export_id = u.export_id),
    b AS (SELECT *, CASE WHEN bad THEN 'unreadable_source_argument' WHEN ou IS NOT NULL THEN 'orgunit_identifier' WHEN org_unit_id IS NOT NULL THEN 'org_unit_id' ELSE 'logical_fingerprint' END AS basis,
                 CASE WHEN bad THEN transport WHEN ou IS NOT NULL THEN ou WHEN org_unit_id IS NOT NULL THEN org_unit_id ELSE digest END AS v, CASE WHEN bad THEN sha256('["unreadable_source","' || transport || '"]') ELSE digest END AS logical FROM i)
"""


@query("lineage_keys", f"""
    WITH {_NAMES}
    SELECT export_id, basis AS lineage_basis, 'cc:lineage:' || left(sha256('["' || CASE WHEN bad THEN 'unreadable_source' ELSE basis END || '","' || v || '"]'), 32) AS source_lineage_key, 'cc:source:' || logical AS source_instance_key,
           CASE WHEN basis IN ('logical_fingerprint', 'unreadable_source_argument') THEN 'unresolved' ELSE 'resolved' END AS lineage_state FROM b
""")
def lineage_keys(t: Tables) -> DataFrame:
    named = identity.export_identity(export_names(t), orgunit_rows(t))
    bad = t.orders.filter("o_orderstatus = 'P' and o_orderpriority = '5-LOW'").select(F.col("o_orderkey").cast("string").alias("export_id"), F.lit("not a zip file").alias("open_error"))
    rows = named.join(bad, "export_id", "left").withColumns({
        "digest": F.sha2(F.concat(F.lit("content "), "source_name"), 256), "transport_sha256": F.sha2(F.concat(F.lit("zip "), "source_name"), 256),
    })
    return identity.lineage(rows).select("export_id", "lineage_basis", "source_lineage_key", "source_instance_key", "lineage_state")


@query("snapshot_diff", """
    WITH p AS (SELECT p_partkey, 'cc:lineage:' || left(sha256('["org_unit_id","' || p_brand || '"]'), 32) AS lin, p_brand, p_name, p_type, p_size FROM {part}),
         e AS (SELECT *, 'cc:entity:' || left(sha256('["' || lin || '","grade_item","resource_code","G-' || p_partkey || '"]'), 32) AS k, CASE WHEN p_brand = 'Brand#3' THEN 'unresolved' ELSE 'resolved' END AS st FROM p),
         o AS (SELECT lin, k, p_name AS v FROM e WHERE st = 'resolved' AND p_type <> 'PROMO'), n AS (SELECT lin, k, CASE WHEN p_size > 30 THEN p_name || ' (new)' ELSE p_name END AS v FROM e WHERE st = 'resolved' AND p_type <> 'LARGE')
    SELECT coalesce(o.lin, n.lin) AS source_lineage_key, coalesce(o.k, n.k) AS entity_key, o.v AS old_value, n.v AS new_value, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' WHEN o.v <> n.v THEN 'changed' ELSE 'same' END AS change
    FROM o FULL JOIN n ON o.lin = n.lin AND o.k = n.k
""")
def snapshot_diff(t: Tables) -> DataFrame:
    """Two terms of the same courses: the type PROMO is new, LARGE is gone, big items were renamed."""
    rows = t.part.withColumns({
        "source_lineage_key": scoped_key("lineage", F.lit("org_unit_id"), F.col("p_brand")), "resource_code": F.concat(F.lit("G-"), F.col("p_partkey").cast("string")),
        "lineage_state": F.when(F.col("p_brand") == "Brand#3", "unresolved").otherwise("resolved"),
    })
    keyed = identity.entity_keys(rows, F.lit("grade_item"), ["resource_code"], F.lit(""))
    old = keyed.filter("p_type <> 'PROMO'")
    new = keyed.filter("p_type <> 'LARGE'").withColumn("p_name", F.when(F.col("p_size") > 30, F.concat("p_name", F.lit(" (new)"))).otherwise(F.col("p_name")))
    return identity.snapshot_diff(old, new, "p_name")


def order_snapshots(t: Tables) -> tuple[str, int, int]:
    """Two versions of one table: open orders come in, finished ones go, urgent ones are priced anew; and a third write that changes nothing."""
    rows = t.orders.select(F.col("o_custkey").cast("string").alias("export_id"), "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    root = shared_folder(t.spark, "orders-table")
    first = versions.write(rows.filter("o_orderstatus <> 'P'"), root, "orders/1", "run-1", buckets=16)
    priced = rows.filter("o_orderstatus <> 'F'").withColumn("o_totalprice", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    second = versions.write(priced, root, "orders/1", "run-2", expected=first)
    versions.write(priced, root, "orders/1", "run-3", expected=second)
    return root, first, second


_SNAPSHOTS = """
    a AS (SELECT cast(o_custkey AS string) AS export_id, o_orderkey, o_orderstatus, o_totalprice FROM {orders} WHERE o_orderstatus <> 'P'),
    b AS (SELECT cast(o_custkey AS string) AS export_id, o_orderkey, o_orderstatus, CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM {orders} WHERE o_orderstatus <> 'F')
"""


@query("table_versions", f"""
    WITH {_SNAPSHOTS}
    SELECT 1 AS version, 'run-1' AS run_id, o_orderstatus, count(*) AS n, cast((SELECT count(*) FROM a) AS bigint) AS version_rows FROM a GROUP BY ALL
    UNION ALL SELECT 2, 'run-2', o_orderstatus, count(*), (SELECT count(*) FROM b) FROM b GROUP BY ALL
""")
def table_versions(t: Tables) -> DataFrame:
    root, first, second = order_snapshots(t)
    log = versions.history(t.spark, root).select(F.col("version").cast("int").alias("version"), "run_id", F.col("rows").alias("version_rows"))
    each = [versions.read(t.spark, root, n).groupBy("o_orderstatus").agg(F.count("*").alias("n")).withColumn("version", F.lit(n)) for n in (first, second)]
    return each[0].unionByName(each[1]).join(log, "version")


@query("snapshot_changes", f"""
    WITH {_SNAPSHOTS}
    SELECT coalesce(a.export_id, b.export_id) AS export_id, coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.export_id IS NULL THEN 'added' WHEN b.export_id IS NULL THEN 'removed' ELSE 'changed' END AS change
    FROM a FULL JOIN b ON a.export_id = b.export_id AND a.o_orderkey = b.o_orderkey WHERE a.o_totalprice IS DISTINCT FROM b.o_totalprice
""")
def snapshot_changes(t: Tables) -> DataFrame:
    root, first, second = order_snapshots(t)
    return versions.changes(t.spark, root, first, second, ["export_id", "o_orderkey"])


@query("artifact_receipts", """
    SELECT export_id, rel_path, bytes, sha256(body) AS sha256, CASE lower(regexp_extract(rel_path, '\\.([^./]+)$', 1)) WHEN 'json' THEN 'application/json' WHEN 'txt' THEN 'text/plain' WHEN 'html' THEN 'text/html' WHEN 'xml' THEN 'text/xml' ELSE 'application/octet-stream' END AS media_type FROM {v_files}
""")
def artifact_receipts(t: Tables) -> DataFrame:
    return identity.receipts(t.v_files.select("export_id", "rel_path", "bytes", F.sha2("body", 256).alias("sha256")))


@query("written_receipts", """
    SELECT 'course-' || coalesce(source, 'none') AS export_id, 'docs/' || doc_id || CASE WHEN lang = 'en' THEN '.txt' ELSE '.json' END AS rel_path, octet_length(encode(coalesce(text, '')))::BIGINT AS bytes,
           sha256(coalesce(text, '')) AS sha256, CASE WHEN lang = 'en' THEN 'text/plain' ELSE 'application/json' END AS media_type, false AS differs FROM {documents}
""")
def written_receipts(t: Tables) -> DataFrame:
    """Documents written as files of their packages, receipts from what the folder holds, held against what was meant to be written."""
    name = F.concat(F.lit("docs/"), F.col("doc_id").cast("string"), F.when(F.col("lang") == "en", ".txt").otherwise(".json"))
    files = t.documents.select(F.concat(F.lit("course-"), F.coalesce("source", F.lit("none"))).alias("export_id"), name.alias("rel_path"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))
    folder = shared_folder(t.spark, "artifacts")
    artifacts.write(files, folder)
    found = stored_table(identity.receipts(artifacts.scan(t.spark, folder)), "receipts")
    meant = files.select("export_id", "rel_path", F.octet_length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    wrong = identity.verify_receipts(meant, found).select("export_id", "rel_path", F.lit(True).alias("_wrong"))
    return found.join(wrong, ["export_id", "rel_path"], "left").withColumn("differs", F.coalesce("_wrong", F.lit(False))).drop("_wrong")


@query("verify_receipts", """
    WITH r AS (SELECT export_id, CASE WHEN bytes % 11 = 0 THEN '../' || rel_path ELSE rel_path END AS rel_path, sha256(CASE WHEN bytes % 7 = 0 THEN body || '!' ELSE body END) AS sha FROM {v_files}),
         a AS (SELECT export_id, rel_path, sha256(body) AS sha FROM {v_files} WHERE bytes % 5 <> 0)
    SELECT r.export_id, r.rel_path, CASE WHEN r.rel_path LIKE '../%' THEN 'unsafe artifact path' WHEN a.sha IS NULL THEN 'missing artifact' ELSE 'artifact checksum mismatch' END AS problem
    FROM r LEFT JOIN a ON r.export_id = a.export_id AND r.rel_path = a.rel_path WHERE r.rel_path LIKE '../%' OR a.sha IS NULL OR a.sha <> r.sha
""")
def verify_receipts(t: Tables) -> DataFrame:
    """Receipts of all files against what is there: some moved out, some deleted, some edited."""
    files = t.v_files
    receipts = identity.receipts(files.select(
        "export_id", F.when(F.col("bytes") % 11 == 0, F.concat(F.lit("../"), "rel_path")).otherwise(F.col("rel_path")).alias("rel_path"), "bytes",
        F.sha2(F.when(F.col("bytes") % 7 == 0, F.concat("body", F.lit("!"))).otherwise(F.col("body")), 256).alias("sha256"),
    ))
    actual = files.filter("bytes % 5 <> 0").select("export_id", "rel_path", F.sha2("body", 256).alias("sha256"))
    return identity.verify_receipts(receipts, actual)


_STEPS = """
    s AS (SELECT cast(l_orderkey AS string) AS run_id, CASE l_linenumber WHEN 1 THEN 'Establish source identity' WHEN 2 THEN 'Inventory export files' WHEN 3 THEN 'Probe manifest' WHEN 4 THEN 'Reconstruct course structure' WHEN 5 THEN 'Extract course activities' WHEN 6 THEN 'Extract rubrics' ELSE 'Run QA report' END AS label,
                 CASE WHEN l_tax > 0.075 THEN 'failed' WHEN l_tax < 0.005 THEN 'unresolved' ELSE 'completed' END AS status FROM {lineitem}),
    f AS (SELECT run_id, count(*) FILTER (WHERE status <> 'completed') AS issues, coalesce(list_sort(list(DISTINCT label) FILTER (WHERE status <> 'completed' AND label NOT IN ('Extract rubrics', 'Run QA report'))), []) AS core FROM s GROUP BY run_id),
    r AS (SELECT cast(o_orderkey AS string) AS run_id, o_orderstatus <> 'P' OR o_totalprice > 100000 AS has_deliverable, CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 3 END AS weeks FROM {orders}),
    d AS (SELECT r.*, coalesce(issues, 0) AS issues, coalesce(core, []) AS core, has_deliverable AND len(coalesce(core, [])) = 0 AS usable FROM r LEFT JOIN f ON r.run_id = f.run_id)
"""


def delivered(t: Tables) -> DataFrame:
    n = F.col("l_linenumber")
    labels = ["Establish source identity", "Inventory export files", "Probe manifest", "Reconstruct course structure", "Extract course activities", "Extract rubrics"]
    label = F.when(F.lit(False), "")
    for i, name in enumerate(labels, start=1):
        label = label.when(n == i, name)
    status = F.when(F.col("l_tax") > 0.075, "failed").when(F.col("l_tax") < 0.005, "unresolved").otherwise("completed")
    steps = t.lineitem.select(F.col("l_orderkey").cast("string").alias("run_id"), label.otherwise("Run QA report").alias("label"), status.alias("status"))
    rows = t.orders.select(F.col("o_orderkey").cast("string").alias("run_id"), ((F.col("o_orderstatus") != "P") | (F.col("o_totalprice") > 100000)).alias("has_deliverable"), F.when(F.col("o_orderpriority") == "5-LOW", 0).otherwise(3).alias("weeks"))
    return runs.run_status(rows, steps)


@query("run_status", f"WITH {_STEPS} SELECT run_id, issues, CASE WHEN NOT has_deliverable THEN 'error' WHEN issues > 0 THEN 'partial' ELSE 'ok' END AS run_status FROM d")
def run_status(t: Tables) -> DataFrame:
    return delivered(t).select("run_id", "issues", "run_status")


@query("delivery_status", f"""
    WITH {_STEPS}
    SELECT run_id, usable, weeks = 0 AS empty, array_to_string(core, '|') AS core_failures, CASE WHEN NOT usable THEN 'Delivery: NOT USABLE - core evidence steps failed (' || CASE WHEN len(core) = 0 THEN 'unknown' ELSE array_to_string(core, ', ') END || ')' WHEN weeks = 0 THEN 'Delivery: usable, but the export produced no weekly structure' ELSE 'Delivery: usable.' END AS delivery_line FROM d
""")
def delivery_status(t: Tables) -> DataFrame:
    return delivered(t).select("run_id", "usable", "empty", F.array_join("core_failures", "|").alias("core_failures"), "delivery_line")


@query("existing_outputs", """
    SELECT CAST(o_custkey AS string) AS export_id, o_orderkey, (SELECT count(*) FROM {lineitem} l WHERE l.l_orderkey = o.o_custkey) AS existing FROM {orders} o
""")
def existing_outputs(t: Tables) -> DataFrame:
    """Files already there for each run target; a customer number stands for the target, lines for its files."""
    targets = t.orders.select(F.col("o_custkey").cast("string").alias("export_id"), "o_orderkey")
    return runs.existing_outputs(targets, t.lineitem.select(F.col("l_orderkey").cast("string").alias("export_id")))


@query("contract_coherence", """
    WITH a AS (SELECT l_orderkey AS run_key, l_linenumber AS artifact, 'run-' || CASE WHEN l_linenumber = 3 THEN l_orderkey + 1 ELSE l_orderkey END AS run_id, CASE WHEN l_tax = 0 THEN NULL ELSE 'src-' || (l_orderkey % 7) END AS source_key FROM {lineitem}),
         r AS (SELECT o_orderkey AS run_key, 'run-' || o_orderkey AS run_id, 'src-' || (o_orderkey % 7) AS source_key FROM {orders})
    SELECT a.run_key, artifact, 'run_id' AS field FROM a LEFT JOIN r ON a.run_key = r.run_key WHERE a.run_id IS DISTINCT FROM r.run_id
    UNION ALL SELECT a.run_key, artifact, 'source_key' FROM a LEFT JOIN r ON a.run_key = r.run_key WHERE a.source_key IS DISTINCT FROM r.source_key
""")
def contract_coherence(t: Tables) -> DataFrame:
    """Artifacts whose run or source differs from their run's own: line 3 names another run, untaxed lines no source."""
    key = F.col("l_orderkey")
    docs = t.lineitem.select(
        key.alias("run_key"), F.col("l_linenumber").alias("artifact"), F.concat(F.lit("run-"), F.when(F.col("l_linenumber") == 3, key + 1).otherwise(key).cast("string")).alias("run_id"),
        F.when(F.col("l_tax") != 0, F.concat(F.lit("src-"), (key % 7).cast("string"))).alias("source_key"),
    )
    own = F.col("o_orderkey")
    runs_of = t.orders.select(own.alias("run_key"), F.concat(F.lit("run-"), own.cast("string")).alias("run_id"), F.concat(F.lit("src-"), (own % 7).cast("string")).alias("source_key"))
    return contracts.coherence(docs, runs_of, ["run_key"], ["run_id", "source_key"]).select("run_key", "artifact", "field")
