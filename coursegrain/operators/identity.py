"""Lineage, entity and relationship keys; fingerprints; snapshots; receipts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import file_line, json_list, scoped_key

EVIDENCE = ("orgunit_identifier", "org_unit_id", "orgunit_code", "course_code")


def export_identity(packages: DataFrame, orgunits: DataFrame | None = None) -> DataFrame:
    """Identity evidence of each package from its name and, when given, its organisation-unit file."""
    from .. import constants as K

    part = lambda i: F.nullif(F.regexp_extract("source_name", K.EXPORT_NAME, i), F.lit(""))
    named = packages.withColumns({"org_unit_id": part(1), "course_code": part(2), "export_timestamp": part(3)})
    if orgunits is None:
        return named.withColumns({c: F.lit(None).cast("string") for c in ("orgunit_identifier", "orgunit_code", "orgunit_name")})
    return named.join(orgunits, "export_id", "left")


def fingerprints(files: DataFrame, partitions: int | None = None) -> DataFrame:
    """sha256 over the path-sorted lines ``["path",size,"sha256"]`` of each package.

    A hash over an ordered byte stream is sequential by definition.  The lines of
    a package are therefore sorted into one partition and *streamed* through the
    hash batch by batch: no list of a package is ever built, and a huge package
    only means a longer stream.
    """
    lines = files.select("export_id", "rel_path", F.col("bytes").cast("bigint").alias("bytes"), file_line(F.col("rel_path"), F.col("bytes").cast("bigint"), F.col("sha256")).alias("line"))
    placed = lines.repartition(partitions, "export_id") if partitions else lines.repartition("export_id")
    ordered = placed.sortWithinPartitions("export_id", F.encode("rel_path", "UTF-8"))

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, count, size = None, None, 0, 0
        for batch in batches:
            ids, texts, sizes = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(1).to_pylist()
            done: list[tuple] = []
            for export_id, text, n in zip(ids, texts, sizes):
                if digest is None or export_id != current:
                    if digest is not None:
                        done.append((current, digest.hexdigest(), count, size))
                    current, digest, count, size = export_id, hashlib.sha256(), 0, 0
                digest.update(text.encode("utf-8"))
                count += 1
                size += n
            if done:
                yield _rows(done)
        if digest is not None:
            yield _rows([(current, digest.hexdigest(), count, size)])

    return ordered.select("export_id", "bytes", "line").mapInArrow(stream, "export_id string, digest string, file_count bigint, bytes bigint")


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = ["export_id", "digest", "file_count", "bytes"]
    types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


def lineage(packages: DataFrame) -> DataFrame:
    """Lineage and instance keys.

    ``packages``: export_id, the evidence columns, digest (NULL when unreadable),
    transport_sha256, open_error.  A package that could not be opened gets a scope
    of its own, so it never equals a readable one.
    """
    unreadable = F.col("open_error").isNotNull()
    basis = F.when(unreadable, "unreadable_source_argument")
    value = F.when(unreadable, F.col("transport_sha256"))
    for name in EVIDENCE:
        has = F.coalesce(F.col(name), F.lit("")) != ""
        basis, value = basis.when(has, name), value.when(has, F.col(name))
    basis, value = basis.otherwise("logical_fingerprint"), value.otherwise(F.col("digest"))
    logical = F.when(unreadable, F.sha2(json_list(F.lit("unreadable_source"), F.col("transport_sha256")), 256)).otherwise(F.col("digest"))
    staged = packages.withColumns({"lineage_basis": basis, "_value": value, "logical_digest": logical})
    scope = F.when(F.col("lineage_basis") == "unreadable_source_argument", "unreadable_source").otherwise(F.col("lineage_basis"))
    open_ended = F.col("lineage_basis").isin("logical_fingerprint", "unreadable_source_argument")
    return staged.withColumns(
        {
            "source_lineage_key": scoped_key("lineage", scope, F.col("_value")),
            "source_instance_key": F.concat(F.lit("cc:source:"), "logical_digest"),
            "lineage_state": F.when(open_ended, "unresolved").otherwise("resolved"),
        }
    ).drop("_value")


def entity_keys(rows: DataFrame, kind: Column, aliases: list[str], fallback: Column) -> DataFrame:
    """Key, quality and basis of each entity from its first non-empty alias.

    ``rows`` carry ``source_lineage_key``.
    """
    basis, value = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for name in aliases:
        has = F.coalesce(F.col(name).cast("string"), F.lit("")) != ""
        basis, value = basis.when(has, name), value.when(has, F.col(name).cast("string"))
    staged = rows.withColumns({"identity_basis": basis.otherwise("source_context"), "_value": value.otherwise(F.coalesce(F.nullif(fallback, F.lit("")), kind)), "_kind": kind})
    quality = (
        F.when(F.col("identity_basis") == "resource_code", "durable_source_id")
        .when(F.col("identity_basis").isin("identifier", "id", "ident", "topic_id", "forum_id"), "scoped_source_id")
        .when(F.col("identity_basis") == "source_context", "fallback").otherwise("observed_reference")
    )
    key = scoped_key("entity", F.col("source_lineage_key"), F.col("_kind"), F.col("identity_basis"), F.col("_value"))
    return staged.withColumns({"entity_key": key, "identity_quality": quality}).drop("_value", "_kind")


_STRUCTURE_ALIASES = ["identifier", "rcode", "resource_code", "identifierref", "href"]


def structure_keys(nodes: DataFrame) -> DataFrame:
    """Keys of tree nodes with the key of the node above (null for roots).

    ``nodes`` carry source_lineage_key, pos, depth, parent_pos, kind, title and the
    aliases.  A node without an alias is named by its place: the positions among
    its siblings from the root down, its kind and its title.  A node's list of
    ancestors brings along what the key of its parent is made of.
    """
    from ..session import stored_table
    from .scan import prefix_scan
    from .tree import ancestors

    fields = ["kind", "title", *_STRUCTURE_ALIASES]
    # Stored, because the scan for ancestors reads its input for the ranges and for their totals.
    placed = "_chunk" in nodes.columns
    family = nodes.withColumn("_family", F.struct("parent_pos"))  # never null itself, as roots have no parent
    counted = prefix_scan(family, ["export_id", "_family"], "pos", {"_nth": ("sum", F.lit(1))}, in_place=placed)
    siblings = stored_table(counted.drop("_family", "_chunk"), "tree-siblings")
    found = ancestors(siblings, F.struct((F.col("_nth") - 1).cast("string").alias("_nth"), *fields))
    places = F.transform("up", lambda u: u["_nth"])
    kind = F.concat(F.lit("structure:"), F.coalesce(F.nullif("kind", F.lit("")), F.lit("unknown")))
    fallback = F.concat(F.array_join("_places", "/"), F.lit("|"), F.coalesce("kind", F.lit("")), F.lit("|"), F.coalesce("title", F.lit("")))
    # The parent is keyed like the node itself, with its fields in their place.
    parent = F.get("up", F.size("up") - 2)
    kept = {c: F.col(c) for c in found.columns}
    above = found.select(F.struct(*kept.values()).alias("_row"), "source_lineage_key", F.slice(places, F.lit(1), F.greatest(F.size("up") - 1, F.lit(0))).alias("_places"), *[parent[c].alias(c) for c in fields])
    keyed = entity_keys(above, kind, _STRUCTURE_ALIASES, fallback)
    back = keyed.select("_row.*", F.when(F.size("_row.up") > 1, F.col("entity_key")).alias("parent_entity_key"))
    return entity_keys(back.withColumn("_places", places), kind, _STRUCTURE_ALIASES, fallback).drop("_nth", "up", "_places")


def entity_aliases(entities: DataFrame, aliases: list[str]) -> DataFrame:
    """Distinct (package, alias value) -> entity pairs."""
    values = F.filter(F.array(*[F.col(a).cast("string") for a in aliases]), lambda v: F.coalesce(v, F.lit("")) != "")
    return entities.select("export_id", F.explode(values).alias("alias"), "entity_key").distinct()


def edge_endpoints(edges: DataFrame, aliases: DataFrame) -> DataFrame:
    """Entity keys of both ends; an alias that names several entities resolves to none of them."""
    single = aliases.groupBy("export_id", "alias").agg(F.min("entity_key").alias("k"), F.max("entity_key").alias("_x")).filter(F.col("k") == F.col("_x"))
    end = lambda column, name: single.select("export_id", F.col("alias").alias(column), F.col("k").alias(name))
    joined = edges.join(end("source_code", "source_entity_key"), ["export_id", "source_code"], "left").join(end("target", "target_entity_key"), ["export_id", "target"], "left")
    both = F.col("source_entity_key").isNotNull() & F.col("target_entity_key").isNotNull()
    one = F.col("source_entity_key").isNotNull() | F.col("target_entity_key").isNotNull()
    return joined.withColumn("endpoint_quality", F.when(both, "resolved_endpoints").when(one, "partial_endpoints").otherwise("evidence_only"))


def edge_keys(edges: DataFrame) -> DataFrame:
    """Relationship key from lineage, the five defining fields and the duplicate ordinal."""
    parts = ["source_lineage_key", "source_kind", "source_code", "join_type", "target", "resolved"]
    return edges.withColumn("relationship_key", scoped_key("relationship", *[F.col(p) for p in parts], F.col("duplicate_ordinal").cast("string")))


def snapshot_diff(old: DataFrame, new: DataFrame, content: str) -> DataFrame:
    """Entities added, removed, changed or kept between two snapshots of the same lineage.

    Rows without a resolved lineage never match anything, so they are left out.
    """
    keys = ["source_lineage_key", "entity_key"]
    pick = lambda df, name: df.filter("lineage_state = 'resolved'").select(*keys, F.col(content).alias(name), F.lit(True).alias(f"_{name}"))
    joined = pick(old, "old_value").join(pick(new, "new_value"), keys, "full_outer")
    change = (
        F.when(F.col("_old_value").isNull(), "added").when(F.col("_new_value").isNull(), "removed")
        .when(~F.col("old_value").eqNullSafe(F.col("new_value")), "changed").otherwise("same")
    )
    return joined.select(*keys, "old_value", "new_value", change.alias("change"))


def receipts(files: DataFrame) -> DataFrame:
    """Receipt of each emitted file: path, bytes, digest, media type."""
    ext = F.lower(F.regexp_extract("rel_path", r"\.([^./]+)$", 1))
    media = F.when(F.lit(False), "")
    # media types of the emitted formats (fixed values)
    for name, kind in (("json", "application/json"), ("md", "text/markdown"), ("csv", "text/csv"), ("txt", "text/plain"), ("html", "text/html"), ("xml", "text/xml"), ("parquet", "application/vnd.apache.parquet")):
        media = media.when(ext == name, kind)
    return files.select("export_id", "rel_path", "bytes", "sha256", media.otherwise("application/octet-stream").alias("media_type"))


def verify_receipts(receipt_rows: DataFrame, actual: DataFrame) -> DataFrame:
    """Problem of each receipt against the files that exist: unsafe path, missing, or changed content."""
    unsafe = F.col("rel_path").rlike(r"(^|/)\.\.(/|$)|^/")
    have = actual.select("export_id", "rel_path", F.col("sha256").alias("_actual"))
    joined = receipt_rows.join(have, ["export_id", "rel_path"], "left")
    problem = (
        F.when(unsafe, "unsafe artifact path").when(F.col("_actual").isNull(), "missing artifact")
        .when(F.col("_actual") != F.col("sha256"), "artifact checksum mismatch")
    )
    return joined.withColumn("problem", problem).filter("problem is not null").select("export_id", "rel_path", "problem")
