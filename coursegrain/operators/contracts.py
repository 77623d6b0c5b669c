"""Conformance of JSON documents to table contracts, and quarantine of unreadable ones."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    """What a document of one schema must look like; plain values, turned into column predicates."""

    schema_id: str
    required: tuple[str, ...] = ()
    enums: dict[str, tuple[str, ...]] = field(default_factory=dict)
    patterns: dict[str, str] = field(default_factory=dict)
    minimums: dict[str, float] = field(default_factory=dict)
    closed_keys: tuple[str, ...] | None = None


def _get(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, f"$.{path}", "string")


def violations(docs: DataFrame, contract: Contract, keep: list[str], raw: str = "doc") -> DataFrame:
    """One row per (document, broken constraint); unparsed documents break ``json``."""
    parsed = docs.select(*keep, F.try_parse_json(raw).alias("_v"), F.col(raw).alias("_raw"))
    checks: list[Column] = [F.when(F.col("_v").isNull(), "json: not parseable")]
    ok = F.col("_v").isNotNull()
    for name in contract.required:
        checks.append(F.when(ok & _get(F.col("_v"), name).isNull(), f"{name}: required"))
    for name, allowed in contract.enums.items():
        checks.append(F.when(ok & ~_get(F.col("_v"), name).isin(*allowed), f"{name}: not allowed"))
    for name, pattern in contract.patterns.items():
        checks.append(F.when(ok & ~_get(F.col("_v"), name).rlike(pattern), f"{name}: pattern"))
    for name, low in contract.minimums.items():
        checks.append(F.when(ok & (F.try_variant_get(F.col("_v"), f"$.{name}", "double") < low), f"{name}: minimum"))
    if contract.closed_keys is not None:
        extra = F.array_except(F.json_object_keys("_raw"), F.array(*[F.lit(k) for k in contract.closed_keys]))
        checks.append(F.when(ok & (F.size(extra) > 0), F.concat(F.lit("unknown keys: "), F.array_join(F.array_sort(extra), ","))))
    return parsed.select(*keep, F.explode(F.array_compact(F.array(*checks))).alias("violation"))


def schema_state(docs: DataFrame, known: tuple[str, ...], raw: str = "doc", inspect: bool = True) -> DataFrame:
    """Known documents pass; an unknown schema is a warning in inspect mode, else an error."""
    schema = _get(F.try_parse_json(raw), "schema")
    state = F.when(schema.isin(*known), "known").otherwise("warning" if inspect else "error")
    return docs.withColumn("schema_state", state)


def split_quarantine(docs: DataFrame, array_key: str, raw: str = "doc") -> DataFrame:
    """Mark documents without the expected array: kept under ``quarantined``, not rendered."""
    value = F.try_variant_get(F.try_parse_json(raw), f"$.{array_key}", "array<variant>")
    return docs.withColumn("quarantined", value.isNull()).withColumn("n_entries", F.when(value.isNotNull(), F.size(value)).otherwise(0))


def coherence(docs: DataFrame, reference: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Documents of one run whose run and source fields differ from the run's own."""
    right = reference.select(*keys, *[F.col(f).alias(f"_{f}") for f in fields])
    joined = docs.join(right, keys, "left")
    differs = F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields]))
    return joined.select(*docs.columns, F.explode(differs).alias("field"))
