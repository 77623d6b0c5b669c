"""Run ledgers: step durations, run status, delivery, partial results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.text import strip


def step_durations(events: DataFrame, decimals: int = 2) -> DataFrame:
    """Start and end of each step joined on (run, index), seconds rounded.

    ``events``: run_id, event, step_index, ts, status.  One start and one end per
    step: the first of each counts.
    """
    start = events.filter("event = 'step_start'").groupBy("run_id", "step_index").agg(F.min("ts").alias("started"))
    end = events.filter("event = 'step_end'").groupBy("run_id", "step_index").agg(F.min(F.struct("ts", "status")).alias("_e"))
    seconds = F.round((F.unix_micros(F.col("_e.ts").cast("timestamp")) - F.unix_micros(F.col("started").cast("timestamp"))) / 1e6, decimals)
    status = F.when(F.col("_e").isNull(), "unresolved").when(F.col("_e.status") == "ok", "completed").otherwise("failed")
    return start.join(end, ["run_id", "step_index"], "left").select("run_id", "step_index", "started", seconds.alias("seconds"), status.alias("status"))


def run_status(runs: DataFrame, steps: DataFrame) -> DataFrame:
    """ok, partial or error per run, with delivery facts.

    ``runs``: run_id, has_deliverable, weeks; ``steps``: run_id, label, status.
    A core step that failed makes the delivery unusable; an empty course stays usable.
    """
    bad = F.col("status").isin("failed", "unresolved")
    core = F.col("label").isin(*K.CORE_STEPS)
    facts = steps.groupBy("run_id").agg(
        F.count_if(bad).alias("issues"), F.array_sort(F.collect_set(F.when(bad & core, F.col("label")))).alias("core_failures"),
    )
    joined = runs.join(facts, "run_id", "left").withColumns({"issues": F.coalesce("issues", F.lit(0)), "core_failures": F.coalesce("core_failures", F.expr("cast(array() as array<string>)"))})
    usable = F.col("has_deliverable") & (F.size("core_failures") == 0)
    status = F.when(~F.col("has_deliverable"), "error").when(F.col("issues") > 0, "partial").otherwise("ok")
    line = (
        F.when(~F.col("usable"), F.concat(F.lit("Delivery: NOT USABLE - core evidence steps failed ("), F.when(F.size("core_failures") == 0, "unknown").otherwise(F.array_join("core_failures", ", ")), F.lit(")")))
        .when(F.col("empty"), "Delivery: usable, but the export produced no weekly structure").otherwise("Delivery: usable.")
    )
    return joined.withColumns({"usable": usable, "empty": F.col("weeks") == 0, "run_status": status}).withColumn("delivery_line", line)


def concise_issue(message):
    """First non-blank line of a diagnostic."""
    lines = F.filter(F.transform(F.split(F.coalesce(message, F.lit("")), r"\r\n|\r|\n"), strip), lambda x: x != "")
    return F.coalesce(F.try_element_at(lines, F.lit(1)), F.lit("Unknown component failure"))


def partial_delivery(packages: DataFrame, components: DataFrame, errors: DataFrame) -> DataFrame:
    """Every package keeps its row: a failed component counts as zero rows and adds a PARTIAL finding.

    ``components``: export_id, component, rows; ``errors``: export_id, component, error.
    """
    names = F.array(*[F.lit(c) for c in ("structure", "activities", "rubrics")])
    wanted = packages.select("export_id", F.explode(names).alias("component"))
    joined = wanted.join(components, ["export_id", "component"], "left").join(errors, ["export_id", "component"], "left")
    failed = F.col("error").isNotNull()
    return joined.select(
        "export_id", "component", F.when(failed, 0).otherwise(F.coalesce("rows", F.lit(0))).cast("bigint").alias("rows"), F.when(failed, "failed").otherwise("completed").alias("status"),
        F.when(failed, F.concat(F.lit("PARTIAL: "), "component", F.lit(" could not be read: "), concise_issue(F.col("error")))).alias("finding"),
    )


def existing_outputs(targets: DataFrame, receipts: DataFrame) -> DataFrame:
    """Number of files already present for each run target."""
    have = receipts.groupBy("export_id").agg(F.count("*").alias("existing"))
    return targets.join(have, "export_id", "left").withColumn("existing", F.coalesce("existing", F.lit(0)))
