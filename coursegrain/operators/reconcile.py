"""Gold rows against the silver rows they came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .findings import finding


def links(rendered: DataFrame, model: DataFrame) -> DataFrame:
    """Link targets whose counts differ; a target the model does not know is a break.  Columns: export_id, href."""
    count = lambda df, name: df.groupBy("export_id", "href").agg(F.count("*").alias(name))
    both = count(rendered, "shown").join(count(model, "expected"), ["export_id", "href"], "full_outer").na.fill(0, ["shown", "expected"])
    state = F.when(F.col("expected") == 0, "breaks").when(F.col("shown") != F.col("expected"), "warnings")
    return both.withColumn("severity", state).filter("severity is not null")


def counts(actual: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Groups whose row counts differ between two tables."""
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    both = count(actual, "actual").join(count(expected, "expected"), keys, "full_outer").na.fill(0, ["actual", "expected"])
    return both.withColumn("agrees", F.col("actual") == F.col("expected"))


def rubric_tables(rubrics: DataFrame, overall: DataFrame) -> DataFrame:
    """Expected tables per package: one per rubric, one more where it has overall levels."""
    with_levels = overall.select("export_id", "rubric_no").distinct().groupBy("export_id").agg(F.count("*").alias("_o"))
    return rubrics.groupBy("export_id").agg(F.count("*").alias("_r")).join(with_levels, "export_id", "left").select(
        "export_id", (F.col("_r") + F.coalesce("_o", F.lit(0))).alias("tables")
    )


def link_findings(rows: DataFrame) -> DataFrame:
    message = F.concat(F.lit("link "), F.col("href"), F.lit(": shown "), F.col("shown").cast("string"), F.lit(", expected "), F.col("expected").cast("string"))
    return finding(rows, "J26", F.col("severity"), "link", F.col("href"), message)
