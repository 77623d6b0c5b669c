"""Progress events of extraction runs as Structured Streaming jobs.

Each function takes and returns a (streaming or batch) DataFrame; ``run_available``
drives a stream over everything that is there and returns the result table.
The order rules of a run are in ``ordered``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_folder


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Split lines into events and pass-through output; unknown keys and event types are kept as they are."""
    doc = F.try_parse_json(line)
    get = lambda path, kind: F.try_variant_get("_doc", f"$.{path}", kind)
    parsed = lines.withColumn("_doc", doc)
    return parsed.withColumns(
        {
            "event": get("event", "string"), "step_index": get("index", "int"), "status": get("status", "string"), "label": get("label", "string"),
            "total": get("total", "int"), "seconds": get("seconds", "double"),
        }
    ).withColumn("is_event", F.col("event").isNotNull()).drop("_doc")


def paired_steps(events: DataFrame, delay: str = "1 hour", limit: str = "1 hour") -> DataFrame:
    """Stream-stream join of step starts and ends on (run, index) within a time limit."""
    start = events.filter("event = 'step_start'").select("run_id", "step_index", F.col("ts").alias("started")).withWatermark("started", delay)
    end = events.filter("event = 'step_end'").select(F.col("run_id").alias("_run"), F.col("step_index").alias("_idx"), F.col("ts").alias("ended"), "status").withWatermark("ended", delay)
    on = (F.col("run_id") == F.col("_run")) & (F.col("step_index") == F.col("_idx")) & (F.col("ended") >= F.col("started")) & (F.col("ended") <= F.col("started") + F.expr(f"INTERVAL {limit}"))
    seconds = F.round((F.unix_micros("ended") - F.unix_micros("started")) / 1e6, 2)
    return start.join(end, on).select("run_id", "step_index", "started", "ended", "status", seconds.alias("seconds"))


def windowed_counts(events: DataFrame, size: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Events per window and type for a live dashboard."""
    return (
        events.withWatermark("ts", delay).groupBy(F.window("ts", size), "event")
        .agg(F.count("*").alias("n"), F.count_if(F.col("status") == "error").alias("errors"))
        .select(F.col("window.start").alias("window_start"), "event", "n", "errors")
    )


def run_available(stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over all available input into a fresh table and return that table.

    Append results are written as they are.  Update results keep, per key, the row
    of the latest batch.  Both the table and the stream's checkpoint live in the
    cluster's shared folder, so a lost executor or driver can resume.
    """
    spark = stream.sparkSession
    target, progress = shared_folder(spark, "stream-out"), shared_folder(spark, "stream-progress")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch_no={batch_id}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", progress).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("batch_no", T.LongType())])
    rows = spark.read.schema(schema).option("basePath", target).parquet(target)
    if mode != "update":
        return rows.drop("batch_no")
    others = [c for c in stream.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*others), "batch_no").alias("_v")).select(*keys, *[F.col(f"_v.{c}") for c in others])


def event_files(spark: SparkSession, folder: str, pattern: str, schema: str | T.StructType, files_per_batch: int = 64) -> DataFrame:
    """File stream over Parquet files that match a name pattern; the file limit bounds every micro-batch."""
    source = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch)
    return source.parquet(folder)
