"""Progress events as streams and as batches.  One run per user of the events table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import runs
from ..streaming import ordered, progress
from .registry import Tables, query


def shaped(events: DataFrame) -> DataFrame:
    """Events with the columns of a progress stream; event time in UTC."""
    kind = F.col("event_type")
    event = F.when(kind == "signup", "run_start").when(kind == "view", "step_start").when(kind == "purchase", "run_end").otherwise("step_end")
    return events.select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("ts"), event.alias("event"),
        F.when(kind == "error", "error").otherwise("ok").alias("status"), (F.col("value").cast("int") % 12).alias("step_index"),
    )


def live(t: Tables) -> DataFrame:
    return shaped(progress.event_files(t.spark, t.sf_dir, "events.parquet", t.events.schema))


_LINES = """
    l AS (SELECT event_id, CASE event_type WHEN 'error' THEN 'plain text ' || event_id WHEN 'signup' THEN '{"note": 1}' ELSE '{"event": "' || event_type || '", "index": ' || (user_id % 9) || ', "status": "ok", "extra": [1]}' END AS value, event_type, user_id FROM {events})
"""


@query("stream_events_parse", f"""
    WITH {_LINES}
    SELECT event_id, value, event_type NOT IN ('error', 'signup') AS is_event, CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END AS event, CASE WHEN event_type NOT IN ('error', 'signup') THEN cast(user_id % 9 AS int) END AS step_index FROM l
""")
def stream_events_parse(t: Tables) -> DataFrame:
    events = progress.event_files(t.spark, t.sf_dir, "events.parquet", t.events.schema)
    good = F.concat(F.lit('{"event": "'), "event_type", F.lit('", "index": '), (F.col("user_id") % 9).cast("string"), F.lit(', "status": "ok", "extra": [1]}'))
    value = F.when(F.col("event_type") == "error", F.concat(F.lit("plain text "), F.col("event_id").cast("string"))).when(F.col("event_type") == "signup", '{"note": 1}').otherwise(good)
    parsed = progress.parse_lines(events.select("event_id", value.alias("value")))
    return progress.run_available(parsed.select("event_id", "value", "is_event", "event", "step_index"), "append")


@query("step_durations", """
    WITH st AS (SELECT run_id, step_index, min(ts) AS started FROM {v_progress} WHERE event = 'step_start' GROUP BY ALL),
         en AS (SELECT run_id, step_index, min(ts) AS ended, arg_min(status, (ts, status)) AS status FROM {v_progress} WHERE event = 'step_end' GROUP BY ALL)
    SELECT st.run_id, st.step_index, started, round((epoch_us(ended) - epoch_us(started)) / 1e6, 2) AS seconds, CASE WHEN ended IS NULL THEN 'unresolved' WHEN status = 'ok' THEN 'completed' ELSE 'failed' END AS status
    FROM st LEFT JOIN en ON st.run_id = en.run_id AND st.step_index = en.step_index
""")
def step_durations(t: Tables) -> DataFrame:
    return runs.step_durations(t.v_progress)


@query("stream_step_pairs", """
    SELECT a.run_id, a.step_index, a.ts AS started, b.ts AS ended, b.status, round((epoch_us(b.ts) - epoch_us(a.ts)) / 1e6, 2) AS seconds
    FROM {v_progress} a JOIN {v_progress} b ON a.run_id = b.run_id AND a.step_index = b.step_index AND a.event = 'step_start' AND b.event = 'step_end' AND b.ts >= a.ts AND b.ts <= a.ts + interval 1 hour
""")
def stream_step_pairs(t: Tables) -> DataFrame:
    pairs = progress.run_available(progress.paired_steps(live(t)), "append")
    return pairs.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("started", "ended")})


@query("stream_run_counts", """
    SELECT date_trunc('hour', ts) AS window_start, event, count(*) AS n, count(*) FILTER (WHERE status = 'error') AS errors FROM {v_progress} GROUP BY ALL
""")
def stream_run_counts(t: Tables) -> DataFrame:
    counts = progress.run_available(progress.windowed_counts(live(t)), "update", ["window_start", "event"])
    return counts.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("run_lifecycle", """
    WITH e AS (SELECT *, count(*) FILTER (WHERE event = 'run_start') OVER w AS starts_before, count(*) FILTER (WHERE event = 'run_end') OVER w AS ends_before FROM {v_progress}
               WINDOW w AS (PARTITION BY run_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
         s AS (SELECT *, lag(event) OVER w AS pe, lag(step_index) OVER w AS pi, lag(ts) OVER w AS pt, lead(event) OVER w AS ne FROM {v_progress} WHERE event <> 'run_start' WINDOW w AS (PARTITION BY run_id ORDER BY ts, seq)),
         x AS (SELECT run_id, 'event after run_end' AS problem, step_index, ts AS happened FROM e WHERE ends_before > 0
               UNION ALL SELECT run_id, 'second run_start', step_index, ts FROM e WHERE event = 'run_start' AND starts_before > 0
               UNION ALL SELECT run_id, 'event before run_start', step_index, ts FROM e WHERE event <> 'run_start' AND starts_before = 0
               UNION ALL SELECT run_id, 'step started inside a step', step_index, ts FROM s WHERE event = 'step_start' AND pe = 'step_start'
               UNION ALL SELECT run_id, 'step_end without step_start', step_index, ts FROM s WHERE event = 'step_end' AND NOT (coalesce(pe, '') = 'step_start' AND pi = step_index)
               UNION ALL SELECT run_id, 'step over time limit', step_index, ts FROM s WHERE event = 'step_end' AND pe = 'step_start' AND pi = step_index AND epoch_us(ts) // 1000000 - epoch_us(pt) // 1000000 > 900
               UNION ALL SELECT run_id, 'run ended inside a step', pi, ts FROM s WHERE event = 'run_end' AND pe = 'step_start'
               UNION ALL SELECT run_id, 'no step_end within time limit', step_index, to_timestamp(epoch_us(ts) // 1000000 + 900) AT TIME ZONE 'UTC' FROM s WHERE event = 'step_start' AND ne IS NULL AND (epoch_us(ts) // 1000000 + 900) * 1000 < (SELECT epoch_ms(max(ts)) FROM {v_progress}) - 3600000)
    SELECT run_id, problem, step_index, happened FROM x
""")
def run_lifecycle(t: Tables) -> DataFrame:
    return ordered.run_through(live(t)).withColumn("happened", F.col("happened").cast("timestamp_ntz"))
