"""Run-log figures and streams; the events table serves as the log."""

from __future__ import annotations

from pyspark.sql import functions as F

from layerkit.operators import checks as C
from layerkit.operators.runlog import state_counts, step_durations
from layerkit.plans.queries.data import table
from layerkit.plans.queries.quality import BY_NAME, EVENT_TYPES
from layerkit.session import new_path
from layerkit.streaming.quality import check_stream, repeated_keys
from layerkit.streaming.windows import append_closed_windows, tumbling_counts, tumbling_counts_stream


def events_stream(spark, sf):
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def stream_tumbling_counts(spark, sf):
    """Windows the watermark has closed, as a stream emits them."""
    path = new_path(spark, "windows")
    stream = events_stream(spark, sf).select("ts", "event_type")
    counts = tumbling_counts_stream(stream, "ts", ["event_type"], "1 day", "1 hour")
    append_closed_windows(counts, f"{path}/out", f"{path}/state").awaitTermination()
    ntz = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return spark.read.schema(counts.schema).parquet(f"{path}/out").withColumns(ntz)


def stream_check_metrics(spark, sf):
    """Metrics of every micro-batch, added up over the batches."""
    path = new_path(spark, "batches")
    wanted = [BY_NAME["event_domain"], C.missing("value", name="no_value", table="events")]
    check_stream(events_stream(spark, sf), wanted, f"{path}/out", f"{path}/state").awaitTermination()
    rows = spark.read.parquet(f"{path}/out").groupBy("check_name")
    return rows.agg(F.sum("total_records").alias("total_records"), F.sum("issues_found").alias("issues_found"))


REPEATED = C.DuplicateCheck(name="repeated", table="events", keys=["user_id", "event_type"], count_as="n")


def stream_repeated_keys(spark, sf):
    """Keys repeated over several micro-batches, each a part of the events."""
    path = new_path(spark, "batches")
    events = table(spark, sf, "events")
    events.repartitionByRange(3, "event_id").write.parquet(f"{path}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    check_stream(stream, [REPEATED], f"{path}/out", f"{path}/state").awaitTermination()
    return repeated_keys(spark, REPEATED, f"{path}/out")


QUERIES = {
    "stream_repeated_keys": stream_repeated_keys,
    "ops_step_duration": lambda spark, sf: step_durations(table(spark, sf, "events"), ["user_id"], "ts"),
    "ops_state_counts": lambda spark, sf: state_counts(table(spark, sf, "events"), "event_type"),
    "ops_tumbling_counts": lambda spark, sf: tumbling_counts(
        table(spark, sf, "events"), "ts", ["event_type"], "1 day"
    ),
    "stream_tumbling_counts": stream_tumbling_counts,
    "stream_check_metrics": stream_check_metrics,
}

_WINDOWS_SQL = """
  SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
         CAST(date_trunc('day', ts) + INTERVAL 1 DAY AS TIMESTAMP) AS window_end,
         event_type, count(*) AS n
  FROM events GROUP BY 1, 2, 3
"""

SQL = {
    "stream_repeated_keys": """
        SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1""",
    "ops_step_duration": """
        SELECT user_id, min(ts) AS started, max(ts) AS ended, count(*) AS entries,
               round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS duration_sec
        FROM events GROUP BY user_id""",
    "ops_state_counts": "SELECT event_type AS state, count(*) AS n FROM events GROUP BY event_type",
    "ops_tumbling_counts": _WINDOWS_SQL,
    "stream_tumbling_counts": f"""
        SELECT * FROM ({_WINDOWS_SQL}) w WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    "stream_check_metrics": f"""
        SELECT 'event_domain' AS check_name, count(*) AS total_records,
               count(CASE WHEN event_type NOT IN ({", ".join(f"'{e}'" for e in EVENT_TYPES)}) THEN 1 END) AS issues_found
        FROM events
        UNION ALL SELECT 'no_value', count(*), count(CASE WHEN value IS NULL THEN 1 END) FROM events""",
}
