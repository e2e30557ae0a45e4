"""Queries of streams: run over what there is, and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators import corpus as C
from textmill.plans.corpus import LINES, sql_lower
from textmill.session import materialize, shared_dir, table, temporary
from textmill.streaming import streams as R


def _stream(df: DataFrame, label: str) -> DataFrame:
    """df, stored, as a stream of its files."""
    stored = materialize(df, label)
    return R.read_folder(df.sparkSession, stored.inputFiles()[0].rpartition("/")[0], stored.schema)


def _drained(stream: DataFrame, label: str, mode: str = "append") -> DataFrame:
    """All that a stream of what there is gives, as a table."""
    spark = stream.sparkSession
    at = temporary(spark, f"{shared_dir(spark)}/textmill-{uuid.uuid4().hex}")
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{at}/{label}").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/{label}")


def events_window_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that the watermark has closed; the last ones are still open and not written."""
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    out = _drained(R.windowed_counts(_stream(events, "events")), "windows")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n", F.round("total", 2).alias("total"))


def events_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions that the watermark has closed."""
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id")
    out = _drained(R.session_counts(_stream(events, "events")), "sessions")
    return out.select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "user_id", "n")


def stream_messages(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.lines(table(spark, sf, "documents")).filter("source is not null")
    return _drained(R.clean_messages(_stream(rows, "lines")), "messages").select("source", "doc_id", "line_no")


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    rows = C.lines(table(spark, sf, "documents")).filter("source is not null").withColumn("at", F.lit("2025-01-01").cast("timestamp"))
    out = _drained(R.deduplicated(_stream(rows, "lines"), "at", "1 hour"), "first")
    return out.select("source", F.md5(F.lower("text")).alias("text_md5"))


QUERIES = {f.__name__: f for f in (events_window_counts, events_sessions, stream_messages, stream_dedup)}

ORACLE = {
    "events_window_counts": "WITH w AS (SELECT date_trunc('hour', ts) AS s, event_type, value, max(ts) OVER () AS m FROM events) SELECT strftime(s, '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM w GROUP BY s, event_type HAVING s + INTERVAL 1 HOUR <= date_trunc('millisecond', max(m)) - INTERVAL 1 HOUR",
    "events_sessions": "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events), m AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR AS m FROM events), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT strftime(date_trunc('second', min(ts)), '%Y-%m-%d %H:%M:%S') AS start, user_id, count(*) AS n FROM s GROUP BY user_id, k HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT m FROM m)",
    "stream_dedup": f"WITH {LINES} SELECT DISTINCT source, md5({sql_lower('text')}) AS text_md5 FROM lines WHERE source IS NOT NULL",
}
from textmill.plans.pairs import ORACLE as _PAIRS  # noqa: E402

ORACLE["stream_messages"] = _PAIRS["message_filter"]
