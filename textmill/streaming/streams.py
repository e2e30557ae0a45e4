"""The row-wise operators on streams, and what of the others has a bounded state.

Cleaning, filters, tidying and flags are Column functions and run on streams unchanged. First-occurrence deduplication keeps
its keys until the watermark has passed them, so it equals the batch result for rows that come within it. Windows by event
time are an extension.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textmill.functions import text as T


def read_folder(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:  # noqa: ANN001
    """A stream of the Parquet files that appear in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def clean_messages(lines: DataFrame) -> DataFrame:
    """lines that pass as messages, tidied."""
    return lines.filter(T.is_message(F.col("text"))).withColumn("text", T.tidied(T.collapse(F.col("text"))))


def deduplicated(lines: DataFrame, time: str, delay: str, by: tuple[str, ...] = ("source",)) -> DataFrame:
    """The first of each text, ignoring letter case, within by; copies later than delay after it may come again."""
    keyed = lines.withColumn("_k", F.md5(F.lower("text"))).withWatermark(time, delay)
    return keyed.dropDuplicatesWithinWatermark([*by, "_k"]).drop("_k")


def windowed_counts(events: DataFrame, time: str = "ts", by: str = "event_type", width: str = "1 hour", slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """start, by, n, total of tumbling or sliding windows; rows later than delay are dropped."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    out = events.withWatermark(time, delay).groupBy(w, by).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), by, "n", "total")


def session_counts(events: DataFrame, time: str = "ts", by: str = "user_id", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """start, end, by, n of sessions that a gap ends."""
    out = events.withWatermark(time, delay).groupBy(F.session_window(time, gap), by).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), by, "n")


def each_batch(stream: DataFrame, apply: Callable[[DataFrame], DataFrame], path: str, checkpoint: str):  # noqa: ANN201
    """Write apply(batch) of each batch to its own folder, so that a batch that is repeated after a failure isn't doubled."""

    def write(batch: DataFrame, number: int) -> None:
        apply(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def teacher(spark: SparkSession, client: Callable[[], Callable[[list[str]], list[str]]], size: int = 60):  # noqa: ANN201
    """A function of a text column that asks a client for rewrites, in groups of size; each task makes its client once.
    An item that fails three times gives an empty text."""
    @F.pandas_udf(StringType())
    def ask(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        call = client()

        def tried(group: list[str]) -> list[str]:
            for _ in range(3):
                try:
                    return call(group)
                except Exception:  # noqa: BLE001 - a client may fail in any way
                    continue
            return [""] * len(group)

        for t in texts:
            values = t.fillna("").tolist()
            yield pd.Series([x for k in range(0, len(values), size) for x in tried(values[k : k + size])], index=t.index)

    return ask
