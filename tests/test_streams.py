from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.streaming import streams as S


def stream(spark, df, path, files=3):
    df.repartition(files).write.mode("overwrite").parquet(path)
    return S.read_folder(spark, path, df.schema, 1)


def drained(spark, df, tmp_path, name):
    out = str(tmp_path / name)
    df.writeStream.format("parquet").option("path", out).option("checkpointLocation", out + "-state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def test_stream_equals_batch(spark, rows, tmp_path):
    df = spark.range(60).selectExpr("'s' AS source", "IF(id % 4 = 0, 'One two three four five six', concat('one two three four five n', id % 9)) AS text", "timestamp '2025-01-01' + make_interval(0, 0, 0, 0, 0, CAST(id AS int)) AS at")
    live = stream(spark, df, str(tmp_path / "in"))
    got = drained(spark, S.clean_messages(live), tmp_path, "clean")
    assert rows(got) == rows(S.clean_messages(df))
    first = drained(spark, S.deduplicated(live, "at", "2 hours"), tmp_path, "dedup")
    assert first.count() == df.select(F.lower("text")).distinct().count()


def test_windows(spark, rows, tmp_path):
    df = spark.createDataFrame([("2025-01-01 00:10:00", "a", 1.0), ("2025-01-01 00:50:00", "a", 2.0), ("2025-01-01 01:10:00", "b", 3.0), ("2025-01-02 00:00:00", "a", 9.0)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    out = drained(spark, S.windowed_counts(stream(spark, df, str(tmp_path / "e"), 1)), tmp_path, "w")
    assert rows(out, "event_type", "n", "total") == [("a", 2, 3.0), ("b", 1, 3.0)]
    assert S.windowed_counts(df, slide="30 minutes").count() == 7
    assert rows(S.session_counts(df, by="event_type", gap="45 minutes"), "event_type", "n") == [("a", 1), ("a", 2), ("b", 1)]


def test_each_batch(spark, tmp_path):
    df = spark.range(9).selectExpr("CAST(id AS string) AS text")
    query = S.each_batch(stream(spark, df, str(tmp_path / "b")), lambda b: b.withColumn("text", T.tidied(F.col("text"))), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9


def test_teacher(spark, rows):
    def client():
        def call(texts):
            if "bad" in texts:
                raise ValueError
            return [t.upper() for t in texts]

        return call

    df = spark.createDataFrame([("a",), ("b",), (None,)], "t string")
    assert rows(df.select(S.teacher(spark, client)("t"))) == [("",), ("A",), ("B",)]
    assert rows(spark.createDataFrame([("bad",)], "t string").select(S.teacher(spark, client)("t"))) == [("",)]
