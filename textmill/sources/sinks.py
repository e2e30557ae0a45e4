"""Writers of lines, pairs, manifests, word lists, results and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.operators.lexicon import combined, header
from textmill.sources.readers import exists


def guarded(df: DataFrame, path: str, force: bool = False) -> bool:
    """Write df as Parquet unless there is something at path; force overwrites it. Whether it was written."""
    if not force and exists(df.sparkSession, path + "/_SUCCESS"):
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def by_source(df: DataFrame, path: str) -> None:
    """A folder of Parquet files for each source. Rows aren't shuffled: a hot source is written by all tasks."""
    df.write.mode("overwrite").partitionBy("source").parquet(path)


def lines(df: DataFrame, path: str, column: str = "text") -> None:
    """Text files of a column, a line each."""
    df.select(F.regexp_replace(column, r"[\r\n]+", " ").alias("value")).write.mode("overwrite").text(path)


def jsonl(df: DataFrame, path: str) -> None:
    """JSON lines; characters stay as they are, null fields are left out."""
    df.write.mode("overwrite").option("ignoreNullFields", "true").json(path)


def manifest(df: DataFrame, path: str, folder: str) -> float:
    """A manifest with audio paths relative to folder; the hours written."""
    start = folder.rstrip("/") + "/"
    audio = F.when(F.col("audio").startswith(start), F.substring("audio", F.lit(len(start) + 1), F.length("audio"))).otherwise(F.col("audio"))
    out = df.withColumn("audio", audio)
    jsonl(out, path)
    return float(out.agg(F.sum(F.coalesce("dur", F.lit(0.0)))).first()[0] or 0.0) / 3600


def wordlist(rows: DataFrame, path: str, locale: str, description: str, version: int = 1, date: int = 0) -> None:
    """A word list: the header, then the words by frequency and word, both descending. Files are range-partitioned and in
    order by name."""
    first = rows.sparkSession.createDataFrame([(header(locale, description, version, date),)], "value string")
    body = combined(rows).orderBy(F.desc("f"), F.desc("word")).select(F.col("line").alias("value"))
    first.coalesce(1).write.mode("overwrite").text(path + "/0-header")
    body.write.mode("overwrite").text(path + "/1-words")


def stats(df: DataFrame, path: str) -> None:
    """A small table as one JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)


def merge_results(spark: SparkSession, new: DataFrame, path: str, key: tuple[str, ...]) -> None:
    """Put new in place of the stored results of the same key; the others stay."""
    from textmill.operators.metrics import merged_results
    from textmill.session import materialize

    if exists(spark, path):
        new = materialize(merged_results(spark.read.parquet(path), new, key), "results")
    new.write.mode("overwrite").parquet(path)


def checksums(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """path, size, sha256 of files. A file is one value; it must fit into a task."""
    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def mismatched(found: DataFrame, expected: DataFrame) -> DataFrame:
    """path, problem of files whose size or checksum isn't the one expected, or that are missing."""
    both = expected.select("path", F.col("size").alias("_s"), F.col("sha256").alias("_h")).join(found, "path", "left")
    problem = F.when(F.col("size").isNull(), "missing").when(F.col("size") != F.col("_s"), "size").when(F.col("sha256") != F.col("_h"), "sha256")
    return both.select("path", problem.alias("problem")).filter("problem is not null")


def attribution(notes: DataFrame, results: DataFrame | None = None, most: int = 1000) -> str:
    """A Markdown page: the sources with licences, a warning for unknown ones, and error rates by model and set. notes and
    results are small tables; more than most rows of either are an error."""
    from textmill.operators.catalog import unknown_licence

    rows = notes.select("source_name", "url", "license", "use_note", "citation", unknown_licence(F.col("license")).alias("unknown")).orderBy("source_name").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError("too many sources for a page")
    text = lambda v: str(v or "").replace("|", "\\|")
    out = ["| Source | Licence | Use |", "| --- | --- | --- |"]
    out += [f"| [{text(r[0])}]({text(r[1])}) | {text(r[2]) or 'unknown'} | {text(r[3])} |" for r in rows]
    if unknown := [r[0] for r in rows if r[5]]:
        out += ["", "Licence unknown, check before publishing: " + ", ".join(unknown)]
    cited = [f"* {text(r[4])}" for r in rows if r[4]]
    out += ["", *cited] if cited else []
    if results is not None:
        sets = [r[0] for r in results.select("set").distinct().orderBy("set").limit(most + 1).collect()]
        if len(sets) > most:
            raise ValueError("too many sets for a page")
        wide = results.groupBy("model").pivot("set", sets).agg(F.first("wer")).orderBy("model").limit(most + 1).collect()
        if len(wide) > most:
            raise ValueError("too many models for a page")
        out += ["", "| Model | " + " | ".join(sets) + " |", "| --- |" + " --- |" * len(sets)]
        out += [f"| {r[0]} | " + " | ".join("n/a" if v is None else f"{v:.1%}" for v in r[1:]) + " |" for r in wide]
        total = results.agg(F.sum("repetitions"), F.sum("n")).first()
        out += ["", f"Runaway repetitions: {total[0] or 0} of {total[1] or 0}"]
    return "\n".join(out) + "\n"
