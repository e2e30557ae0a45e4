"""What is around models: vocabularies, examples by length, runs of several models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.functions import locale as L
from textmill.operators.skew import running


def language_names(spark: SparkSession) -> DataFrame:
    """code, name (in English) of the languages that the Java runtime knows, a few hundred rows."""
    java = spark.sparkContext._jvm.java.util.Locale
    rows = [(str(c), str(java.forLanguageTag(c).getDisplayLanguage(java.ENGLISH))) for c in java.getISOLanguages()]
    return spark.createDataFrame(rows, "code string, name string")


def named(rows: DataFrame, names: DataFrame, tag: str = "lang") -> DataFrame:
    """rows with lang_name: the name of the tag's language, the tag itself in lower case where there is none."""
    known = names.select(F.col("code").alias("_code"), F.col("name").alias("lang_name"))
    out = rows.withColumn("_code", L.language(F.col(tag))).join(F.broadcast(known), "_code", "left")
    return out.withColumn("lang_name", F.coalesce("lang_name", F.lower(tag))).drop("_code")


def transcripts_cleaned(text: Column, replacements: list[tuple[str, str]]) -> Column:
    """text (in form C) after the regular replacements in order, blanks collapsed."""
    from textmill.functions.text import collapse

    for pattern, to in replacements:
        text = F.regexp_replace(text, pattern, to)
    return collapse(text)


def decoded(data: Column) -> Column:
    """Bytes as text; bytes that aren't UTF-8 are left out."""
    return F.regexp_replace(F.make_valid_utf8(data.cast("string")), "�", "")


def vocabulary_mapped(student: DataFrame, teacher: DataFrame, aliases: DataFrame, default: int) -> DataFrame:
    """token, id, teacher_id: of each of the student's tokens the teacher's id by the same string, else by its alias, else
    default. student, teacher: token, id; aliases: token, alias."""
    theirs = teacher.select("token", F.col("id").alias("_own"))
    other = aliases.join(teacher.select(F.col("token").alias("alias"), F.col("id").alias("_other")), "alias").select("token", "_other")
    return student.join(theirs, "token", "left").join(other, "token", "left").select("token", "id", F.coalesce("_own", "_other", F.lit(default)).alias("teacher_id"))


def words_among(text: Column, listed: list[str]) -> Column:
    """The distinct words of text that are among listed, in the order of text."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}\p{M}_'’-]+"), 0)
    return F.array_intersect(words, F.array(*[F.lit(w) for w in listed]).cast("array<string>"))


def by_length(rows: DataFrame, length: str, batch: int, by: str, order: str) -> DataFrame:
    """rows with batch: rows of a group in the order of length, cut into batches, so that a batch has rows of like length."""
    ranked = running(rows.withColumn("_l", F.coalesce(length, F.lit(0.0))), [by], ["_l", order], "batch")
    return ranked.withColumn("batch", F.floor(F.col("batch") / batch)).drop("_l")


def each_model(rows: DataFrame, models: list[str]) -> DataFrame:
    """rows once for each model, with model."""
    return rows.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models])))


def file_choice(base: Column, adapter: Column, merged: Column) -> Column:
    """Which files serve a language: adapter with its base if both are there, else the merged model, else none."""
    return F.when(base.isNotNull() & adapter.isNotNull(), F.concat(base, F.lit("+"), adapter)).otherwise(merged)


def ranked_guesses(rows: DataFrame, by: tuple[str, ...], guess: Column, score: str, k: int = 3) -> DataFrame:
    """by, guess, rank (from 1): the k best of a beam's words; words that are the same as a guess count once, the best."""
    best = rows.select(*by, guess.alias("guess"), score).filter("guess <> ''").groupBy(*by, "guess").agg(F.max(score).alias("_s"))
    w = Window.partitionBy(*by).orderBy(F.desc("_s"), "guess")
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("_s")
