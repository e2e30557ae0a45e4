"""Queries of vocabularies, names and runs of models, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators import models as O
from textmill.plans.corpus import sql_collapse, sql_lower
from textmill.session import spread, table

NUMBERS = ["two", "three", "four", "dy", "tri", "dos", "tres", "δύο", "τρία", "τρεις"]
REPLACEMENTS = [(r"[“”„«»]", '"'), (r"…", "..."), (r"\p{Zs}+([.!?,;:])", "$1")]


def languages_named(spark: SparkSession, sf: str) -> DataFrame:
    tags = table(spark, sf, "documents").filter("lang is not null").select("lang").distinct()
    return O.named(tags, O.language_names(spark))


def transcripts_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    clips = T.composed(spread(table(spark, sf, "train_cv")).filter("text is not null").select("clip_id", "text"), "text")
    return clips.select("clip_id", O.transcripts_cleaned(F.col("text"), REPLACEMENTS).alias("text"))


def vocabulary_map(spark: SparkSession, sf: str) -> DataFrame:
    ids = lambda df: df.select("token", F.conv(F.substring(F.md5("token"), 1, 8), 16, 10).cast("long").alias("id"))
    tokens = lambda df, c: df.filter(F.col(c).isNotNull()).select(F.explode(F.regexp_extract_all(c, F.lit(r"\p{L}+"), 0)).alias("token")).distinct()
    student, teacher = ids(tokens(table(spark, sf, "eval_cv"), "text")), ids(tokens(table(spark, sf, "train_cv"), "text"))
    return O.vocabulary_mapped(student, teacher, student.select("token", F.lower("token").alias("alias")), -1)


def number_words(spark: SparkSession, sf: str) -> DataFrame:
    pairs = table(spark, sf, "pairs").filter("output is not null").select("pair_id", O.words_among(F.col("output"), NUMBERS).alias("w"))
    return pairs.filter(F.size("w") > 0).select("pair_id", F.size("w").alias("n"), F.array_join("w", " ").alias("words"))


def length_batches(spark: SparkSession, sf: str) -> DataFrame:
    return O.by_length(table(spark, sf, "eval_cv"), "dur", 16, "src", "clip_id").select("clip_id", "batch")


def models_by_set(spark: SparkSession, sf: str) -> DataFrame:
    out = O.each_model(table(spark, sf, "eval_cv"), ["small", "base", "tiny"])
    return out.groupBy("model", "lang", "split").agg(F.count(F.lit(1)).alias("n"))


def beam_guesses(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return O.ranked_guesses(events, ("user_id",), T.prediction_key(F.col("event_type")), "value", 3)


QUERIES = {f.__name__: f for f in (languages_named, transcripts_cleaned, vocabulary_map, number_words, length_batches, models_by_set, beam_guesses)}

_NUMBERS = ", ".join(f"'{n}'" for n in NUMBERS)
_tokens = lambda t: rf"(SELECT DISTINCT unnest(regexp_extract_all(text, '\p{{L}}+')) AS token FROM {t} WHERE text IS NOT NULL)"
ORACLE = {
    "languages_named": "SELECT DISTINCT lang, CASE lower(lang[1:2]) WHEN 'el' THEN 'Greek' WHEN 'sq' THEN 'Albanian' WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish' ELSE lower(lang) END AS lang_name FROM documents WHERE lang IS NOT NULL",
    "transcripts_cleaned": rf"""SELECT clip_id, {sql_collapse(r"regexp_replace(regexp_replace(regexp_replace(nfc_normalize(text), '[“”„«»]', '" + '"' + r"', 'g'), '…', '...', 'g'), '\p{Zs}+([.!?,;:])', '\1', 'g')")} AS text FROM train_cv WHERE text IS NOT NULL""",
    "vocabulary_map": f"""WITH s AS {_tokens("eval_cv")}, t AS {_tokens("train_cv")}, i AS (SELECT token, ('0x' || substr(md5(token), 1, 8))::BIGINT AS id FROM t)
        SELECT s.token, ('0x' || substr(md5(s.token), 1, 8))::BIGINT AS id, coalesce(a.id, b.id, -1) AS teacher_id FROM s LEFT JOIN i a ON a.token = s.token LEFT JOIN i b ON b.token = CASE WHEN regexp_matches(s.token, '\\p{{L}}Σ$') THEN regexp_replace(lower(s.token), 'σ$', 'ς') ELSE lower(s.token) END""",
    "number_words": rf"""WITH w AS (SELECT pair_id, list_distinct(list_filter(regexp_extract_all({sql_lower("output")}, '[\p{{L}}\p{{N}}\p{{M}}_''’-]+'), lambda x: x IN ({_NUMBERS}))) AS w, regexp_extract_all({sql_lower("output")}, '[\p{{L}}\p{{N}}\p{{M}}_''’-]+') AS o FROM pairs WHERE output IS NOT NULL)
        SELECT pair_id, len(w)::INT AS n, array_to_string(list_sort(list_transform(w, lambda x: {{'p': list_position(o, x), 'x': x}})).list_transform(lambda s: s.x), ' ') AS words FROM w WHERE len(w) > 0""",
    "length_batches": "SELECT clip_id, (row_number() OVER (PARTITION BY src ORDER BY coalesce(dur, 0), clip_id) - 1) // 16 AS batch FROM eval_cv",
    "models_by_set": "SELECT model, lang, split, count(*) AS n FROM eval_cv, (SELECT unnest(['small', 'base', 'tiny']) AS model) GROUP BY ALL",
    "beam_guesses": "WITH b AS (SELECT user_id, lower(event_type) AS guess, max(value) AS s FROM events GROUP BY ALL) SELECT user_id, guess, r::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, guess) AS r FROM b) WHERE r <= 3",
}
