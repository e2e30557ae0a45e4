"""Queries of clip manifests and scores, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.draw import draw_sql
from textmill.operators import corpus as C
from textmill.operators import manifest as M
from textmill.operators import metrics as E
from textmill.plans.corpus import FIRST, _tables, sql_collapse, sql_lower, sql_strip
from textmill.session import materialize, spread, table


def _clips(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return spread(table(spark, sf, "train_cv")), table(spark, sf, "eval_cv")


def _leakfree(spark: SparkSession, sf: str) -> DataFrame:
    return M.without_held(*_clips(spark, sf))


def clip_durations(spark: SparkSession, sf: str) -> DataFrame:
    return M.with_durations(table(spark, sf, "train_cv"), table(spark, sf, "cv_durations")).select("clip_id", "seconds")


def manifest_train(spark: SparkSession, sf: str) -> DataFrame:
    return M.short_enough(_leakfree(spark, sf).filter("src <> 'cv_other'"), M.MOST_TRAIN).select("clip_id")


def manifest_other(spark: SparkSession, sf: str) -> DataFrame:
    clean = _leakfree(spark, sf)
    return M.new_by_path(clean.filter("src = 'cv_other'"), clean.filter("src <> 'cv_other'")).select("clip_id")


def leakage_removed(spark: SparkSession, sf: str) -> DataFrame:
    train, held = _clips(spark, sf)
    left = M.without_held(train, held).groupBy("src").agg(F.count(F.lit(1)).alias("n_left"))
    return train.groupBy("src").agg(F.count(F.lit(1)).alias("n")).join(left, "src", "left").select("src", "n", F.coalesce("n_left", F.lit(0)).alias("n_left"))


def held_texts(spark: SparkSession, sf: str) -> DataFrame:
    _, held = _clips(spark, sf)
    return held.filter(T.strip(F.col("text")) != "").select("lang", T.normed(F.col("text")).alias("text")).distinct()


def group_cap(spark: SparkSession, sf: str) -> DataFrame:
    clips = table(spark, sf, "train_cv")
    return M.capped(clips, 0.005).select("clip_id")


def label_verification(spark: SparkSession, sf: str) -> DataFrame:
    return M.verified(spread(table(spark, sf, "train_cv")), F.when(F.col("src") == "cv_other", 0.10).otherwise(0.15)).select("clip_id", "cer")


def eval_sample(spark: SparkSession, sf: str) -> DataFrame:
    return M.fixed_sample(table(spark, sf, "eval_cv"), 100).select("clip_id")


def dev_fallback(spark: SparkSession, sf: str) -> DataFrame:
    return M.dev_split(table(spark, sf, "train_cv")).select("clip_id", "part")


def hours_by_source(spark: SparkSession, sf: str) -> DataFrame:
    return M.hours(table(spark, sf, "train_cv")).select("src", "n_clips", F.round("hours", 6).alias("hours"))


def epoch_heuristic(spark: SparkSession, sf: str) -> DataFrame:
    return M.hours(table(spark, sf, "train_cv"), "lang").select("lang", M.epochs(F.col("hours")).alias("epochs"))


def required_fields(spark: SparkSession, sf: str) -> DataFrame:
    return M.required(table(spark, sf, "eval_cv")).select("clip_id", "audio")


def error_rates_by_source(spark: SparkSession, sf: str) -> DataFrame:
    clips = spread(table(spark, sf, "train_cv")).filter("teacher is not null")
    out = E.error_rates(clips, "text", "teacher", ("lang", "src"))
    return out.select("lang", "src", "n", *[F.round(c, 6).alias(c) for c in ("wer", "cer", "loose_cer")])


def similarity_by_language(spark: SparkSession, sf: str) -> DataFrame:
    pairs = spread(table(spark, sf, "pairs")).filter("input is not null and output is not null")
    return E.similarities(pairs, "output", "input", ("lang", "mode")).select("lang", "mode", "n", F.round("similarity", 6).alias("similarity"))


def metric_pivot(spark: SparkSession, sf: str) -> DataFrame:
    clips = spread(table(spark, sf, "train_cv")).filter("teacher is not null")
    return E.pivoted(E.error_rates(clips, "text", "teacher", ("lang", "src")), "lang", "src", "wer", ["cv", "cv_other", "fleurs", "own_readings"])


def dev_score(spark: SparkSession, sf: str) -> DataFrame:
    clips = table(spark, sf, "train_cv").filter("teacher_cer is not null")
    sets = clips.groupBy("lang", "src").agg(F.avg("teacher_cer").alias("value"))
    return E.mean_of_sets(sets, "lang", "value").select("lang", F.round("score", 6).alias("score"))


def best_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    clips = table(spark, sf, "train_cv").filter("teacher_cer is not null")
    steps = clips.groupBy("lang", F.floor(F.col("clip_id") / 500).alias("step")).agg(F.round(F.avg("teacher_cer"), 3).alias("score"))
    return E.earliest_best(steps, ("lang",), "step", "score")


def results_merged(spark: SparkSession, sf: str) -> DataFrame:
    old = table(spark, sf, "train_cv").groupBy("lang", "src").agg(F.count(F.lit(1)).alias("n"))
    new = table(spark, sf, "eval_cv").groupBy("lang", "src").agg(F.count(F.lit(1)).alias("n")).filter("src <> 'cv'")
    return E.merged_results(old, new, ("lang", "src"))


def _guesses(spark: SparkSession, sf: str) -> DataFrame:
    ws = F.filter(F.split(F.lower("text"), " "), lambda w: w != "")
    pairs = F.explode(F.expr("transform(sequence(1, greatest(size(ws) - 1, 1)), i -> struct(ws[i - 1] AS before, ws[i] AS word))"))
    rows = C.prepared(*_tables(spark, sf)).select("lang", (F.pmod("doc_id", F.lit(10)) == 0).alias("held"), ws.alias("ws")).filter("size(ws) > 1").select("lang", "held", pairs.alias("p")).select("lang", "held", "p.*")
    # pairs of words are counted before anything is joined, so that a frequent word has no more rows than words that follow it
    counts = materialize(rows.groupBy("lang", "held", "before", "word").agg(F.count(F.lit(1)).alias("n")), "counts")
    return counts.filter("held").join(E.top_k(counts.filter("not held"), ("lang", "before")), ["lang", "before"], "left")


def next_word_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    out = E.accuracies(_guesses(spark, sf), F.col("word"), F.col("best"), "lang", F.col("n"))
    return out.select("kind", "n", F.round("top1", 6).alias("top1"), F.round("top3", 6).alias("top3"))


def fastest_backend(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return E.first_success(events, ("user_id",), F.col("event_type") != "error", "value", "event_id")


def licences(spark: SparkSession, sf: str) -> DataFrame:
    from textmill.operators.catalog import unknown_licence

    return table(spark, sf, "source_notes").select("source_name", unknown_licence(F.col("license")).alias("unknown"))


QUERIES = {f.__name__: f for f in (manifest_train, clip_durations, manifest_other, leakage_removed, held_texts, group_cap, label_verification, eval_sample, dev_fallback, hours_by_source, epoch_heuristic, required_fields, error_rates_by_source, similarity_by_language, metric_pivot, dev_score, best_checkpoint, results_merged, next_word_accuracy, fastest_backend, licences)}

_norm = lambda x: sql_collapse(rf"regexp_replace(nfc_normalize({sql_lower(x)}), '[^\p{{L}}\p{{N}}_\t\n\x0B\f\r\x1c-\x1f\x{{85}}\p{{Z}}]', ' ', 'g')")
_FREE = f"""texts AS (SELECT DISTINCT lang, {_norm("text")} AS t FROM eval_cv WHERE {sql_strip("text")} <> ''),
speakers AS (SELECT DISTINCT left(speaker, 16) AS s FROM eval_cv WHERE trim(speaker) <> ''),
free AS (SELECT * FROM train_cv c WHERE {sql_strip("text")} <> '' AND NOT EXISTS (SELECT 1 FROM speakers WHERE s = left(c.speaker, 16)) AND NOT EXISTS (SELECT 1 FROM texts t WHERE t.lang = c.lang AND t.t = {_norm("c.text")}))"""
# the SQL's edit distance counts bytes, so the distinct parts of a pair become ASCII characters, one each
_POOL = "array_to_string(list_transform(range(1, 128), lambda i: chr(i::INT)), '')"


def sql_edited(a: str, b: str) -> str:
    """Characters of a to change into b."""
    known = f"array_to_string(list_distinct(string_split({a} || {b}, '')), '')"
    return f"levenshtein(translate({a}, {known}, {_POOL}), translate({b}, {known}, {_POOL}))"


def sql_words_edited(a: str, b: str) -> str:
    """Words of list a to change into list b."""
    coded = lambda ws: f"array_to_string(list_transform({ws}, lambda w: chr(list_position(list_distinct(list_concat({a}, {b})), w)::INT)), '')"
    return f"levenshtein({coded(a)}, {coded(b)})"


_loose = lambda x: f"strip_accents(replace({_norm(x)}, 'ς', 'σ'))"
_dash = lambda x: f"coalesce(nullif({x}, ''), '-')"
_RATES = f"""forms AS (SELECT lang, src, {_dash(_norm("coalesce(text, '')"))} AS r, {_dash(_norm("teacher"))} AS h, {_dash(_loose("coalesce(text, '')"))} AS lr, {_dash(_loose("teacher"))} AS lh FROM train_cv WHERE teacher IS NOT NULL),
split AS (SELECT *, list_filter(string_split(r, ' '), lambda w: w <> '') AS rw, list_filter(string_split(h, ' '), lambda w: w <> '') AS hw FROM forms),
rates AS (SELECT lang, src, count(*) AS n, sum({sql_words_edited("rw", "hw")}) / sum(len(rw)) AS wer, sum({sql_edited("r", "h")}) / sum(length(r)) AS cer, sum({sql_edited("lr", "lh")}) / sum(length(lr)) AS loose_cer FROM split GROUP BY lang, src)"""
ORACLE = {
    "error_rates_by_source": f"WITH {_RATES} SELECT lang, src, n, round(wer, 6) AS wer, round(cer, 6) AS cer, round(loose_cer, 6) AS loose_cer FROM rates",
    "metric_pivot": f"WITH {_RATES} SELECT lang, " + ", ".join(f"coalesce(max(printf('%.4f', wer)) FILTER (WHERE src = '{s}'), 'n/a') AS {s}" for s in ("cv", "cv_other", "fleurs", "own_readings")) + " FROM rates GROUP BY lang",
    "similarity_by_language": f"SELECT lang, mode, count(*) AS n, round(avg(CASE WHEN length(output) > 0 THEN 1 - least(1, {sql_edited('output', 'input')} / length(output)) ELSE 0 END), 6) AS similarity FROM pairs WHERE input IS NOT NULL AND output IS NOT NULL GROUP BY lang, mode",
    "label_verification": f"""WITH f AS (SELECT clip_id, src, {_loose("coalesce(text, '')")} AS a, {_loose("teacher")} AS z FROM train_cv WHERE {sql_strip("teacher")} <> ''), c AS (SELECT clip_id, src, {sql_edited("a", "z")} / length(a) AS cer FROM f WHERE length(a) > 0)
        SELECT clip_id, round_even(cer, 3) AS cer FROM c WHERE cer <= CASE WHEN src = 'cv_other' THEN 0.10 ELSE 0.15 END""",
    "group_cap": f"""WITH RECURSIVE o AS (SELECT clip_id, clip_group AS g, greatest(coalesce(dur, 0), 0) AS l, row_number() OVER (PARTITION BY clip_group ORDER BY {draw_sql(1, "cap", "clip_id")}, clip_id) AS k FROM train_cv WHERE clip_group IS NOT NULL),
        t AS (SELECT g, 0::BIGINT AS k, 0::DOUBLE AS s, NULL::BIGINT AS clip_id, false AS taken FROM (SELECT DISTINCT g FROM o)
            UNION ALL SELECT o.g, o.k, CASE WHEN round(t.s + o.l, 6) <= 18 THEN t.s + o.l ELSE t.s END, o.clip_id, round(t.s + o.l, 6) <= 18 FROM t JOIN o ON o.g = t.g AND o.k = t.k + 1)
        SELECT clip_id FROM t WHERE taken UNION ALL SELECT clip_id FROM train_cv WHERE clip_group IS NULL""",
    "clip_durations": "SELECT clip_id, coalesce((SELECT max(duration_ms) / 1000.0 FROM cv_durations d WHERE d.clip = string_split(coalesce(audio, ''), '/')[-1]), 0.0)::DOUBLE AS seconds FROM train_cv",
    "manifest_train": f"WITH {_FREE} SELECT clip_id FROM free WHERE src <> 'cv_other' AND coalesce(dur, 0) <= 29.5",
    "manifest_other": f"WITH {_FREE} SELECT clip_id FROM free WHERE src = 'cv_other' AND audio NOT IN (SELECT audio FROM free WHERE src <> 'cv_other' AND audio IS NOT NULL)",
    "leakage_removed": f"WITH {_FREE} SELECT t.src, count(*) AS n, count(f.clip_id) AS n_left FROM train_cv t LEFT JOIN free f ON t.clip_id = f.clip_id GROUP BY t.src",
    "held_texts": f"SELECT DISTINCT lang, {_norm('text')} AS text FROM eval_cv WHERE {sql_strip('text')} <> ''",
    "eval_sample": f"SELECT clip_id FROM eval_cv WHERE coalesce(dur, 0) <= 30 ORDER BY {draw_sql(7, 'eval', 'clip_id')}, clip_id LIMIT 100",
    "dev_fallback": f"SELECT clip_id, CASE WHEN row_number() OVER (ORDER BY {draw_sql(1, 'dev', 'clip_id')}, clip_id) <= least(200, greatest(1, (SELECT count(*) FROM train_cv) // 20)) THEN 'dev' ELSE 'train' END AS part FROM train_cv",
    "hours_by_source": "SELECT src, count(*) AS n_clips, round(sum(coalesce(dur, 0)) / 3600, 6) AS hours FROM train_cv GROUP BY src",
    "epoch_heuristic": "SELECT lang, CASE WHEN sum(coalesce(dur, 0)) / 3600 < 15 THEN 10 WHEN sum(coalesce(dur, 0)) / 3600 < 50 THEN 6 ELSE 4 END AS epochs FROM train_cv GROUP BY lang",
    "required_fields": "SELECT clip_id, audio FROM eval_cv",
    "dev_score": "SELECT lang, round(avg(v), 6) AS score FROM (SELECT lang, src, avg(teacher_cer) AS v FROM train_cv WHERE teacher_cer IS NOT NULL GROUP BY lang, src) GROUP BY lang",
    "best_checkpoint": "WITH s AS (SELECT lang, clip_id // 500 AS step, round(avg(teacher_cer), 3) AS score FROM train_cv WHERE teacher_cer IS NOT NULL GROUP BY lang, clip_id // 500) SELECT lang, step, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score, step) AS r FROM s) WHERE r = 1",
    "results_merged": "WITH o AS (SELECT lang, src, count(*) AS n FROM train_cv GROUP BY lang, src), w AS (SELECT lang, src, count(*) AS n FROM eval_cv WHERE src <> 'cv' GROUP BY lang, src) SELECT * FROM w UNION ALL SELECT * FROM o WHERE (lang, src) NOT IN (SELECT lang, src FROM w)",
    "next_word_accuracy": f"""WITH {FIRST}, w AS (SELECT lang, doc_id % 10 AS fold, list_filter(string_split({sql_lower("text")}, ' '), lambda x: x <> '') AS ws FROM prepared), i AS (SELECT *, unnest(range(1, len(ws))) AS i FROM w),
        p AS (SELECT lang, fold, ws[i] AS before, ws[i + 1] AS word FROM i), c AS (SELECT lang, before, word, count(*) AS n FROM p WHERE fold <> 0 GROUP BY ALL),
        t AS (SELECT *, row_number() OVER (PARTITION BY lang, before ORDER BY n DESC, word) AS r FROM c), b AS (SELECT lang, before, list(word ORDER BY r) AS best FROM t WHERE r <= 3 GROUP BY lang, before),
        h AS (SELECT p.lang AS kind, coalesce(best[1] = word, false)::INT AS a, coalesce(list_contains(best, word), false)::INT AS z FROM p LEFT JOIN b ON p.lang = b.lang AND p.before = b.before WHERE fold = 0)
        SELECT coalesce(kind, 'ALL') AS kind, count(*) AS n, round(avg(a), 6) AS top1, round(avg(z), 6) AS top3 FROM h GROUP BY GROUPING SETS ((kind), ()) HAVING grouping(kind) = 1 OR trim(kind) <> ''""",
    "fastest_backend": "SELECT user_id, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value, event_id) AS r FROM events WHERE event_type <> 'error') WHERE r = 1",
    "licences": "SELECT source_name, coalesce(contains(upper(license), 'UNKNOWN'), true) AS unknown FROM source_notes",
}
