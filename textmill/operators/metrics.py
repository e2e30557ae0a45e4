"""Scores of outputs, and tables of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.functions import score as S
from textmill.functions import text as T


def error_rates(rows: DataFrame, ref: str, hyp: str, by: tuple[str, ...]) -> DataFrame:
    """by, n, wer, cer, loose_cer over all rows together: edits by reference units; an empty text counts as '-'."""
    text = lambda c, f: F.when(f(F.coalesce(F.col(c), F.lit(""))) == "", "-").otherwise(f(F.coalesce(F.col(c), F.lit(""))))
    rows = rows.select(*by, text(ref, T.normed).alias("r"), text(hyp, T.normed).alias("h"), text(ref, T.loosened).alias("lr"), text(hyp, T.loosened).alias("lh"))
    r, h = F.col("r"), F.col("h")
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        (F.sum(S.words_edited(r, h)) / F.sum(F.size(S.words(r)))).alias("wer"),
        (F.sum(S.chars_edited(r, h)) / F.sum(F.length(r))).alias("cer"),
        (F.sum(S.chars_edited(F.col("lr"), F.col("lh"))) / F.sum(F.length("lr"))).alias("loose_cer"),
    )


def similarities(rows: DataFrame, ref: str, hyp: str, by: tuple[str, ...]) -> DataFrame:
    """by, n, similarity: the mean over rows of 1 less the clipped error rate."""
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg(S.similarity(F.col(ref), F.col(hyp))).alias("similarity"))


def top_k(counts: DataFrame, key: tuple[str, ...], k: int = 3) -> DataFrame:
    """key, best: the k words that follow most often, ties by the word. counts: key, word, n."""
    w = Window.partitionBy(*key).orderBy(F.desc("n"), "word")
    top = counts.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
    return top.groupBy(*key).agg(F.transform(F.sort_array(F.collect_list(F.struct("_r", "word"))), lambda x: x["word"]).alias("best"))


def accuracies(rows: DataFrame, gold: Column, guesses: Column, kind: str, times: Column | None = None) -> DataFrame:
    """kind (ALL: all rows), n, top1, top3: shares of rows whose gold is the first, or one of the guesses, each row counted
    times. Rows of a blank kind count in ALL only."""
    hit = rows.select(F.col(kind).alias("kind"), (F.lit(1) if times is None else times).alias("_n"), F.coalesce(F.try_element_at(guesses, F.lit(1)) == gold, F.lit(False)).cast("int").alias("_1"), F.coalesce(F.array_contains(guesses, gold), F.lit(False)).cast("int").alias("_3"))
    out = hit.groupingSets([["kind"], []], "kind").agg(F.grouping("kind").alias("_g"), F.coalesce(F.sum("_n"), F.lit(0)).alias("n"), (F.sum(F.col("_1") * F.col("_n")) / F.sum("_n")).alias("top1"), (F.sum(F.col("_3") * F.col("_n")) / F.sum("_n")).alias("top3"))
    return out.filter("_g = 1 or trim(kind) <> ''").select(F.when(F.col("_g") == 1, "ALL").otherwise(F.col("kind")).alias("kind"), "n", "top1", "top3")


def pivoted(results: DataFrame, rows: str, columns: str, value: str, names: list[str]) -> DataFrame:
    """A row for each of rows, a column for each name, n/a where there is no value."""
    wide = results.groupBy(rows).pivot(columns, names).agg(F.first(value))
    return wide.select(rows, *[F.when(F.col(n).isNull(), "n/a").otherwise(F.format_string("%.4f", F.col(n))).alias(n) for n in names])


def mean_of_sets(results: DataFrame, model: str, value: str) -> DataFrame:
    """model, score: the unweighted mean over sets."""
    return results.groupBy(model).agg(F.avg(value).alias("score"))


def earliest_best(scores: DataFrame, by: tuple[str, ...], step: str, score: str) -> DataFrame:
    """by, step, score: the lowest score, the earliest if there are several."""
    return scores.groupBy(*by).agg(F.min(F.struct(score, step)).alias("_b")).select(*by, F.col("_b")[step].alias(step), F.col("_b")[score].alias(score))


def merged_results(old: DataFrame, new: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """old with the rows of new in place of those with the same key."""
    return old.join(new.select(*key).distinct(), list(key), "left_anti").unionByName(new)


def first_success(runs: DataFrame, by: tuple[str, ...], ok: Column, millis: str, result: str) -> DataFrame:
    """by, result: that of the fastest run that succeeded, ties by the result."""
    good = runs.filter(ok)
    return good.groupBy(*by).agg(F.min(F.struct(millis, result)).alias("_m")).select(*by, F.col("_m")[result].alias(result))
