"""Joins and ranks that hold when one key has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.session import materialize

#: A key with more than this share of the rows is hot; there are at most HOT_SHARE**-1 such keys, so that they can be broadcast.
HOT_SHARE = 1 / 1000


def attach(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """rows with the columns of their group (one row a key in groups, whose column size counts the key's rows).

    Hot keys, of which there can be no more than 1 / HOT_SHARE, are broadcast, so that their rows stay where they
    are; the others are joined by a shuffle. Rows with a null in a key match nothing and are dropped (how=inner) or
    kept with nulls (how=left).
    """
    limit = max(1.0, total * HOT_SHARE)
    hot = groups.filter(F.col(size) > limit)
    marked = rows.join(F.broadcast(hot.select(*keys, F.lit(True).alias("_hot"))), keys, "left")
    near = marked.filter(F.col("_hot")).drop("_hot").join(F.broadcast(hot), keys, "inner")
    far = marked.filter(F.col("_hot").isNull()).drop("_hot").join(groups.filter(F.col(size) <= limit), keys, how)
    return near.unionByName(far)


def running(df: DataFrame, keys: list[str], order: list[str], name: str, weight: Column | None = None) -> DataFrame:
    """df with the column name: of each row how many rows of its key come before it in the order of the columns order
    (their weights added up, if given). Rows of equal order are taken in any order; keys may be null.

    The rows are cut into ranges of key and order, so that a hot key lies in many of them, and stored with their range's
    number; sums run within a key's range, in a task of its own, and of the keys that lie in several ranges, fewer than there are
    ranges, the ranges' sums before are broadcast.
    """
    step = F.lit(1) if weight is None else weight
    cut = df.withColumn("_run_w", step).repartitionByRange(*keys, *order).withColumn("_run_p", F.spark_partition_id())
    cut = materialize(cut, "ranges")
    sums = cut.groupBy(*keys, "_run_p").agg(F.sum("_run_w").alias("_run_s"))
    within = Window.partitionBy(*keys, "_run_p").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("_run_p").rowsBetween(Window.unboundedPreceding, -1)
    # a range that isn't a key's first one: no more such pairs than ranges
    later = sums.withColumn("_run_o", F.sum("_run_s").over(before)).filter("_run_o is not null").select(*[F.col(k).alias("_run_k" + k) for k in keys], F.col("_run_p").alias("_run_q"), "_run_o")
    same = F.col("_run_p") == F.col("_run_q")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col("_run_k" + k))
    out = cut.withColumn("_run_r", F.coalesce(F.sum("_run_w").over(within), F.lit(0))).join(F.broadcast(later), same, "left")
    return out.withColumn(name, F.col("_run_r") + F.coalesce("_run_o", F.lit(0))).drop("_run_w", "_run_p", "_run_q", "_run_r", "_run_o", *["_run_k" + k for k in keys])


#: Rows of a group up to which the engine lets only a group's first rows leave a task.
GROUP_LIMIT = 1000


def first_of_each(df: DataFrame, most: int, keys: list[str], order: list[str]) -> DataFrame:
    """The first most rows of each key in the order of the columns order."""
    if most <= GROUP_LIMIT:
        ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        return ranked.filter(F.col("_n") <= most).drop("_n")
    return running(df, keys, order, "_n").filter(F.col("_n") < most).drop("_n")
