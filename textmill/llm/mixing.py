"""Problem 7: mixing sources to target weights.

Capped water-filling: with a total size given, each source's part is its weight's share; sources that would need more than
their highest number of repetitions are clamped there, and what they lack is spread over the others in proportion to
their weights, until nothing exceeds its cap. A part of x times a source's size is its every text floor(x) times, and
once more those texts that come first in a seeded order, as far as they fit into the fraction's size, and of the others the
one that brings the size nearest to it, if any does; the running sizes are taken in ranges of that order, so that no task gets
a whole source.

Defined cases: texts of null or unlisted sources are left out, and so are sources of null or zero weight; a null cap means
once; null and empty texts have no size and are left out; listed sources without texts get nothing, and their weight is
spread; if all caps together are below the total, all sources are at their caps; extra columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.functions.draw import draw
from textmill.llm.tokens import TOKENIZER, counted
from textmill.operators.skew import running
from textmill.session import materialize

#: Most sources in a configuration; their weights are filled on the driver.
MOST_SOURCES = 100_000


def water_fill(sizes: dict[str, int], weights: dict[str, float], caps: dict[str, float], total: float | None = None) -> dict[str, float]:
    """The size that each source gives. total: None means the size of all sources that have a weight."""
    open_ = {s for s, w in weights.items() if w > 0}
    room = {s: sizes.get(s, 0) * max(0.0, caps.get(s, 1)) for s in open_}
    left = float(sum(sizes.get(s, 0) for s in open_) if total is None else total)
    given = dict.fromkeys(weights, 0.0)
    while open_ and left > 0:
        whole = sum(weights[s] for s in open_)
        full = {s for s in open_ if weights[s] / whole * left >= room[s]}
        if not full:
            for s in open_:
                given[s] = weights[s] / whole * left
            break
        for s in full:
            given[s] = float(room[s])
        left -= sum(room[s] for s in full)
        open_ -= full
    return given


def mixed(docs: DataFrame, config: DataFrame, total: float | None = None, seed: int = 1, path: str = TOKENIZER) -> DataFrame:
    """doc_id, source, n_tokens, copies (1 or more) of each text of the mix, with the source's target and available
    size, for shares()."""
    spark = docs.sparkSession
    listed = config.filter("source_name is not null").select("source_name", "mix", "max_repeat").limit(MOST_SOURCES + 1).collect()
    if len(listed) > MOST_SOURCES:
        raise ValueError("too many sources in the configuration")
    weights = {r[0]: max(0.0, r[1] or 0.0) for r in listed}
    caps = {r[0]: 1 if r[2] is None else r[2] for r in listed}
    names = [(name,) for name, w in weights.items() if w > 0]
    wanted = F.broadcast(spark.createDataFrame(names, "source string"))  # MOST_SOURCES rows at most
    sized = materialize(counted(docs.join(wanted, "source"), "doc_id", "text", ["source"], path).filter("n_tokens > 0"), "sizes")
    sizes = {r[0]: int(r[1]) for r in sized.groupBy("source").agg(F.sum("n_tokens")).collect()}  # at most MOST_SOURCES rows
    given = water_fill(sizes, weights, caps, total)
    whole = sum(weights.values()) or 1.0
    rows = [(s, int(given[s] // n), given[s] - int(given[s] // n) * n, n, weights[s] / whole) for s, n in sizes.items()]
    schema = "source string, times int, rest double, available bigint, target double"
    parts = F.broadcast(spark.createDataFrame(rows, schema))
    drawn = sized.withColumn("_u", draw(seed, "mix", F.col("source"), F.col("doc_id")))
    placed = running(drawn, ["source"], ["_u", "doc_id"], "_before", F.col("n_tokens")).join(parts, "source")
    placed = placed.withColumn("_in", F.col("_before") + F.col("n_tokens") <= F.col("rest")).withColumn("_row", F.monotonically_increasing_id())
    placed = materialize(placed.drop("_before"), "placed")
    gaps = F.broadcast(placed.groupBy("source").agg((F.max("rest") - F.sum(F.when(F.col("_in"), F.col("n_tokens")).otherwise(0))).alias("_gap")))
    off = F.abs(F.col("n_tokens") - F.col("_gap"))
    best = placed.filter("not _in").join(gaps, "source").filter(off < F.col("_gap")).groupBy("source").agg(F.min(F.struct(off.alias("off"), "_u", "_row")).alias("_b"))
    placed = placed.join(F.broadcast(best.select("source", F.col("_b._row").alias("_last"))), "source", "left")
    once = (F.col("_in") | F.coalesce(F.col("_row") == F.col("_last"), F.lit(False))).cast("int")
    return placed.withColumn("copies", F.col("times") + once).filter("copies > 0").select("doc_id", "source", "n_tokens", "copies", "target", "available")


def shares(mix: DataFrame, config: DataFrame) -> DataFrame:
    """source_name, target, reached (shares of all tokens), n_tokens, epochs, capped: one row for each listed source of a weight."""
    used = mix.groupBy(F.col("source").alias("source_name")).agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("n_tokens"), F.max("available").alias("available"))
    listed = config.filter("source_name is not null and mix > 0").select("source_name", "mix", F.coalesce("max_repeat", F.lit(1)).alias("cap"))
    out = listed.join(used, "source_name", "left")
    whole = Window.partitionBy()  # over the listed sources, a row each
    tokens = F.coalesce("n_tokens", F.lit(0))
    epochs = F.coalesce(F.col("n_tokens") / F.col("available"), F.lit(0.0))
    return out.select("source_name", (F.col("mix") / F.sum("mix").over(whole)).alias("target"), (tokens / F.sum(tokens).over(whole)).alias("reached"), tokens.alias("n_tokens"), epochs.alias("epochs"), (epochs >= F.col("cap") - 1e-9).alias("capped"))
