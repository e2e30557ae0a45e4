"""Messages from lines: joining, choosing, sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.draw import draw
from textmill.operators.skew import first_of_each, running
from textmill.session import materialize


def joined(lines: DataFrame, seed: int = 1, by: tuple[str, ...] = ("source", "doc_id"), most: int = 3) -> DataFrame:
    """by, message_no, text: consecutive lines of a conversation joined to messages. At each line a size is drawn from 1
    to most; when as many lines wait, they become a message; what waits at the end is dropped. A conversation, one
    text here, is folded as an array."""
    size = F.floor(draw(seed, "join", *[F.col(b) for b in by], F.col("line_no")) * most + 1).cast("int")
    whole = lines.select(*by, "line_no", "text", size.alias("k")).groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("line_no", "text", "k"))).alias("_l"))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.array().cast("array<string>").alias("buf"))

    def add(acc: Column, line: Column) -> Column:
        buf = F.array_append(acc["buf"], line["text"])
        full = F.size(buf) >= line["k"]
        return F.struct(F.when(full, F.array_append(acc["out"], F.array_join(buf, " "))).otherwise(acc["out"]).alias("out"), F.when(full, F.array().cast("array<string>")).otherwise(buf).alias("buf"))

    return whole.select(*by, F.posexplode(F.aggregate("_l", start, add, lambda acc: acc["out"])).alias("message_no", "text"))


def usable(rows: DataFrame) -> DataFrame:
    """Messages that pass the message predicate, composed and tidied; each text once over all sources, the first by
    source, doc_id and line_no."""
    good = T.composed(rows.filter(T.is_message(F.col("text"))), "text").withColumn("text", T.tidied(F.col("text")))
    order = [c for c in good.columns if c != "text"]
    return good.groupBy("text").agg(F.min(F.struct(*order)).alias("_f")).select("_f.*", "text")


def reservoir(rows: DataFrame, n: int, key: tuple[str, ...], seed: int = 1, by: tuple[str, ...] = ("source",)) -> DataFrame:
    """n rows of each group at random, all if there are fewer."""
    drawn = rows.withColumn("_d", draw(seed, "reservoir", *[F.col(k) for k in key]))
    return first_of_each(drawn, n, list(by), ["_d", *key]).drop("_d")


def stratified(rows: DataFrame, n: int, share: float, stratum: Column, key: tuple[str, ...], seed: int = 1, by: tuple[str, ...] = ("source",)) -> DataFrame:
    """n rows of each group: int(n * share) of the stratum if there are as many, the rest of the others."""
    want = int(n * share)
    # at most n rows a group and stratum from here on
    ranked = materialize(reservoir(rows.withColumn("_s", F.coalesce(stratum.cast("boolean"), F.lit(False))), n, key, seed, (*by, "_s")), "strata")
    ranked = ranked.withColumn("_d", draw(seed, "reservoir", *[F.col(k) for k in key]))
    ranked = running(ranked, [*by, "_s"], ["_d", *key], "_r").filter(~F.col("_s") | (F.col("_r") < want))
    taken = ranked.groupBy(*by).agg(F.count_if("_s").alias("_k"))
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col("_k" + b))
    joined = ranked.join(taken.select(*[F.col(b).alias("_k" + b) for b in by], "_k"), same)
    return joined.filter(F.col("_s") | (F.col("_r") < n - F.col("_k"))).select(*rows.columns)


def shared(rows: DataFrame, shares: DataFrame, n: int, key: tuple[str, ...], seed: int = 1) -> DataFrame:
    """int(n * share) rows of each source at random, and all of those with always. shares: source, share, always."""
    known = rows.join(F.broadcast(shares), "source").withColumn("_d", draw(seed, "share", *[F.col(k) for k in key]))
    always = F.coalesce("always", F.lit(False))
    some = running(known.filter(~always), ["source"], ["_d", *key], "_r").filter(F.col("_r") < F.floor(F.lit(n) * F.coalesce("share", F.lit(0.0)))).drop("_r")
    return some.unionByName(known.filter(always)).select(*rows.columns)
