"""Keys, taps and typing errors."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.functions.draw import draw
from textmill.session import materialize

# Rows of the usual layouts with their offsets, in key widths.
LAYOUTS = {"en": (("qwertyuiop", 0.0), ("asdfghjkl", 0.5), ("zxcvbnm", 1.5)), "sq": (("qwertzuiopç", 0.0), ("asdfghjklë", 0.5), ("yxcvbnm", 2.0)), "el": ((";ςερτυθιοπ", 0.0), ("ασδφγηξκλ", 0.5), ("ζχψωβνμ", 1.5)), "es": (("qwertyuiop", 0.0), ("asdfghjklñ", 0.0), ("zxcvbnm", 1.5))}
#: Width of the weights around a tap, and the smallest weight that counts.
SPREAD, LEAST = 0.35, 0.05


@dataclass(frozen=True)
class Taps:
    """Chances of tap errors, one draw for all kinds."""

    drop: float = 0.08
    extra: float = 0.06
    swap: float = 0.05
    double: float = 0.03
    partial: float = 0.35
    seed: int = 1


@dataclass(frozen=True)
class Rule:
    """One typing error: kind and arguments; p as a stage or as part of a choice."""

    kind: str
    p: float
    args: dict = field(default_factory=dict)
    least: int = 0
    fallthrough: bool = False


def keys(spark: SparkSession, layouts: dict = LAYOUTS) -> DataFrame:
    """lang, key, x, y: centres of keys; a key i of row r lies at (offset + i + 0.5, r + 0.5)."""
    rows = [(lang, c, x0 + i + 0.5, r + 0.5) for lang, lines in layouts.items() for r, (line, x0) in enumerate(lines) for i, c in enumerate(line)]
    return spark.createDataFrame(rows, "lang string, key string, x double, y double")


def row_offsets(rows: DataFrame) -> DataFrame:
    """lang, row, offset: half of what a row lacks to the widest one. rows: lang, row, keys (first of each key)."""
    widest = F.max(F.length("keys")).over(Window.partitionBy("lang"))
    return rows.select("lang", "row", ((widest - F.length("keys")) / 2).alias("offset"))


def neighbours(keys: DataFrame, n: int = 4) -> DataFrame:
    """lang, key, near, rank (from 1): the n nearest other letter keys, ties by the key. Keyboards have a few dozen keys."""
    letters = keys.filter(F.col("key").rlike(r"^\p{L}$"))
    other = letters.select("lang", F.col("key").alias("near"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    d2 = F.round(F.pow(F.col("x") - F.col("x2"), 2) + F.pow(F.col("y") - F.col("y2"), 2), 6)
    pairs = letters.join(other, "lang").filter("key <> near").withColumn("d2", d2)
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "key").orderBy("d2", "near"))).filter(F.col("rank") <= n).select("lang", "key", "near", "rank", "d2")


def mixed(taps: DataFrame, keys: DataFrame, sigma: float, id: tuple[str, ...], seed: int = 1, n: int = 4) -> DataFrame:
    """taps (lang, key, id) with near, weight: the n letter keys nearest to a tap beside the key's centre, weighted by
    distance; small weights are dropped and the others add up to 1. Keys that a layout lacks are left out; in languages without
    a layout each key is hit for sure."""
    u = lambda k: draw(seed, "tap" + k, *[F.col(c) for c in id])
    radius = F.sqrt(-2 * F.ln(F.greatest(u("1"), F.lit(1e-10))))
    at = taps.join(F.broadcast(keys), ["lang", "key"])  # a few dozen keys a language
    at = at.withColumn("_x", F.col("x") + sigma * radius * F.cos(2 * 3.141592653589793 * u("2"))).withColumn("_y", F.col("y") + 0.8 * sigma * radius * F.sin(2 * 3.141592653589793 * u("2"))).drop("x", "y")
    letters = keys.filter(F.col("key").rlike(r"^\p{L}$")).groupBy("lang").agg(F.collect_list(F.struct("key", "x", "y")).alias("_k"))
    ranked = at.join(F.broadcast(letters), "lang").withColumn("_n", F.slice(F.array_sort(F.transform("_k", lambda k: F.struct((F.pow(k["x"] - F.col("_x"), 2) + F.pow(k["y"] - F.col("_y"), 2)).alias("d2"), k["key"].alias("key")))), 1, n))
    weights = F.transform("_n", lambda k: F.struct(k["key"].alias("near"), F.exp(-k["d2"] / (2 * SPREAD**2)).alias("w")))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, k: a + k["w"])
    ranked = ranked.withColumn("_w", weights).withColumn("_t", total("_w")).withColumn("_w", F.filter("_w", lambda k: k["w"] / F.col("_t") >= LEAST)).withColumn("_t", total("_w"))
    hit = ranked.select(*taps.columns, "_t", F.posexplode("_w").alias("rank", "_e")).select(*taps.columns, "rank", F.col("_e.near").alias("near"), (F.col("_e.w") / F.col("_t")).alias("weight"))
    sure = taps.join(F.broadcast(keys.select("lang").distinct()), "lang", "left_anti").select(*taps.columns, F.lit(0).alias("rank"), F.col("key").alias("near"), F.lit(1.0).alias("weight"))
    return hit.unionByName(sure)


def known_keys(keys: DataFrame) -> DataFrame:
    """lang, _known: the letter keys of each layout, a few dozen."""
    return keys.filter(F.col("key").rlike(r"^\p{L}$")).groupBy("lang").agg(F.collect_set("key").alias("_known"))


def base_letters(word: Column, own: str = "ëç", accents: str = "áéíóúüñàèìòùâêîôûäëïöåçάέήίόύώϊϋΐΰ", plain: str = "aeiouunaeiouaeiouaeioacαεηιουωιυιυ") -> Column:
    """What the keys under the finger were: lower case, no accents but on letters that have a key of their own."""
    kept = "".join(a for a in accents if a not in own)
    to = "".join(p for a, p in zip(accents, plain) if a not in own)
    return F.translate(F.lower(word), kept, to)


def applied(rule: Rule, k: Column, u: Column, v: Column) -> Column:
    """k with one rule applied, null if it doesn't fit. u, v: draws for its choices."""
    a, n = rule.args, F.length(k)
    pick = lambda options, d: F.element_at(options, (F.floor(d * F.size(options)) + 1).cast("int"))
    if rule.kind == "replace_all":
        out = k
        for x, y in a["map"].items():
            out = F.replace(out, F.lit(x), F.lit(y))
        out = F.when(k.rlike("[" + "".join(a["map"]) + "]"), out)
    elif rule.kind == "drop_final":
        out = F.when(k.rlike(f"[{a['letters']}]$"), F.substring(k, F.lit(1), n - 1))
    elif rule.kind == "final":
        out = F.lit(None).cast("string")
        for x, y in a["map"].items():
            out = F.when(k.endswith(x), F.concat(F.substring(k, F.lit(1), n - 1), F.lit(y))).otherwise(out)
    elif rule.kind == "replace_one":
        chars = F.split(k, "")
        at = F.filter(F.transform(chars, lambda c, i: F.when(c.isin(list(a["map"])), i + 1)), lambda i: i.isNotNull())
        where = pick(at, u).cast("int")
        new = F.lit(None).cast("string")
        for x, ys in a["map"].items():
            new = F.when(F.substring(k, where, F.lit(1)) == x, pick(F.array(*[F.lit(y) for y in ys]), v)).otherwise(new)
        out = F.when(F.size(at) > 0, F.concat(F.substring(k, F.lit(1), where - 1), new, F.substring(k, where + 1, n)))
    elif rule.kind == "substitute":
        start = a.get("from", 0)
        options = F.array(*[F.struct(F.lit(x).alias("a"), F.lit(y).alias("b")) for x, y in a["pairs"]])
        if a.get("pick", "present") == "present":
            options = F.filter(options, lambda o: F.contains(F.substring(k, F.lit(start + 1), n), o["a"]))
        one = pick(F.when(F.size(options) > 0, options), u)
        at = F.filter(F.sequence(F.lit(start + 1), F.greatest(F.lit(start + 1), n)), lambda i: F.substring(k, i, F.length(one["a"])) == one["a"])
        where = F.when(F.size(at) > 0, F.element_at(at, 1) if a.get("occurrence") == "first" else pick(at, v))
        out = F.when(one.isNull(), F.lit(None).cast("string")).when(where.isNull(), k).otherwise(F.concat(F.substring(k, F.lit(1), where - 1), one["b"], F.substring(k, where + F.length(one["a"]), n)))
    elif rule.kind == "ending":
        out = F.lit(None).cast("string")
        for group in reversed(a["groups"]):
            for e in sorted(group, key=len):
                others = F.array(*[F.lit(x) for x in group if x != e])
                out = F.when(k.endswith(e), F.concat(F.substring(k, F.lit(1), n - len(e)), pick(others, u))).otherwise(out)
    else:
        raise ValueError(f"unknown rule: {rule.kind}")
    return F.when(n >= rule.least, out)


def staged(k: Column, stage: list[Rule], draws: tuple[Column, Column, Column]) -> Column:
    """k after one stage: one draw over the rules' chances, added up; a rule that doesn't fit does nothing, unless it falls
    through to the next."""
    r, u, v = draws
    out, low = k, 0.0
    tops = []
    for rule in stage:
        low += rule.p
        tops.append(low)
    for rule, top in reversed(list(zip(stage, tops))):
        got = applied(rule, k, u, v)
        out = F.when(r < top, F.coalesce(got, out if rule.fallthrough else k)).otherwise(out)
    return out


def typed(words: DataFrame, keys: DataFrame, stages: dict[str, list[list[Rule]]], how: Taps = Taps(), id: tuple[str, ...] = ("word_id",), word: str = "word") -> DataFrame:
    """words with keys_typed: the keys of a word after typing and tap errors, unknown keys removed; in languages without a layout
    all keys are known and have no neighbours. words: lang, word, id."""
    u = lambda salt, *more: draw(how.seed, salt, *[F.col(c) for c in id], *more)
    k = base_letters(F.col(word))
    out = words.withColumn("_k", k)
    for lang, list_ in stages.items():
        for number, stage in enumerate(list_):
            draws = (u(f"stage{number}"), u(f"stage{number}-u"), u(f"stage{number}-v"))
            out = out.withColumn("_k", F.when(F.col("lang") == lang, staged(F.col("_k"), stage, draws)).otherwise(F.col("_k")))
    near = neighbours(keys).groupBy("lang", "key").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "near"))), lambda x: x["near"]).alias("n"))
    maps = near.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("key", "n"))).alias("_near"))  # a few dozen keys a language
    out = out.join(F.broadcast(maps), "lang", "left")
    cum = [how.drop, how.drop + how.extra, how.drop + how.extra + how.swap, how.drop + how.extra + how.swap + how.double]
    c, n, r = F.split("_k", ""), F.length("_k"), u("tap")
    i = F.floor(u("where") * n).cast("int")  # from 0
    j = (F.floor(u("where") * (n - 1)) + 1).cast("int")  # from 1, never the first
    at = F.substring("_k", i + 1, F.lit(1))
    options = F.coalesce(F.try_element_at("_near", at), F.array(at))
    added = F.element_at(options, (F.floor(u("which") * F.size(options)) + 1).cast("int"))
    head = lambda m: F.substring("_k", F.lit(1), m)
    tail = lambda m: F.substring("_k", m + 1, n)
    s = (F.floor(u("where") * (n - 1))).cast("int")
    taps = (
        F.when((n > 3) & (r < cum[0]), F.concat(head(j), tail(j + 1)))
        .when((n > 2) & (r < cum[1]), F.concat(head(i + 1), added, tail(i + 1)))
        .when((n > 3) & (r < cum[2]), F.concat(head(s), F.substring("_k", s + 2, F.lit(1)), F.substring("_k", s + 1, F.lit(1)), tail(s + 2)))
        .when((n > 2) & (r < cum[3]), F.concat(head(i + 1), at, tail(i + 1)))
        .otherwise(F.col("_k"))
    )
    out = out.withColumn("_k", taps)
    part = (F.floor(u("partial-at") * (n - 1)) + 1).cast("int")
    out = out.withColumn("_k", F.when((n > 2) & (u("partial") < how.partial), head(part)).otherwise(F.col("_k")))
    known = F.filter(F.split("_k", ""), lambda x: F.coalesce(F.map_contains_key("_near", x), F.lit(True)))
    return out.withColumn("keys_typed", F.array_join(known, "")).drop("_k", "_near")


def with_errors(words: DataFrame, keys: DataFrame, stages: dict[str, list[list[Rule]]], how: Taps = Taps(), id: tuple[str, ...] = ("word_id",), word: str = "word", attempts: int = 20) -> DataFrame:
    """typed(), but of up to attempts tries the first with an error that leaves at most one key out; the last one if none
    has."""
    base = base_letters(F.col(word))
    good = (F.length("keys_typed") >= F.length(base) - 1) & (F.col("keys_typed") != base)
    rest, done = words, None
    for low, high in ((0, 2), (2, 7), (7, attempts)):  # most words need few tries
        if low >= min(high, attempts):
            continue
        high = min(high, attempts)
        tries = rest.withColumn("_try", F.explode(F.sequence(F.lit(low), F.lit(high - 1))))
        out = typed(tries, keys, stages, how, (*id, "_try"), word)
        first = out.groupBy(*words.columns).agg(F.min(F.struct((~good).alias("bad"), F.when(good, F.col("_try")).otherwise(-F.col("_try")).alias("n"), "keys_typed")).alias("_f"))
        first = materialize(first, "tries")
        got = first.filter(F.lit(high == attempts) | ~F.col("_f.bad")).select(*words.columns, F.col("_f.keys_typed").alias("keys_typed"))
        done = got if done is None else done.unionByName(got)
        rest = first.filter("_f.bad").select(*words.columns)
    return done


def conditions(words: DataFrame, keys: DataFrame, typed_: str = "keys_typed", word: str = "word") -> DataFrame:
    """words with condition, keys, sigma: clean (base letters), typos (with errors) and partial (the first 0.6). Keys that the
    layout (keys) of a language lacks are left out, and conditions without any key too."""
    base = base_letters(F.col(word))
    short = F.substring(base, F.lit(1), F.greatest(F.lit(1), F.bround(F.length(base) * 0.6, 0)).cast("int"))
    kinds = F.array(F.struct(F.lit("clean").alias("condition"), base.alias("keys"), F.lit(0.15).alias("sigma")), F.struct(F.lit("typos").alias("condition"), F.col(typed_).alias("keys"), F.lit(0.35).alias("sigma")), F.struct(F.lit("partial").alias("condition"), short.alias("keys"), F.lit(0.15).alias("sigma")))
    each = words.select("*", F.inline(kinds)).join(F.broadcast(known_keys(keys)), "lang", "left")
    known = F.array_join(F.filter(F.split("keys", ""), lambda x: F.coalesce(F.array_contains("_known", x), F.lit(True))), "")
    return each.withColumn("keys", known).drop("_known").filter("keys <> ''")
