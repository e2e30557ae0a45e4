"""Clip manifests: durations, leak-free sets, verified labels, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import score as S
from textmill.functions import text as T
from textmill.functions.draw import draw
from textmill.operators.skew import first_of_each, running
from textmill.session import materialize

#: Longest clips, in seconds.
MOST_TRAIN, MOST_EVAL = 29.5, 30.0
#: Clips of a group that are gone through at once.
FOLDED = 500


def with_durations(clips: DataFrame, durations: DataFrame) -> DataFrame:
    """clips with seconds: the length listed under the last part of audio, 0.0 where none is; of several the greatest."""
    best = durations.filter("clip is not null").groupBy("clip").agg((F.max("duration_ms") / 1000).alias("seconds"))
    named = clips.withColumn("clip", F.element_at(F.split(F.coalesce("audio", F.lit("")), "/"), -1))
    return named.join(best, "clip", "left").withColumn("seconds", F.coalesce("seconds", F.lit(0.0))).drop("clip")


def without_held(clips: DataFrame, held: DataFrame, text: str = "text", speaker: str = "speaker") -> DataFrame:
    """clips with a text, whose speaker (first 16 characters) and normalised text no held clip of the language has. Null speakers match
    nobody. The held side is reduced to distinct keys before the join."""
    key = lambda df: df.withColumn("_s", F.substring(speaker, 1, 16)).withColumn("_t", F.md5(T.normed(F.col(text))))
    mine = key(clips.filter(T.strip(F.col(text)) != ""))
    theirs = key(held.filter(T.strip(F.col(text)) != ""))
    speakers = key(held).filter("_s is not null and trim(_s) <> ''").select("_s").distinct()
    texts = theirs.select("lang", "_t").distinct()
    return mine.join(speakers, "_s", "left_anti").join(texts, ["lang", "_t"], "left_anti").drop("_s", "_t")


def short_enough(clips: DataFrame, most: float, seconds: str = "dur") -> DataFrame:
    """clips of at most most seconds; a missing length counts as 0 and passes."""
    return clips.filter(F.coalesce(seconds, F.lit(0.0)) <= most)


def new_by_path(clips: DataFrame, have: DataFrame) -> DataFrame:
    """clips whose audio isn't among those of have."""
    return clips.join(have.select("audio").filter("audio is not null").distinct(), "audio", "left_anti")


def verified(clips: DataFrame, most: Column, text: str = "text", heard: str = "teacher") -> DataFrame:
    """clips that a teacher heard nearly as labelled: loose character error rate at most most; with cer, to 3 digits."""
    loose = lambda c: T.loosened(F.coalesce(F.col(c), F.lit("")))
    rated = clips.filter(F.coalesce(T.strip(F.col(heard)), F.lit("")) != "")
    rated = T.computed(T.computed(rated, _a=loose(text), _z=loose(heard)), _cer=S.cer(F.col("_a"), F.col("_z"))).drop("_a", "_z")
    return rated.filter(F.col("_cer") <= most).withColumn("cer", F.bround("_cer", 3)).drop("_cer")


def capped(clips: DataFrame, hours: float, by: str = "clip_group", id: str = "clip_id", seconds: str = "dur", seed: int = 1) -> DataFrame:
    """clips in a seeded order, each taken if its group then has at most hours; a shorter one later on may still fit.
    Clips without a group are all taken.

    The order's longest prefix that fits is taken by running sums over ranges. What is left of the cap, less than a clip's length,
    is then filled by the next FOLDED clips of every group that fit by themselves, gone through in order; usually there are fewer, and
    one round does. Clips of no length fit always. No task holds a group.
    """
    length = F.coalesce(F.col(seconds), F.lit(0.0))
    free = clips.filter(F.col(by).isNull())
    drawn = clips.filter(F.col(by).isNotNull()).withColumn("_d", draw(seed, "cap", F.col(id))).withColumn("_l", F.greatest(length, F.lit(0.0)))
    cap = hours * 3600
    placed = running(drawn, [by], ["_d", id], "_from", F.col("_l")).withColumn("_to", F.round(F.col("_from") + F.col("_l"), 6)).drop("_from")
    placed = materialize(placed, "cap")
    taken = placed.filter(F.col("_to") <= cap)
    rest = placed.filter((F.col("_to") > cap) & (F.col("_l") > 0))
    none = placed.filter((F.col("_to") > cap) & (F.col("_l") <= 0))
    state = taken.groupBy(by).agg(F.sum("_l").alias("_sum")).join(rest.select(by).distinct(), by, "right")
    state = materialize(state.select(by, (F.lit(cap) - F.coalesce("_sum", F.lit(0.0))).alias("_room"), F.struct(F.lit(-1.0).alias("_d"), F.lit(None).cast(rest.schema[id].dataType).alias(id)).alias("_from")), "room")
    more = None
    while True:
        # of every group the next clips that fit by themselves, a bounded number, are gone through in order; those between them fit no more
        fits = rest.join(state, by).filter((F.round("_l", 6) <= F.round("_room", 6)) & (F.struct("_d", id) > F.col("_from")))
        block = first_of_each(fits.select(by, "_d", id, "_l", "_room"), FOLDED, [by], ["_d", id])
        block = block.groupBy(by).agg(F.first("_room").alias("_room"), F.sort_array(F.collect_list(F.struct("_d", id, "_l"))).alias("_c"))
        start = F.struct(F.col("_room").alias("room"), F.array().cast(f"array<{rest.schema[id].dataType.simpleString()}>").alias("ids"))

        def take(acc: Column, c: Column) -> Column:
            ok = F.round(c["_l"], 6) <= F.round(acc["room"], 6)
            return F.struct(F.when(ok, acc["room"] - c["_l"]).otherwise(acc["room"]).alias("room"), F.when(ok, F.array_append(acc["ids"], c[id])).otherwise(acc["ids"]).alias("ids"))

        block = materialize(block.select(by, "_c", F.aggregate("_c", start, take).alias("_a")), "fit")
        new = block.select(by, F.explode("_a.ids").alias(id))
        more = new if more is None else more.unionByName(new)
        last = F.element_at("_c", -1)
        state = block.filter(F.size("_c") == FOLDED).select(by, F.col("_a.room").alias("_room"), F.struct(last["_d"].alias("_d"), last[id].alias(id)).alias("_from"))
        if state.isEmpty():
            break
    out = taken.unionByName(none).select(*clips.columns)
    out = out.unionByName(rest.join(more, [by, id], "left_semi").select(*clips.columns))
    return free.unionByName(out)


def fixed_sample(clips: DataFrame, n: int, seed: int = 7, id: str = "clip_id", seconds: str = "dur") -> DataFrame:
    """n clips that aren't too long, by a seeded order; 0 means all."""
    usable = short_enough(clips, MOST_EVAL, seconds)
    return usable.orderBy(draw(seed, "eval", F.col(id)), id).limit(n) if n else usable


def dev_split(clips: DataFrame, most: int = 200, per: int = 20, seed: int = 1, id: str = "clip_id") -> DataFrame:
    """clips with part: dev for min(most, max(1, clips / per)) of them, by a seeded order, else train."""
    total = clips.count()
    want = min(most, max(1, total // per)) if total else 0
    dev = clips.select(id).orderBy(draw(seed, "dev", F.col(id)), id).limit(want).withColumn("_dev", F.lit(True))
    return clips.join(F.broadcast(dev), id, "left").withColumn("part", F.when(F.col("_dev"), "dev").otherwise("train")).drop("_dev")  # most rows at most


def hours(clips: DataFrame, by: str = "src", seconds: str = "dur") -> DataFrame:
    """by, n_clips, hours."""
    return clips.groupBy(by).agg(F.count(F.lit(1)).alias("n_clips"), (F.sum(F.coalesce(seconds, F.lit(0.0))) / 3600).alias("hours"))


def epochs(total_hours: Column) -> Column:
    """How often to go over so many hours of speech."""
    return F.when(total_hours < 15, 10).when(total_hours < 50, 6).otherwise(4)


def required(rows: DataFrame, fields: tuple[str, ...] = ("audio", "text")) -> DataFrame:
    """rows, failing as they are read if one lacks a field."""
    missing = F.lit(False)
    for f in fields:
        missing = missing | F.col(f).isNull()
    checked = F.when(missing, F.raise_error(F.concat(F.lit("a row lacks one of " + ", ".join(fields) + ": "), F.to_json(F.struct("*"))))).otherwise(F.col(fields[0]))
    return rows.withColumn(fields[0], checked)
