"""A catalogue of versioned artifacts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import locale as L

_VARIANT = "struct<name:string,size:bigint,sha256:string,url:string>"
INDEX = f"struct<version:int,models:array<struct<id:string,kind:string,locale:string,title:string,description:string,version:int,size:bigint,sha256:string,url:string,license:string,info_url:string,variants:array<{_VARIANT}>>>>"


def entries(indexes: DataFrame, json: str = "json") -> DataFrame:
    """id, kind, locale, title, version, license, variant, n_variant (from 0), is_default, size, sha256, url: the variants of
    the entries of indexes of version 1. An entry is left out if it lacks a field that it needs, or one of its addresses
    isn't https; without variants it is its own."""
    root = F.from_json(F.col(json), INDEX)
    each = indexes.select(root.alias("_r")).filter("_r.version = 1").select(F.explode("_r.models").alias("m")).select("m.*")
    own = F.struct(F.lit("").alias("name"), F.col("size"), F.col("sha256"), F.col("url"))
    each = each.withColumn("_v", F.when(F.size(F.coalesce("variants", F.array())) > 0, F.col("variants")).otherwise(F.array(own)))
    needed = F.lit(True)
    for c in ("id", "kind", "locale", "title", "size", "sha256", "url"):
        needed = needed & F.col(c).isNotNull()
    sound = F.forall("_v", lambda v: v["url"].startswith("https://") & v["size"].isNotNull() & v["sha256"].isNotNull() & v["name"].isNotNull())
    each = each.filter(needed & F.coalesce(sound, F.lit(False)))
    first = F.greatest(F.lit(0), F.array_position(F.transform("_v", lambda v: v["url"]), F.col("url")) - 1)
    out = each.select("id", "kind", "locale", "title", F.coalesce("version", F.lit(1)).alias("version"), "license", first.alias("_d"), F.posexplode("_v").alias("n_variant", "v"))
    return out.select("id", "kind", "locale", "title", "version", "license", F.col("v.name").alias("variant"), "n_variant", (F.col("n_variant") == F.col("_d")).alias("is_default"), F.col("v.size").alias("size"), F.col("v.sha256").alias("sha256"), F.col("v.url").alias("url"))


def for_locale(found: DataFrame, tags: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    """tag and the entries of kinds whose locale is the tag's or its language's."""
    wanted = tags.select("tag", L.canonical(F.col("tag")).alias("_t"), L.language(F.col("tag")).alias("_l")).withColumn("locale", F.explode(F.array_distinct(F.array("_t", "_l")))).drop("_t", "_l")
    return found.filter(F.col("kind").isin(list(kinds))).join(wanted, "locale")


def installed(slots: DataFrame, value: str = "value") -> DataFrame:
    """slots with id, version, variant of a packed id@version@variant."""
    parts = F.split(F.col(value), "@")
    return slots.select("*", parts[0].alias("id"), F.try_element_at(parts, F.lit(2)).cast("int").alias("version"), F.coalesce(F.try_element_at(parts, F.lit(3)), F.lit("")).alias("variant")).drop(value)


def status(found: DataFrame, have: DataFrame) -> DataFrame:
    """id, variant, version, state: current, update, other variant or missing."""
    mine = have.select("id", F.col("version").alias("_v"), F.col("variant").alias("_n"))
    state = F.when(F.col("_v").isNull(), "missing").when(F.col("_n") != F.col("variant"), "other variant").when(F.col("_v") < F.col("version"), "update").otherwise("current")
    return found.join(mine, "id", "left").select("id", "variant", "version", "size", state.alias("state"))


def bytes_needed(states: DataFrame) -> DataFrame:
    """id, n_bytes: sizes of what is missing or outdated."""
    return states.groupBy("id").agg(F.sum(F.when(F.col("state").isin("missing", "update"), F.col("size")).otherwise(0)).alias("n_bytes"))


def best_dialect(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """tag, found: of the tags there are (have: tag) the wanted one's region, else the chosen one's, else its language, else
    the first other of the language; null if there is none. wanted: tag, chosen (a region or null)."""
    lang = L.language(F.col("tag"))
    ranked = wanted.select("tag", lang.alias("_l"), F.concat_ws("-", lang, L.region(F.col("tag"))).alias("_1"), F.concat_ws("-", lang, F.col("chosen")).alias("_2"), L.region(F.col("tag")).isNotNull().alias("_r"))
    there = have.select(F.col("tag").alias("_have"), L.language(F.col("tag")).alias("_l"))
    rank = F.when(F.col("_r") & (F.col("_have") == F.col("_1")), 1).when((F.col("_have") == F.col("_2")) & (F.col("_2") != F.col("_l")), 2).when(F.col("_have") == F.col("_l"), 3).otherwise(4)
    best = ranked.join(there, "_l").groupBy("tag").agg(F.min(F.struct(rank.alias("r"), F.col("_have").alias("found"))).alias("_b"))
    return wanted.select("tag").join(best, "tag", "left").select("tag", F.col("_b.found").alias("found"))


def unknown_licence(c: Column) -> Column:
    """Whether a licence is missing or says that it is unknown."""
    return F.coalesce(F.contains(F.upper(c), F.lit("UNKNOWN")), F.lit(True))
