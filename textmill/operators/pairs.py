"""Noisy and clean pairs: made, filtered, held out."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.functions import text as T
from textmill.functions.draw import draw
from textmill.operators.messages import reservoir
from textmill.operators.skew import attach, running
from textmill.session import materialize

TOKENS = r"[\p{L}\p{N}\p{M}_'’-]+"
# How a reply that isn't the text begins, and the app's self-correction phrases (no accents).
CHATTER = ("here", "sure", "i can")
SELF_CORRECTIONS = ("i meant", "i mean", "no wait", "sorry", "correction", "scratch that", "not that", "εννοω", "ηθελα να πω", "οχι συγγνωμη", "συγγνωμη", "δηλαδη οχι", "λαθος", "desha te them", "me fal", "jo jo", "gabim", "dmth jo")


@dataclass(frozen=True)
class Swears:
    """Beginnings and whole forms of words that a rewrite must keep (lower case, no accents)."""

    stems: tuple[str, ...] = ("damn", "crap", "dreq", "διαολ", "diablo", "maldit", "mierd")
    exact: tuple[str, ...] = ("mut", "hell")

    def count(self, unaccented: Column) -> Column:
        return T.count_words_of(unaccented, list(self.stems), list(self.exact))

    def count_in_app(self, unaccented: Column) -> Column:
        """As the app counts: words are letters and apostrophes, those before a word don't count."""
        return T.count_words_of(F.regexp_replace(unaccented, r"(?<![\p{L}'])'+", ""), list(self.stems), list(self.exact), r"[\p{L}']")


@dataclass(frozen=True)
class Noise:
    """Chances of the noise of dictation."""

    clean: float = 0.15
    filler: float = 0.10
    repeat: float = 0.04
    false_start: float = 0.02
    correction: float = 0.35
    lead: float = 0.30
    inner: float = 0.08
    seed: int = 1
    phrases: dict[str, tuple[str, ...]] = field(default_factory=dict)


def parsed(lines: DataFrame, raw: str = "raw", fields: tuple[str, ...] = ("lang", "mode", "input", "output")) -> DataFrame:
    """The lines that are JSON objects, with their fields; lines that aren't valid are left out, missing fields null."""
    v = F.try_parse_json(F.col(raw))
    good = lines.withColumn("_v", v).filter(F.col("_v").isNotNull() & F.schema_of_variant("_v").startswith("OBJECT"))
    return good.select(*[c for c in lines.columns if c != raw], *[F.try_variant_get("_v", f"$.{f}", "string").alias(f) for f in fields])


def valid(rows: DataFrame) -> DataFrame:
    """Rows whose input and output, without outer blanks, hold something."""
    return rows.filter((T.strip(F.col("input")) != "") & (T.strip(F.col("output")) != ""))


def last_of(rows: DataFrame, key: tuple[str, ...], order: str) -> DataFrame:
    """The last row of each key; later ones overwrite earlier ones."""
    rest = [c for c in rows.columns if c not in (*key, order)]
    last = rows.groupBy(*key).agg(F.max_by(F.struct(order, *rest), F.struct(order, *[F.col(c).isNotNull() for c in rest])).alias("_l"))
    return last.select(*key, "_l.*")


def light_with_rambler(rows: DataFrame, order: str = "pair_id") -> DataFrame:
    """lang, input, light, rambler (null if there is none): the last output of each mode for each input that has a light
    one. Keys of a null input match nothing."""
    usable = rows.filter("lang is not null and input is not null")
    best = lambda mode: F.max_by(F.when(F.col("mode") == mode, F.col("output")), F.when(F.col("mode") == mode, F.col(order)))
    both = usable.groupBy("lang", "input").agg(F.count_if(F.col("mode") == "light").alias("_n"), best("light").alias("light"), best("rambler").alias("rambler"))
    return both.filter("_n > 0").drop("_n")


def rewrites_judged(rows: DataFrame, swears: Swears = Swears(), no_add: tuple[str, ...] = (), low: float = 0.2, high: float = 1.3) -> DataFrame:
    """rows with verdict: ok, empty, ratio, swears, chatter or added, for a rewrite output of a message input."""
    base = T.unaccented(T.unaccented(rows, "input", "_i"), "output", "_o")
    i, o = F.coalesce("_i", F.lit("")), F.coalesce("_o", F.lit(""))
    base = T.computed(base, _reply=T.reply_cleaned(F.coalesce("output", F.lit(""))))
    reply = F.col("_reply")
    ratio = F.length(reply) / F.greatest(F.lit(1), F.length(F.coalesce("input", F.lit(""))))
    chatter = F.lit(False)
    for c in CHATTER:
        chatter = chatter | F.lower(reply).startswith(c)
    verdict = F.when(reply == "", "empty").when(~ratio.between(low, high), "ratio").when(2 * swears.count(o) < swears.count(i), "swears").when(chatter, "chatter")
    if no_add:
        verdict = verdict.when(F.size(T.has_words_of(o, i, list(no_add))) > 0, "added")
    return base.withColumn("verdict", verdict.otherwise("ok")).drop("_i", "_o", "_reply")


def outputs_judged(rows: DataFrame, swears: Swears = Swears()) -> DataFrame:
    """rows with sane: ok, empty, ratio or sanitized, as the app judges an output by its input and mode."""
    base = T.unaccented(T.unaccented(rows, "input", "_i"), "output", "_o")
    out = T.strip(F.regexp_replace(T.strip(F.coalesce("output", F.lit(""))), '^"([\\s\\S]*)"$', "$1"))
    rambler = F.coalesce(F.col("mode") == "rambler", F.lit(False))
    i, o = F.coalesce("_i", F.lit("")), F.coalesce("_o", F.lit(""))
    corrects = F.lit(False)
    for p in SELF_CORRECTIONS:
        corrects = corrects | F.contains(i, F.lit(p))
    base = T.computed(base, _had=swears.count_in_app(i), _kept=swears.count_in_app(o), _out=out)
    had, kept, out, ratio = F.col("_had"), F.col("_kept"), F.col("_out"), F.length("_out") / F.greatest(F.lit(1), F.length(F.coalesce("input", F.lit(""))))
    sane = F.when(out == "", "empty").when(~ratio.between(F.when(rambler, 0.15).otherwise(0.4), F.when(rambler, 1.5).otherwise(1.6)), "ratio")
    return base.withColumn("sane", sane.when((had > 0) & (2 * (kept + corrects.cast("int")) < had), "sanitized").otherwise("ok")).drop("_i", "_o", "_had", "_kept", "_out")


def boundary(pattern: Column) -> Column:
    """A detection pattern with word ends that know all letters."""
    return F.replace(F.replace(pattern, F.lit(r"\b("), F.lit(r"(?:^|[^\p{L}\p{N}_])(")), F.lit(r")\b"), F.lit(r")(?:$|[^\p{L}\p{N}_])"))


def language_kept(rows: DataFrame, rules: DataFrame, target: str = "input", output: str = "output") -> DataFrame:
    """rows with kept: whether the output looks like the language exactly when the target does; true without a pattern."""
    known = rows.join(F.broadcast(rules.select(F.col("code").alias("lang"), "detect")), "lang", "left")
    looks = lambda c: F.regexp_like(F.lower(F.coalesce(F.col(c), F.lit(""))), F.concat(F.lit("(?i)"), boundary(F.col("detect"))))
    return known.withColumn("kept", F.when(F.col("detect").isNull(), True).otherwise(looks(output) == looks(target))).drop("detect")


def _pick(options: Column, u: Column) -> Column:
    return F.element_at(options, (F.floor(u * F.size(options)) + 1).cast("int"))


def dictated(rows: DataFrame, rules: DataFrame, how: Noise = Noise(), id: str = "pair_id", text: str = "output") -> DataFrame:
    """id, lang, text, input: each clean text with a raw dictation of it. rules: code, fillers, corrections.

    One draw per word decides between filler, repeat and false start; a self-correction and a leading filler follow; a
    share of the texts stays clean. Languages without rules stay clean.
    """
    base = T.composed(rows.select(id, "lang", text).filter(F.col(text).isNotNull()), text)
    known = base.join(F.broadcast(rules.select(F.col("code").alias("lang"), "fillers", "corrections")), "lang", "left")
    u = lambda salt, *more: draw(how.seed, salt, F.col(id), *more)
    ws = F.regexp_extract_all(F.lower(text), F.lit(TOKENS), 0)
    known = known.withColumn("_w", ws).withColumn("_n", F.size("_w"))

    def word(w: Column, i: Column) -> Column:
        r, filler = u("word", i), _pick(F.col("fillers"), u("which", i))
        starts = (r < how.filler + how.repeat + how.false_start) & (i + 2 < F.col("_n"))
        return F.when(r < how.filler, F.array(filler, w)).when(r < how.filler + how.repeat, F.array(w, w)).when(starts, F.array(w, F.element_at("_w", (i + 2).cast("int")), filler, w)).otherwise(F.array(w))

    noisy = known.withColumn("_o", F.flatten(F.transform("_w", word))).withColumn("_m", F.size("_o"))
    long = F.filter("_o", lambda w: F.length(w) > 3)
    noisy = noisy.withColumn("_j", (F.floor(u("where") * F.greatest(F.lit(1), F.col("_m") - 2)) + 1).cast("int"))
    noisy = noisy.withColumn("_x", F.when(F.size(long) > 0, _pick(long, u("wrong"))).otherwise(F.try_element_at("_o", F.col("_j") + 1)))
    fixes = (F.col("_m") > 5) & (u("fix") < how.correction) & (F.col("_x") != F.try_element_at("_o", F.col("_j") + 1))
    with_fix = F.concat(F.slice("_o", F.lit(1), F.col("_j")), F.array("_x", _pick(F.col("corrections"), u("phrase"))), F.slice("_o", F.col("_j") + 1, F.greatest(F.lit(0), F.col("_m") - F.col("_j"))))
    out = F.when(fixes, with_fix).otherwise(F.col("_o"))
    out = F.when(u("lead") < how.lead, F.concat(F.array(_pick(F.col("fillers"), u("first"))), out)).otherwise(out)
    stays = (u("clean") < how.clean) | F.col("fillers").isNull() | (F.col("_n") == 0)
    return noisy.select(id, "lang", F.col(text).alias("text"), F.when(stays, F.col(text)).otherwise(F.array_join(out, " ")).alias("input"))


def corrected_later(rows: DataFrame, rules: DataFrame, per_lang: int, how: Noise = Noise(), id: str = "pair_id", text: str = "output", numbers: dict[str, list[str]] | None = None) -> DataFrame:
    """id, lang, text, input: dictations in which a wrong word is put right later on; at most per_lang of each language.

    The wrong word is drawn from the words of all texts of the language: they are ranked, and a draw picks a rank (the next one, if
    that is the word itself), so the vocabulary is joined, not collected. Texts of fewer than five words, or without a word of four letters after the
    first, give none. numbers: number words by language; every other text that has one gets a wrong number instead.
    """
    base = T.composed(rows.select(id, "lang", text).filter(F.col(text).isNotNull() & F.col("lang").isNotNull()), text)
    u = lambda salt, *more: draw(how.seed, "later-" + salt, F.col(id), *more)
    ws = F.regexp_extract_all(F.lower(text), F.lit(TOKENS), 0)
    places = F.filter(F.transform("_w", lambda w, i: F.when((i > 0) & (F.length(w) >= 4), i + 1)), lambda p: p.isNotNull())
    count = F.array().cast("array<string>")
    for lang, listed in (numbers or {}).items():
        count = F.when(F.col("lang") == lang, F.array(*[F.lit(w) for w in listed])).otherwise(count)
    known = base.withColumn("_w", ws).filter(F.size("_w") >= 5).withColumn("_p", places).withColumn("_numbers", count)
    at = F.filter(F.transform("_w", lambda w, i: F.when(F.array_contains("_numbers", w), i + 1)), lambda p: p.isNotNull())
    known = known.withColumn("_at", F.when(u("number") < 0.5, at).otherwise(F.array().cast("array<int>"))).withColumn("_isnumber", F.size("_at") > 0)
    known = known.withColumn("_p", F.when(F.col("_isnumber"), F.col("_at")).otherwise(F.col("_p"))).filter(F.size("_p") > 0)
    rules = rules.select(F.col("code").alias("lang"), F.coalesce("light_fillers", F.slice("fillers", 1, 3)).alias("_f"), F.col("corrections").alias("_c"))
    known = known.join(F.broadcast(rules), "lang").withColumn("_i", _pick(F.col("_p"), u("place")))
    known = materialize(reservoir(known, per_lang, (id,), how.seed, ("lang",)), "drawn")  # the rows are drawn before the words
    vocab = base.select("lang", F.explode(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}{4,}"), 0))).alias("wrong")).distinct()
    ranked = materialize(running(vocab, ["lang"], ["wrong"], "_rank"), "vocab")
    sizes = ranked.groupBy("lang").agg(F.count(F.lit(1)).alias("_size"))
    known = known.join(F.broadcast(sizes), "lang").withColumn("_rank", F.floor(u("vocab") * F.col("_size")).cast("long")).withColumn("_next", (F.col("_rank") + 1) % F.col("_size"))
    known = known.join(ranked, ["lang", "_rank"]).join(ranked.select("lang", F.col("_rank").alias("_next"), F.col("wrong").alias("_after")), ["lang", "_next"])
    spoken_word = F.element_at("_w", F.col("_i").cast("int"))
    other = _pick(F.filter("_numbers", lambda n: n != spoken_word), u("other"))
    drawn = F.when(F.col("wrong") != spoken_word, F.col("wrong")).otherwise(F.col("_after"))
    known = known.withColumn("wrong", F.when(F.col("_isnumber"), other).otherwise(drawn)).filter(F.col("wrong") != spoken_word)
    i, n = F.col("_i").cast("int"), F.size("_w")
    right = F.when(~F.col("_isnumber") & (u("article") < 0.5), F.slice("_w", i - 1, F.lit(2))).otherwise(F.slice("_w", i, F.lit(1)))
    spoken = F.concat(F.slice("_w", F.lit(1), i - 1), F.array("wrong"), F.slice("_w", i + 1, n - i))
    known = known.withColumn("_s", spoken).withColumn("_r", right).withColumn("_cut", (i + F.floor(u("cut") * (n - i + 1))).cast("int"))
    said = lambda part, salt: F.flatten(F.transform(part, lambda w, k: F.when(u(salt, k) < how.inner, F.array(_pick(F.col("_f"), u(salt + "-which", k)), w)).otherwise(F.array(w))))
    out = F.concat(said(F.slice("_s", F.lit(1), F.col("_cut")), "head"), F.array(_pick(F.col("_c"), u("phrase"))), F.col("_r"), said(F.slice("_s", F.col("_cut") + 1, n - F.col("_cut")), "tail"))
    return known.select(id, "lang", F.col(text).alias("text"), F.array_join(out, " ").alias("input"))


def held_out(rows: DataFrame, seed: int = 1, old_share: float = 1.0, old: Column | None = None, least: int = 200, per: int = 50, id: str = "pair_id") -> DataFrame:
    """rows with part: val (one row of each message held out), dropped (rows that share a held-out message's input or one
    of its targets), repeat (a later row of the same lang, mode and input) or train.

    Messages are (lang, input). A language holds out its part of max(least, rows / per) messages, in a seeded order.
    old: rows that are thinned to old_share first.
    """
    u = lambda salt, *key: draw(seed, salt, *key)
    good = valid(rows).filter("lang is not null")
    if old is not None and old_share < 1:
        good = good.filter(~old | (u("old", F.col(id)) <= old_share))
    good = good.withColumn("_k", F.md5(F.concat_ws("\x1f", "lang", "input"))).withColumn("_u", u("row", F.col(id)))
    good = materialize(good, "good")  # each stored table below is read several times
    keys = good.groupBy("lang", "_k").agg(F.min(F.struct("_u", id)).alias("_f"), F.count(F.lit(1)).alias("_n"))
    per_lang = keys.groupBy("lang").agg(F.count(F.lit(1)).alias("_keys"), F.sum("_n").alias("_rows"))
    everything = per_lang.agg(F.sum("_keys").alias("_all_keys"), F.sum("_rows").alias("_all_rows"))
    quota = per_lang.join(F.broadcast(everything)).select("lang", F.greatest(F.lit(1), F.bround(F.col("_keys") * F.greatest(F.lit(least), F.floor(F.col("_all_rows") / per)) / F.col("_all_keys"), 0)).alias("_q"), "_keys")
    drawn = keys.withColumn("_d", u("key", F.col("_k"))).join(F.broadcast(quota), "lang")
    drawn = materialize(drawn, "drawn")
    low = F.col("_d") <= (2 * F.col("_q") + 50) / F.col("_keys")  # more than the quota, but not all keys, unless they are too few
    near = drawn.join(F.broadcast(drawn.groupBy("lang").agg(F.count_if(low).alias("_low"))), "lang").filter(low | (F.col("_low") < F.col("_q")))
    held = near.withColumn("_r", F.row_number().over(Window.partitionBy("lang").orderBy("_d", "_k"))).filter("_r <= _q").select("lang", "_k", F.col("_f")[id].alias("_val"), "_n")
    total = good.count()
    held = materialize(held.select("lang", "_k", "_val", "_n"), "held")
    marked = attach(good, held, ["lang", "_k"], "_n", total, "left")
    marked = materialize(marked.withColumn("_t", F.md5(F.concat_ws("\x1f", "lang", "output"))), "marked")
    targets = marked.filter("_val is not null").groupBy("_t").agg(F.lit(True).alias("_leaks"))
    sizes = marked.groupBy("_t").agg(F.count(F.lit(1)).alias("_m")).join(targets, "_t")
    marked = attach(marked, materialize(sizes, "leaks"), ["_t"], "_m", total, "left")
    leak = F.when(F.col(id) == F.col("_val"), "val").when(F.col("_val").isNotNull() | F.col("_leaks"), "dropped")
    marked = materialize(marked.withColumn("part", leak), "parts")
    rest = marked.filter("part is null")
    mode = F.md5(F.concat_ws("\x1f", "lang", "mode", "input"))
    firsts = rest.groupBy(mode.alias("_mk")).agg(F.min(F.struct("_u", id)).alias("_first"), F.count(F.lit(1)).alias("_c"))
    rest = attach(rest.withColumn("_mk", mode), firsts, ["_mk"], "_c", total)
    rest = rest.withColumn("part", F.when(F.col("_first")[id] == F.col(id), "train").otherwise("repeat"))
    columns = [*rows.columns, "part"]
    return marked.filter("part is not null").select(*columns).unionByName(rest.select(*columns))


def prompts(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """rows with prompt: what a model is asked for an input, by mode and language. names: languages' names by code."""
    # The tasks by mode and the wording of a prompt.
    task = F.when(F.col("mode") == "rambler", "Rewrite as a short, clear message").otherwise("Clean up: punctuation, capitals, remove fillers, apply self-corrections, keep the words")
    name = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in sorted(names.items()) for x in kv]), F.col("lang")), F.col("lang"))
    system = F.concat(task, F.lit(". Language: "), name, F.lit(". Never translate. Keep slang and swearing exactly. Output only the text."))
    return rows.withColumn("prompt", F.concat(F.lit("<|im_start|>system\n"), system, F.lit("<|im_end|>\n<|im_start|>user\n"), F.coalesce("input", F.lit("")), F.lit("<|im_end|>\n<|im_start|>assistant\n<think>\n\n</think>\n\n")))
