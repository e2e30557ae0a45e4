"""From raw texts to clean, packed, deduplicated, sampled and split lines."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from textmill.functions import text as T
from textmill.functions.draw import draw
from textmill.operators.skew import first_of_each, running
from textmill.session import spread

# The letters of each language, as regex classes.
LETTERS = {"el": r"\x{370}-\x{3ff}\x{1f00}-\x{1fff}", "sq": "A-Za-zËëÇç", "en": "A-Za-z", "es": "A-Za-zÁÉÍÓÚÜÑáéíóúüñ"}
#: A text of another language is checked against any letter.
ANY_LETTER = r"\p{L}"
# The signs that end a sentence and the letters that begin one, where they differ from the defaults (any letter of
# the language begins one).
ENDS = {"el": ".!;…"}
DEFAULT_ENDS = ".!?…"
STARTS = {"el": "Ά-ΫA-Z", "sq": "A-ZËÇ"}


@dataclass(frozen=True)
class Cleaning:
    """Parameters of clean lines."""

    letters: dict[str, str] = field(default_factory=lambda: dict(LETTERS))
    share: dict[str, float] = field(default_factory=lambda: {"el": 0.6})
    default_share: float = 0.9
    least: int = 15
    most: int = 2000
    group: int = 300
    subtitles: str = "opensubtitles"
    ends: dict[str, str] = field(default_factory=lambda: dict(ENDS))
    default_ends: str = DEFAULT_ENDS
    starts: dict[str, str] = field(default_factory=lambda: dict(STARTS))


def lines(docs: DataFrame, least: int = 1, id: str = "doc_id", text: str = "text") -> DataFrame:
    """source, doc_id, line_no (from 0), text: the lines of texts, stripped, of at least least characters."""
    parts = F.transform(F.split(F.col(text), "\n"), T.strip)
    return spread(docs).select("source", F.col(id).alias("doc_id"), F.posexplode(parts).alias("line_no", "text")).filter(F.length("text") >= least)


def kept(rows: DataFrame, config: DataFrame, seed: int = 1) -> DataFrame:
    """rows with their source's configuration, thinned to its share keep by a draw per line. config: source_name, keep
    and whatever the next steps need; sources that aren't listed are left out."""
    known = rows.join(F.broadcast(config.withColumnRenamed("source_name", "source")), "source")
    share = F.coalesce("keep", F.lit(1.0))
    return known.filter((share >= 1) | (draw(seed, "keep", F.col("source"), F.col("doc_id"), F.col("line_no")) <= share))


def cleaned(rows: DataFrame, how: Cleaning = Cleaning()) -> DataFrame:
    """rows with text cleaned; lines that are too short or long, or mostly of another script, are left out."""
    text = T.cleaned(F.col("text"), F.coalesce(F.col("origin") == how.subtitles, F.lit(False)))
    out = T.computed(T.composed(rows, "text"), text=text).filter(F.length("text").between(F.coalesce("min_chars", F.lit(how.least)), F.lit(how.most)))
    own, least = T.n_letters(F.col("text"), ANY_LETTER), F.lit(how.default_share)
    for lang, letters in how.letters.items():
        own = F.when(F.col("lang") == lang, T.n_letters(F.col("text"), letters)).otherwise(own)
        least = F.when(F.col("lang") == lang, how.share.get(lang, how.default_share)).otherwise(least)
    return out.filter(F.try_divide(own, T.n_letters(F.col("text"), ANY_LETTER)) >= least)


def packed(rows: DataFrame, how: Cleaning = Cleaning()) -> DataFrame:
    """rows with one row for each group of sentences, cut as their language does, and chunk_no within the line."""
    parts = T.sentences(F.col("text"), how.default_ends, ANY_LETTER)
    for lang in {**how.letters, **how.ends, **how.starts}:
        own = T.sentences(F.col("text"), how.ends.get(lang, how.default_ends), how.starts.get(lang, how.letters.get(lang, ANY_LETTER)))
        parts = F.when(F.col("lang") == lang, own).otherwise(parts)
    return rows.select(*[c for c in rows.columns if c != "text"], F.posexplode(T.packed(parts, how.group)).alias("chunk_no", "text"))


def deduplicated(rows: DataFrame, by: tuple[str, ...] = ("source",), order: tuple[str, ...] = ("doc_id", "line_no", "chunk_no")) -> DataFrame:
    """The first row of each text, ignoring letter case, within by; order tells which comes first.

    A minimum of whole rows with map-side combining, instead of a window: no task gets all copies of a hot text.
    """
    rest = [c for c in rows.columns if c not in (*by, *order)]
    firsts = rows.groupBy(*by, F.md5(F.lower("text")).alias("_k")).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return firsts.select(*by, "_first.*").select(*rows.columns)


def prepared(docs: DataFrame, config: DataFrame, how: Cleaning = Cleaning(), seed: int = 1) -> DataFrame:
    """The clean table: source, lang, val, sp, doc_id, line_no, chunk_no, text."""
    wanted = config.select("source_name", "origin", "lang", "sp", "keep", "min_chars", "val")
    raw = kept(lines(docs), wanted, seed)
    out = deduplicated(packed(cleaned(raw, how), how))
    return out.select("source", "lang", "val", "sp", "doc_id", "line_no", "chunk_no", "text")


def capped(rows: DataFrame, most: int, by: str = "source", order: tuple[str, ...] = ("doc_id", "line_no")) -> DataFrame:
    """The first most rows of each source. The row cap for quick runs."""
    return first_of_each(rows, most, [by], list(order))


def within_bytes(rows: DataFrame, budget: Column, batch: int = 2000, by: str = "source", order: tuple[str, ...] = ("doc_id", "line_no")) -> DataFrame:
    """The rows of each source until its budget (bytes as UTF-8, a line break a row) is exceeded: batches of rows are
    taken as long as the bytes before them are within it. Budgets of null take all."""
    numbered = running(rows.withColumn("_bytes", F.octet_length("text") + 1), [by], list(order), "_before").withColumn("_batch", F.floor(F.col("_before") / batch)).drop("_before")
    batches = numbered.groupBy(by, "_batch").agg(F.sum("_bytes").alias("_size"))
    before = Window.partitionBy(by).orderBy("_batch").rowsBetween(Window.unboundedPreceding, -1)
    batches = batches.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0))).drop("_size")
    return numbered.join(batches, [by, "_batch"]).filter(budget.isNull() | (F.col("_before") < budget)).drop("_batch", "_bytes", "_before")


def split(rows: DataFrame, seed: int = 1, most: int = 5000, per: int = 500) -> DataFrame:
    """rows with part: val for min(most, lines / per) lines of each source that allows it, in a seeded order; else train."""
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("_lines"))
    w = Window.partitionBy("source").orderBy("_d", "doc_id", "line_no", "chunk_no")
    drawn = rows.withColumn("_d", draw(seed, "val", F.col("source"), F.col("doc_id"), F.col("line_no"), F.col("chunk_no"))).join(F.broadcast(sizes), "source")
    want = F.when(F.coalesce("val", F.lit(True)), F.least(F.lit(most), F.floor(F.col("_lines") / per))).otherwise(0)
    # only draws that can be among the first are ranked: twice the share wanted, and what chance may add; all, should they be too few
    low = F.col("_d") <= (2 * want + 50) / F.col("_lines")
    enough = drawn.groupBy("source").agg(F.count_if(low).alias("_low"))
    drawn = drawn.join(F.broadcast(enough), "source")
    near = low | (F.col("_low") < want)
    picked = drawn.filter(near).withColumn("_r", F.row_number().over(w)).withColumn("part", F.when(F.col("_r") <= want, "val").otherwise("train")).drop("_r")
    return picked.unionByName(drawn.filter(~near).withColumn("part", F.lit("train"))).drop("_d", "_lines", "_low")


def stats(rows: DataFrame, tokens: Column | None = None) -> DataFrame:
    """source, n_lines, n_tokens, n_chars."""
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(T.n_words(F.col("text")) if tokens is None else tokens).alias("n_tokens"), F.sum(F.length("text")).alias("n_chars"))


def tokenizer_sample(rows: DataFrame, total: int, seed: int = 1, most: int = 20) -> DataFrame:
    """rows for a tokenizer's training: int(total * sp) lines of each source, thinned by draws or repeated at most most
    times, with rep. A source without sp has an equal part."""
    sizes = rows.groupBy("source").agg(F.count(F.lit(1)).alias("_c"))
    sources = sizes.agg(F.count(F.lit(1)).alias("_sources"))
    info = F.broadcast(sizes.join(F.broadcast(sources)))
    known = rows.join(info, "source").withColumn("_want", F.floor(F.lit(total) * F.coalesce("sp", 1 / F.col("_sources"))))
    share = F.least(F.lit(1.0), F.col("_want") / F.col("_c"))
    reps = F.when(share >= 1, F.least(F.lit(most), F.greatest(F.lit(1), F.floor(F.col("_want") / F.col("_c"))))).otherwise(1).cast("int")
    taken = known.filter((share >= 1) | (draw(seed, "sp", F.col("source"), F.col("doc_id"), F.col("line_no"), F.col("chunk_no")) < share))
    return taken.withColumn("rep", F.explode(F.sequence(F.lit(1), reps))).drop("_want", "_c", "_sources")


def offsets(rows: DataFrame, tokens: Column) -> DataFrame:
    """rows with n_tokens and start: the tokens of all earlier rows of the source, in the order of id and line."""
    return running(rows.withColumn("n_tokens", tokens.cast("long")), ["source"], ["doc_id", "line_no", "chunk_no"], "start", F.col("n_tokens"))


def expected_mix(config: DataFrame, total: int) -> DataFrame:
    """source_name, share, n_examples: how many of total examples a weighted choice of sources takes from each."""
    w = config.filter("mix > 0").agg(F.sum("mix").alias("_w"))
    return config.filter("mix > 0").join(F.broadcast(w)).select("source_name", (F.col("mix") / F.col("_w")).alias("share"), (F.lit(total) * F.col("mix") / F.col("_w")).alias("n_examples"))


def availability(config: DataFrame, docs: DataFrame) -> DataFrame:
    """source_name, n_docs: listed sources and how many texts there are; 0 for those that a run skips."""
    n = docs.groupBy(F.col("source").alias("source_name")).agg(F.count(F.lit(1)).alias("_n"))
    return config.select("source_name").join(n, "source_name", "left").select("source_name", F.coalesce("_n", F.lit(0)).alias("n_docs"))


def missing_letters(rows: DataFrame, alphabets: dict[str, str]) -> DataFrame:
    """lang, letter: letters of the alphabets that no row of the language has."""
    seen = rows.select("lang", F.explode(F.array_distinct(F.split(F.lower("text"), ""))).alias("letter")).distinct()  # a few rows a text
    pairs = [(lang, c) for lang, letters in alphabets.items() for c in letters]
    return rows.sparkSession.createDataFrame(pairs, "lang string, letter string").join(seen, ["lang", "letter"], "left_anti")


def contexts(rows: DataFrame, most: int = 60) -> DataFrame:
    """doc_id, line_no, chunk_no, position (from 1), context (up to most words before), word: next-word examples."""
    ws = F.filter(F.split(F.col("text"), " "), lambda w: w != "")
    each = rows.select("doc_id", "line_no", "chunk_no", ws.alias("_ws")).withColumn("position", F.explode(F.expr("sequence(1, greatest(size(_ws) - 1, 1))"))).filter(F.size("_ws") > 1)
    start = F.greatest(F.lit(1), F.col("position") - most + 1)
    return each.select("doc_id", "line_no", "chunk_no", "position", F.array_join(F.slice("_ws", start, F.col("position") - start + 1), " ").alias("context"), F.element_at("_ws", F.col("position") + 1).alias("word"))


def sequences(rows: DataFrame, length: int) -> DataFrame:
    """source, seq, n_lines, n_tokens: each source's lines laid end to end and cut into sequences of length tokens; a line
    counts for each sequence that it lies in. rows: of offsets()."""
    first, last = F.floor(F.col("start") / length), F.floor((F.col("start") + F.col("n_tokens") - 1) / length)
    each = rows.filter("n_tokens > 0").withColumn("seq", F.explode(F.sequence(first, last)))
    inside = F.least((F.col("seq") + 1) * length, F.col("start") + F.col("n_tokens")) - F.greatest(F.col("seq") * length, F.col("start"))
    return each.groupBy("source", "seq").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(inside).alias("n_tokens"))
