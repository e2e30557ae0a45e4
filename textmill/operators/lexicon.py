"""From corpora to a word list with frequencies."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.session import materialize, spread

#: Whole words: letters, with apostrophes inside.
WORD = r"^\p{L}+(?:['’]\p{L}+)*$"


@dataclass(frozen=True)
class Lexicon:
    """Parameters of a word list."""

    word: str = WORD
    share: float = 0.9
    all_caps: str = "titlecase"
    skip: str = ""
    drop: str = ""
    singles: str = ""
    least: float = 30
    least_capitalised: float = 600
    min_f: int = 30
    core_f: int = 150
    max_f: int = 250
    core: tuple[str, ...] = ()
    longest: int = 30


@dataclass(frozen=True)
class Offensive:
    """Lists of words to flag, in lower case; those of not_ win."""

    stems: tuple[str, ...] = ()
    exact: tuple[str, ...] = ()
    not_stems: tuple[str, ...] = ()
    not_exact: tuple[str, ...] = ()
    capitalised: tuple[str, ...] = field(default=())


def counts(docs: DataFrame, boost: Column, by: tuple[str, ...] = ("lang",), text: str = "text", word: str = WORD) -> DataFrame:
    """by, form, n: uses of each word, each counted boost times. Words are taken from texts in form C."""
    tokens = F.explode(F.regexp_extract_all(F.col(text), F.lit(T.TOKEN), 0)).alias("form")
    each = T.composed(spread(docs).filter(F.col(text).isNotNull()), text).select(*by, boost.cast("double").alias("_b"), tokens)
    return each.filter(F.col("form").rlike(word)).groupBy(*by, "form").agg(F.sum("_b").alias("n"))


def cased(found: DataFrame, how: Lexicon, by: tuple[str, ...] = ("lang",)) -> DataFrame:
    """by, word, n: one form for each word, capitalised only if it nearly always is; the most frequent capitalised form,
    ties by code points. Two words that end in one form are added up."""
    upper = F.col("form").rlike(r"^\p{Lu}")
    merged = found.groupBy(*by, F.lower("form").alias("low")).agg(
        F.sum("n").alias("n"), F.sum(F.when(upper, F.col("n")).otherwise(0.0)).alias("cap"), F.min_by(F.when(upper, F.col("form")), F.when(upper, F.struct(-F.col("n"), F.col("form")))).alias("best")
    )
    form = F.when((F.col("cap") >= how.share * F.col("n")) & (F.length("low") > 1) & F.col("best").isNotNull(), F.col("best")).otherwise(F.col("low"))
    caps = (F.upper(form) == form) & (F.lower(form) != form) & (F.length(form) > 1)
    if how.all_caps == "skip":
        merged, word = merged.filter(~caps), form
    else:
        word = F.when(caps, T.capitalised(form)).otherwise(form)
    if how.skip:
        merged = merged.filter(~F.col("low").rlike(how.skip))
    return merged.select(*by, word.alias("word"), "n").groupBy(*by, "word").agg(F.sum("n").alias("n"))


def with_core(words: DataFrame, how: Lexicon, by: tuple[str, ...] = ("lang",)) -> DataFrame:
    """words with the core words, each at least once, in every group of by."""
    if not how.core:
        return words
    core = words.select(*by).distinct().withColumn("word", F.explode(F.array(*[F.lit(w) for w in how.core]))).withColumn("n", F.lit(1.0))
    return words.unionByName(core).groupBy(*by, "word").agg(F.max("n").alias("n"))


def rated(words: DataFrame, how: Lexicon, by: tuple[str, ...] = ("lang",)) -> DataFrame:
    """by, word, f: words that pass the gates, with their log frequency among all words."""
    totals = words.groupBy(*by).agg(F.sum("n").alias("_t"))
    core = F.lower("word").isin([w.lower() for w in how.core]) if how.core else F.lit(False)
    short = (F.length("word") == 1) & ~F.contains(F.lit(how.singles), F.lower("word"))
    rare = (F.col("n") < how.least) | (F.col("word").rlike(r"^\p{Lu}") & (F.col("n") < how.least_capitalised))
    if how.drop:
        rare = rare | F.lower("word").rlike(how.drop)
    kept = words.filter((F.length("word") <= how.longest) & ~short & (core | ~rare)).join(F.broadcast(totals), list(by))
    f = F.bround(255 + F.ln(F.col("n") / F.col("_t")) / F.ln(F.lit(1.15)), 0)
    low = F.when(core, how.core_f).otherwise(how.min_f)
    return kept.select(*by, "word", F.least(F.greatest(f, low), F.lit(how.max_f)).cast("int").alias("f"))


def extra_list(lines: DataFrame, line: str = "value") -> DataFrame:
    """word, f of the lines word=...,f=... of a list; others are left out."""
    pattern = r"^\s*word=([^,]+),\s*f=(\d+)"
    good = lines.filter(F.col(line).rlike(pattern))
    return good.select(F.regexp_extract(line, pattern, 1).alias("word"), F.regexp_extract(line, pattern, 2).cast("int").alias("f"))


def with_extra(rows: DataFrame, extra: DataFrame, most_f: int = 100, word: str = WORD, by: tuple[str, ...] = ("lang",)) -> DataFrame:
    """rows with the words of extra (by, word, f) that they don't have in any case; of one word's forms the one of highest f,
    ties by code points."""
    usable = extra.filter(F.col("word").rlike(word) & (F.length("word") > 1)).withColumn("_low", F.lower("word"))
    new = usable.join(rows.select(*by, F.lower("word").alias("_low")).distinct(), [*by, "_low"], "left_anti")
    best = new.groupBy(*by, "_low").agg(F.min(F.struct((-F.col("f")).alias("g"), "word")).alias("b"))
    return rows.unionByName(best.select(*by, F.col("b.word").alias("word"), F.least(-F.col("b.g"), F.lit(most_f)).cast("int").alias("f")))


def _starts(c: Column, stems: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for s in stems:
        out = out | c.startswith(s)
    return out


def offensive(word: Column, lists: Offensive) -> Column:
    """Whether a word is to be flagged: accents count, curly apostrophes don't; capitalised words only by their own stems."""
    low = F.replace(F.lower(word), F.lit("’"), F.lit("'"))
    named = word.rlike(r"^\p{Lu}") & ~_starts(low, lists.capitalised)
    spared = _starts(low, lists.not_stems) | low.isin(list(lists.not_exact))
    return ~named & ~spared & (low.isin(list(lists.exact)) | _starts(low, lists.stems))


def built(docs: DataFrame, boost: Column, how: Lexicon, lists: Offensive, by: tuple[str, ...] = ("lang",)) -> DataFrame:
    """by, word, f, possibly_offensive: the whole way."""
    words = with_core(cased(counts(docs, boost, by, word=how.word), how, by), how, by)
    rows = rated(materialize(words, "words"), how, by)  # read for the total and for the rows
    return rows.withColumn("possibly_offensive", offensive(F.col("word"), lists))


def combined(rows: DataFrame) -> DataFrame:
    """lang, f, word, line: the lines of a list file; to be written in the order of f and word, both descending."""
    flag = F.when(F.col("possibly_offensive"), ",possibly_offensive=true").otherwise("")
    return rows.select("lang", "f", "word", F.concat(F.lit(" word="), F.col("word"), F.lit(",f="), F.col("f").cast("string"), flag).alias("line"))


def header(locale: str, description: str, version: int, date: int) -> str:
    """The first line of a list file. date: seconds since 1970, a parameter so that results repeat."""
    return f"dictionary=main:{locale.lower()},locale={locale},description={description},date={date},version={version}"
