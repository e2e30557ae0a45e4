"""Problem 4: visually identical text with different characters.

Each odd value of a text (a token with stand-in, invisible or decomposed characters, an unusual space, or a word all of
whose letters look like letters of the text's own script, a Latin word with ı) is mapped to the form it looks like. In SQL, the
ordinary words of all texts are grouped under the accent-sensitive collation UNICODE and joined to the mapped forms without
the signs around them; the most frequent ordinary member of a class, ties by code points, is its canonical one (the mapped form
where there is no ordinary member), and joined back to the records. A word all of whose letters are of another script
counts only if the word it looks like stands LEAST_SEEN times in all texts, in any letter case.

Defined cases: null and empty texts have no odd values; emoji keep their joiners; words of another script stand if no
ordinary word looks like them; typographic signs stand; texts of any length are mapped as a whole; rows with repeated
ids are told apart by nothing and come out once; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm.scripts import INVISIBLE, MIXED, ODD, SPACES, _TOKEN, Confusables, composed, of_script, script, scripts_of, unmixed
from textmill.operators.skew import attach
from textmill.session import materialize, spread

_RUN = re.compile(r"[^\W\d_]+")
_FOREIGN = {"G": re.compile("[A-Za-zЀ-ԯ]"), "L": re.compile("[Ͱ-Ͽ]"), "C": re.compile("$^")}
#: Ordinary occurrences that a word must look like before a word all in another script counts as odd.
LEAST_SEEN = 2


def confusables(spark: SparkSession) -> Confusables:
    """The look-alike letters of all scripts, from the skeletons of the Unicode library that the engine brings along for
    collations; without ideographs and syllables, which look like no letter."""
    letters = [c for c in map(chr, (*range(0x80, 0x3400), *range(0xA000, 0xAC00), *range(0xFB00, 0xFE00), *range(0x10000, 0x1F000))) if unicodedata.category(c)[0] == "L"]
    letters += [c for c in map(chr, range(0x80)) if c.isalpha()]
    checker = spark.sparkContext._jvm.com.ibm.icu.text.SpoofChecker.Builder().build()
    skeletons = checker.getSkeleton("\n".join(letters)).split("\n")
    return Confusables(dict(zip(letters, skeletons)) if len(skeletons) == len(letters) else {})


def odd_values(text: str, more: Confusables | None = None) -> Iterator[tuple[str, str, bool]]:
    """(value, form that it looks like, whether it is odd in itself) of each odd value; the values are whole tokens,
    single spaces, or words within a token."""
    main = None
    strange = more.strange if more else lambda t: False
    if not text.isascii() and (ODD.search(text) or MIXED.search(text) or strange(text)):
        for c in SPACES.findall(text):
            yield c, " ", True
        main = script(unicodedata.normalize("NFKC", text))
        for token in _TOKEN.findall(text):
            if token.isascii() or not (ODD.search(token) or MIXED.search(token) or strange(token)):
                continue
            plain = composed(token)
            fixed = _RUN.sub(lambda m: unmixed(m[0], main, more), plain)
            if fixed != token or any(unicodedata.category(c) == "Mn" for c in INVISIBLE.sub("", token)):
                yield token, fixed, True
    if not text.isascii():
        main = main or script(text)
        if "ı" in text:  # a letter of Turkish words, unless the word with i is an ordinary one
            for run in _RUN.findall(text):
                if "ı" in run and scripts_of(run) == "L":
                    yield run, run.replace("ı", "i"), False
        if _FOREIGN.get(main, _FOREIGN["C"]).search(text) or main != "C" and "Ѐ" <= max(text) and re.search("[Ѐ-ԯ]", text):
            for run in _RUN.findall(text):
                there = scripts_of(run)
                if len(there) == 1 and there != main and main in ("L", "G") and (form := of_script(run, main)):
                    yield run, form, False


def _odd(more: Confusables) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def odd(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(tbl, i, *v) for tbl, i, t in zip(b["tbl"], b["rec_id"], b["t"]) for v in set(odd_values(t, more))]
            yield pd.DataFrame(rows, columns=["tbl", "rec_id", "value", "form", "certain"])

    return odd


def texts(clips: DataFrame, pairs: DataFrame) -> DataFrame:
    """tbl, rec_id, t of all texts looked at."""
    part = lambda df, tbl, id, t: df.select(F.lit(tbl).alias("tbl"), F.col(id).cast("long").alias("rec_id"), F.col(t).cast("string").alias("t"))
    return part(clips, "train_cv", "clip_id", "text").unionByName(part(pairs, "pairs", "pair_id", "input")).filter("t is not null")


_GROUPED = """
    WITH ordinary AS (
        SELECT word, seen FROM textmill_words
        WHERE lower(word) COLLATE UNICODE IN (SELECT lower(core) COLLATE UNICODE FROM textmill_odd WHERE core IS NOT NULL)
    ), classes AS (
        SELECT word COLLATE UNICODE AS class, max_by(word, struct(seen, word)) AS canonical FROM ordinary GROUP BY word COLLATE UNICODE
    ), folded AS (
        SELECT lower(word) COLLATE UNICODE AS class, sum(seen) AS seen FROM ordinary GROUP BY lower(word) COLLATE UNICODE
    )
    SELECT odd.value, odd.form, odd.certain, odd.n,
        coalesce(concat(odd.before, coalesce(classes.canonical, odd.core), odd.after), odd.form) AS canonical
    FROM textmill_odd odd LEFT JOIN classes ON odd.core COLLATE UNICODE = classes.class
        LEFT JOIN folded ON lower(odd.core) COLLATE UNICODE = folded.class
    WHERE odd.certain OR folded.seen >= {least}
"""
#: What stands before the only word of a form, the word, and what stands after it.
_CORE = r"^([^\p{L}\p{M}]*)(\p{L}+)([^\p{L}\p{M}]*)$"


def canonical_values(rows: DataFrame, found: DataFrame) -> DataFrame:
    """value, form, certain, n, canonical: one row for each distinct odd value. found: the stored odd values of rows."""
    odd = found.groupBy("value", "form", "certain").agg(F.count(F.lit(1)).alias("n"))
    part = lambda k: F.when(F.col("form").rlike(_CORE), F.regexp_extract("form", _CORE, k))
    odd = odd.select("*", part(1).alias("before"), part(2).alias("core"), part(3).alias("after"))
    words = rows.select(F.explode(F.regexp_extract_all("t", F.lit(r"\p{L}+"), 0)).alias("word"))
    odd.createOrReplaceTempView("textmill_odd")
    counted = materialize(words.groupBy("word").agg(F.count(F.lit(1)).alias("seen")), "words")  # else the collated join moves below the count
    counted.createOrReplaceTempView("textmill_words")
    return rows.sparkSession.sql(_GROUPED.format(least=LEAST_SEEN))


def affected(rows: DataFrame) -> DataFrame:
    """tbl, rec_id, value, canonical of each odd value of each record of texts()."""
    found = materialize(spread(rows).mapInPandas(_odd(confusables(rows.sparkSession)), "tbl string, rec_id bigint, value string, form string, certain boolean"), "odd")
    return attach(found.select("tbl", "rec_id", "value", "form", "certain"), canonical_values(rows, found), ["value", "form", "certain"], "n", found.count()).select("tbl", "rec_id", "value", "canonical")


def records(rows: DataFrame) -> DataFrame:
    """tbl, rec_id of the affected records."""
    return affected(rows).select("tbl", "rec_id").distinct()


def _rewrite(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for text, values in zip(b["t"], b["values"]):
            to = {v["value"]: v["canonical"] for v in values}
            text = SPACES.sub(lambda m, to=to: to.get(m[0], m[0]), text)
            token = lambda m, to=to: to[m[0]] if m[0] in to else _RUN.sub(lambda r: to.get(r[0], r[0]), m[0])
            out.append(_TOKEN.sub(token, text))
        yield pd.DataFrame({"tbl": b["tbl"], "rec_id": b["rec_id"], "text": out})


def consistent(rows: DataFrame) -> DataFrame:
    """tbl, rec_id, text: the affected records' texts in one consistent form."""
    values = affected(rows).groupBy("tbl", "rec_id").agg(F.collect_set(F.struct("value", "canonical")).alias("values"))  # bounded by the text
    return rows.join(values, ["tbl", "rec_id"]).mapInPandas(_rewrite, "tbl string, rec_id bigint, text string")
