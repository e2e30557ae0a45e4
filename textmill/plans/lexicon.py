"""Queries of the lexicon, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.operators import lexicon as L
from textmill.plans.corpus import sql_lower
from textmill.session import table

#: Parameters that make all gates fire on the test tables.
HOW = L.Lexicon(least=5, least_capitalised=20, min_f=170, max_f=225, singles="aeioyοηω", core=("wifi", "emoji", "tokenizer", "qwerty"))
LISTS = L.Offensive(stems=("dam", "dreq", "διάολ", "garb"), exact=("mut", "wifi"), not_stems=("dama",), not_exact=("damn",), capitalised=("dreq",))
BOOST = {"slang": 3.0, "chat": 2.0, "notes": 1.5}


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    lang = F.lower(F.substring("lang", 1, 2))
    return table(spark, sf, "documents").filter("lang is not null and text is not null").select("doc_id", "text", "source", lang.alias("lang"))


def _boost():  # noqa: ANN202
    out = F.lit(1.0)
    for start, b in BOOST.items():
        out = F.when(F.coalesce(F.col("source").startswith(start), F.lit(False)), b).otherwise(out)
    return out


def lexicon_build(spark: SparkSession, sf: str) -> DataFrame:
    return L.built(_docs(spark, sf), _boost(), HOW, LISTS)


def word_count_boosted(spark: SparkSession, sf: str) -> DataFrame:
    return L.counts(_docs(spark, sf), _boost())


def casing_merge(spark: SparkSession, sf: str) -> DataFrame:
    return L.cased(L.counts(_docs(spark, sf), _boost()), HOW)


def _extra(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    listed = part.select(F.explode(F.split("p_name", " ")).alias("w"), "p_size").select(F.concat(F.lit(" word="), "w", F.lit(",f="), (F.col("p_size") * 4).cast("string")).alias("value"))
    return L.extra_list(listed).withColumn("lang", F.lit("en"))


def lexicon_extra_merge(spark: SparkSession, sf: str) -> DataFrame:
    rows = lexicon_build(spark, sf).select("lang", "word", "f")
    return L.with_extra(rows, _extra(spark, sf))


def lexicon_combined(spark: SparkSession, sf: str) -> DataFrame:
    return L.combined(lexicon_build(spark, sf)).select("lang", "line")


def lexicon_flagged(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon_build(spark, sf).filter("possibly_offensive").select("lang", "word").distinct()


def lexicon_top(spark: SparkSession, sf: str) -> DataFrame:
    return lexicon_build(spark, sf).filter("lang = 'sq'").orderBy(F.desc("f"), F.desc("word")).limit(15).select("word", "f")


QUERIES = {f.__name__: f for f in (lexicon_build, word_count_boosted, casing_merge, lexicon_extra_merge, lexicon_combined, lexicon_flagged, lexicon_top)}

_BOOST = "CASE " + " ".join(f"WHEN starts_with(source, '{s}') THEN {b}" for s, b in BOOST.items()) + " ELSE 1.0 END"
_low = lambda w: rf"CASE WHEN regexp_matches({w}, '\p{{L}}Σ$') THEN regexp_replace(lower({w}), 'σ$', 'ς') ELSE {sql_lower(w)} END"
_COUNTS = rf"""docs AS (SELECT lower(left(lang, 2)) AS lang, {_BOOST} AS b, nfc_normalize(text) AS text FROM documents WHERE lang IS NOT NULL AND text IS NOT NULL),
tokens AS (SELECT lang, b, unnest(regexp_extract_all(text, '{T.TOKEN.replace("'", "''")}')) AS form FROM docs),
counts AS (SELECT lang, form, sum(b)::DOUBLE AS n FROM tokens WHERE regexp_matches(form, '{L.WORD.replace("'", "''")}') GROUP BY lang, form)"""
_CASED = rf"""{_COUNTS}, lowered AS (SELECT *, {_low("form")} AS low, regexp_matches(form, '^\p{{Lu}}') AS up FROM counts),
merged AS (SELECT lang, low, sum(n) AS n, coalesce(sum(n) FILTER (WHERE up), 0) AS cap, first(form ORDER BY n DESC, form) FILTER (WHERE up) AS best FROM lowered GROUP BY lang, low),
formed AS (SELECT *, CASE WHEN cap >= {HOW.share} * n AND length(low) > 1 AND best IS NOT NULL THEN best ELSE low END AS form FROM merged),
cased AS (SELECT lang, word, sum(n) AS n FROM (SELECT lang, n, CASE WHEN upper(form) = form AND lower(form) <> form AND length(form) > 1 THEN upper(form[1]) || {sql_lower("form")}[2:] ELSE form END AS word FROM formed) GROUP BY lang, word)"""
_CORE = ", ".join(f"'{w}'" for w in HOW.core)
_any = lambda c, ws: "(" + " OR ".join(f"starts_with({c}, '{w}')" for w in ws) + ")"
_in = lambda c, ws: f"{c} IN (" + ", ".join(f"'{w}'" for w in ws) + ")"
_BUILT = rf"""{_CASED}, words AS (SELECT lang, word, max(n) AS n FROM (SELECT * FROM cased UNION ALL SELECT lang, word, 1.0 FROM (SELECT DISTINCT lang FROM cased), (SELECT unnest([{_CORE}]) AS word)) GROUP BY lang, word),
totals AS (SELECT lang, sum(n) AS t FROM words GROUP BY lang),
rated AS (SELECT lang, word, least(greatest(round_even(255 + ln(n / t) / ln(1.15), 0), CASE WHEN lower(word) IN ({_CORE}) THEN {HOW.core_f} ELSE {HOW.min_f} END), {HOW.max_f})::INT AS f FROM words JOIN totals USING (lang)
    WHERE length(word) <= {HOW.longest} AND NOT (length(word) = 1 AND NOT contains('{HOW.singles}', lower(word)))
    AND (lower(word) IN ({_CORE}) OR NOT (n < {HOW.least} OR (regexp_matches(word, '^\p{{Lu}}') AND n < {HOW.least_capitalised})))),
flagged AS (SELECT *, replace(lower(word), '’', '''') AS lw FROM rated),
built AS (SELECT lang, word, f, NOT (regexp_matches(word, '^\p{{Lu}}') AND NOT {_any("lw", LISTS.capitalised)}) AND NOT ({_any("lw", LISTS.not_stems)} OR {_in("lw", LISTS.not_exact)}) AND ({_in("lw", LISTS.exact)} OR {_any("lw", LISTS.stems)}) AS possibly_offensive FROM flagged)"""
ORACLE = {
    "lexicon_build": f"WITH {_BUILT} SELECT * FROM built",
    "word_count_boosted": f"WITH {_COUNTS} SELECT * FROM counts",
    "casing_merge": f"WITH {_CASED} SELECT * FROM cased",
    "lexicon_extra_merge": f"""WITH {_BUILT}, extra AS (SELECT unnest(string_split(p_name, ' ')) AS word, p_size * 4 AS f FROM part),
        usable AS (SELECT *, lower(word) AS low FROM extra WHERE regexp_matches(word, '{L.WORD.replace("'", "''")}') AND length(word) > 1),
        new AS (SELECT low, first(word ORDER BY f DESC, word) AS word, first(f ORDER BY f DESC, word) AS f FROM usable WHERE low NOT IN (SELECT lower(word) FROM built WHERE lang = 'en') GROUP BY low)
        SELECT lang, word, f FROM built UNION ALL SELECT 'en', word, least(f, 100)::INT FROM new""",
    "lexicon_combined": f"WITH {_BUILT} SELECT lang, ' word=' || word || ',f=' || f || CASE WHEN possibly_offensive THEN ',possibly_offensive=true' ELSE '' END AS line FROM built",
    "lexicon_flagged": f"WITH {_BUILT} SELECT DISTINCT lang, word FROM built WHERE possibly_offensive",
    "lexicon_top": f"WITH {_BUILT} SELECT word, f FROM built WHERE lang = 'sq' ORDER BY f DESC, word DESC LIMIT 15",
}
