"""Queries of corpus preparation, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.draw import draw_sql
from textmill.operators import corpus as C
from textmill.session import materialize, spread, table

_WS = r"[\t\n\x0B\f\r\x1c-\x1f\x{85}\p{Z}]"
_NOT_WS = r"[^\t\n\x0B\f\r\x1c-\x1f\x{85}\p{Z}]"


def sql_lower(x: str) -> str:
    """lower() that ends words in ς, as the JVM's does."""
    return rf"lower(regexp_replace({x}, '(\p{{L}})Σ(\P{{L}}|$)', '\1ς\2', 'g'))"


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'), ' ')"


def sql_words(x: str) -> str:
    return rf"len(regexp_extract_all({x}, '{_NOT_WS}+'))"


# What the SQL takes as a language's letters, and as places where its sentences are cut.
_LETTERS = {"el": "Ͱ-Ͽἀ-῿", "sq": "A-Za-zËëÇç", "en": "A-Za-z", "es": "A-Za-zÁÉÍÓÚÜÑáéíóúüñ"}
_ANY = r"\p{L}"
_CUTS = {"el": ("[.!;…]", "Ά-ΫA-Z"), "sq": ("[.!?…]", "A-ZËÇ"), "en": ("[.!?…]", "A-Za-z"), "es": ("[.!?…]", "A-Za-zÁÉÍÓÚÜÑáéíóúüñ")}


def _cut(x: str) -> str:
    one = lambda ends, starts: rf"""regexp_replace({x}, '({ends}){_WS}+(["«(“{starts}])', '\1' || chr(1) || '\2', 'g')"""
    return "CASE " + " ".join(f"WHEN lang = '{k}' THEN {one(*v)}" for k, v in _CUTS.items()) + rf" ELSE {one('[.!?…]', _ANY)} END"


def _share(x: str) -> str:
    cases = " ".join(f"WHEN lang = '{k}' THEN len(regexp_extract_all({x}, '[{v}]'))" for k, v in _LETTERS.items())
    return rf"(CASE {cases} ELSE len(regexp_extract_all({x}, '\p{{L}}')) END)::DOUBLE / len(regexp_extract_all({x}, '\p{{L}}'))"


LINES = rf"""
raw AS (
    SELECT source, doc_id, i - 1 AS line_no, {sql_strip("parts[i]")} AS text
    FROM (SELECT source, doc_id, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL), LATERAL (SELECT unnest(range(1, len(parts) + 1)) AS i)
), lines AS (SELECT * FROM raw WHERE length(text) >= 1)
"""
KEPT = f"""{LINES}, known AS (
    SELECT l.*, c.origin, c.lang, c.sp, c.min_chars, c.val FROM lines l JOIN source_config c ON l.source = c.source_name
    WHERE coalesce(c.keep, 1.0) >= 1 OR {draw_sql(1, "keep", "l.source", "l.doc_id", "l.line_no")} <= coalesce(c.keep, 1.0)
)
"""
CLEAN = rf"""{KEPT}, composed AS (SELECT * REPLACE (nfc_normalize(text) AS text) FROM known),
bare AS (
    SELECT * REPLACE (CASE WHEN origin = 'opensubtitles' THEN {sql_strip(rf"regexp_replace(regexp_replace({sql_strip('text')}, '{T.TAGS}', '', 'g'), '^[-– ]+', '')")} ELSE {sql_strip("text")} END AS text) FROM composed
), spaced AS (
    SELECT * REPLACE ({sql_collapse(rf"regexp_replace(text, '{T.URLS}', '', 'g')")} AS text) FROM bare
), clean AS (
    SELECT * FROM spaced WHERE length(text) BETWEEN coalesce(min_chars, 15) AND 2000 AND len(regexp_extract_all(text, '\p{{L}}')) > 0
    AND {_share("text")} >= CASE WHEN lang = 'el' THEN 0.6 ELSE 0.9 END
)
"""
PACKED = rf"""{CLEAN}, cut AS (
    SELECT *, string_split({_cut("text")}, chr(1)) AS parts FROM clean
), folded AS (
    SELECT *, list_reduce(list_transform(parts, lambda s: {{'out': CAST([] AS VARCHAR[]), 'buf': s}}), lambda a, b:
        CASE WHEN a.buf <> '' AND length(a.buf) + length(b.buf) > 300 THEN {{'out': list_append(a.out, a.buf), 'buf': b.buf}}
        ELSE {{'out': a.out, 'buf': trim(a.buf || ' ' || b.buf)}} END) AS f FROM cut
), grouped AS (SELECT * EXCLUDE (text, parts, f), list_filter(list_append(f.out, f.buf), lambda s: s <> '') AS groups FROM folded),
packed AS (SELECT * EXCLUDE (groups), groups[i] AS text, i - 1 AS chunk_no FROM grouped, LATERAL (SELECT unnest(range(1, len(groups) + 1)) AS i))
"""
FIRST = f"""{PACKED}, numbered AS (
    SELECT *, row_number() OVER (PARTITION BY source, {sql_lower("text")} ORDER BY doc_id, line_no, chunk_no) AS rn FROM packed
), prepared AS (SELECT * EXCLUDE (rn) FROM numbered WHERE rn = 1)
"""
_OUT = "source, doc_id, line_no, chunk_no, text"


def _tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf, "documents"), table(spark, sf, "source_config")


def _kept(spark: SparkSession, sf: str) -> DataFrame:
    docs, config = _tables(spark, sf)
    return C.kept(C.lines(docs), config.select("source_name", "origin", "lang", "sp", "keep", "min_chars", "val"))


def _prepared(spark: SparkSession, sf: str) -> DataFrame:
    """The clean table, stored: the steps after it read it more than once."""
    return materialize(C.prepared(*_tables(spark, sf)), "prepared")


def paragraph_lines(spark: SparkSession, sf: str) -> DataFrame:
    return C.lines(table(spark, sf, "documents"), 21)


def keep_sample(spark: SparkSession, sf: str) -> DataFrame:
    return _kept(spark, sf).select("source", "doc_id", "line_no")


def clean_lines(spark: SparkSession, sf: str) -> DataFrame:
    return C.cleaned(_kept(spark, sf)).select("source", "doc_id", "line_no", "text")


def sentence_pack(spark: SparkSession, sf: str) -> DataFrame:
    return C.packed(C.cleaned(_kept(spark, sf))).select(*_OUT.split(", "))


def dedup_first_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return C.prepared(*_tables(spark, sf)).select(*_OUT.split(", "))


def source_stats(spark: SparkSession, sf: str) -> DataFrame:
    return C.stats(C.prepared(*_tables(spark, sf)))


def train_val_split(spark: SparkSession, sf: str) -> DataFrame:
    return C.split(_prepared(spark, sf), per=50).select("source", "doc_id", "line_no", "chunk_no", "part")


def tokenizer_sample(spark: SparkSession, sf: str) -> DataFrame:
    return C.tokenizer_sample(_prepared(spark, sf), 20_000).select("source", "doc_id", "line_no", "chunk_no", "rep")


def byte_budget_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs, config = _tables(spark, sf)
    budget = config.select(F.col("source_name").alias("source"), (F.col("max_mb") * 10).alias("_budget"))
    rows = C.lines(docs, 21).join(F.broadcast(budget), "source")
    return C.within_bytes(rows, F.col("_budget"), batch=50).select("source", "doc_id", "line_no")


def row_cap(spark: SparkSession, sf: str) -> DataFrame:
    return C.capped(C.lines(table(spark, sf, "documents")).filter("source is not null"), 100).select("source", "doc_id", "line_no")


def source_availability(spark: SparkSession, sf: str) -> DataFrame:
    docs, config = _tables(spark, sf)
    return C.availability(config, docs)


def expected_mix(spark: SparkSession, sf: str) -> DataFrame:
    out = C.expected_mix(table(spark, sf, "source_config"), 100_000)
    return out.select("source_name", F.round("share", 6).alias("share"), F.round("n_examples", 3).alias("n_examples"))


def token_offsets(spark: SparkSession, sf: str) -> DataFrame:
    return C.offsets(C.prepared(*_tables(spark, sf)), T.n_words(F.col("text"))).select("source", "doc_id", "line_no", "chunk_no", "n_tokens", "start")


def sequence_packing(spark: SparkSession, sf: str) -> DataFrame:
    return C.sequences(C.offsets(C.prepared(*_tables(spark, sf)), T.n_words(F.col("text"))), 256)


def next_word_contexts(spark: SparkSession, sf: str) -> DataFrame:
    return C.contexts(C.prepared(*_tables(spark, sf)).filter(F.length("text").between(19, 199)))


_ALPHABETS = {"el": "αβγδεζηθικλμνξοπρστυφχψωςάέήίόύώϊϋΐΰ", "sq": "abcdefghijklmnopqrstuvxyzëçw", "en": "abcdefghijklmnopqrstuvwxyz", "es": "abcdefghijklmnopqrstuvwxyzáéíóúüñ"}


def missing_letters(spark: SparkSession, sf: str) -> DataFrame:
    return C.missing_letters(C.prepared(*_tables(spark, sf)), _ALPHABETS)


def columns_joined(spark: SparkSession, sf: str) -> DataFrame:
    notes = table(spark, sf, "source_notes")
    return notes.select("source_name", T.joined(F.col("license"), F.col("use_note"), F.col("citation")).alias("text"))


def repetition_flags(spark: SparkSession, sf: str) -> DataFrame:
    docs = spread(table(spark, sf, "documents")).filter("text is not null")
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(T.is_runaway(F.col("text"))).alias("n_runaway"))


QUERIES = {f.__name__: f for f in (dedup_first_per_source, paragraph_lines, keep_sample, clean_lines, sentence_pack, source_stats, train_val_split, tokenizer_sample, byte_budget_scan, row_cap, source_availability, expected_mix, token_offsets, sequence_packing, next_word_contexts, missing_letters, columns_joined, repetition_flags)}

_TOKENS = f"{FIRST}, sized AS (SELECT *, {sql_words('text')} AS n_tokens FROM prepared)"
_OFFSETS = f"{_TOKENS}, placed AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY source ORDER BY doc_id, line_no, chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM sized)"
ORACLE = {
    "paragraph_lines": f"WITH {LINES} SELECT source, doc_id, line_no, text FROM lines WHERE length(text) >= 21",
    "keep_sample": f"WITH {KEPT} SELECT source, doc_id, line_no FROM known",
    "clean_lines": f"WITH {CLEAN} SELECT source, doc_id, line_no, text FROM clean",
    "sentence_pack": f"WITH {PACKED} SELECT {_OUT} FROM packed",
    "dedup_first_per_source": f"WITH {FIRST} SELECT {_OUT} FROM prepared",
    "source_stats": f"WITH {FIRST} SELECT source, count(*) AS n_lines, sum({sql_words('text')})::BIGINT AS n_tokens, sum(length(text))::BIGINT AS n_chars FROM prepared GROUP BY source",
    "train_val_split": f"""WITH {FIRST}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY source ORDER BY {draw_sql(1, "val", "source", "doc_id", "line_no", "chunk_no")}, doc_id, line_no, chunk_no) AS r, count(*) OVER (PARTITION BY source) AS n FROM prepared)
        SELECT source, doc_id, line_no, chunk_no, CASE WHEN coalesce(val, true) AND r <= least(5000, n // 50) THEN 'val' ELSE 'train' END AS part FROM ranked""",
    "tokenizer_sample": f"""WITH {FIRST}, sizes AS (SELECT source, count(*) AS c FROM prepared GROUP BY source), info AS (SELECT *, (SELECT count(*) FROM sizes) AS k FROM sizes),
        wanted AS (SELECT p.*, c, floor(20000 * coalesce(sp, 1.0 / k)) AS want FROM prepared p JOIN info USING (source)),
        taken AS (SELECT *, CASE WHEN want >= c THEN least(20, greatest(1, floor(want / c))) ELSE 1 END::INT AS reps FROM wanted
            WHERE want >= c OR {draw_sql(1, "sp", "source", "doc_id", "line_no", "chunk_no")} < want / c)
        SELECT source, doc_id, line_no, chunk_no, unnest(range(1, reps + 1))::INT AS rep FROM taken""",
    "byte_budget_scan": f"""WITH {LINES}, known AS (SELECT l.*, c.max_mb * 10 AS budget, strlen(text) + 1 AS b FROM lines l JOIN source_config c ON l.source = c.source_name WHERE length(text) >= 21),
        numbered AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY doc_id, line_no) - 1) // 50 AS batch FROM known),
        batches AS (SELECT source, batch, coalesce(sum(sum(b)) OVER (PARTITION BY source ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM numbered GROUP BY source, batch)
        SELECT source, doc_id, line_no FROM numbered JOIN batches USING (source, batch) WHERE budget IS NULL OR before < budget""",
    "row_cap": f"WITH {LINES}, numbered AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, line_no) AS n FROM lines WHERE source IS NOT NULL) SELECT source, doc_id, line_no FROM numbered WHERE n <= 100",
    "source_availability": "SELECT c.source_name, count(d.source) AS n_docs FROM source_config c LEFT JOIN documents d ON d.source = c.source_name GROUP BY c.source_name",
    "expected_mix": "SELECT source_name, round(mix / sum(mix) OVER (), 6) AS share, round(100000 * mix / sum(mix) OVER (), 3) AS n_examples FROM source_config WHERE mix > 0",
    "token_offsets": f"WITH {_OFFSETS} SELECT source, doc_id, line_no, chunk_no, n_tokens, start::BIGINT AS start FROM placed",
    "sequence_packing": f"""WITH {_OFFSETS}, each AS (SELECT *, unnest(range((start // 256)::BIGINT, ((start + n_tokens - 1) // 256)::BIGINT + 1)) AS seq FROM placed WHERE n_tokens > 0)
        SELECT source, seq, count(*) AS n_lines, sum(least((seq + 1) * 256, start + n_tokens) - greatest(seq * 256, start))::BIGINT AS n_tokens FROM each GROUP BY source, seq""",
    "next_word_contexts": f"""WITH {FIRST}, ws AS (SELECT *, list_filter(string_split(text, ' '), lambda w: w <> '') AS w FROM prepared WHERE length(text) BETWEEN 19 AND 199),
        each AS (SELECT *, unnest(range(1, len(w))) AS position FROM ws)
        SELECT doc_id, line_no, chunk_no, position::INT AS position, array_to_string(w[greatest(1, position - 59):position], ' ') AS context, w[position + 1] AS word FROM each""",
    "missing_letters": f"""WITH {FIRST}, want AS (SELECT lang, unnest(string_split(letters, '')) AS letter FROM (VALUES {", ".join(f"('{k}', '{v}')" for k, v in _ALPHABETS.items())}) v(lang, letters)),
        seen AS (SELECT DISTINCT lang, unnest(string_split({sql_lower("text")}, '')) AS letter FROM prepared) SELECT lang, letter FROM want WHERE letter <> '' AND (lang, letter) NOT IN (SELECT lang, letter FROM seen)""",
    "columns_joined": "SELECT source_name, array_to_string(list_filter([license, use_note, citation], lambda x: x IS NOT NULL AND x <> ''), ' ') AS text FROM source_notes",
    "repetition_flags": rf"""WITH w AS (SELECT lang, list_filter(string_split({sql_collapse(sql_lower("text"))}, ' '), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL)
        SELECT lang, count(*) AS n, count(*) FILTER (WHERE len(w) > 8 AND len(list_distinct(w)) < 0.4 * len(w)) AS n_runaway FROM w GROUP BY lang""",
}
