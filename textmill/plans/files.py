"""Queries that go through files: what a writer wrote, a reader reads back, and their SQL over the tables they came from."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.locale import chat_endpoint
from textmill.operators import catalog as K
from textmill.operators import models as O
from textmill.operators.lexicon import Offensive, offensive
from textmill.session import shared_dir, table, temporary
from textmill.sources import readers as R
from textmill.sources import sinks as W


def _place(spark: SparkSession, label: str) -> str:
    """A new folder among the stored steps; it goes when the driver ends."""
    return temporary(spark, f"{shared_dir(spark)}/textmill-{uuid.uuid4().hex}") + "/" + label


def _one_line(df: DataFrame, column: str) -> DataFrame:
    """Rows of df whose text is one line that isn't blank."""
    return df.filter(F.col(column).isNotNull() & (F.trim(column) != "") & ~F.col(column).rlike(r"[\r\n\x{85}\x{2028}\x{2029}]"))


def text_lines_read(spark: SparkSession, sf: str) -> DataFrame:
    at = _place(spark, "lines")
    W.lines(_one_line(table(spark, sf, "train_cv"), "text"), at)
    return R.text_lines(spark, at, "clips").groupBy("source", "text").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("line_no") < 0).alias("n_before"))


def lines_unordered_read(spark: SparkSession, sf: str) -> DataFrame:
    at = _place(spark, "lines")
    _one_line(table(spark, sf, "eval_cv"), "text").select(F.col("text").alias("value")).write.option("compression", "gzip").text(at)
    return R.lines_unordered(spark, at, "clips", 4).groupBy("source", "text").agg(F.count(F.lit(1)).alias("n"))


def parquet_columns_read(spark: SparkSession, sf: str) -> DataFrame:
    return R.parquet_text(spark, f"{sf}/source_notes.parquet", "notes", ["license", "no such column", "citation"]).select("source", "text")


def paragraphs_read(spark: SparkSession, sf: str) -> DataFrame:
    return R.parquet_paragraphs(spark, f"{sf}/documents.parquet", "docs", least=21).groupBy("source", "text").agg(F.count(F.lit(1)).alias("n"))


def dataset_splits_read(spark: SparkSession, sf: str) -> DataFrame:
    clips, folders = table(spark, sf, "eval_cv").select("clip_id", "text", "split"), {}
    for name in ("dev", "test"):
        folders[name] = _place(spark, name)
        part = clips.filter(F.col("split") == name)
        (part if name == "dev" else part.drop("text")).write.parquet(folders[name])
    return R.splits(spark, folders, "all", {"dev": "validation"}).select("clip_id", "text", "part")


def newest_version_read(spark: SparkSession, sf: str) -> DataFrame:
    old, new = _place(spark, "v1"), _place(spark, "v2")
    table(spark, sf, "pack_sizes").select("pack_name", F.lit(1).alias("version")).write.parquet(old)
    table(spark, sf, "pack_sizes").select("pack_name", F.lit(2).alias("version")).write.parquet(new)
    found = R.first_of(spark, [old + "-missing", new, old])
    return spark.read.parquet(found)


def jsonl_field_read(spark: SparkSession, sf: str) -> DataFrame:
    at = _place(spark, "raw")
    table(spark, sf, "pair_lines").filter("raw is not null and raw not rlike '[\\r\\n]'").select(F.col("raw").alias("value")).write.text(at)
    return R.jsonl_field(spark, at, "input").groupBy("text").agg(F.count(F.lit(1)).alias("n"))


def jsonl_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    at = _place(spark, "pairs")
    W.jsonl(table(spark, sf, "pairs").select("lang", "mode", "input", "output"), at)
    return R.pairs(spark, at).groupBy("lang", "mode", "input", "output").agg(F.count(F.lit(1)).alias("n"))


def manifest_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    at = _place(spark, "clips")
    clips = table(spark, sf, "train_cv").filter("audio is not null and text is not null").withColumn("audio", F.concat(F.lit("/data/"), "audio"))
    W.manifest(clips.select("audio", "text", "dur", "src", "speaker"), at, "/data")
    return R.manifest(spark, at, "/clips").select("audio", "text", "dur", "src", "speaker")


def tsv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    at = _place(spark, "tsv")
    clips = _one_line(table(spark, sf, "eval_cv"), "text").filter("text not like '%\t%'").select(F.col("clip_id").cast("string").alias("clip_id"), "text")
    head = spark.createDataFrame([("clip_id\ttext",)], "value string")
    for name, rows in (("0", head), ("1", clips.select(F.concat_ws("\t", "clip_id", "text").alias("value")))):
        rows.coalesce(1).write.text(f"{at}/{name}")
    one = _place(spark, "table")
    R.lines_unordered(spark, [f"{at}/0", f"{at}/1"], "t").coalesce(1).sortWithinPartitions("path").select(F.col("text").alias("value")).write.text(one)
    return R.tsv(spark, one).select("clip_id", F.btrim("text", F.lit(" ")).alias("text"))


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    at = _place(spark, "csv")
    table(spark, sf, "source_notes").select("source_name", F.coalesce("citation", F.lit("none")).alias("citation")).write.option("header", True).option("escape", '"').csv(at)
    return R.csv(spark, at).select("source_name", F.col("citation").alias("citation"))


def configuration_read(spark: SparkSession, sf: str) -> DataFrame:
    """The rules of each language as a configuration with comments, over defaults. lang_rules has a row a language."""
    rows = table(spark, sf, "lang_rules").select("code", "fillers", "light_fillers").collect()
    out = []
    for r in rows:
        text = "// the rules of a language\n" + json.dumps({"code": r[0], "words": {"fillers": r[1]} | ({"light": r[2]} if r[2] else {})}, ensure_ascii=False, indent=1) + "\n  // the end\n"
        made = R.with_defaults(R.config(text), {"seed": 7, "words": {"fillers": [], "light": ["-"]}})
        out.append((made["code"], made["seed"], " ".join(made["words"]["fillers"]), " ".join(made["words"]["light"])))
    return spark.createDataFrame(out, "code string, seed int, fillers string, light string")


def written_by_source(spark: SparkSession, sf: str) -> DataFrame:
    at = _place(spark, "docs")
    W.by_source(table(spark, sf, "documents").filter("source is not null").select("source", "doc_id", "text"), at)
    return spark.read.parquet(at).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("ids"), F.sum(F.length("text")).alias("n_chars"))


def written_once(spark: SparkSession, sf: str) -> DataFrame:
    at, plan = _place(spark, "once"), table(spark, sf, "split_plan")
    first = W.guarded(plan, at)
    again = W.guarded(plan.withColumn("share", F.lit(0.0)), at)
    return spark.read.parquet(at).select("split_name", "share", F.lit(first).alias("first"), F.lit(again).alias("again"))


def file_checksums(spark: SparkSession, sf: str) -> DataFrame:
    at = _place(spark, "sums")
    for r in table(spark, sf, "pack_sizes").select("pack_name").collect():  # four rows
        spark.createDataFrame([(r[0],)], "value string").coalesce(1).write.text(f"{at}/{r[0]}")
    return W.checksums(spark, f"{at}/*/part-*").select(F.element_at(F.split("path", "/"), -2).alias("pack_name"), "size", "sha256")


def results_replaced(spark: SparkSession, sf: str) -> DataFrame:
    at, clips = _place(spark, "results"), table(spark, sf, "train_cv").filter("src is not null")
    n = clips.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
    W.merge_results(spark, n, at, ("src",))
    W.merge_results(spark, n.filter("src = 'cv'").withColumn("n", -F.col("n")), at, ("src",))
    return spark.read.parquet(at)


def attribution_page(spark: SparkSession, sf: str) -> DataFrame:
    page = W.attribution(table(spark, sf, "source_notes"))
    return spark.createDataFrame(list(enumerate(page.split("\n"))), "line int, text string")


def bytes_decoded(spark: SparkSession, sf: str) -> DataFrame:
    clips = table(spark, sf, "train_cv").filter("text is not null and text not like '%�%'")
    return clips.select("clip_id", O.decoded(F.concat(F.lit(b"\xff"), F.encode("text", "utf-8"), F.lit(b"\xc3"))).alias("text"))


def _words(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pairs").filter("output is not null").select(F.explode(F.regexp_extract_all("output", F.lit(r"\p{L}[\p{L}'’-]*"), 0)).alias("word")).distinct()


def case_shapes(spark: SparkSession, sf: str) -> DataFrame:
    return _words(spark, sf).select("word", T.case_shape(F.col("word")).alias("shape"))


def exact_keys(spark: SparkSession, sf: str) -> DataFrame:
    return _words(spark, sf).groupBy(T.exact_key(F.col("word")).alias("key")).agg(F.count(F.lit(1)).alias("n"))


def chat_addresses(spark: SparkSession, sf: str) -> DataFrame:
    notes = table(spark, sf, "source_notes").filter("url is not null").select("source_name", "url")
    tails = F.explode(F.array(*[F.lit(x) for x in ("", "/", "/v1", "/v1/", "/v1/chat/completions")])).alias("tail")
    return notes.select("source_name", "url", tails).select("source_name", "tail", chat_endpoint(F.concat(F.lit(" "), F.regexp_replace("url", "/+$", ""), "tail", F.lit(" "))).alias("endpoint"))


def update_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes to load by pack: a pack of an even capacity/64 is there in an old version, others are missing or current."""
    packs = table(spark, sf, "pack_sizes").select(F.col("pack_name").alias("id"), F.lit("").alias("variant"), F.lit(2).alias("version"), F.col("capacity").cast("long").alias("size"))
    have = packs.select("id", F.when(F.length("id") % 2 == 0, 1).otherwise(2).alias("version"), "variant").filter(~F.col("id").startswith("page"))
    return K.bytes_needed(K.status(packs, have))


def served_by(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "source_notes")
    return rows.select("source_name", O.file_choice(F.col("license"), F.col("use_note"), F.col("citation")).alias("files"))


def words_flagged_by_list(spark: SparkSession, sf: str) -> DataFrame:
    lists = Offensive(stems=("ma", "κα"), exact=("the",), not_stems=("mar",), not_exact=("mami",), capitalised=("ma",))
    return _words(spark, sf).filter(offensive(F.col("word"), lists)).select("word")


QUERIES = {f.__name__: f for f in (text_lines_read, lines_unordered_read, parquet_columns_read, paragraphs_read, dataset_splits_read, newest_version_read, jsonl_field_read, jsonl_round_trip, manifest_round_trip, tsv_round_trip, csv_round_trip, configuration_read, written_by_source, written_once, file_checksums, results_replaced, attribution_page, bytes_decoded, case_shapes, exact_keys, chat_addresses, update_sizes, served_by, words_flagged_by_list)}

_ONE = r"text IS NOT NULL AND trim(text) <> '' AND NOT regexp_matches(text, '[\r\n\x{85}\x{2028}\x{2029}]')"
_WORDS = r"words AS (SELECT DISTINCT unnest(regexp_extract_all(output, '\p{L}[\p{L}''’-]*')) AS word FROM pairs WHERE output IS NOT NULL)"
from textmill.plans.corpus import sql_lower, sql_strip  # noqa: E402

_low = lambda w: rf"CASE WHEN regexp_matches({w}, '\p{{L}}Σ$') THEN regexp_replace(lower({w}), 'σ$', 'ς') ELSE {sql_lower(w)} END"
_cell = lambda x: f"replace(coalesce({x}, ''), '|', '\\|')"
ORACLE = {
    "text_lines_read": f"SELECT 'clips' AS source, text, count(*) AS n, 0 AS n_before FROM train_cv WHERE {_ONE} GROUP BY text",
    "lines_unordered_read": f"SELECT 'clips' AS source, text, count(*) AS n FROM eval_cv WHERE {_ONE} GROUP BY text",
    "parquet_columns_read": "SELECT 'notes' AS source, regexp_replace(array_to_string(list_filter([license, citation], lambda x: x IS NOT NULL AND x <> ''), ' '), '[\\r\\n]+', ' ', 'g') AS text FROM source_notes",
    "paragraphs_read": f"SELECT 'docs' AS source, text, count(*) AS n FROM (SELECT {sql_strip('unnest(string_split(text, chr(10)))')} AS text FROM documents) WHERE length(text) >= 21 GROUP BY text",
    "dataset_splits_read": "SELECT clip_id, CASE WHEN split = 'dev' THEN text END AS text, CASE WHEN split = 'dev' THEN 'validation' ELSE 'test' END AS part FROM eval_cv WHERE split IN ('dev', 'test')",
    "newest_version_read": "SELECT pack_name, 2 AS version FROM pack_sizes",
    "jsonl_field_read": "SELECT coalesce(raw ->> '$.input', '') AS text, count(*) AS n FROM pair_lines WHERE json_valid(raw) GROUP BY 1",
    "jsonl_round_trip": "SELECT lang, mode, input, output, count(*) AS n FROM pairs GROUP BY ALL",
    "manifest_round_trip": "SELECT CASE WHEN starts_with(audio, '/') THEN '/data/' || audio ELSE '/clips/' || audio END AS audio, text, dur, src, speaker FROM train_cv WHERE audio IS NOT NULL AND text IS NOT NULL",
    "tsv_round_trip": f"SELECT clip_id::VARCHAR AS clip_id, trim(text, ' ') AS text FROM eval_cv WHERE {_ONE} AND NOT contains(text, chr(9))",
    "csv_round_trip": "SELECT source_name, coalesce(citation, 'none') AS citation FROM source_notes",
    "configuration_read": "SELECT code, 7 AS seed, array_to_string(fillers, ' ') AS fillers, coalesce(array_to_string(light_fillers, ' '), '-') AS light FROM lang_rules",
    "written_by_source": "SELECT source, count(*) AS n, sum(doc_id)::BIGINT AS ids, sum(length(text))::BIGINT AS n_chars FROM documents WHERE source IS NOT NULL GROUP BY source",
    "written_once": "SELECT split_name, share, true AS first, false AS again FROM split_plan",
    "file_checksums": "SELECT pack_name, strlen(pack_name) + 1 AS size, sha256(pack_name || chr(10)) AS sha256 FROM pack_sizes",
    "results_replaced": "SELECT src, CASE WHEN src = 'cv' THEN -count(*) ELSE count(*) END AS n FROM train_cv WHERE src IS NOT NULL GROUP BY src",
    "attribution_page": f"""WITH n AS (SELECT source_name AS s, {_cell("source_name")} AS name, {_cell("url")} AS url, {_cell("license")} AS l, {_cell("use_note")} AS use, {_cell("citation")} AS c, coalesce(contains(upper(license), 'UNKNOWN'), true) AS unknown FROM source_notes),
        parts AS (SELECT 0 AS a, '' AS s, '| Source | Licence | Use |' || chr(10) || '| --- | --- | --- |' AS t UNION ALL SELECT 1, s, '| [' || name || '](' || url || ') | ' || CASE WHEN l = '' THEN 'unknown' ELSE l END || ' | ' || use || ' |' FROM n
            UNION ALL SELECT 2, '', chr(10) || 'Licence unknown, check before publishing: ' || string_agg(s, ', ' ORDER BY s) FROM n WHERE unknown HAVING count(*) > 0 UNION ALL SELECT 3, '', '' FROM (SELECT 1 FROM n WHERE c <> '' LIMIT 1) UNION ALL SELECT 4, s, '* ' || c FROM n WHERE c <> '' UNION ALL SELECT 5, '', ''),
        page AS (SELECT string_split(string_agg(t, chr(10) ORDER BY a, s), chr(10)) AS p FROM parts) SELECT i::INT AS line, p[i + 1] AS text FROM page, LATERAL (SELECT unnest(range(0, len(p))) AS i)""",
    "bytes_decoded": "SELECT clip_id, text FROM train_cv WHERE text IS NOT NULL AND NOT contains(text, chr(65533))",
    "case_shapes": rf"""WITH {_WORDS}, l AS (SELECT word, regexp_replace(word, '[^\p{{L}}]', '', 'g') AS x FROM words)
        SELECT word, CASE WHEN length(x) > 1 AND upper(word) = word AND regexp_matches(word, '\p{{Lu}}') THEN 'all' WHEN regexp_matches(word, '^\p{{Lu}}') THEN 'first' ELSE 'none' END AS shape FROM l""",
    "exact_keys": f"WITH {_WORDS}, k AS (SELECT replace(replace(word, chr(39), ''), '-', '') AS w FROM words) SELECT {_low('w')} AS key, count(*) AS n FROM k GROUP BY 1",
    "chat_addresses": """SELECT source_name, tail, rtrim(url, '/') || '/v1/chat/completions' AS endpoint FROM source_notes, (SELECT unnest(['', '/', '/v1', '/v1/', '/v1/chat/completions']) AS tail) WHERE url IS NOT NULL""",
    "update_sizes": "SELECT pack_name AS id, CASE WHEN starts_with(pack_name, 'page') OR length(pack_name) % 2 = 0 THEN capacity ELSE 0 END::BIGINT AS n_bytes FROM pack_sizes",
    "served_by": "SELECT source_name, CASE WHEN license IS NOT NULL AND use_note IS NOT NULL THEN license || '+' || use_note ELSE citation END AS files FROM source_notes",
    "words_flagged_by_list": rf"""WITH {_WORDS}, l AS (SELECT word, replace(lower(word), '’', chr(39)) AS w FROM words)
        SELECT word FROM l WHERE NOT (regexp_matches(word, '^\p{{Lu}}') AND NOT starts_with(w, 'ma')) AND NOT (starts_with(w, 'mar') OR w = 'mami') AND (w = 'the' OR starts_with(w, 'ma') OR starts_with(w, 'κα'))""",
}
