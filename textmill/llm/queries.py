"""The queries p1_ to p8_ and what of them DuckDB can check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.llm import copies, defects, encodings, lookalikes, mixing, overlap, packing, splits
from textmill.session import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return copies.copies(copies.both(table(spark, sf, "train_cv"), table(spark, sf, "pair_lines")))


def p1_copies_counted(spark: SparkSession, sf: str) -> DataFrame:
    return copies.groups(copies.both(table(spark, sf, "train_cv"), table(spark, sf, "pair_lines"))).select("tbl", "first_id", "n")


def p1_collisions(spark: SparkSession, sf: str) -> DataFrame:
    return copies.collisions(copies.both(table(spark, sf, "train_cv"), table(spark, sf, "pair_lines")))


def _split(spark: SparkSession, sf: str) -> DataFrame:
    return splits.split_records(splits.records(table(spark, sf, "train_cv"), table(spark, sf, "eval_cv"), table(spark, sf, "pairs")), table(spark, sf, "split_plan"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return splits.crossing(_split(spark, sf))


def p2_split(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).select("tbl", "rec_id", "unit", "bin", "new_split")


def p2_shares(spark: SparkSession, sf: str) -> DataFrame:
    return splits.shares_reached(_split(spark, sf), table(spark, sf, "split_plan"))


def p2_together(spark: SparkSession, sf: str) -> DataFrame:
    """By unit the records, the relatives (records of one component) in more than one split, and whether a share is missed by a hundredth."""
    rows, plan = _split(spark, sf), table(spark, sf, "split_plan")
    torn = rows.groupBy("unit", "comp").agg(F.min("new_split").alias("a"), F.max("new_split").alias("z"), F.count(F.lit(1)).alias("n"))
    torn = torn.groupBy("unit").agg(F.sum("n").alias("n_records"), F.count_if(F.col("a") != F.col("z")).alias("n_torn"))
    missed = splits.shares_reached(rows, plan).groupBy("unit").agg(F.max(F.abs(F.col("reached") - F.col("target")) >= 0.01).alias("missed"))
    return torn.join(missed, "unit")


def p2_linked(spark: SparkSession, sf: str) -> DataFrame:
    """Clips that are linked by speaker or by a text of the same letters and language, with the smallest id of their component."""
    clips = [table(spark, sf, t).select("clip_id", "speaker", "text", F.col("lang").cast("string").alias("lang")) for t in ("train_cv", "eval_cv")]
    keyed = copies.keyed_clips(both := clips[0].unionByName(clips[1])).select(F.col("id").alias("clip_id"), F.hex("h").alias("same_text"))
    rows = both.select("clip_id", splits.speaker_key(F.col("speaker")).alias("speaker")).join(keyed, "clip_id", "left")
    return splits.linked(rows, "clip_id", ["speaker", "same_text"]).select("clip_id", "first_id")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return defects.defects(table(spark, sf, "pairs"), table(spark, sf, "lang_rules"))


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.texts(table(spark, sf, "train_cv"), table(spark, sf, "pairs"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.records(_texts(spark, sf))


def p4_consistent(spark: SparkSession, sf: str) -> DataFrame:
    return lookalikes.consistent(_texts(spark, sf))


def _sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, sf, "train_cv"), table(spark, sf, "eval_cv"), table(spark, sf, "pairs")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return overlap.found(*_sides(spark, sf))


def p5_counts(spark: SparkSession, sf: str) -> DataFrame:
    return overlap.counts(*_sides(spark, sf))


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed(table(spark, sf, "documents"), table(spark, sf, "pack_sizes"))


def p6_pack(spark: SparkSession, sf: str) -> DataFrame:
    return _packed(spark, sf)


def p6_fill(spark: SparkSession, sf: str) -> DataFrame:
    return packing.fill(_packed(spark, sf))


def p6_placed(spark: SparkSession, sf: str) -> DataFrame:
    """Of each pack what any packing must hold: the texts placed, the blocks over the capacity, the texts split though they fit into
    a block, and the texts whose pieces don't make up the whole, each piece once."""
    rows = _packed(spark, sf)
    texts = rows.groupBy("pack_name", "capacity", "doc_id").agg(F.sum("n_tokens").alias("t"), F.count(F.lit(1)).alias("k"), F.countDistinct("piece").alias("d"), F.max(F.col("first_token") + F.col("n_tokens")).alias("end"))
    texts = texts.groupBy("pack_name").agg(F.count(F.lit(1)).alias("n_texts"), F.count_if((F.col("k") > 1) & (F.col("t") <= F.col("capacity"))).alias("n_split"), F.count_if((F.col("k") != F.col("d")) | (F.col("end") != F.col("t"))).alias("n_torn"))
    blocks = rows.groupBy("pack_name", "capacity", "block_id").agg(F.sum("n_tokens").alias("t"))
    return texts.join(blocks.groupBy("pack_name").agg(F.count_if(F.col("t") > F.col("capacity")).alias("n_over")), "pack_name").select("pack_name", "n_texts", "n_over", "n_split", "n_torn")


def p7_held(spark: SparkSession, sf: str) -> DataFrame:
    """Of each source of a weight what any mix must hold: whether it is used beyond its cap, and whether its texts differ in use by more than one."""
    mix = _mixed(spark, sf).groupBy(F.col("source").alias("source_name")).agg(F.max("copies").alias("most"), F.min("copies").alias("least"))
    listed = table(spark, sf, "source_config").filter("source_name is not null and mix > 0").select("source_name", F.coalesce("max_repeat", F.lit(1)).alias("cap"))
    return listed.join(mix, "source_name", "left").select("source_name", F.coalesce(F.col("most") > F.col("cap"), F.lit(False)).alias("beyond"), F.coalesce(F.col("most") - F.col("least") > 1, F.lit(False)).alias("uneven"), F.col("most").isNotNull().alias("used"))


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixed(table(spark, sf, "documents"), table(spark, sf, "source_config"))


def p7_mix(spark: SparkSession, sf: str) -> DataFrame:
    return _mixed(spark, sf).select("doc_id", "source", "n_tokens", "copies")


def p7_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(_mixed(spark, sf), table(spark, sf, "source_config"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return encodings.restored(table(spark, sf, "documents")).select("doc_id")


def p8_restored(spark: SparkSession, sf: str) -> DataFrame:
    return encodings.restored(table(spark, sf, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_copies_counted, p1_collisions, p2_found, p2_split, p2_shares, p2_together, p2_linked, p3_found, p4_found, p4_consistent, p5_found, p5_counts, p6_pack, p6_fill, p6_placed, p7_mix, p7_shares, p7_held, p8_found, p8_restored)}
_letters = lambda x: rf"replace(regexp_replace(lower(nfc_normalize(coalesce({x}, ''))), '[^\p{{L}}\p{{N}}]', '', 'g'), 'ς', 'σ')"
_strip = lambda x: rf"regexp_replace({x}, '^[\s\p{{Z}}\p{{Cf}}]+|[\s\p{{Z}}\p{{Cf}}]+$', '', 'g')"
_KEYED = f"""clips AS (SELECT 'train_cv' AS tbl, clip_id AS id, lang || chr(31) || {_letters("text")} AS k FROM train_cv WHERE {_letters("text")} <> ''),
objects AS (SELECT line_id, raw FROM pair_lines WHERE CASE WHEN json_valid(raw) THEN json_type(raw) = 'OBJECT' ELSE false END),
fields AS (SELECT line_id, trim(lower(coalesce(raw ->> '$.lang', ''))) AS l, trim(lower(coalesce(raw ->> '$.mode', ''))) AS m, {_letters("raw ->> '$.input'")} AS a, {_letters("raw ->> '$.output'")} AS b FROM objects),
keyed AS (SELECT * FROM clips UNION ALL SELECT 'pair_lines', line_id, concat_ws(chr(31), l, m, a, b) FROM fields WHERE a <> '' AND b <> ''),
grouped AS (SELECT tbl, k, min(id) AS first_id, count(*) AS n FROM keyed GROUP BY tbl, k)"""
# What the SQL takes as naming nobody.
_NOBODY = "'unknown', 'anonymous', 'anon', 'n/a', 'na', 'none', 'null', 'nil', 'nan', 'nobody', 'undefined', 'missing', 'test', 'speaker', 'unnamed', 'default', 'guest', 'user', 'tbd', 'no speaker', 'άγνωστος', 'desconocido', 'panjohur'"
_who = f"lower(left({_strip('speaker')}, 16))"
_NAMED = rf"""bare AS (SELECT *, regexp_replace(who, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g') AS b FROM (SELECT 'train_cv' AS tbl, clip_id, {_who} AS who FROM train_cv UNION ALL SELECT 'eval_cv', clip_id, {_who} FROM eval_cv)),
named AS (SELECT * FROM bare WHERE b <> '' AND b NOT IN ({_NOBODY}))"""
# Problem 5 without an index: pairs of texts that share enough words, compared by the edit distance of their words as characters.
_bare = lambda x: f"replace(strip_accents(lower({x})), 'ς', 'σ')"
_list = lambda x: rf"regexp_extract_all({_bare(x)}, '[\p{{L}}\p{{N}}]+')"
_coded = "array_to_string(list_transform({0}, lambda w: chr(list_position(list_distinct(list_concat(a.w, b.w)), w)::INT)), '')"
_PAIRED = f"""texts AS (SELECT 'clips' AS kind, lang, false AS held, clip_id AS id, {_list("text")} AS w FROM train_cv UNION ALL SELECT 'clips', lang, true, clip_id, {_list("text")} FROM eval_cv
    UNION ALL SELECT 'pairs.input', lang, split <> 'train', pair_id, {_list("input")} FROM pairs UNION ALL SELECT 'pairs.output', lang, split <> 'train', pair_id, {_list("output")} FROM pairs),
long AS (SELECT kind, lang, held, w, list(id) AS ids, row_number() OVER () AS t FROM texts WHERE len(w) >= 5 AND lang IS NOT NULL AND held IS NOT NULL GROUP BY kind, lang, held, w),
bag AS (SELECT t, kind, lang, held, x, count(*) AS n FROM (SELECT *, unnest(w) AS x FROM long) GROUP BY ALL),
near AS (SELECT a.t AS a, b.t AS b, sum(least(a.n, b.n)) AS n FROM bag a JOIN bag b ON a.kind = b.kind AND a.lang = b.lang AND a.x = b.x WHERE NOT a.held AND b.held GROUP BY ALL),
same AS (SELECT a.kind, a.ids AS trains, b.ids AS helds, a.w AS aw, b.w AS bw FROM near JOIN long a ON a.t = near.a JOIN long b ON b.t = near.b
    WHERE n >= greatest(len(a.w), len(b.w)) - greatest(len(a.w), len(b.w)) // 10 AND levenshtein({_coded.format("a.w")}, {_coded.format("b.w")}) <= greatest(len(a.w), len(b.w)) // 10),
cover AS (SELECT *, list_filter(range(1, len(bw) - 2), lambda j: list_contains(list_transform(range(1, len(aw) - 2), lambda i: aw[i:i + 3]), bw[j:j + 3])) AS starts FROM same),
sized AS (SELECT kind, trains, helds, CASE WHEN aw = bw THEN len(bw) ELSE len(list_distinct(flatten(list_transform(starts, lambda j: range(j, j + 4))))) END AS n FROM cover),
each AS (SELECT split_part(kind, '.', 1) AS tbl, unnest(trains) AS train, helds, n FROM sized), matched AS (SELECT tbl, train, unnest(helds) AS held, n FROM each), inside AS (SELECT * FROM matched),
info AS (SELECT 'clips' AS tbl, clip_id AS id, split, src AS source FROM eval_cv UNION ALL SELECT 'pairs', pair_id, split, source FROM pairs)"""
ORACLE: dict[str, str] = {
    "p1_found": f"WITH {_KEYED} SELECT tbl, first_id, id AS copy_id FROM keyed JOIN grouped USING (tbl, k) WHERE id <> first_id",
    "p1_copies_counted": f"WITH {_KEYED} SELECT tbl, first_id, n FROM grouped",
    "p1_collisions": f"WITH {_KEYED} SELECT tbl, upper(md5(k)) AS h FROM (SELECT DISTINCT tbl, k FROM keyed) GROUP BY tbl, md5(k) HAVING count(*) > 1",
    "p2_together": "SELECT 'clips' AS unit, (SELECT count(*) FROM train_cv) + (SELECT count(*) FROM eval_cv) AS n_records, 0 AS n_torn, false AS missed UNION ALL SELECT 'pairs', count(*), 0, false FROM pairs",
    "p2_linked": f"""WITH RECURSIVE {_NAMED}, c AS (SELECT clip_id, lang, text FROM train_cv UNION ALL SELECT clip_id, lang, text FROM eval_cv),
        links AS (SELECT clip_id, 's' || who AS v FROM named UNION ALL SELECT clip_id, 't' || coalesce(lang, '') || chr(31) || {_letters("text")} FROM c WHERE {_letters("text")} <> ''),
        same AS (SELECT clip_id, min(clip_id) OVER (PARTITION BY v) AS low, v FROM links), edges AS (SELECT DISTINCT a.v AS a, b.v AS b FROM links a JOIN links b USING (clip_id) WHERE a.v <> b.v),
        lows AS (SELECT v, min(clip_id) AS low FROM links GROUP BY v),
        t(v, low) USING KEY (v) AS (SELECT v, low FROM lows UNION SELECT e.b, min(t.low) FROM t JOIN edges e ON e.a = t.v JOIN recurring.t AS r ON r.v = e.b WHERE t.low < r.low GROUP BY e.b)
        SELECT c.clip_id, min(t.low) AS first_id FROM c LEFT JOIN links USING (clip_id) LEFT JOIN t USING (v) GROUP BY c.clip_id""",
    "p5_counts": f"""WITH {_PAIRED} SELECT tbl, split, source, count(*) AS n_records, sum(k)::BIGINT AS n_pairs, sum(w)::BIGINT AS n_words FROM (
        SELECT m.tbl, m.held, count(DISTINCT m.train) AS k, max(n) AS w FROM inside m GROUP BY ALL) JOIN info USING (tbl) WHERE info.id = held GROUP BY ALL""",
    "p5_found": f"WITH {_PAIRED} SELECT DISTINCT tbl, least(train, held) AS id_a, greatest(train, held) AS id_b FROM matched WHERE train <> held",
    "p6_placed": "SELECT pack_name, (SELECT count(DISTINCT doc_id) FROM documents WHERE text <> '') AS n_texts, 0 AS n_over, 0 AS n_split, 0 AS n_torn FROM pack_sizes WHERE capacity > 0",
    "p7_held": "SELECT source_name, false AS beyond, false AS uneven, EXISTS (SELECT 1 FROM documents WHERE source = source_name AND text <> '') AS used FROM source_config WHERE source_name IS NOT NULL AND mix > 0",
    "p2_found": f"""WITH {_NAMED}, keys AS (SELECT pair_id, split, coalesce(lang, '') AS l, {_letters("input")} AS k FROM pairs)
        SELECT 'eval_cv' AS tbl, clip_id AS rec_id FROM named WHERE tbl = 'eval_cv' AND who IN (SELECT who FROM named WHERE tbl = 'train_cv')
        UNION ALL SELECT 'pairs', pair_id FROM keys e WHERE split IN ('val', 'test') AND k <> '' AND EXISTS (SELECT 1 FROM keys t WHERE t.split = 'train' AND t.l = e.l AND t.k = e.k)""",
}
