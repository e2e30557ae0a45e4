"""Queries of messages and pairs, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import text as T
from textmill.functions.draw import draw_sql
from textmill.operators import corpus as C
from textmill.operators import messages as M
from textmill.operators import pairs as P
from textmill.plans.corpus import LINES, sql_lower, sql_strip, sql_words
from textmill.session import spread, table

SWEARS = P.Swears()
NO_ADD = ("please", "basically", "κοιτα", "pra", "bueno")
NUMBERS = {"el": ["δύο", "τρία", "τέσσερα"], "sq": ["dy", "tri", "katër"], "en": ["two", "three", "four"], "es": ["dos", "tres", "cuatro"]}
_KEY = ("source", "doc_id", "line_no")


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pairs"))


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    return C.lines(table(spark, sf, "documents")).filter("source is not null")


def message_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _lines(spark, sf).filter(T.is_message(F.col("text"))).select(*_KEY)


def message_tidy(spark: SparkSession, sf: str) -> DataFrame:
    return M.usable(_lines(spark, sf)).select(*_KEY, "text")


def subtitle_filter(spark: SparkSession, sf: str) -> DataFrame:
    subs = _lines(spark, sf).filter(F.col("source").startswith("subs")).withColumn("text", T.strip(F.regexp_replace("text", r"<[^>]+>|^-[\t ]*", "")))
    return subs.filter((F.col("text") != "") & T.is_subtitle(F.col("text"))).select(*_KEY, "text")


def dialogue_join(spark: SparkSession, sf: str) -> DataFrame:
    return M.joined(_lines(spark, sf)).filter(T.is_message(F.col("text"))).select("source", "doc_id", "message_no", "text")


def reservoir_sample(spark: SparkSession, sf: str) -> DataFrame:
    return M.reservoir(_lines(spark, sf).filter(T.is_message(F.col("text"))), 40, _KEY).select(*_KEY)


def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.unaccented(_lines(spark, sf).filter(T.is_message(F.col("text"))), "text", "bare")
    return M.stratified(rows, 60, 0.3, SWEARS.count(F.col("bare")) > 0, _KEY).select(*_KEY)


def source_share_sample(spark: SparkSession, sf: str) -> DataFrame:
    shares = table(spark, sf, "source_config").select(F.col("source_name").alias("source"), F.col("mix").alias("share"), F.col("source_name").startswith("slang").alias("always"))
    return M.shared(_lines(spark, sf), shares, 3000, _KEY).select(*_KEY)


def pair_lines_parsed(spark: SparkSession, sf: str) -> DataFrame:
    return P.parsed(table(spark, sf, "pair_lines").select("line_id", "raw"))


def light_rambler_join(spark: SparkSession, sf: str) -> DataFrame:
    return P.light_with_rambler(_pairs(spark, sf))


def rewrite_filter(spark: SparkSession, sf: str) -> DataFrame:
    return P.rewrites_judged(_pairs(spark, sf), SWEARS, NO_ADD).select("pair_id", "verdict")


def sanity_filter(spark: SparkSession, sf: str) -> DataFrame:
    return P.outputs_judged(_pairs(spark, sf), SWEARS).select("pair_id", "sane")


def rewrite_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.rewrites_judged(_pairs(spark, sf), SWEARS, NO_ADD).groupBy("lang", "mode", "verdict").agg(F.count(F.lit(1)).alias("n"))


def swear_retention(spark: SparkSession, sf: str) -> DataFrame:
    rows = T.unaccented(T.unaccented(_pairs(spark, sf).filter("input is not null and output is not null"), "input", "i"), "output", "o")
    had, kept = SWEARS.count(F.col("i")), SWEARS.count(F.col("o"))
    out = rows.groupBy("lang").agg(F.sum(F.least(kept, had)).alias("kept"), F.sum(had).alias("had"))
    return out.select("lang", "had", F.round(F.col("kept") / F.greatest(F.lit(1), F.col("had")), 6).alias("retained"))


def language_kept(spark: SparkSession, sf: str) -> DataFrame:
    rows = P.language_kept(_pairs(spark, sf).filter("input is not null and output is not null"), table(spark, sf, "lang_rules"))
    return rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("n_kept"))


def messy_dictation(spark: SparkSession, sf: str) -> DataFrame:
    return P.dictated(_pairs(spark, sf).filter("mode = 'light'"), table(spark, sf, "lang_rules"))


def trailing_corrections(spark: SparkSession, sf: str) -> DataFrame:
    return P.corrected_later(_pairs(spark, sf).filter("mode = 'light'"), table(spark, sf, "lang_rules"), 200, numbers=NUMBERS)


def holdout_by_message(spark: SparkSession, sf: str) -> DataFrame:
    return P.held_out(_pairs(spark, sf), old_share=0.9, old=F.coalesce(F.col("source") != "corrections", F.lit(True))).select("pair_id", "part")


def pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    return P.valid(_pairs(spark, sf)).groupBy("lang", "mode").agg(F.count(F.lit(1)).alias("n"))


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    return P.prompts(_pairs(spark, sf), {"el": "Greek", "sq": "Albanian", "en": "English", "es": "Spanish"}).select("pair_id", F.md5("prompt").alias("prompt_md5"))


QUERIES = {f.__name__: f for f in (holdout_by_message, message_filter, message_tidy, subtitle_filter, dialogue_join, reservoir_sample, stratified_sample, source_share_sample, pair_lines_parsed, light_rambler_join, rewrite_filter, rewrite_counts, sanity_filter, swear_retention, language_kept, messy_dictation, trailing_corrections, pair_counts, prompts)}

_MESSAGE = rf"""{sql_words("text")} BETWEEN 6 AND 60 AND NOT regexp_matches(text, 'https?://|@[\p{{L}}\p{{N}}_]|#[\p{{L}}\p{{N}}_]|\p{{Nd}}{{4}}')"""
_ROWS = f"{LINES}, named AS (SELECT * FROM lines WHERE source IS NOT NULL)"
_MESSAGES = f"{_ROWS}, messages AS (SELECT * FROM named WHERE {_MESSAGE})"
_bare = lambda x: f"replace(strip_accents(lower({x})), 'ς', 'σ')"
_SWEAR = "^(" + "|".join([*(f"{s}[\\p{{L}}\\p{{N}}_'']*" for s in SWEARS.stems), *SWEARS.exact]) + ")$"
_SWEAR_IN_APP = "^(" + "|".join([*(f"{s}.*" for s in SWEARS.stems), *SWEARS.exact]) + ")$"
_swears = lambda x: rf"len(list_filter(regexp_extract_all({_bare(x)}, '[\p{{L}}\p{{N}}_'']+'), lambda w: regexp_matches(w, '{_SWEAR}')))"
_in_app = lambda x: rf"len(list_filter(regexp_extract_all({_bare(x)}, '[\p{{L}}'']+'), lambda w: regexp_matches(ltrim(w, chr(39)), '{_SWEAR_IN_APP}')))"
_pad = lambda x: rf"(' ' || array_to_string(regexp_extract_all({_bare(x)}, '{T.WORD}'), ' ') || ' ')"
_ADDED = " OR ".join(f"(contains(o, ' {w} ') AND NOT contains(i, ' {w} '))" for w in NO_ADD)
_JUDGED = rf"""base AS (SELECT *, trim({sql_strip("regexp_replace(coalesce(output, ''), '(?s)<think>.*?</think>', '', 'g')")}, '"') AS reply, {_pad("coalesce(output, '')")} AS o, {_pad("coalesce(input, '')")} AS i,
    {_swears("coalesce(input, '')")} AS had, {_swears("coalesce(output, '')")} AS kept FROM pairs),
judged AS (SELECT *, length(reply) / greatest(1, length(coalesce(input, ''))) AS ratio FROM base),
verdicts AS (SELECT *, CASE WHEN reply = '' THEN 'empty' WHEN NOT (ratio BETWEEN 0.2 AND 1.3) THEN 'ratio' WHEN 2 * kept < had THEN 'swears' WHEN regexp_matches(lower(reply), '^(here|sure|i can)') THEN 'chatter' WHEN {_ADDED} THEN 'added' ELSE 'ok' END AS verdict FROM judged)"""
_CORRECTS = " OR ".join(f"contains({_bare('coalesce(input, chr(32))')}, '{_p.replace('ς', 'σ')}')" for _p in P.SELF_CORRECTIONS)
_VALID = f"{sql_strip('input')} <> '' AND {sql_strip('output')} <> ''"
_detect = r"replace(replace(detect, '\b(', '(?:^|[^\p{L}\p{N}_])('), ')\b', ')(?:$|[^\p{L}\p{N}_])')"
_pick = lambda options, u: f"({options})[floor({u} * len({options}))::INT + 1]"
_tokens = lambda x: rf"regexp_extract_all({sql_lower(f'nfc_normalize({x})')}, '[\p{{L}}\p{{N}}\p{{M}}_''’-]+')"
_u = lambda salt, *more: draw_sql(1, salt, "pair_id", *more)
_DICTATED = f"""base AS (SELECT pair_id, p.lang, nfc_normalize(output) AS text, {_tokens("output")} AS w, fillers, corrections FROM pairs p LEFT JOIN lang_rules ON p.lang = code WHERE mode = 'light' AND output IS NOT NULL),
each AS (SELECT *, list_transform(w, lambda x, i: {{'x': x, 'k': i, 'r': {_u("word", "(i - 1)")}, 'f': {_pick("fillers", _u("which", "(i - 1)"))}}}) AS e FROM base),
noisy AS (SELECT *, flatten(list_transform(e, lambda s: CASE WHEN s.r < 0.10 THEN [s.f, s.x] WHEN s.r < 0.14 THEN [s.x, s.x] WHEN s.r < 0.16 AND s.k + 1 < len(w) THEN [s.x, w[s.k + 1], s.f, s.x] ELSE [s.x] END)) AS o FROM each),
placed AS (SELECT *, floor({_u("where")} * greatest(1, len(o) - 2))::INT + 1 AS j, list_filter(o, lambda x: length(x) > 3) AS long FROM noisy),
wrong AS (SELECT *, CASE WHEN len(long) > 0 THEN {_pick("long", _u("wrong"))} ELSE o[j + 1] END AS x FROM placed),
fixed AS (SELECT *, CASE WHEN len(o) > 5 AND {_u("fix")} < 0.35 AND x <> o[j + 1] THEN list_concat(o[1:j], [x, {_pick("corrections", _u("phrase"))}], o[j + 1:]) ELSE o END AS z FROM wrong)"""
_v = lambda salt, *more: _u("later-" + salt, *more)
_NUMBERED = "CASE lang " + " ".join(f"WHEN '{k}' THEN [" + ", ".join(f"'{x}'" for x in v) + "]" for k, v in NUMBERS.items()) + " ELSE CAST([] AS VARCHAR[]) END"
_said = lambda part, salt: f"flatten(list_transform({part}, lambda x, i: CASE WHEN {_v(salt, '(i - 1)')} < 0.08 THEN [{_pick('f', _v(salt + '-which', '(i - 1)'))}, x] ELSE [x] END))"
_CORRECTED = rf"""base AS (SELECT pair_id, lang, nfc_normalize(output) AS text, {_tokens("output")} AS w FROM pairs WHERE mode = 'light' AND output IS NOT NULL AND lang IS NOT NULL),
numbered AS (SELECT *, {_NUMBERED} AS numbers FROM base WHERE len(w) >= 5),
marked AS (SELECT *, CASE WHEN {_v("number")} < 0.5 THEN list_filter(range(1, len(w) + 1), lambda i: list_contains(numbers, w[i])) ELSE CAST([] AS BIGINT[]) END AS nums, list_filter(range(2, len(w) + 1), lambda i: length(w[i]) >= 4) AS places FROM numbered),
able AS (SELECT a.*, len(nums) > 0 AS isnumber, CASE WHEN len(nums) > 0 THEN nums ELSE places END AS p, coalesce(light_fillers, fillers[1:3]) AS f, corrections AS c FROM marked a JOIN lang_rules ON code = a.lang WHERE len(nums) > 0 OR len(places) > 0),
drawn AS (SELECT *, {_pick("p", _v("place"))} AS i FROM able QUALIFY row_number() OVER (PARTITION BY lang ORDER BY {_u("reservoir")}, pair_id) <= 200),
vocab AS (SELECT lang, word, row_number() OVER (PARTITION BY lang ORDER BY word) - 1 AS r, count(*) OVER (PARTITION BY lang) AS size FROM (SELECT DISTINCT lang, unnest(regexp_extract_all({sql_lower("text")}, '\p{{L}}{{4,}}')) AS word FROM base)),
ranked AS (SELECT d.*, floor({_v("vocab")} * s.size)::BIGINT AS r, s.size FROM drawn d JOIN (SELECT DISTINCT lang, size FROM vocab) s USING (lang)),
words AS (SELECT d.*, CASE WHEN isnumber THEN {_pick("list_filter(numbers, lambda n: n <> w[i])", _v("other"))} WHEN a.word <> w[i] THEN a.word ELSE b.word END AS wrong FROM ranked d JOIN vocab a ON a.lang = d.lang AND a.r = d.r JOIN vocab b ON b.lang = d.lang AND b.r = (d.r + 1) % d.size),
spoken AS (SELECT *, list_concat(w[1:i - 1], [wrong], w[i + 1:]) AS s, CASE WHEN NOT isnumber AND {_v("article")} < 0.5 THEN w[i - 1:i] ELSE w[i:i] END AS fix, (i + floor({_v("cut")} * (len(w) - i + 1)))::INT AS cut FROM words WHERE wrong <> w[i])"""
ORACLE = {
    "messy_dictation": f"""WITH {_DICTATED} SELECT pair_id, lang, text, CASE WHEN {_u("clean")} < 0.15 OR fillers IS NULL OR len(w) = 0 THEN text
        ELSE array_to_string(CASE WHEN {_u("lead")} < 0.30 THEN list_prepend({_pick("fillers", _u("first"))}, z) ELSE z END, ' ') END AS input FROM fixed""",
    "trailing_corrections": f"WITH {_CORRECTED} SELECT pair_id, lang, text, array_to_string(list_concat({_said('s[1:cut]', 'head')}, [{_pick('c', _v('phrase'))}], fix, {_said('s[cut + 1:]', 'tail')}), ' ') AS input FROM spoken",
    "message_filter": f"WITH {_MESSAGES} SELECT source, doc_id, line_no FROM messages",
    "message_tidy": rf"""WITH {_MESSAGES}, head AS (SELECT * REPLACE (nfc_normalize(text) AS text), regexp_extract(nfc_normalize(text), '^[^\p{{L}}]*') AS h FROM messages),
        up AS (SELECT * REPLACE (h || upper(text[length(h) + 1:length(h) + 1]) || text[length(h) + 2:] AS text) FROM head),
        tidy AS (SELECT * REPLACE (CASE WHEN regexp_matches(text, '[.!?…)"»]$') THEN text ELSE text || '.' END AS text) FROM up)
        SELECT source, doc_id, line_no, text FROM (SELECT *, row_number() OVER (PARTITION BY text ORDER BY source, doc_id, line_no) AS r FROM tidy) WHERE r = 1""",
    "subtitle_filter": rf"""WITH {_ROWS}, bare AS (SELECT * REPLACE ({sql_strip(r"regexp_replace(text, '<[^>]+>|^-[\t ]*', '', 'g')")} AS text) FROM named WHERE starts_with(source, 'subs'))
        SELECT source, doc_id, line_no, text FROM bare WHERE text <> '' AND NOT regexp_matches(text, '[♪#]|\p{{Nd}}{{3}}')""",
    "dialogue_join": f"""WITH {_ROWS}, sized AS (SELECT source, doc_id, line_no, text, floor({draw_sql(1, "join", "source", "doc_id", "line_no")} * 3 + 1)::INT AS k FROM named),
        whole AS (SELECT source, doc_id, list({{'out': CAST([] AS VARCHAR[]), 'buf': [text], 'k': k}} ORDER BY line_no) AS l FROM sized GROUP BY source, doc_id),
        folded AS (SELECT source, doc_id, list_reduce(list_transform(l, lambda a: CASE WHEN len(a.buf) >= a.k THEN {{'out': [a.buf[1]], 'buf': CAST([] AS VARCHAR[]), 'k': a.k}} ELSE a END), lambda a, b:
            CASE WHEN b.out <> CAST([] AS VARCHAR[]) THEN {{'out': list_append(a.out, array_to_string(list_append(a.buf, b.out[1]), ' ')), 'buf': CAST([] AS VARCHAR[]), 'k': 0}}
            WHEN len(a.buf) + 1 >= b.k THEN {{'out': list_append(a.out, array_to_string(list_concat(a.buf, b.buf), ' ')), 'buf': CAST([] AS VARCHAR[]), 'k': 0}}
            ELSE {{'out': a.out, 'buf': list_concat(a.buf, b.buf), 'k': 0}} END) AS f FROM whole),
        each AS (SELECT source, doc_id, f.out AS o, unnest(range(1, len(f.out) + 1)) AS n FROM folded), messages AS (SELECT source, doc_id, n - 1 AS message_no, o[n] AS text FROM each)
        SELECT * FROM messages WHERE {_MESSAGE}""",
    "reservoir_sample": f"""WITH {_MESSAGES} SELECT source, doc_id, line_no FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY {draw_sql(1, "reservoir", *_KEY)}, source, doc_id, line_no) AS r FROM messages) WHERE r <= 40""",
    "stratified_sample": f"""WITH {_MESSAGES}, s AS (SELECT *, {_swears("text")} > 0 AS s, {draw_sql(1, "reservoir", *_KEY)} AS d FROM messages),
        r AS (SELECT *, row_number() OVER (PARTITION BY source, s ORDER BY d, source, doc_id, line_no) AS r FROM s), k AS (SELECT *, count(*) FILTER (WHERE s AND r <= 18) OVER (PARTITION BY source) AS k FROM r)
        SELECT source, doc_id, line_no FROM k WHERE (s AND r <= 18) OR (NOT s AND r <= 60 - k)""",
    "source_share_sample": f"""WITH {_ROWS}, r AS (SELECT n.*, mix, starts_with(n.source, 'slang') AS always, row_number() OVER (PARTITION BY n.source ORDER BY {draw_sql(1, "share", "n.source", "doc_id", "line_no")}, n.source, doc_id, line_no) AS r FROM named n JOIN source_config c ON n.source = c.source_name)
        SELECT source, doc_id, line_no FROM r WHERE always OR r <= floor(3000 * coalesce(mix, 0))""",
    "pair_lines_parsed": "SELECT line_id, raw ->> '$.lang' AS lang, raw ->> '$.mode' AS mode, raw ->> '$.input' AS input, raw ->> '$.output' AS output FROM pair_lines WHERE CASE WHEN json_valid(raw) THEN json_type(raw) = 'OBJECT' ELSE false END",
    "light_rambler_join": "SELECT lang, input, max_by(output, pair_id) FILTER (WHERE mode = 'light' ) AS light, max_by(output, pair_id) FILTER (WHERE mode = 'rambler') AS rambler FROM pairs WHERE lang IS NOT NULL AND input IS NOT NULL GROUP BY lang, input HAVING count(*) FILTER (WHERE mode = 'light') > 0",
    "rewrite_filter": f"WITH {_JUDGED} SELECT pair_id, verdict FROM verdicts",
    "rewrite_counts": f"WITH {_JUDGED} SELECT lang, mode, verdict, count(*) AS n FROM verdicts GROUP BY lang, mode, verdict",
    "sanity_filter": rf"""WITH base AS (SELECT *, {sql_strip(rf"regexp_replace({sql_strip(chr(99) + 'oalesce(output, chr(32))')}, '^\"((?s:.*))\"$', '\1')")} AS o, {_in_app("coalesce(input, '')")} AS had, {_in_app("coalesce(output, '')")} AS kept, ({_CORRECTS})::INT AS fixes FROM pairs),
        r AS (SELECT *, length(o) / greatest(1, length(coalesce(input, ''))) AS ratio FROM base)
        SELECT pair_id, CASE WHEN o = '' THEN 'empty' WHEN NOT (ratio BETWEEN CASE WHEN mode = 'rambler' THEN 0.15 ELSE 0.4 END AND CASE WHEN mode = 'rambler' THEN 1.5 ELSE 1.6 END) THEN 'ratio' WHEN had > 0 AND 2 * (kept + fixes) < had THEN 'sanitized' ELSE 'ok' END AS sane FROM r""",
    "swear_retention": f"WITH s AS (SELECT lang, {_swears('input')} AS had, {_swears('output')} AS kept FROM pairs WHERE input IS NOT NULL AND output IS NOT NULL) SELECT lang, sum(had)::BIGINT AS had, round(sum(least(had, kept)) / greatest(1, sum(had)), 6) AS retained FROM s GROUP BY lang",
    "language_kept": f"""WITH k AS (SELECT p.lang, CASE WHEN detect IS NULL THEN true ELSE regexp_matches({sql_lower("output")}, '(?i)' || {_detect}) = regexp_matches({sql_lower("input")}, '(?i)' || {_detect}) END AS kept
        FROM pairs p LEFT JOIN lang_rules ON p.lang = code WHERE input IS NOT NULL AND output IS NOT NULL) SELECT lang, count(*) AS n, count(*) FILTER (WHERE kept) AS n_kept FROM k GROUP BY lang""",
    "holdout_by_message": f"""WITH good AS (SELECT *, {draw_sql(1, "row", "pair_id")} AS u, md5(lang || chr(31) || input) AS k FROM pairs WHERE {_VALID} AND lang IS NOT NULL AND (coalesce(source = 'corrections', false) OR {draw_sql(1, "old", "pair_id")} <= 0.9)),
        keys AS (SELECT lang, k, first(pair_id ORDER BY u, pair_id) AS val, count(*) AS n FROM good GROUP BY lang, k),
        quota AS (SELECT lang, greatest(1, round_even(count(*) * greatest(200, floor((SELECT count(*) FROM good) / 50)) / (SELECT count(*) FROM keys), 0)) AS q FROM keys GROUP BY lang),
        held AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY {draw_sql(1, "key", "k")}, k) AS r FROM keys JOIN quota USING (lang)) WHERE r <= q),
        leaks AS (SELECT DISTINCT g.lang, g.output FROM good g JOIN held h ON g.lang = h.lang AND g.k = h.k),
        marked AS (SELECT g.*, CASE WHEN g.pair_id = h.val THEN 'val' WHEN h.val IS NOT NULL OR l.lang IS NOT NULL THEN 'dropped' END AS part FROM good g LEFT JOIN held h ON g.lang = h.lang AND g.k = h.k LEFT JOIN leaks l ON g.lang = l.lang AND g.output = l.output)
        SELECT pair_id, coalesce(part, CASE WHEN row_number() OVER (PARTITION BY lang, mode, input, part ORDER BY u, pair_id) = 1 THEN 'train' ELSE 'repeat' END) AS part FROM marked""",
    "pair_counts": f"SELECT lang, mode, count(*) AS n FROM pairs WHERE {_VALID} GROUP BY lang, mode",
    "prompts": """SELECT pair_id, md5('<|im_start|>system' || chr(10) || CASE WHEN mode = 'rambler' THEN 'Rewrite as a short, clear message' ELSE 'Clean up: punctuation, capitals, remove fillers, apply self-corrections, keep the words' END || '. Language: ' ||
        coalesce(CASE lang WHEN 'el' THEN 'Greek' WHEN 'sq' THEN 'Albanian' WHEN 'en' THEN 'English' WHEN 'es' THEN 'Spanish' END, lang) || '. Never translate. Keep slang and swearing exactly. Output only the text.<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || coalesce(input, '') ||
        '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10)) AS prompt_md5 FROM pairs""",
}
