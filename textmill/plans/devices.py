"""Queries of typing and of the catalogue, and their SQL."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textmill.functions import locale as LOC
from textmill.functions.draw import draw_sql
from textmill.operators import catalog as K
from textmill.operators import typing as Y
from textmill.plans.corpus import sql_lower
from textmill.session import spread, table

#: Typing errors of the test languages.
STAGES = {
    "sq": [[Y.Rule("replace_all", 0.3, {"map": {"ë": "e", "ç": "c"}}, fallthrough=True), Y.Rule("replace_one", 0.1, {"map": {"q": ["ç", "c"]}}), Y.Rule("drop_final", 0.1, {"letters": "ëe"}, 3)], [Y.Rule("substitute", 0.2, {"pairs": [["sh", "s"], ["rr", "r"], ["dh", "d"]]})]],
    "el": [[Y.Rule("final", 0.3, {"map": {"ς": "σ"}})], [Y.Rule("substitute", 0.25, {"pairs": [["ει", "ι"], ["αι", "ε"], ["οι", "ι"]], "occurrence": "first"}), Y.Rule("ending", 0.1, {"groups": [["ος", "ου", "ο"], ["ης", "η"]]})]],
}


def _words(spark: SparkSession, sf: str) -> DataFrame:
    words = spread(table(spark, sf, "pairs")).filter("output is not null and lang is not null").select("lang", F.explode(F.regexp_extract_all("output", F.lit(r"\p{L}{2,24}"), 0)).alias("word"))
    return words.select("lang", F.lower("word").alias("word")).distinct()


def nearest_keys(spark: SparkSession, sf: str) -> DataFrame:
    return Y.neighbours(Y.keys(spark))


def layout_offsets(spark: SparkSession, sf: str) -> DataFrame:
    rows = [(lang, r, line) for lang, lines in Y.LAYOUTS.items() for r, (line, _) in enumerate(lines)]
    return Y.row_offsets(spark.createDataFrame(rows, "lang string, row int, keys string"))


def typing_noise(spark: SparkSession, sf: str) -> DataFrame:
    return Y.typed(_words(spark, sf), Y.keys(spark), STAGES, id=("lang", "word"))


def typing_conditions(spark: SparkSession, sf: str) -> DataFrame:
    return Y.conditions(Y.with_errors(_words(spark, sf), Y.keys(spark), STAGES, id=("lang", "word")), Y.keys(spark)).select("lang", "word", "condition", "keys", "sigma")


def tap_mix(spark: SparkSession, sf: str) -> DataFrame:
    taps = _words(spark, sf).select("lang", "word", F.explode(F.array_distinct(F.split("word", ""))).alias("key"))
    return Y.mixed(taps, Y.keys(spark), 0.35, ("word", "key")).select("lang", "word", "key", "near", F.round("weight", 6).alias("weight"))


_V = lambda name, url: {"name": name, "size": 1_000_000 * len(name), "sha256": name * 4, "url": url}
_MODELS = [
    {"id": "voice-el", "kind": "voice", "locale": "el", "title": "Greek", "version": 2, "size": 7_000_000, "sha256": "aa", "url": "https://a.example/base", "license": "MIT", "variants": [_V("small", "https://a.example/small"), _V("base", "https://a.example/base")]},
    {"id": "lm-sq", "kind": "lm", "locale": "sq", "title": "Albanian", "size": 35_000_000, "sha256": "bb", "url": "https://a.example/sq", "license": "MIT"},
    {"id": "adapter-es-MX", "kind": "adapter", "locale": "es-MX", "title": "Mexico", "version": 3, "size": 9_500_000, "sha256": "cc", "url": "https://a.example/mx", "license": "MIT"},
    {"id": "adapter-es", "kind": "adapter", "locale": "es", "title": "Spanish", "version": 1, "size": 9_000_000, "sha256": "dd", "url": "https://a.example/es", "license": "UNKNOWN"},
    {"id": "plain", "kind": "lm", "locale": "en", "title": "No https", "size": 1, "sha256": "ee", "url": "http://a.example/en"},
    {"id": "broken", "kind": "lm", "locale": "en", "title": "No size", "sha256": "ff", "url": "https://a.example/x"},
]


def _entries(spark: SparkSession) -> DataFrame:
    indexes = [(json.dumps({"version": 1, "models": _MODELS}),), (json.dumps({"version": 2, "models": _MODELS[:1]}),), ("not json",)]
    return K.entries(spark.createDataFrame(indexes, "json string"))


def catalog_resolve(spark: SparkSession, sf: str) -> DataFrame:
    tags = table(spark, sf, "documents").filter("lang is not null").select(F.col("lang").alias("tag")).distinct()
    out = K.for_locale(_entries(spark), tags, ("voice", "lm", "adapter"))
    return out.filter("is_default").select("tag", "id", "variant", LOC.size_text(F.col("size")).alias("size_text"))


def sizes_shown(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_chars")
    sizes = table(spark, sf, "documents").select(F.explode(F.array(n, n * 1000, n * 1_000_000, *[F.lit(x).cast("long") for x in (10485759, 10485760, 11220000, 52000000, 1048575999, 1048576000)])).alias("size"))
    return sizes.filter("size is not null").distinct().select("size", LOC.size_text(F.col("size")).alias("size_text"))


def catalog_status(spark: SparkSession, sf: str) -> DataFrame:
    have = spark.createDataFrame([("a", "voice-el@1@small"), ("b", "lm-sq@1"), ("c", "adapter-es@0@")], "slot string, value string")
    return K.status(_entries(spark).filter("is_default"), K.installed(have)).select("id", "variant", "version", "state")


def adapter_priority(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "documents").filter("lang is not null").select(F.col("lang").alias("tag"), F.when(F.col("lang").startswith("es"), "MX").alias("chosen")).distinct()
    have = spark.createDataFrame([("es-MX",), ("es",), ("el",), ("sq-AL",)], "tag string")
    return K.best_dialect(wanted, have)


def locales(spark: SparkSession, sf: str) -> DataFrame:
    tags = table(spark, sf, "documents").filter("lang is not null").select("lang").distinct()
    return tags.select("lang", LOC.language(F.col("lang")).alias("language"), LOC.region(F.col("lang")).alias("region"), LOC.canonical(F.col("lang")).alias("tag"))


QUERIES = {f.__name__: f for f in (typing_noise, nearest_keys, layout_offsets, typing_conditions, tap_mix, catalog_resolve, sizes_shown, catalog_status, adapter_priority, locales)}

_KEYS = "keys(lang, key, x, y) AS (VALUES " + ", ".join(f"('{lang}', '{c}', {x0 + i + 0.5}, {r + 0.5})" for lang, lines in Y.LAYOUTS.items() for r, (line, x0) in enumerate(lines) for i, c in enumerate(line)) + ")"
_TAG = "lower(string_split(replace(lang, '_', '-'), '-')[1])"
_REGION = "upper(list_filter(string_split(replace(lang, '_', '-'), '-')[2:], lambda p: regexp_full_match(p, '[A-Za-z]{2}|[0-9]{3}'))[1])"
_LANGS = f"tags AS (SELECT DISTINCT lang, CASE {_TAG} WHEN 'iw' THEN 'he' WHEN 'in' THEN 'id' WHEN 'ji' THEN 'yi' ELSE {_TAG} END AS language, {_REGION} AS region FROM documents WHERE lang IS NOT NULL)"
_u = lambda salt, *key: draw_sql(1, salt, *key)
_TAPPED = rf"""{_KEYS}, words AS (SELECT DISTINCT lang, {sql_lower("word")} AS word FROM (SELECT lang, unnest(regexp_extract_all(output, '\p{{L}}{{2,24}}')) AS word FROM pairs WHERE output IS NOT NULL AND lang IS NOT NULL)),
taps AS (SELECT lang, word, unnest(list_distinct(string_split(word, ''))) AS key FROM words),
tapped AS (SELECT t.*, x + 0.35 * sqrt(-2 * ln(greatest({_u("tap1", "word", "key")}, 1e-10))) * cos(2 * 3.141592653589793 * {_u("tap2", "word", "key")}) AS px, y + 0.8 * 0.35 * sqrt(-2 * ln(greatest({_u("tap1", "word", "key")}, 1e-10))) * sin(2 * 3.141592653589793 * {_u("tap2", "word", "key")}) AS py FROM taps t JOIN keys USING (lang, key)),
near AS (SELECT a.lang, word, a.key, k.key AS near, exp(-((k.x - px) ^ 2 + (k.y - py) ^ 2) / (2 * 0.35 ^ 2)) AS w, row_number() OVER (PARTITION BY a.lang, word, a.key ORDER BY (k.x - px) ^ 2 + (k.y - py) ^ 2, k.key) AS r FROM tapped a JOIN keys k ON a.lang = k.lang AND k.key <> ';'),
kept AS (SELECT * FROM near WHERE r <= 4 QUALIFY w / sum(w) OVER (PARTITION BY lang, word, key) >= 0.05)"""
_choose = lambda options, u: f"({options})[floor({u} * len({options}))::INT + 1]"
_base = lambda x: f"translate({sql_lower(x)}, 'áéíóúüñàèìòùâêîôûäïöåάέήίόύώϊϋΐΰ', 'aeiouunaeiouaeiouaioaαεηιουωιυιυ')"


def _sub(pairs: list[tuple[str, str]], n: int, first: bool) -> str:
    """A substitution of one of the pairs that stand in k; null if none does."""
    options = "list_filter([" + ", ".join(f"{{'a': '{a}', 'b': '{b}'}}" for a, b in pairs) + "], lambda o: contains(k, o.a))"
    places = "list_filter(range(1, length(k) + 1), lambda i: substr(k, i, length(o1.a)) = o1.a)"
    where = f"({places})[1]" if first else _choose(places, f"v{n}")
    return f"(SELECT CASE WHEN o1 IS NULL THEN NULL ELSE left(k, w1 - 1) || o1.b || substr(k, w1 + length(o1.a)) END FROM (SELECT o1, {where} AS w1 FROM (SELECT {_choose(options, f'u{n}')} AS o1)))"


def _typed(words: str, *key: str) -> str:
    """The stages, taps and partial words of the rows of words, as tables up to typed (keys_typed)."""
    d = lambda salt: draw_sql(1, salt, *key)
    draws = ", ".join(f"{d(f'stage{n}')} AS r{n}, {d(f'stage{n}-u')} AS u{n}, {d(f'stage{n}-v')} AS v{n}" for n in (0, 1))
    one_q = f"(SELECT CASE WHEN w1 IS NOT NULL THEN left(k, w1 - 1) || {_choose("['ç', 'c']", 'v0')} || substr(k, w1 + 1) END FROM (SELECT {_choose("list_filter(range(1, length(k) + 1), lambda i: substr(k, i, 1) = 'q')", 'u0')} AS w1))"
    ends = " ".join(f"WHEN ends_with(k, '{e}') THEN left(k, length(k) - {len(e)}) || {_choose(str(o), 'u1')}" for e, o in (("ου", ["ος", "ο"]), ("ος", ["ου", "ο"]), ("ο", ["ος", "ου"]), ("ης", ["η"]), ("η", ["ης"])))
    return f"""near AS (SELECT lang, key, list(near ORDER BY rank) AS n FROM (SELECT a.lang, a.key, b.key AS near, row_number() OVER (PARTITION BY a.lang, a.key ORDER BY round((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2, 6), b.key) AS rank FROM keys a JOIN keys b ON a.lang = b.lang AND a.key <> b.key WHERE a.key <> ';' AND b.key <> ';') WHERE rank <= 4 GROUP BY lang, key),
drawn AS (SELECT *, {_base("word")} AS k, {draws}, {d("tap")} AS r, {d("where")} AS wh, {d("which")} AS wi, {d("partial")} AS pa, {d("partial-at")} AS pt FROM {words}),
first AS (SELECT * REPLACE (CASE WHEN lang = 'sq' AND r0 < 0.3 THEN CASE WHEN regexp_matches(k, '[ëç]') THEN translate(k, 'ëç', 'ec') ELSE coalesce({one_q}, k) END WHEN lang = 'sq' AND r0 < 0.4 THEN coalesce({one_q}, k)
    WHEN lang = 'sq' AND r0 < 0.5 AND length(k) >= 3 AND regexp_matches(k, '[ëe]$') THEN left(k, length(k) - 1) WHEN lang = 'el' AND r0 < 0.3 AND ends_with(k, 'ς') THEN left(k, length(k) - 1) || 'σ' ELSE k END AS k) FROM drawn),
second AS (SELECT * REPLACE (CASE WHEN lang = 'sq' AND r1 < 0.2 THEN coalesce({_sub([("sh", "s"), ("rr", "r"), ("dh", "d")], 1, False)}, k) WHEN lang = 'el' AND r1 < 0.25 THEN coalesce({_sub([("ει", "ι"), ("αι", "ε"), ("οι", "ι")], 1, True)}, k)
    WHEN lang = 'el' AND r1 < 0.35 THEN CASE {ends} ELSE k END ELSE k END AS k) FROM first),
spots AS (SELECT s.*, length(k) AS n, floor(wh * length(k))::INT AS i, floor(wh * (length(k) - 1))::INT AS s, substr(k, floor(wh * length(k))::INT + 1, 1) AS here FROM second s),
added AS (SELECT s.*, coalesce(near.n, [here]) AS options FROM spots s LEFT JOIN near ON near.lang = s.lang AND near.key = s.here),
hit AS (SELECT * REPLACE (CASE WHEN n > 3 AND r < 0.08 THEN left(k, s + 1) || substr(k, s + 3) WHEN n > 2 AND r < 0.14 THEN left(k, i + 1) || {_choose("options", "wi")} || substr(k, i + 2)
    WHEN n > 3 AND r < 0.19 THEN left(k, s) || substr(k, s + 2, 1) || substr(k, s + 1, 1) || substr(k, s + 3) WHEN n > 2 AND r < 0.22 THEN left(k, i + 1) || here || substr(k, i + 2) ELSE k END AS k) FROM added),
cut AS (SELECT * REPLACE (CASE WHEN length(k) > 2 AND pa < 0.35 THEN left(k, floor(pt * (length(k) - 1))::INT + 1) ELSE k END AS k) FROM hit),
known AS (SELECT lang, list(key) AS known FROM keys WHERE key <> ';' GROUP BY lang),
typed AS (SELECT c.*, CASE WHEN known IS NULL THEN k ELSE array_to_string(list_filter(string_split(k, ''), lambda x: list_contains(known, x)), '') END AS keys_typed FROM cut c LEFT JOIN known USING (lang))"""


_DISTINCT = rf"words AS (SELECT DISTINCT lang, {sql_lower('word')} AS word FROM (SELECT lang, unnest(regexp_extract_all(output, '\p{{L}}{{2,24}}')) AS word FROM pairs WHERE output IS NOT NULL AND lang IS NOT NULL))"
_SIZE = "CASE WHEN size >= 1048576000 THEN printf('%.1f GB', size / 1073741824.0) WHEN size >= 10485760 THEN printf('%d MB', size // 1048576) ELSE printf('%.1f MB', size / 1048576.0) END"
ORACLE = {
    "typing_noise": f"WITH {_KEYS}, {_DISTINCT}, {_typed('words', 'lang', 'word')} SELECT lang, word, keys_typed FROM typed",
    "typing_conditions": f"""WITH {_KEYS}, {_DISTINCT}, tries AS (SELECT *, unnest(range(20)) AS try FROM words), {_typed("tries", "lang", "word", "try")},
        judged AS (SELECT lang, word, try, keys_typed, length(keys_typed) >= length({_base("word")}) - 1 AND keys_typed <> {_base("word")} AS good FROM typed),
        best AS (SELECT lang, word, coalesce(first(keys_typed ORDER BY try) FILTER (WHERE good), last(keys_typed ORDER BY try)) AS keys_typed FROM judged GROUP BY lang, word),
        each AS (SELECT lang, word, unnest([{{'c': 'clean', 'k': {_base("word")}, 's': 0.15}}, {{'c': 'typos', 'k': keys_typed, 's': 0.35}}, {{'c': 'partial', 'k': left({_base("word")}, greatest(1, round_even(length({_base("word")}) * 0.6, 0))::INT), 's': 0.15}}], recursive := true) FROM best),
        kept AS (SELECT e.lang, word, c, s, CASE WHEN known IS NULL THEN k ELSE array_to_string(list_filter(string_split(k, ''), lambda x: list_contains(known, x)), '') END AS k FROM each e LEFT JOIN known ON known.lang = e.lang)
        SELECT lang, word, c AS condition, k AS keys, s::DOUBLE AS sigma FROM kept WHERE k <> ''""",
    "sizes_shown": f"SELECT DISTINCT size, {_SIZE} AS size_text FROM (SELECT unnest([n_chars, n_chars * 1000, n_chars * 1000000, 10485759, 10485760, 11220000, 52000000, 1048575999, 1048576000]) AS size FROM documents) WHERE size IS NOT NULL",
    "tap_mix": f"""WITH {_TAPPED} SELECT lang, word, key, near, round(w / sum(w) OVER (PARTITION BY lang, word, key), 6) AS weight FROM kept
        UNION ALL SELECT lang, word, key, key, 1.0 FROM taps WHERE lang NOT IN (SELECT lang FROM keys)""",
    "nearest_keys": f"WITH {_KEYS}, l AS (SELECT * FROM keys WHERE key <> ';'), d AS (SELECT a.lang, a.key, b.key AS near, round((a.x - b.x) ^ 2 + (a.y - b.y) ^ 2, 6)::DOUBLE AS d2 FROM l a JOIN l b ON a.lang = b.lang AND a.key <> b.key) SELECT * FROM (SELECT lang, key, near, row_number() OVER (PARTITION BY lang, key ORDER BY d2, near) AS rank, d2 FROM d) WHERE rank <= 4",
    "layout_offsets": "WITH r(lang, row, k) AS (VALUES " + ", ".join(f"('{lang}', {r}, '{line}')" for lang, lines in Y.LAYOUTS.items() for r, (line, _) in enumerate(lines)) + ") SELECT lang, row, ((max(length(k)) OVER (PARTITION BY lang) - length(k)) / 2)::DOUBLE AS \"offset\" FROM r",
    "locales": f"WITH {_LANGS} SELECT lang, language, region, concat_ws('-', language, region) AS tag FROM tags",
    "adapter_priority": f"""WITH {_LANGS}, have(h, l) AS (VALUES ('es-MX', 'es'), ('es', 'es'), ('el', 'el'), ('sq-AL', 'sq')), r AS (SELECT lang AS tag, h, CASE WHEN region IS NOT NULL AND h = language || '-' || region THEN 1 WHEN lang LIKE 'es%' AND h = language || '-MX' THEN 2 WHEN h = language THEN 3 ELSE 4 END AS r FROM tags JOIN have ON l = language)
        SELECT t.lang AS tag, (SELECT first(h ORDER BY r.r, h) FROM r WHERE r.tag = t.lang) AS found FROM tags t""",
    "catalog_resolve": f"""WITH {_LANGS}, e(id, locale, variant, size) AS (VALUES ('voice-el', 'el', 'base', 4000000::BIGINT), ('lm-sq', 'sq', '', 35000000::BIGINT), ('adapter-es-MX', 'es-MX', '', 9500000::BIGINT), ('adapter-es', 'es', '', 9000000::BIGINT))
        SELECT lang AS tag, id, variant, {_SIZE} AS size_text FROM tags JOIN e ON locale = language OR locale = concat_ws('-', language, region)""",
    "catalog_status": """WITH e(id, variant, version) AS (VALUES ('voice-el', 'base', 2), ('lm-sq', '', 1), ('adapter-es-MX', '', 3), ('adapter-es', '', 1)),
        h AS (SELECT p[1] AS id, p[2]::INT AS version, coalesce(p[3], '') AS variant FROM (SELECT string_split(value, '@') AS p FROM (VALUES ('voice-el@1@small'), ('lm-sq@1'), ('adapter-es@0@')) v(value)))
        SELECT id, e.variant, e.version, CASE WHEN h.version IS NULL THEN 'missing' WHEN h.variant <> e.variant THEN 'other variant' WHEN h.version < e.version THEN 'update' ELSE 'current' END AS state FROM e LEFT JOIN h USING (id)""",
}
