import json

import pytest
from pyspark.sql import functions as F

from textmill.operators import catalog as K
from textmill.operators import typing as Y


def test_neighbours(spark, rows):
    keys = Y.keys(spark)
    near = [r.near for r in Y.neighbours(keys).filter("lang = 'en' AND key = 'g'").orderBy("rank").collect()]
    assert near[:2] == ["f", "h"] and len(near) == 4
    assert keys.filter("lang = 'el' AND key = ';'").count() == 1 and Y.neighbours(keys).filter("key = ';' OR near = ';'").isEmpty()
    lines = spark.createDataFrame([("x", 0, "abcdefghij"), ("x", 1, "abcdefghi"), ("x", 2, "abcdefg")], "lang string, row int, keys string")
    assert rows(Y.row_offsets(lines), "row", "offset") == [(0, 0.0), (1, 0.5), (2, 1.5)]


@pytest.mark.parametrize(
    ("rule", "word", "want"),
    [
        (Y.Rule("replace_all", 1, {"map": {"ë": "e", "ç": "c"}}), "çdoë", {"cdoe"}),
        (Y.Rule("replace_all", 1, {"map": {"ë": "e"}}), "abc", {None}),
        (Y.Rule("drop_final", 1, {"letters": "ë"}), "në", {"n"}),
        (Y.Rule("drop_final", 1, {"letters": "ë"}, 3), "në", {None}),
        (Y.Rule("final", 1, {"map": {"ς": "σ"}}), "τος", {"τοσ"}),
        (Y.Rule("replace_one", 1, {"map": {"q": ["ç", "c"]}}), "qaq", {"çaq", "caq", "qaç", "qac"}),
        (Y.Rule("substitute", 1, {"pairs": [["sh", "s"], ["rr", "r"]]}), "rrush", {"rush", "rrus"}),
        (Y.Rule("substitute", 1, {"pairs": [["a", "o"]], "occurrence": "first"}), "banana", {"bonana"}),
        (Y.Rule("substitute", 1, {"pairs": [["a", "o"]], "from": 2}), "banana", {"banona", "banano"}),
        (Y.Rule("substitute", 1, {"pairs": [["zz", "z"]], "pick": "any"}), "abc", {"abc"}),
        (Y.Rule("ending", 1, {"groups": [["os", "ou", "o"]]}), "filos", {"filou", "filo"}),
    ],
)
def test_rules(spark, rule, word, want):
    u, v = F.rand(1), F.rand(2)
    got = {r[0] for r in spark.range(60).select(F.lit(word).alias("k"), u.alias("u"), v.alias("v")).select(Y.applied(rule, F.col("k"), F.col("u"), F.col("v"))).collect()}
    assert got == want


def test_stage_falls_through(spark):
    stage = lambda through: [Y.Rule("final", 0.5, {"map": {"x": "y"}}, fallthrough=through), Y.Rule("drop_final", 0.3, {"letters": "a"})]
    at = lambda d, through: spark.range(1).select(Y.staged(F.lit("ba"), stage(through), (F.lit(d), F.lit(0.0), F.lit(0.0)))).first()[0]
    assert [at(0.1, False), at(0.1, True), at(0.6, False), at(0.9, True)] == ["ba", "b", "b", "ba"]


def test_typed(spark):
    words = spark.createDataFrame([("en", w, k) for k, w in enumerate(["a", "ab", "abc", "abcd", "naïve", "keyboard"] * 200)], "lang string, word string, word_id int")
    out = Y.typed(words, Y.keys(spark), {}, Y.Taps(partial=0.0)).collect()
    assert all(r.keys_typed == r.word for r in out if len(r.word) < 3)
    same = [r for r in out if r.word == "keyboard" and r.keys_typed == "keyboard"]
    assert 130 < len(same) < 180
    assert {abs(len(r.keys_typed) - len(r.word)) for r in out} == {0, 1}
    assert all(r.keys_typed[0] == r.word[0] or r.keys_typed[1] == r.word[0] for r in out)
    assert any(r.keys_typed == "naive" for r in out)
    short = Y.typed(words, Y.keys(spark), {}, Y.Taps(0, 0, 0, 0, partial=1.0)).collect()
    assert all(1 <= len(r.keys_typed) < len(r.word) for r in short if len(r.word) > 2)


def test_with_errors(spark):
    words = spark.createDataFrame([("en", w, k) for k, w in enumerate(["a", "keyboard", "letter", "word"] * 20)], "lang string, word string, word_id int")
    out = Y.with_errors(words, Y.keys(spark), {}).collect()
    assert len(out) == 80
    assert all(r.keys_typed != r.word and len(r.keys_typed) >= len(r.word) - 1 for r in out if len(r.word) > 3)
    assert {r.keys_typed for r in out if r.word == "a"} == {"a"}


def test_mixed_and_conditions(spark):
    taps = spark.createDataFrame([("en", c, k) for k, c in enumerate("qwertyasdfgh")], "lang string, key string, id int")
    out = Y.mixed(taps, Y.keys(spark), 0.15, ("id",)).groupBy("id").agg(F.sum("weight").alias("w"), F.count("*").alias("n"), F.min("weight").alias("lo")).collect()
    assert len(out) == 12 and all(abs(r.w - 1) < 1e-9 and r.n <= 4 and r.lo >= 0.05 for r in out)
    word = spark.createDataFrame([("en", "café!", "cafe")], "lang string, word string, keys_typed string").withColumn("word", F.lit("café"))
    assert [r["keys"] for r in Y.conditions(word, Y.keys(spark)).orderBy("condition").collect()] == ["cafe", "ca", "cafe"]
    odd = spark.createDataFrame([("en", "Ω5", "qΩ"), ("xx", "Ω5", "Ω5")], "lang string, word string, keys_typed string")
    got = {(r.lang, r.condition): r["keys"] for r in Y.conditions(odd, Y.keys(spark)).collect()}
    assert got == {("en", "typos"): "q", ("xx", "clean"): "ω5", ("xx", "typos"): "Ω5", ("xx", "partial"): "ω"}
    none = Y.mixed(spark.createDataFrame([("xx", "ж", 1), ("en", "ж", 2)], "lang string, key string, id int"), Y.keys(spark), 0.3, ("id",)).collect()
    assert [(r.key, r.near, r.weight) for r in none] == [("ж", "ж", 1.0)]


def entry(**over):
    base = {"id": "x", "kind": "lm", "locale": "el", "title": "t", "size": 5, "sha256": "h", "url": "https://a.example/b"}
    return {k: v for k, v in (base | over).items() if v is not None}


def variant(url, name="v"):
    return {"name": name, "size": 1, "sha256": "s", "url": url}


def test_entries(spark, rows):
    models = [entry(), entry(id="y", variants=[variant("https://a.example/a", "a"), variant("https://a.example/b", "b")]), entry(id="z", variants=[]), entry(id="w", url="http://a.example/b"), entry(id="u", size=None), entry(id="t", variants=[variant("http://x")])]
    df = spark.createDataFrame([(json.dumps({"version": 1, "models": models}),), (json.dumps({"version": 2, "models": models}),), ("{",), (None,)], "json string")
    assert rows(K.entries(df), "id", "variant", "is_default") == [("x", "", True), ("y", "a", False), ("y", "b", True), ("z", "", True)]
    tags = spark.createDataFrame([("el-GR",), ("sq",)], "tag string")
    assert rows(K.for_locale(K.entries(df).filter("is_default"), tags, ("lm",)), "tag", "id") == [("el-GR", "x"), ("el-GR", "y"), ("el-GR", "z")]


def test_status_and_dialects(spark, rows):
    found = spark.createDataFrame([("a", "", 2, 10), ("b", "v", 1, 20), ("c", "", 1, 30)], "id string, variant string, version int, size int")
    have = K.installed(spark.createDataFrame([("1", "a@1"), ("2", "b@1@w")], "slot string, value string"))
    states = K.status(found, have)
    assert rows(states, "id", "state") == [("a", "update"), ("b", "other variant"), ("c", "missing")]
    assert rows(K.bytes_needed(states)) == [("a", 10), ("b", 0), ("c", 30)]
    tags = lambda *t: spark.createDataFrame([(x,) for x in t], "tag string")
    wanted = spark.createDataFrame([("es-MX", None), ("es-AR", "MX"), ("es", None), ("el", None)], "tag string, chosen string")
    assert rows(K.best_dialect(wanted, tags("es", "es-MX"))) == [("el", None), ("es", "es"), ("es-AR", "es-MX"), ("es-MX", "es-MX")]
    assert rows(K.best_dialect(wanted, tags("es-CO")), "found") == sorted([("es-CO",)] * 3 + [(None,)], key=str)
    assert spark.createDataFrame([("MIT",), ("unknown",), (None,)], "l string").select(K.unknown_licence(F.col("l"))).collect() == [(False,), (True,), (True,)]
