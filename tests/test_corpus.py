import pytest
from pyspark.sql import functions as F

from textmill.operators import corpus as C
from textmill.operators import skew

DOC = "doc_id bigint, text string, lang string, source string"
CONFIG = "source_name string, origin string, lang string, sp double, keep double, min_chars int, val boolean"
CONF = [("web", "fineweb", "en", 0.7, None, None, True), ("subs", "opensubtitles", "en", 0.3, None, 4, False)]


@pytest.fixture
def config(spark):
    return spark.createDataFrame(CONF, CONFIG)


def test_prepared(spark, rows, config):
    docs = [(1, "A first long line here.\n\n  A FIRST long line here. \nshort", None, "web"), (2, "A first long line here.", None, "subs"), (3, "Όλα ελληνικά εδώ πέρα φίλε", None, "web"), (4, None, None, "web"), (5, "A line of no source at all", None, None), (6, "", None, "web"), (7, "1234567890 1234567890", None, "web")]
    out = C.prepared(spark.createDataFrame(docs, DOC), config)
    assert rows(out, "source", "doc_id", "line_no", "text") == [("subs", 2, 0, "A first long line here."), ("web", 1, 0, "A first long line here.")]
    assert rows(C.prepared(spark.createDataFrame([], DOC), config)) == []


@pytest.mark.parametrize(("n", "kept"), [(14, 0), (15, 1), (2000, 1), (2001, 0)])
def test_length_gate(spark, config, n, kept):
    docs = spark.createDataFrame([(1, "x" * n, None, "web")], DOC)
    assert C.cleaned(C.kept(C.lines(docs), config)).count() == kept


def test_script_gate(spark, config):
    docs = spark.createDataFrame([(1, "abcdefghi abcdefghi αβ", None, "web"), (2, "abcdefghi abcdefghi αβγ", None, "web")], DOC)
    assert [r.doc_id for r in C.cleaned(C.kept(C.lines(docs), config)).collect()] == [1]


def test_dedup_is_idempotent_and_first(spark, rows):
    df = spark.createDataFrame([("a", k, 0, 0, "Same" if k % 2 else "same") for k in range(50)] + [("b", 1, 0, 0, "same"), (None, 1, 0, 0, "same")], "source string, doc_id bigint, line_no int, chunk_no int, text string")
    for n in (1, 4, 50):
        out = C.deduplicated(df.repartition(n))
        assert rows(out, "source", "doc_id") == sorted([("a", 0), ("b", 1), (None, 1)], key=str)
    assert rows(C.deduplicated(out)) == rows(out)


def test_split(spark, config):
    df = spark.range(1000).selectExpr("'web' AS source", "id AS doc_id", "0 AS line_no", "0 AS chunk_no", "true AS val", "'x' AS text")
    out = C.split(df, per=50)
    assert out.count() == 1000 and out.filter("part = 'val'").count() == 20
    assert C.split(df, most=5, per=50).filter("part = 'val'").count() == 5
    assert C.split(df.withColumn("val", F.lit(False)), per=50).filter("part = 'val'").isEmpty()
    assert C.split(df.repartition(7), per=50).filter("part = 'val'").exceptAll(out.filter("part = 'val'")).isEmpty()


def test_tokenizer_sample(spark):
    df = spark.range(1000).selectExpr("IF(id < 990, 'big', 'small') AS source", "id AS doc_id", "0 AS line_no", "0 AS chunk_no", "'x' AS text", "CAST(0.5 AS double) AS sp")
    got = {r["source"]: r["count"] for r in C.tokenizer_sample(df, 400).groupBy("source").count().collect()}
    assert got["small"] == 10 * 20 and 150 < got["big"] < 250


def test_budget_cap_offsets(spark, rows):
    df = spark.range(10).selectExpr("'a' AS source", "id AS doc_id", "0 AS line_no", "0 AS chunk_no", "'xyz' AS text", "10 AS _budget")
    assert [r[0] for r in rows(C.within_bytes(df, F.col("_budget"), batch=2), "doc_id")] == [0, 1, 2, 3]
    assert C.within_bytes(df.withColumn("_budget", F.lit(None).cast("int")), F.col("_budget")).count() == 10
    assert C.capped(df, 3).count() == 3
    placed = C.offsets(df, F.lit(3))
    assert [r[1] for r in sorted(rows(placed, "doc_id", "start"))] == [3 * k for k in range(10)]
    assert sum(r.n_tokens for r in C.sequences(placed, 8).collect()) == 30


def test_contexts(spark, rows):
    df = spark.createDataFrame([(1, 0, 0, "a b c"), (2, 0, 0, "one"), (3, 0, 0, "")], "doc_id bigint, line_no int, chunk_no int, text string")
    assert rows(C.contexts(df), "context", "word") == [("a b", "c"), ("a", "b")]
    assert rows(C.contexts(df, 1), "context", "word") == [("a", "b"), ("b", "c")]


def test_missing_letters_and_availability(spark, rows, config):
    df = spark.createDataFrame([("en", "ab C")], "lang string, text string")
    assert rows(C.missing_letters(df, {"en": "abcd"})) == [("en", "d")]
    docs = spark.createDataFrame([(1, "x", None, "web"), (2, None, None, "web")], DOC)
    assert rows(C.availability(config, docs)) == [("subs", 0), ("web", 2)]


def test_attach_splits_hot_keys(spark, rows):
    df = spark.range(5000).selectExpr("IF(id % 3 = 0, 'hot', concat('k', id)) AS k", "id").unionByName(spark.createDataFrame([(None, -1)], "k string, id bigint"))
    groups = df.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("lo"))
    out = skew.attach(df, groups, ["k"], "n", 5000)
    assert out.count() == 5000 and out.filter("k = 'hot' AND lo = 0 AND n = 1667").count() == 1667
    assert skew.attach(df, groups.filter("n > 1"), ["k"], "n", 5000, "left").count() == 5001


def test_running_sums_hold_over_ranges(spark):
    df = spark.range(3000).selectExpr("IF(id % 3 > 0, 'hot', IF(id % 2 = 0, NULL, concat('k', id % 5))) AS k", "(id * 7919) % 3000 AS o", "id % 4 AS w", "'x' AS _s")
    out = skew.running(df, ["k"], ["o"], "before", F.col("w")).collect()
    seen = {}
    for r in sorted(out, key=lambda r: r.o):
        assert r.before == seen.get(r.k, 0)
        seen[r.k] = seen.get(r.k, 0) + r.w
    assert len(out) == 3000 and set(out[0].asDict()) == {"k", "o", "w", "_s", "before"}
    assert skew.running(df.limit(0), ["k"], ["o"], "before").isEmpty()


def test_first_of_each_for_any_number(spark, monkeypatch):
    df = spark.range(500).selectExpr("id % 2 AS k", "id")
    few = skew.first_of_each(df, 7, ["k"], ["id"])
    monkeypatch.setattr(skew, "GROUP_LIMIT", 5)
    many = skew.first_of_each(df, 7, ["k"], ["id"])
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect())) == sorted((i % 2, i) for i in range(14))


def test_split_holds_its_quota_whatever_the_draws(spark, monkeypatch):
    rows = [("s", True, k, 0, 0) for k in range(400)]
    df = spark.createDataFrame(rows, "source string, val boolean, doc_id int, line_no int, chunk_no int")
    monkeypatch.setattr(C, "draw", lambda *_: F.lit(0.999))
    assert C.split(df, per=4).filter("part = 'val'").count() == 100


def test_sentences_end_by_language(spark, rows):
    texts = [("en", "One; Two. three! Four"), ("el", "Ένα; Δύο! τρία. Τέσσερα. πέντε"), ("sq", "Një; Dy. tre! Ëndërr"), ("es", "Uno; ¿Dos? Tres. ñu"), (None, "A; B. c")]
    df = spark.createDataFrame([(x, t, k) for k, (x, t) in enumerate(texts)], "lang string, text string, id int")
    got = [r.text for r in C.packed(df, C.Cleaning(group=1)).orderBy("id", "chunk_no").collect()]
    assert got == ["One; Two.", "three!", "Four", "Ένα;", "Δύο! τρία.", "Τέσσερα. πέντε", "Një; Dy. tre!", "Ëndërr", "Uno; ¿Dos?", "Tres.", "ñu", "A; B.", "c"]
