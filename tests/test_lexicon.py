import pytest
from pyspark.sql import functions as F

from textmill.operators import lexicon as L

COUNT = "lang string, form string, n double"


def cased(spark, rows, forms, **how):
    df = spark.createDataFrame([("xx", f, float(n)) for f, n in forms], COUNT)
    return {(w, n) for _, w, n in rows(L.cased(df, L.Lexicon(**how)))}


@pytest.mark.parametrize(
    ("forms", "want"),
    [
        ([("Rome", 90), ("rome", 10)], {("Rome", 100.0)}),
        ([("Rome", 89), ("rome", 11)], {("rome", 100.0)}),
        ([("ROME", 5), ("Rome", 5)], {("Rome", 10.0)}),  # a tie: by code points ROME is first, then written as Rome
        ([("NATO", 9)], {("Nato", 9.0)}),
        ([("A", 9)], {("a", 9.0)}),
        ([("x", 1)], {("x", 1.0)}),
    ],
)
def test_cased(spark, rows, forms, want):
    assert cased(spark, rows, forms) == want


def test_skips(spark, rows):
    assert cased(spark, rows, [("NATO", 9), ("at", 2)], all_caps="skip", skip="^a") == set()


def test_counts(spark, rows):
    df = spark.createDataFrame([("en", "Don't go, go 2x x_y café", 2.0), ("en", None, 1.0)], "lang string, text string, b double")
    assert rows(L.counts(df, F.col("b")), "form", "n") == [("Don't", 2.0), ("café", 2.0), ("go", 4.0)]


def test_rated(spark, rows):
    words = [("common", 1000.0), ("Rare", 10.0), ("once", 1.0), ("z", 50.0), ("a", 50.0), ("core", 1.0), ("x" * 31, 99.0)]
    how = L.Lexicon(least=5, least_capitalised=20, singles="a", core=("core",), min_f=100, max_f=250)
    out = dict((w, f) for _, w, f in rows(L.rated(spark.createDataFrame([("xx", *w) for w in words], "lang string, word string, n double"), how)))
    assert set(out) == {"common", "a", "core"} and out["common"] == 250 and out["core"] >= 150


def test_core_and_extra(spark, rows):
    words = spark.createDataFrame([("xx", "old", 3.0)], "lang string, word string, n double")
    assert rows(L.with_core(words, L.Lexicon(core=("new", "old")))) == [("xx", "new", 1.0), ("xx", "old", 3.0)]
    base = spark.createDataFrame([("xx", "Old", 200)], "lang string, word string, f int")
    lines = spark.createDataFrame([(" word=old,f=9",), ("word=New,f=150,x=1",), (" word=new,f=20",), ("word=q,f=3",), ("junk",)], "value string")
    extra = L.extra_list(lines).withColumn("lang", F.lit("xx"))
    assert rows(L.with_extra(base, extra)) == [("xx", "New", 100), ("xx", "Old", 200)]


@pytest.mark.parametrize(("word", "want"), [("badly", True), ("Badly", False), ("Capbad", True), ("badge", False), ("bád", False), ("it’s", True), ("fine", False)])
def test_offensive(spark, word, want):
    lists = L.Offensive(stems=("bad", "capb"), exact=("it's",), not_stems=("badg",), capitalised=("capb",))
    assert spark.createDataFrame([(word,)], "w string").select(L.offensive(F.col("w"), lists)).first()[0] is want


def test_combined(spark, rows):
    df = spark.createDataFrame([("xx", "a", 9, False), ("xx", "b", 8, True)], "lang string, word string, f int, possibly_offensive boolean")
    assert rows(L.combined(df), "line") == [(" word=a,f=9",), (" word=b,f=8,possibly_offensive=true",)]
    assert L.header("pt_BR", "x", 2, 5) == "dictionary=main:pt_br,locale=pt_BR,description=x,date=5,version=2"


def test_empty(spark, rows):
    docs = spark.createDataFrame([], "lang string, text string")
    assert rows(L.built(docs, F.lit(1.0), L.Lexicon(), L.Offensive())) == []
