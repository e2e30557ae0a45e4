import pytest
from pyspark.sql import functions as F

from textmill.functions import locale as L
from textmill.functions import score as S
from textmill.functions import text as T
from textmill.functions.draw import draw


def one(spark, expr, **values):
    schema = ", ".join(f"{k} string" for k in values)
    return spark.createDataFrame([tuple(values.values())], schema).select(expr).first()[0]


@pytest.mark.parametrize(
    ("line", "subtitles", "want"),
    [
        ("  a  b ", False, "a b"),
        ("- <i>Hello</i> ♪ {x}", True, "Hello"),
        ("- <i>Hello</i>", False, "- <i>Hello</i>"),
        ("see https://a.example/x?y now me@b.example bye", False, "see now bye"),
        ("", False, ""),
        (None, False, None),
    ],
)
def test_cleaned(spark, line, subtitles, want):
    assert one(spark, T.cleaned(F.col("t"), F.lit(subtitles)), t=line) == want


@pytest.mark.parametrize(
    ("text", "most", "want"),
    [
        ("One two. Three four! Five", 12, ["One two.", "Three four!", "Five"]),
        ("One two. Three four! Five", 300, ["One two. Three four! Five"]),
        ("Aa. Bb. Cc.", 6, ["Aa. Bb.", "Cc."]),  # 3 + 3 fits: the joining blank isn't counted
        ("Aa. Bb. Cc.", 5, ["Aa.", "Bb.", "Cc."]),
        ("no end", 3, ["no end"]),
        ("A. b. C", 1, ["A. b.", "C"]),
        ('Yes. "No." «Ναι.» (x.)', 5, ["Yes.", '"No." «Ναι.» (x.)']),  # a quote after the stop is no end
    ],
)
def test_packed(spark, text, most, want):
    assert one(spark, T.packed(T.sentences(F.col("t"), starts=r"\p{Lu}"), most), t=text) == want


@pytest.mark.parametrize(("text", "want"), [("«hello there", "«Hello there."), ("ok!", "Ok!"), ("123", "123."), ("éa)", "Éa)"), ("", ".")])
def test_tidied(spark, text, want):
    assert one(spark, T.tidied(F.col("t")), t=text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [("a b c d e", False), ("a b c d e f", True), ("w " * 60, True), ("w " * 61, False), ("a b c d e 1234", False), ("a b c d e 123", True), ("a b c d e @x", False), ("a b c d e #x", False), ("a b c d e http://x", False)],
)
def test_is_message(spark, text, want):
    assert one(spark, T.is_message(F.col("t")), t=text) is want


def test_small_ones(spark):
    assert one(spark, T.normed(F.col("t")), t="Hé, LLO!  x_1") == "hé llo x_1"
    assert one(spark, T.loosened(F.col("t")), t="Çdo Ëndërr") == "cdo enderr"
    assert one(spark, T.normed(F.col("t")), t="Cafe\u0301, O\u0323\u0302 x\u0301!") == "café ộ x"
    how = T.Scoring(form="NFKC", replace=(("ﬁ", "-"), ("ß", "ss")), strip_marks=True, loose_replace=(("x", "y"),), loose_strip_marks=False)
    assert one(spark, T.normed(F.col("t"), how), t="Ａßé ﬁx") == "asse fix" and one(spark, T.loosened(F.col("t"), how), t="Ａßé ﬁx") == "asse fiy"
    assert one(spark, T.normed(F.col("t"), T.Scoring(lower=False)), t="A b") == "A b"
    assert one(spark, T.unmarked(F.col("t")), t="Ὧν ᾷ \u05d1\u05b0 x") == "Ων α ב x" and one(spark, T.unmarked(F.col("t")), t=None) is None
    assert one(spark, T.prediction_key(F.col("t")), t="Don't!") == "dont"
    assert one(spark, T.reply_cleaned(F.col("t")), t='<think>\nx\n</think> "Hi" ') == "Hi"
    assert one(spark, T.is_runaway(F.col("t")), t="a b " * 5) is True
    assert one(spark, T.is_runaway(F.col("t")), t="a b a b a b a b") is False
    assert one(spark, T.exact_key(F.col("t")), t="Well-Known 'x'") == "wellknownx"
    assert [one(spark, T.case_shape(F.col("t")), t=w) for w in ("ABC", "A", "Abc", "abc")] == ["all", "first", "first", "none"]
    assert one(spark, T.capitalised(F.col("t")), t="ΑΒΓ") == "Αβγ"
    assert one(spark, T.joined(F.col("a"), F.col("b"), F.col("c")), a="x\ny", b=None, c="") == "x y"
    assert one(spark, T.script_share(F.col("t"), "a-z"), t="abΑΒ 12") == 0.5
    assert one(spark, T.script_share(F.col("t"), "a-z"), t="12") is None
    assert one(spark, T.has_words_of(F.col("o"), F.col("i"), ["x y", "z"]), o="a x y z", i="z b") == ["x y"]
    assert one(spark, T.count_words_of(F.col("t"), ["dam"], ["hell"]), t="damn dams hell hello") == 3
    assert one(spark, T.count_words_of(F.col("t"), [], []), t="damn") == 0


def test_composed(spark, rows):
    df = spark.createDataFrame([("éa",), ("plain",), (None,)], "t string")
    assert rows(T.composed(df, "t")) == sorted([("éa",), ("plain",), (None,)], key=str)
    assert rows(T.unaccented(df, "t", "u"), "u") == sorted([("ea",), ("plain",), (None,)], key=str)


def test_computed_keeps_columns(spark, rows):
    df = spark.createDataFrame([("a", 1)], "t string, n int")
    assert rows(T.computed(df, t=F.upper("t"), m=F.col("n") + 1), "t", "n", "m") == [("A", 1, 2)]


def test_scores(spark):
    r, h = F.col("r"), F.col("h")
    assert one(spark, S.cer(r, h), r="café", h="cafe") == 0.25
    assert one(spark, S.cer(r, h), r="", h="x") is None
    assert one(spark, S.wer(r, h), r="a b c", h="a x c d") == pytest.approx(2 / 3)
    assert one(spark, S.wer(r, h), r="a b", h="") == 1
    assert one(spark, S.similarity(r, h), r="ab", h="uvwxyz") == 0
    assert one(spark, S.similarity(r, h), r=None, h="x") == 0


def test_locale(spark):
    t = F.col("t")
    assert [one(spark, L.canonical(t), t=x) for x in ("pt_BR", "zh-Hant-TW", "es-419", "EL", "iw")] == ["pt-BR", "zh-TW", "es-419", "el", "he"]
    assert one(spark, L.region(t), t="sq") is None
    size = lambda n: one(spark, L.size_text(t.cast("long")), t=str(n))
    assert [size(x) for x in (1_500_000_000, 20_000_000, 5_000_000)] == ["1.4 GB", "19 MB", "4.8 MB"] and [size(x) for x in (11_220_000, 52_000_000, 10_485_759)] == ["10 MB", "49 MB", "10.0 MB"] and size(2**30) == "1.0 GB"
    assert [one(spark, L.chat_endpoint(t), t=x) for x in ("http://a", "http://a/v1/", "http://a/v1/chat/completions")] == ["http://a/v1/chat/completions"] * 3


def test_draw(spark):
    got = spark.range(1000).select(draw(1, "a", F.col("id")).alias("d")).agg(F.min("d"), F.max("d"), F.avg("d")).first()
    assert 0 <= got[0] and got[1] < 1 and abs(got[2] - 0.5) < 0.05
