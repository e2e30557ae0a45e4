import pytest

from textmill.llm import lookalikes as L
from textmill.llm.scripts import ordinary

ODD = {
    "\U0001d41b\U0001d428\U0001d425\U0001d41d": "bold",
    "ｏｋ go": "ok go",
    "Mбr": None,  # no look-alike of б: stays
    "Мbrëmë shofеr": "Mbrëmë shofer",
    "στης µάvας": "στης μάνας",
    "oﬀ now": "off now",
    "a b": "a b",
    "cáble": "cáble",
    "​word": "word",
    "so­ft": "soft",
    "Kelvin": "Kelvin",
    "άλλα": "άλλα",
}
PLAIN = ["plain text", "wifi και tokenizer", "Привет naïve", "“quotes” — … • ½ 1.º €", "\U0001f9d1‍\U0001f373 ❤️", "tab\tand\nline", "5 \u00b5m x\u00b2 \u2460 H\u2082O"]


@pytest.mark.parametrize(("text", "want"), [(k, v) for k, v in ODD.items() if v])
def test_ordinary(text, want):
    assert ordinary(text) == want
    assert any(certain for *_, certain in L.odd_values(text))


@pytest.mark.parametrize("text", PLAIN)
def test_plain_stays(text):
    assert ordinary(text) == text
    assert not [v for v in L.odd_values(text) if v[2]]


@pytest.mark.parametrize(("text", "want"), [("pɑper is", "paper is"), ("a wօrd!", "a word!"), ("το κɑλό κɩ", "το καλό κι"), ("ᴄow ꜱad", "cow sad")])
def test_stand_ins_of_no_script(text, want):
    test_ordinary(text, want)


def test_own_letters_stay():
    for text in ("the /ɪŋɡlɪʃ/ word", "հաց is", "Yıldız went"):
        test_plain_stays(text)
    assert ("mıx", "mix", False) in list(L.odd_values("a mıx"))


CLIP, PAIR = "clip_id bigint, text string, value string, form string", "pair_id bigint, input string, n int"
NORMAL = "το παιδί και ο γερο"


def test_records(spark, rows):
    clips = [(k, NORMAL, "x", "y") for k in range(5)] + [(10, NORMAL.replace("ο γ", "o γ"), "x", "y"), (11, None, "x", "y"), (12, "", "x", "y"), (13, "a b c", "x", "y"), (13, "a b c", "x", "y"), (14, "pin το παιδί και", "x", "y")]
    pairs = [(1, "ｏｋ " * 30_000, 1), (2, "fine", 1), (3, None, 1)]
    texts = L.texts(spark.createDataFrame(clips, CLIP), spark.createDataFrame(pairs, PAIR))
    assert rows(L.records(texts)) == [("pairs", 1), ("train_cv", 10), ("train_cv", 13)]
    out = {(r["tbl"], r["rec_id"]): r["text"] for r in L.consistent(texts).collect()}
    assert out["train_cv", 10] == NORMAL and out["train_cv", 13] == "a b c" and out["pairs", 1] == "ok " * 30_000


def test_letter_case_and_signs(spark, rows):
    texts = lambda *xs: L.texts(spark.createDataFrame([(k, x, "x", "y") for k, x in enumerate(xs)], CLIP), spark.createDataFrame([], PAIR))
    upper = "το παιδί και ΚΑΤΟ".replace("ΚΑΤΟ", "KATO")  # a whole word of Latin letters
    found = texts("κατο παιδί", "Κατο παιδί", upper)
    assert rows(L.records(found)) == [("train_cv", 2)]
    assert [r["text"] for r in L.consistent(found).collect()] == ["το παιδί και ΚΑΤΟ"]
    signs = texts("(саfe!) and so on", "cafe")
    values = L.canonical_values(signs, signs.mapInPandas(L._odd(L.confusables(spark)), "tbl string, rec_id bigint, value string, form string, certain boolean"))
    assert rows(values, "value", "canonical") == [("(саfe!)", "(cafe!)")]


def test_empty(spark, rows):
    assert rows(L.records(L.texts(spark.createDataFrame([], CLIP), spark.createDataFrame([], PAIR)))) == []


def test_look_alikes_of_all_scripts(spark):
    more = L.confusables(spark)
    found = {t: [(v, f) for v, f, certain in L.odd_values(t, more) if certain] for t in ("Привeт, как дела", "Ꭺpple pie", "ⲟne more", "коd", "שלום hello 日本語", "abcдef", "ქართული and ʻOkina", "ﷺ ok")}
    assert found.pop("Привeт, как дела") == [("Привeт,", "Привет,")] and found.pop("Ꭺpple pie") == [("Ꭺpple", "Apple")] and found.pop("ⲟne more") == [("ⲟne", "one")] and found.pop("коd") == [("коd", "коԁ")]
    assert not any(found.values())
    assert len(more.tables["C"]) > 200
    clips = spark.createDataFrame([(1, "Ꭺpple pie"), (2, "Привeт всем")], "clip_id int, text string")
    pairs = spark.createDataFrame([(1, "שלום hello"), (2, None)], "pair_id int, input string")
    assert sorted(map(tuple, L.consistent(L.texts(clips, pairs)).collect())) == [("train_cv", 1, "Apple pie"), ("train_cv", 2, "Привет всем")]
