import pytest
from pyspark.sql import functions as F

from textmill.llm import defects as D

RULES = [("en", ["um", "uh", "like", "you know"], ["no wait"], ["um"], "x"), ("es", ["eh", "o sea"], ["mejor dicho"], None, "y")]
RULE = "code string, fillers array<string>, corrections array<string>, light_fillers array<string>, detect string"
PAIR = "pair_id bigint, lang string, mode string, input string, output string, defect string"
THINGS = ["the red lamp", "a small drum", "the garden hose", "an old radio", "the brass key", "a torn map"]
COSAS = ["la silla rota", "un mapa viejo", "el espejo alto", "una llave gris", "el tambor rojo", "la puerta azul"]


def clean(k):
    a, b = THINGS[k % 6], THINGS[(k // 6) % 6]
    return f"My friend Katenas{k} bought {a} near the harbour. The driver lost {b} after dinner with Domareck{k}."


def limpio(k):
    return f"Mi vecino Tolames{k} compró {COSAS[k % 6]} cerca del puerto. El conductor perdió {COSAS[(k // 6) % 6]} después de cenar con Bafadoz{k}."


def raw(text):
    return "um " + text.replace(".", "").lower().replace(" near ", " uh near ").replace(" after ", " after after ")


@pytest.fixture(scope="module")
def model(spark):
    pairs = [(k, "en", "light", raw(clean(k)), clean(k), "x") for k in range(60)] + [(100 + k, "es", "light", "eh " + limpio(k).replace(".", "").lower(), limpio(k), "x") for k in range(60)]
    return D.learn(spark.createDataFrame(pairs, PAIR), spark.createDataFrame(RULES, RULE))


@pytest.mark.parametrize(
    ("mode", "input", "output", "want"),
    [
        ("light", raw(clean(1)), clean(1), None),
        ("light", raw(clean(1)), clean(1)[:-1], None),  # a final stop alone
        ("light", raw(clean(1)), None, "empty"),
        ("light", raw(clean(1)), "<think>\n\n</think>", "empty"),
        ("rambler", raw(clean(1)), "N/A", "empty"),
        ("rambler", raw(clean(1)), "​ ", "empty"),
        ("light", raw(clean(1)), "I'm sorry, but I can't help with this request.", "refusal"),
        ("light", raw(clean(1)), "No puedo ayudar con esta solicitud", "refusal"),
        ("light", raw(clean(1)), raw(clean(1)), "copy"),
        ("light", raw(clean(1)), raw(clean(1)) + ".", "copy"),
        ("light", clean(1), clean(1), None),  # clean already
        ("light", raw(clean(1)), limpio(2), "other_language"),
        ("rambler", raw(clean(1)), "Ο γείτονας έχασε το κλειδί του χθες το βράδυ στο λιμάνι.", "other_language"),
        ("light", raw(clean(1)), clean(1).split(". ")[0] + ".", "truncated"),
        ("light", raw(clean(1)), clean(1)[:50], "truncated"),
        ("rambler", raw(clean(1)), clean(1).split(". ")[0] + ".", None),  # may shorten
        ("rambler", raw(clean(1)), "My friend Katenas1 bought the small dru", "truncated"),
        ("rambler", raw(clean(1)), "My friend Katenas1 bought the", "truncated"),
        ("rambler", raw(clean(1)), "My friend Katenas1 bought,", "truncated"),
        ("light", None, "Hello.", None),
        ("light", " ", None, "empty"),
        (None, raw(clean(1)), clean(1), None),
        ("light", raw(clean(1)).replace("a", "а"), clean(1), None),  # look-alikes in the input
    ],
)
def test_defect(model, mode, input, output, want):
    assert D.defect(model, D._Zip(), mode, input, output) == want


def test_refusals_of_any_length(model):
    long = "I'm sorry, but I can't help with this request. The message holds wording that could be harmful, and my guidelines do not allow me to rewrite such content. If you want, I can assist with another text: send me a message in respectful language and I will gladly edit it, rephrase single sentences, or help with the wording of a letter. I can also process other content for you, such as a text about travel or a request to a shop."
    assert len(D.words(long)) > 60
    for output in (long, " ".join([long] * 5)):
        assert D.defect(model, D._Zip(), "light", raw(clean(1)), output) == "refusal"
    told = limpio(1) + " Dice que no puedo ver el mensaje. " + limpio(2) + " " + limpio(3)
    assert D.defect(model, D._Zip(), "light", raw(clean(1)), told) == "other_language"


def test_long_text(model):
    text = " ".join(clean(k) for k in range(3000))
    assert D.defect(model, D._Zip(), "light", raw(text), text) is None


def test_frame(spark, rows):
    pairs = [(k, "en", "light", raw(clean(k)), clean(k), "x") for k in range(30)] + [(50, "en", "light", "um a", None, "x"), (50, "en", "light", "um a", None, "x"), (51, None, None, None, None, "x")]
    rules = spark.createDataFrame(RULES, RULE)
    assert rows(D.defects(spark.createDataFrame(pairs, PAIR), rules)) == [(50, "empty"), (50, "empty"), (51, "empty")]
    assert rows(D.defects(spark.createDataFrame([], PAIR), rules)) == []


def test_short_answers_in_an_unknown_language_and_refusals_in_others(spark):
    words_ = "the then that this other mother father there their weather thing think with without within whether together gather rather either".split()
    some = [(k, "en", "light", " ".join(words_[(k * 7 + j) % len(words_)] for j in range(8)), " ".join(words_[(k * 7 + j) % len(words_)] for j in range(8)).capitalize() + ".") for k in range(600)]
    pairs = spark.createDataFrame(some, "pair_id int, lang string, mode string, input string, output string")
    rules = spark.createDataFrame([("en", ["uh"], None, ["no wait"], "the")], "code string, fillers array<string>, light_fillers array<string>, corrections array<string>, detect string")
    model = D.learn(pairs, rules)
    assert D.defect(model, D._Zip(), "rambler", "the other weather with father", "Zxq vkwy quizj.") == "other_language"
    assert D.defect(model, D._Zip(), "rambler", "the other weather with father", "Whether father gathers.") is None
    assert D.defect(model, D._Zip(), "light", "the other weather with father", "Przepraszam, nie mogę przetworzyć tej wiadomości, proszę spróbować.") == "refusal"
    assert D.defect(model, D._Zip(), "light", "the other weather with father", "Я не могу переписать это сообщение.") == "refusal"
    with pytest.raises(ValueError, match="rules"):
        D.learn(pairs, spark.range(D.MOST_RULES + 1).selectExpr("array('a') AS fillers", "array('b') AS light_fillers", "array('c') AS corrections"))


def test_long_markup_is_nothing_and_a_long_end_may_be_missing():
    model = D.Model()
    assert D.defect(model, D._Zip(), "light", "hello there", "<p " + "class " * 200 + ">") == "empty"
    said = "we met at the market and bought fresh bread before walking home along that narrow river path near grandma"
    assert D.defect(model, D._Zip(), "light", said, "We met at the market and bought fresh bread.") == "truncated"
    assert D.defect(model, D._Zip(), "light", said, said.capitalize() + ".") is None


def test_words_and_ends_are_counted_over_all_rows(spark, rows):
    """30,000 pairs in one language; what the six of another hold, whose ids a sample by hash leaves out, must count."""
    late = [r[0] for r in spark.range(30_000).filter("pmod(xxhash64(id), 1000000) > 990000").orderBy("id").limit(6).collect()]
    said = "um the river and the hill are near the town"
    many = spark.range(30_000).filter(~F.col("id").isin(late)).selectExpr("id AS pair_id", "'en' AS lang", "'light' AS mode", f"'{said}' AS input", "'The river and the hill are near the town.' AS output")
    few = [(k, "sq", "light", "um lumi dhe kodra afer qytetit sot harbour", "Lumi dhe kodra afer qytetit sot harbour.") for k in late]
    odd = [(-1, "en", "rambler", said, "The river and the lumi dhe kodra afer qytetit sot."), (-2, "en", "rambler", said, "The river and the hill harbour"), (-3, "en", "rambler", said, "The river and the hill are")]
    pairs = many.unionByName(spark.createDataFrame(few + odd, "pair_id bigint, lang string, mode string, input string, output string"))
    assert rows(D.defects(pairs, spark.createDataFrame(RULES, RULE))) == [(-1, "other_language"), (-3, "truncated")]


def test_tables_tell_what_the_model_in_memory_tells(spark, rows):
    outputs = [clean(1), clean(1)[:-1], limpio(2), limpio(2)[:-1], raw(clean(1)), clean(1)[:50], "My friend Katenas1 bought the", "My friend Katenas1 met Domareck1", "", None, "«»", "Ο γείτονας έχασε το κλειδί."]
    odd = [(1000 + k // 2, "en", "rambler" if k % 2 else "light", raw(clean(1)), x, "x") for k, x in enumerate([x for x in outputs for _ in range(2)])]
    some = [(k, "en", "light", raw(clean(k)), clean(k), "x") for k in range(60)] + [(100 + k, "es", "light", "eh " + limpio(k).replace(".", "").lower(), limpio(k), "x") for k in range(60)]
    pairs, rules = spark.createDataFrame(some + odd + odd, PAIR), spark.createDataFrame(RULES, RULE)
    model = D.learn(pairs, rules)
    assert model.language and model.ends
    assert rows(D.defects(pairs, rules)) == sorted([(k, d) for k, _, m, a, b, _ in some + odd + odd if (d := D.defect(model, D._Zip(), m, a, b))], key=str)


def test_counts_are_the_same_however_often_a_task_hands_them_on(spark, rows):
    pairs = spark.createDataFrame([(k, "en" if k % 3 else None, "light", raw(clean(k)), clean(k), "x") for k in range(40)], PAIR)
    counts = rows(D._counted(pairs, [("um",), ("no", "wait")]))
    assert counts == rows(D._counted(pairs.repartition(7), [("um",), ("no", "wait")], most=3))
    assert ("clean", "", "", 40, 0) in counts
    assert ("word", "friend", "en", 26, 0) in counts
    assert ("end", "friend", "my", 0, 40) in counts
    assert sum(c[3] for c in counts if c[0] == "end") == 40
