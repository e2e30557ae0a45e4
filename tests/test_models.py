from pyspark.sql import functions as F

from textmill.operators import models as O


def test_names(spark, rows):
    names = O.language_names(spark)
    assert names.count() > 100
    df = spark.createDataFrame([("el_GR",), ("iw",), ("SQ",), ("xx",), (None,)], "lang string")
    assert rows(O.named(df, names)) == sorted([("el_GR", "Greek"), ("iw", "Hebrew"), ("SQ", "Albanian"), ("xx", "xx"), (None, None)], key=str)


def test_text(spark):
    one = lambda t, c: spark.createDataFrame([(t,)], "t string").select(c).first()[0]
    assert one("„a“ … b", O.transcripts_cleaned(F.col("t"), [("[„“]", '"'), ("…", "...")])) == '"a" ... b'
    assert one("Two cats, two dogs and three", O.words_among(F.col("t"), ["three", "two"])) == ["two", "three"]
    data = spark.createDataFrame([(bytearray("é".encode() + b"\xff\xc3" + b"x"),), (bytearray(b""),), (None,)], "b binary")
    assert [r[0] for r in data.select(O.decoded(F.col("b"))).collect()] == ["éx", "", None]


def test_vocabulary(spark, rows):
    token = lambda *t: spark.createDataFrame(list(t), "token string, id int")
    aliases = spark.createDataFrame([("</s>", "<end>"), ("gone", "nowhere")], "token string, alias string")
    got = O.vocabulary_mapped(token(("a", 1), ("</s>", 2), ("gone", 3)), token(("a", 10), ("<end>", 20)), aliases, -1)
    assert rows(got) == [("</s>", 2, 20), ("a", 1, 10), ("gone", 3, -1)]


def test_batches_models_guesses(spark, rows):
    df = spark.createDataFrame([("s", k, None if k == 3 else float(k % 4)) for k in range(8)], "src string, id int, dur double")
    got = rows(O.by_length(df, "dur", 3, "src", "id"), "batch", "id")
    assert got[:3] == [(0, 0), (0, 3), (0, 4)] and got[-1][0] == 2
    assert O.each_model(df, ["a", "b"]).count() == 16
    files = spark.createDataFrame([("b", "a", "m"), (None, "a", "m"), ("b", None, None)], "base string, adapter string, merged string")
    assert [r[0] for r in files.select(O.file_choice(F.col("base"), F.col("adapter"), F.col("merged"))).collect()] == ["b+a", "m", None]
    beams = spark.createDataFrame([("q", "A", 0.5), ("q", "a", 0.9), ("q", "b", 0.7), ("q", "", 1.0), ("q", "c", 0.1)], "q string, w string, s double")
    assert rows(O.ranked_guesses(beams, ("q",), F.lower("w"), "s", 2)) == [("q", "a", 1), ("q", "b", 2)]
