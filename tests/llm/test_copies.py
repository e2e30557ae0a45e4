import json

from textmill.llm import copies
from textmill.llm.letters import letters, words

CLIPS = "clip_id bigint, text string, lang string, h int, key string"
LINES = "line_id bigint, raw string, chk string"


def line(order="lang mode input output", **over):
    record = {"lang": "en", "mode": "light", "input": "um hello there", "output": "Hello there."} | over
    return json.dumps({k: record[k] for k in order.split()})


def test_letters():
    assert letters("Ο ΔΟΣ; «τος»") == letters("ο δος τοσ") == "οδοστοσ"
    assert letters("éa ​-_!") == "éa"
    assert letters(None) == letters(" .…") == ""
    assert words("Άλλος_ένας 3x") == ["αλλοσ", "ενασ", "3x"]


def test_copies(spark, rows):
    clips = [(5, "Hello, world", "en", 1, "x"), (2, "hello WORLD!", "en", 1, "x"), (9, "hello world", "sq", 1, "x"), (3, None, "en", 1, "x"), (4, " .", "en", 1, "x"), (6, " ", "en", 1, "x"), (7, "HELLO\tworld", "en", 1, "x")]
    lines = [(1, line()), (8, line("output input mode lang", mode=" LIGHT ", input="Um,  hello\nthere")), (3, line(output="Hello here.")), (4, "//" + line()), (5, "{"), (6, "[1]"), (7, None), (9, line(output="...")), (10, line(output="..."))]
    df = copies.both(spark.createDataFrame(clips, CLIPS), spark.createDataFrame([(*x, "c") for x in lines], LINES))
    assert rows(copies.copies(df)) == [("pair_lines", 1, 8), ("train_cv", 2, 5), ("train_cv", 2, 7)]
    assert rows(copies.groups(df), "tbl", "first_id", "n") == [("pair_lines", 1, 2), ("pair_lines", 3, 1), ("train_cv", 2, 3), ("train_cv", 9, 1)]
    assert copies.collisions(df).isEmpty()


def test_collision_keeps_records_apart(spark, rows):
    df = spark.createDataFrame([("t", bytearray(b"h"), 1, 1), ("t", bytearray(b"h"), 2, 2), ("t", bytearray(b"h"), 2, 3)], "tbl string, h binary, chk bigint, id bigint")
    assert rows(copies.copies(df)) == [("t", 2, 3)]
    assert copies.collisions(df).count() == 1


def test_empty_and_hot(spark, rows):
    empty = copies.both(spark.createDataFrame([], CLIPS), spark.createDataFrame([], LINES))
    assert rows(copies.copies(empty)) == []
    hot = spark.range(3000).selectExpr("id AS clip_id", "IF(id % 3 = 0, 'Same text', concat('text ', id)) AS text", "'en' AS lang")
    found = copies.copies(copies.both(hot, spark.createDataFrame([], LINES)))
    assert found.count() == 999 and rows(found.select("first_id").distinct()) == [(0,)]


def test_very_long(spark, rows):
    text = "ab " * 200_000
    df = copies.both(spark.createDataFrame([(1, text, "en"), (2, text.upper() + ".", "en"), (3, text + "c", "en")], "clip_id bigint, text string, lang string"), spark.createDataFrame([], LINES))
    assert rows(copies.copies(df)) == [("train_cv", 1, 2)]
