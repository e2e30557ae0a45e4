import pytest
from pyspark.sql import functions as F

from textmill.operators import messages as M
from textmill.operators import pairs as P

PAIR = "pair_id bigint, lang string, mode string, input string, output string, source string"
RULE = "code string, fillers array<string>, corrections array<string>, light_fillers array<string>, detect string"
RULES = [("en", ["um", "uh"], ["no wait"], ["um"], r"\b(the|and)\b"), ("es", ["eh"], ["mejor dicho"], None, None)]


def pairs(spark, *given):
    return spark.createDataFrame([(k, *g, *["s"] * (5 - len(g))) for k, g in enumerate(given)], PAIR)


@pytest.mark.parametrize(
    ("input", "output", "want"),
    [("x" * 10, "x" * 2, "ok"), ("x" * 100, "x" * 19, "ratio"), ("x" * 10, "x" * 13, "ok"), ("x" * 100, "x" * 131, "ratio"), ("abc", "", "empty"), ("abc", None, "empty"), ("damn it damn", "damn it all", "ok"), ("damn it damn", "it it it it", "swears"), ("hello there you", "Sure, hello", "chatter"), ("hello there you", "hello please", "added"), ("abcdef", '<think>x</think>"abc"', "ok"), (None, "", "empty")],
)
def test_rewrites(spark, input, output, want):
    got = P.rewrites_judged(pairs(spark, ("en", "rambler", input, output)), no_add=("please",)).first()
    assert got["verdict"] == want


@pytest.mark.parametrize(
    ("mode", "input", "output", "want"),
    [("light", "x" * 10, "x" * 4, "ok"), ("light", "x" * 10, "x" * 3, "ratio"), ("light", "x" * 10, "x" * 16, "ok"), ("light", "x" * 10, "x" * 17, "ratio"), ("rambler", "x" * 100, "x" * 15, "ok"), ("rambler", "x" * 100, "x" * 151, "ratio"), ("light", "abc", '""', "empty"), ("light", "damn no wait crap", "well no wait then", "ok"), ("light", "damn and crap", "well and then", "sanitized"), ("light", None, None, "empty")],
)
def test_sane(spark, mode, input, output, want):
    assert P.outputs_judged(pairs(spark, ("en", mode, input, output))).first()["sane"] == want


def test_language_kept(spark, rows):
    df = pairs(spark, ("en", "light", "the cat", "And so"), ("en", "light", "the cat", "le chat"), ("en", "light", "theme", "chat"), ("es", "light", "a", "b"), (None, "light", "a", None))
    assert [r.kept for r in P.language_kept(df, spark.createDataFrame(RULES, RULE)).orderBy("pair_id").collect()] == [True, False, True, True, True]


def test_parsed_and_join(spark, rows):
    lines = spark.createDataFrame([(1, '{"lang":"en","input":"x"}'), (2, "{"), (3, "[1]"), (4, None), (5, '{"lang":5}')], "line_id bigint, raw string")
    assert rows(P.parsed(lines), "line_id", "lang", "input") == [(1, "en", "x"), (5, "5", None)]
    df = pairs(spark, ("en", "light", "i", "old"), ("en", "light", "i", "new"), ("en", "rambler", "i", "r"), ("en", "rambler", "only", "r"), (None, "light", "i", "x"))
    assert rows(P.light_with_rambler(df)) == [("en", "i", "new", "r")]
    assert rows(P.last_of(df.filter("lang = 'en'"), ("lang", "mode", "input"), "pair_id"), "mode", "input", "output") == [("light", "i", "new"), ("rambler", "i", "r"), ("rambler", "only", "r")]


def test_dictated(spark, rows):
    rules = spark.createDataFrame(RULES, RULE)
    df = spark.range(400).selectExpr("id AS pair_id", "'en' AS lang", "'The quick brown fox jumps over the lazy dog today.' AS output")
    out = P.dictated(df, rules).collect()
    clean = [r for r in out if r.input == r.text]
    words = "the quick brown fox jumps over the lazy dog today".split()
    assert 30 < len(clean) < 95
    for r in out:
        if r.input != r.text:
            said = iter(r.input.split())
            assert all(w in said for w in words), r.input  # every word is still there, in order
    assert any("no wait" in r.input for r in out) and any(" um " in r.input or " uh " in r.input for r in out)
    assert rows(P.dictated(df.repartition(7), rules)) == rows(P.dictated(df, rules))
    odd = spark.createDataFrame([(1, "xx", "Hi there."), (2, "en", ""), (3, "en", None), (4, None, "Hi")], "pair_id bigint, lang string, output string")
    assert rows(P.dictated(odd, rules), "pair_id", "input") == [(1, "Hi there."), (2, ""), (4, "Hi")]


def test_corrected_later(spark):
    rules = spark.createDataFrame(RULES, RULE)
    df = spark.range(100).selectExpr("id AS pair_id", "'en' AS lang", "concat('We saw nice number', id, ' thing yesterday evening.') AS output")
    out = P.corrected_later(df, rules, 30).collect()
    assert len(out) == 30
    for r in out:
        assert " no wait " in r.input or r.input.endswith("no wait")
    count = spark.range(60).selectExpr("id AS pair_id", "'en' AS lang", "'Please buy two more of these today' AS output")
    said = [r.input for r in P.corrected_later(count, rules, 60, numbers={"en": ["two", "three"]}).collect()]
    assert 15 < sum(" three " in f" {x} " for x in said) < 45 and all(x.rstrip().count("two") >= 1 for x in said)
    short = spark.createDataFrame([(1, "en", "Too short here"), (2, "xx", "no rules for this one here"), (3, "en", None)], "pair_id bigint, lang string, output string")
    assert P.corrected_later(short, rules, 5).isEmpty()


def test_held_out(spark, rows):
    given = [("en", m, f"message {k // 2}", f"target {k // 2}" if m == "light" else f"short {k // 2}") for k in range(1000) for m in (["light"] if k % 2 else ["rambler"])]
    given += [("en", "light", "another", "target 3"), ("en", "light", "message 7", "again"), ("en", "light", " ", "x"), ("en", "light", None, "x"), (None, "light", "a", "b")]
    out = P.held_out(pairs(spark, *given), least=50).cache()
    val = out.filter("part = 'val'").collect()
    keys, train = {r.input for r in val}, out.filter("part = 'train'").collect()
    assert len(val) == 50 == len(keys)
    assert not keys & {r.input for r in train}
    targets = {r.output for r in out.collect() if r.input in keys}
    assert not targets & {r.output for r in train}
    assert len({(r.lang, r.mode, r.input) for r in train}) == len(train)
    assert out.count() == 1002
    assert rows(P.held_out(pairs(spark, *given).repartition(9), least=50), "pair_id", "part") == rows(out, "pair_id", "part")


def test_messages(spark, rows):
    lines = spark.createDataFrame([("s", d, k, f"line {k} of a small talk") for d in range(40) for k in range(7)], "source string, doc_id bigint, line_no int, text string")
    out = M.joined(lines).collect()
    assert {r.text.count("line") for r in out} <= {1, 2, 3}
    for d in range(40):
        said = " ".join(r.text for r in sorted((r for r in out if r.doc_id == d), key=lambda r: r.message_no))
        assert " ".join(f"line {k} of a small talk" for k in range(7)).startswith(said)
    key = ("source", "doc_id", "line_no")
    assert M.reservoir(lines, 5, key).count() == 5 and M.reservoir(lines, 500, key).count() == 280
    some = M.stratified(lines, 20, 0.3, F.col("line_no") == 0, key)
    assert some.count() == 20 and some.filter("line_no = 0").count() == 6
    none = M.stratified(lines, 20, 0.3, F.lit(False), key)
    assert none.count() == 20
    shares = spark.createDataFrame([("s", 0.1, False), ("t", 0.0, True)], "source string, share double, always boolean")
    assert M.shared(lines.unionByName(lines.limit(3).withColumn("source", F.lit("t"))), shares, 50, key).count() == 5 + 3
    dup = lines.limit(1).unionByName(lines.limit(1)).withColumn("text", F.lit("one two three four five six"))
    assert rows(M.usable(dup), "text") == [("One two three four five six.",)]
