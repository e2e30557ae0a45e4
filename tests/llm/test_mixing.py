from textmill.llm import mixing as M

DOC = "doc_id bigint, text string, source string, times int, target string"
CONFIG = "source_name string, mix double, max_repeat int, source int"


def test_water_fill():
    sizes, weights, caps = {"a": 100, "b": 10, "c": 50}, {"a": 0.5, "b": 0.3, "c": 0.2, "d": 0.4, "e": 0.0}, {"a": 2, "b": 2, "c": 2, "d": 5, "e": 1}
    got = M.water_fill(sizes, weights, caps, 160)
    assert got["b"] == 20 and got["d"] == got["e"] == 0
    assert abs(sum(got.values()) - 160) < 1e-9 and abs(got["a"] / got["c"] - 2.5) < 1e-9
    assert M.water_fill(sizes, weights, caps, 10_000) == {"a": 200, "b": 20, "c": 100, "d": 0, "e": 0}
    assert M.water_fill({}, {}, {}) == {}
    assert sum(M.water_fill(sizes, weights, caps).values()) == 160


def test_mixed(spark, rows):
    docs = [(k, "one two three", "big" if k % 3 else "mid", 1, "x") for k in range(3000)] + [(9000 + k, "one two three", "tiny", 1, "x") for k in range(20)] + [(1, None, "big", 1, "x"), (2, "", "big", 1, "x"), (3, "one", None, 1, "x"), (4, "one", "other", 1, "x")]
    config = spark.createDataFrame([("big", 0.2, 3, 1), ("mid", 0.5, None, 1), ("tiny", 0.2, 4, 1), ("gone", 0.1, 9, 1), ("zero", None, 1, 1), (None, 1.0, 1, 1)], CONFIG)
    mix = M.mixed(spark.createDataFrame(docs, DOC), config).cache()
    got = {r.source_name: r for r in M.shares(mix, config).collect()}
    assert set(got) == {"big", "mid", "tiny", "gone"}
    assert got["tiny"].epochs == 4 and got["tiny"].capped and got["mid"].epochs == 1 and got["gone"].n_tokens == 0
    total = sum(r.n_tokens for r in got.values())
    assert abs(total - 3020 * 3) <= 3 and abs(sum(r.reached for r in got.values()) - 1) < 1e-9
    assert rows(M.mixed(spark.createDataFrame(docs, DOC), config).select("doc_id", "copies")) == rows(mix.select("doc_id", "copies"))
    assert M.mixed(spark.createDataFrame(docs, DOC), config, total=100).groupBy().sum("copies").first()[0] <= 40


def test_empty(spark, rows):
    config = spark.createDataFrame([("a", 1.0, 1, 1)], CONFIG)
    assert rows(M.mixed(spark.createDataFrame([], DOC), config)) == []
    assert M.shares(M.mixed(spark.createDataFrame([], DOC), config), config).count() == 1
    assert rows(M.mixed(spark.createDataFrame([(1, "a b", "a", 1, "x")], DOC), config.limit(0))) == []
