import random
import tracemalloc

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from textmill.llm import splits

CLIP = "clip_id bigint, speaker string, split string, bin int, comp string"
PAIR = "pair_id bigint, lang string, input string, split string, weight int"
PLAN = "split_name string, share double"


def test_speaker_key(spark):
    given_ = [" ABCDEF0123456789xyz ", "abcdef0123456789", "n/a", "Unknown", "-", "", "  ", None, "(none)", "anonymous", "a", " n/a​"]
    df = spark.createDataFrame([(g,) for g in given_], "s string").select(splits.speaker_key("s"))
    assert [r[0] for r in df.collect()] == ["abcdef0123456789"] * 2 + [None] * 8 + ["a", None]


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), min_size=1, max_size=12))
def test_balance_holds_every_component(histogram):
    split, left, rounds = splits.balance(histogram, {"train": 0.9, "val": 0.05, "test": 0.05}, bins=20)
    sums = np.zeros(20)
    for w, n in histogram.items():
        assert rounds[w] * 20 + len(left.get(w, ())) == n
        sums += w * rounds[w]
    for w, bs in left.items():
        np.add.at(sums, bs, w)
    assert sums.sum() == sum(w * n for w, n in histogram.items())
    assert set(split) == set(range(20))


def test_differencing_is_even():
    where, sums = splits._kk([(w, 1) for w in (8, 7, 6, 5, 4)], 2)
    assert abs(int(sums[0]) - int(sums[1])) <= 2 and len(where) == 5
    _, sums = splits._kk([(3, 9), (1, 3)], 10)
    assert sorted(sums.tolist()) == [3] * 10
    assert splits._kk([], 3)[1].tolist() == [0, 0, 0]


def test_a_million_left_over_components_need_little_memory():
    tracemalloc.start()
    split, left, _ = splits.balance({w: 399 for w in range(1, 2601)}, {"train": 0.9, "val": 0.1})
    assert sum(map(len, left.values())) > 1_000_000 and len(split) == 400
    assert tracemalloc.get_traced_memory()[1] < 500_000_000
    tracemalloc.stop()


def frames(spark):
    train = [(i, "hot" if i % 3 == 0 else f"s{i % 50}", "train", 0, "x") for i in range(900)] + [(900, None, "train", 0, "x"), (901, "n/a", "train", 0, "x")]
    held = [(1000 + i, "HOT " if i < 2 else f"e{i}", "dev", 0, "x") for i in range(20)] + [(1100, "n/a", "test", 0, "x"), (1101, None, "dev", 0, "x")]
    pairs = [(1, "en", "Hi there you", "train", 1), (2, "en", "hi, there YOU!", "val", 1), (3, "sq", "hi there you", "val", 1), (4, "en", None, "val", 1), (5, "en", " ", "train", 1), (6, "en", "...", "test", 1)]
    return spark.createDataFrame(train, CLIP), spark.createDataFrame(held, CLIP), spark.createDataFrame(pairs, PAIR)


def test_split(spark, rows):
    plan = spark.createDataFrame([("train", 0.9), ("val", 0.05), ("test", 0.05), (None, 1.0)], PLAN)
    recs = splits.records(*frames(spark))
    out = splits.split_records(recs, plan)
    assert out.count() == recs.count() == 924 + 6
    assert rows(splits.crossing(out)) == [("eval_cv", 1000), ("eval_cv", 1001), ("pairs", 2)]
    assert out.groupBy("unit", "comp").agg({"new_split": "approx_count_distinct"}).filter("`approx_count_distinct(new_split)` > 1").isEmpty()
    got = {r["split_name"]: r["reached"] for r in splits.shares_reached(out, plan).filter("unit = 'clips'").collect()}
    assert abs(got["train"] - 0.9) < 0.01 and abs(got["val"] - 0.05) < 0.01


def test_linked_equals_union_find(spark):
    rng = random.Random(4)
    data = [(k, rng.choice([None, *map(str, range(60))]), rng.choice([None, None, *map(str, range(60))])) for k in range(150)]
    data += [(1000 + k, f"a{k // 2}", f"b{(k + 1) // 2}") for k in range(64)]  # one long chain
    data += [(2000 + k, "hot", None) for k in range(300)]
    up = {i: i for i, *_ in data}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    seen = {}
    for i, a, b in data:
        for k in (("a", a), ("b", b)):
            if k[1] is not None:
                up[find(i)] = find(seen.setdefault(k, i))
    df = spark.createDataFrame(data, "id bigint, a string, b string")
    got = {r.id: r.key for r in splits.linked(df, "id", ["a", "b"]).collect()}
    assert len(got) == len(data)
    groups, want = {}, {}
    for i, a, b in data:
        if a is None and b is None:
            assert got[i] is None
        else:
            groups.setdefault(got[i], set()).add(i)
            want.setdefault(find(i), set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert splits.linked(df.limit(0), "id", ["a"]).isEmpty()


def test_empty(spark, rows):
    plan = spark.createDataFrame([("train", 1.0)], PLAN)
    recs = splits.records(spark.createDataFrame([], CLIP), spark.createDataFrame([], CLIP), spark.createDataFrame([], PAIR))
    assert rows(splits.split_records(recs, plan)) == []
