import random

import pytest

from textmill.llm import packing as P

DOC = "doc_id bigint, text string, n_tokens int, pack_name string, rank int"
PACK = "pack_name string, capacity int"


@pytest.mark.parametrize("seed", range(6))
def test_patterns_pack_everything(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 60): rng.randint(1, 30) for _ in range(20)}
    packed = P.patterns(dict(histogram), 60)
    left = dict(histogram)
    for used, times in packed:
        assert times > 0 and sum(s * k for s, k in used.items()) <= 60
        for s, k in used.items():
            left[s] -= k * times
    assert not any(left.values())
    blocks, tokens = sum(t for _, t in packed), sum(s * n for s, n in histogram.items())
    big = sum(n for s, n in histogram.items() if s > 30)
    assert blocks <= max(big, -(-tokens // 60)) + max(3, blocks // 20)


@pytest.mark.parametrize("most", [0, 64_000_000])
def test_closest_is_best(monkeypatch, most):
    monkeypatch.setattr(P, "MOST_BYTES", most)
    rng = random.Random(1)
    for _ in range(100):
        left = {rng.randint(1, 15): rng.randint(1, 3) for _ in range(5)}
        sums = {0}
        for s, n in left.items():
            sums = {t + s * k for t in sums for k in range(n + 1)}
        room = rng.randint(1, 30)
        used = P._closest(left, sorted(left, reverse=True), room)
        assert all(used[s] <= left[s] for s in used)
        assert sum(s * k for s, k in used.items()) == max(t for t in sums if t <= room)


@pytest.mark.parametrize("seed", range(10))
def test_no_packing_is_below_the_bound(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 60): rng.randint(1, 30) for _ in range(20)}
    blocks, bound = sum(t for _, t in P.patterns(dict(histogram), 60)), P.least_blocks(histogram, 60)
    assert -(-sum(s * n for s, n in histogram.items()) // 60) <= bound <= blocks
    assert P.least_blocks({31: 7}, 60) == 7 and P.least_blocks({20: 4, 41: 3}, 60) == 5 and P.least_blocks({}, 60) == 0


def test_packed(spark, rows):
    docs = [(k, "word " * (k % 50 + 1), 1, "x", 1) for k in range(200)] + [(500, "one two three " * 3000, 1, "x", 1), (501, None, 1, "x", 1), (502, "", 1, "x", 1), (3, "word word", 1, "x", 1)]
    packs = spark.createDataFrame([("small", 32), ("large", 200), ("none", None), ("zero", 0), (None, 5)], PACK)
    out = P.packed(spark.createDataFrame(docs, DOC), packs).cache()
    sizes = {}
    for r in P.counted(spark.createDataFrame(docs, DOC).filter("text <> ''"), "doc_id", "text", []).collect():
        sizes.setdefault(r.doc_id, []).append(r.n_tokens)
    for name, capacity in (("small", 32), ("large", 200)):
        mine = [r for r in out.collect() if r.pack_name == name]
        blocks, texts = {}, {}
        for r in mine:
            blocks[r.block_id] = blocks.get(r.block_id, 0) + r.n_tokens
            texts.setdefault(r.doc_id, []).append(r)
        assert max(blocks.values()) <= capacity and sorted(blocks) == list(range(len(blocks)))
        for doc, n in sizes.items():
            assert sum(r.n_tokens for r in texts[doc]) == sum(n)
            assert len(texts[doc]) == sum(max(1, -(-x // capacity)) for x in n)
        assert 501 not in texts and 502 not in texts
    got = {r.pack_name: r for r in P.fill(out).collect()}
    assert set(got) == {"small", "large"} and got["large"].filled > 0.95 and got["small"].n_blocks >= got["small"].least_blocks > 0


def test_empty(spark, rows):
    packs = spark.createDataFrame([("a", 10)], PACK)
    assert rows(P.packed(spark.createDataFrame([], DOC), packs)) == []
    assert rows(P.packed(spark.createDataFrame([(1, "a", 1, "x", 1)], DOC), packs.limit(0))) == []


def test_too_large_packs_are_errors(spark):
    docs = spark.createDataFrame([(1, "a", 1, "x", 1)], DOC)
    with pytest.raises(ValueError, match="capacity over"):
        P.packed(docs, spark.createDataFrame([("a", 10), ("vast", P.MOST_CAPACITY + 1)], PACK))
    with pytest.raises(ValueError, match="packs"):
        P.packed(docs, spark.createDataFrame([(f"p{k}", 10) for k in range(P.MOST_PACKS + 1)], PACK))
