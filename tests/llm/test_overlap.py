import random

import numpy as np
import pytest

from textmill.llm import overlap as O
from textmill.llm.letters import words

CLIP = "clip_id bigint, text string, lang string, split string, src string, n int, bands string"
PAIR = "pair_id bigint, input string, output string, lang string, split string, source string, w int"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def match(a, b):
    return min(len(a), len(b)) >= 5 and distance(a, b) <= max(len(a), len(b)) // 10


def changed(rng, t, alphabet):
    t = list(t)
    for _ in range(rng.randint(0, 4)):
        k, how = rng.randrange(len(t)), rng.random()
        if how < 0.33 and len(t) > 5:
            t.pop(k)
        elif how < 0.66:
            t.insert(k, rng.randrange(alphabet))
        else:
            t[k] = rng.randrange(alphabet)
    return t


@pytest.mark.parametrize("seed", range(8))
def test_matches_equal_brute_force(seed):
    rng, alphabet = random.Random(seed), 12 if seed % 2 else 200
    base = [[rng.randrange(alphabet) for _ in range(rng.choice([5, 6, 8, 9, 10, 11, 15, 19, 20, 22, 30, 31, 45, 120]))] for _ in range(30)]
    some = lambda: [np.array(x, dtype=np.uint32) for x in {tuple(changed(rng, rng.choice(base), alphabet)) for _ in range(100)} if len(x) >= 5]
    a, b = some(), some()
    got = {tuple(x[:2]) for x in O.matches(a, b).tolist()}
    assert got == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if match(x.tolist(), y.tolist())}


@pytest.mark.parametrize("seed", range(60))
def test_long_pairs_equal_brute_force(seed):
    rng = random.Random(seed)
    a = [rng.randrange(rng.choice([2, 5, 50])) for _ in range(rng.randint(0, 40))]
    b = changed(rng, changed(rng, a, 9), 9) if a and seed % 3 else [rng.randrange(5) for _ in range(rng.randint(0, 40))]
    for most in (0, 1, 2, 4, 9, 45):
        assert O.within_long(np.array(a, dtype=np.uint32), np.array(b, dtype=np.uint32), most) == (distance(a, b) <= most)


def test_lengths():
    for n in range(5, 3000):
        m = O.longest_partner(n)
        assert m - m // 10 <= n < m + 1 - (m + 1) // 10
        assert O.band(n) <= O.band(m)


def test_spans_are_merged():
    a = np.array([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19, 20], dtype=np.uint32)
    b = a.copy()
    b[10] = 99
    assert O.matches([a], [b]).tolist() == [[0, 0, 19]]
    assert O.matches([a], [a]).tolist() == [[0, 0, 20]]


def test_all_maximal_matches_are_counted():
    assert min(n // (O.longest_partner(n) // 10 + 1) for n in range(5, 3000)) == O.LEAST_RUN
    a = np.arange(20, dtype=np.uint32)
    b = a.copy()
    b[[6, 13]] = 99, 98
    assert O.matches([a], [b]).tolist() == [[0, 0, 18]]
    rng = random.Random(1)
    for _ in range(300):
        x = [rng.randrange(6) for _ in range(rng.randint(5, 40))]
        y = changed(rng, x, 6)
        k = O.LEAST_RUN
        inside = {j + i for j in range(len(y) - k + 1) if any(x[p : p + k] == y[j : j + k] for p in range(len(x) - k + 1)) for i in range(k)}
        assert O._covered(np.array(x, dtype=np.uint32), np.array(y, dtype=np.uint32), k) == (len(y) if x == y else len(inside))


def test_search_finds_all_windows():
    texts = [np.array([1, 2, 3, 1, 2], dtype=np.uint32), np.array([2, 3, 1, 2, 9], dtype=np.uint32)]
    index = O.Index(texts)
    codes = index.codes(np.array([3, 1, 2, 7], dtype=np.uint32))
    lo, hi = index.search(codes, np.array([2]), 3)
    places = index.located(np.arange(lo[0], hi[0]))
    assert sorted((int(t), int(p - index.start[t])) for p, t in zip(places, index.text_of(places))) == [(0, 2), (1, 1)]
    assert index.search(codes, np.array([3]), 2)[0].tolist() == index.search(codes, np.array([3]), 2)[1].tolist()


@pytest.mark.parametrize("seed", range(20))
def test_index_equals_brute_force(seed):
    rng = random.Random(seed)
    some = rng.choice([2, 5, 50])
    texts = [np.array([rng.randrange(some) for _ in range(rng.randint(1, 30))], dtype=np.uint64) for _ in range(rng.randint(1, 20))]
    texts += texts[:1]
    index = O.Index(texts)
    assert len(index.begins) <= index.size
    for k in range(1, 6):
        flat = np.array([rng.randrange(some + 1) for _ in range(40)], dtype=np.uint64)
        ends = np.arange(k - 1, 40)
        lo, hi = index.search(index.codes(flat), ends, k)
        for e, a, z in zip(ends, lo, hi):
            places = index.located(np.arange(a, z))
            got = sorted((int(t), int(p - index.start[t])) for p, t in zip(places, index.text_of(places)))
            want = flat[e - k + 1 : e + 1].tolist()
            assert got == [(t, i) for t, x in enumerate(texts) for i in range(len(x) - k + 1) if x[i : i + k].tolist() == want]


def frames(spark, train, held, pairs=()):
    clip = lambda xs, split: spark.createDataFrame([(i, t, lang, split, "cv", 1, "x") for i, t, lang in xs], CLIP)
    return clip(train, "train"), clip(held, "dev"), spark.createDataFrame([(*p, 1) for p in pairs], PAIR)


def test_found(spark, rows, monkeypatch):
    ten = "one two three four five six seven eight nine ten"
    train = [(1, ten, "en"), (2, ten.upper().replace(" ", ", "), "en"), (3, ten.replace("five", "fünf"), "en"), (4, ten.replace("five", "x").replace("six", "y"), "en"), (5, ten, "sq"), (6, None, "en"), (7, "one two three four", "en"), (8, "", None)]
    held = [(20, ten, "en"), (21, "one two three four", "en"), (22, ten + " eleven", "en"), (22, ten + " eleven", "en")]
    pairs = [(1, "a b c d e", "Á b c d e f", "en", "train", "s"), (2, "z z z z y", "a b c d e f", "en", "val", "s"), (3, "a, b c d E", None, "en", "test", "s"), (4, "a b c d e", "a b c d e f", "en", None, "s")]
    want = [("clips", 1, 20), ("clips", 1, 22), ("clips", 2, 20), ("clips", 2, 22), ("clips", 3, 20), ("pairs", 1, 2), ("pairs", 1, 3)]
    args = frames(spark, train, held, pairs)
    assert rows(O.found(*args)) == want
    monkeypatch.setattr(O, "SHARD_WORDS", 10)
    monkeypatch.setattr(O, "BLOCK_WORDS", 10)
    assert rows(O.found(*args)) == want
    got = rows(O.counts(*args))
    assert ("pairs", "val", "s", 1, 1, 6) in got and ("pairs", "test", "s", 1, 1, 5) in got


@pytest.mark.parametrize("seed", range(2))
def test_pairs_are_counted_as_listed(spark, seed):
    rng = random.Random(seed)
    make = lambda: rng.choice(["a b c d e f g h i j k", "A b c d e f g h i j K", "l m n o p q", "l m n o p q r", "s t u v w", "a b c d e f g h i j x"])
    pairs = [(k, make(), make(), "en", rng.choice(["train", "train", "val", "test"]), rng.choice(["s", None])) for k in range(80)]
    args = frames(spark, [], [], pairs)
    listed = {}
    info = {p[0]: p for p in pairs}
    for r in O.found(*args).collect():
        held = r.id_a if info[r.id_a][4] != "train" else r.id_b
        listed.setdefault(info[held][4:6], []).append(held)
    got = {(r.split, r.source): (r.n_records, r.n_pairs) for r in O.counts(*args).collect()}
    assert got == {k: (len(set(v)), len(v)) for k, v in listed.items()}


def test_long_and_hot(spark):
    rng = random.Random(3)
    long = [f"w{rng.randrange(5000)}" for _ in range(20_000)]
    near = [w if k % 40 else "changed" for k, w in enumerate(long)]
    train = [(1, " ".join(long), "en")] + [(k, "the same text again and again", "en") for k in range(10, 400)]
    held = [(5000, " ".join(near), "en"), (5001, "The same text again, and again!", "en")]
    got = {(r.id_a, r.id_b) for r in O.found(*frames(spark, train, held)).collect()}
    assert got == {(1, 5000)} | {(k, 5001) for k in range(10, 400)}


def test_random_texts_equal_brute_force(spark):
    rng = random.Random(5)
    make = lambda: " ".join(rng.choice(["red", "blue", "old", "cat", "dog", "ran", "sat", "hat"]) for _ in range(rng.randint(4, 14)))
    train, held = [(k, make(), "en") for k in range(300)], [(1000 + k, make(), "en") for k in range(300)]
    got = {(r.id_a, r.id_b) for r in O.found(*frames(spark, train, held)).collect()}
    assert got == {(i, j) for i, a, _ in train for j, b, _ in held if match(words(a), words(b))}


def test_empty(spark, rows):
    assert rows(O.found(*frames(spark, [], []))) == []


def test_words_of_one_32_bit_hash_differ(spark, rows):
    import xxhash

    seen = {}
    for k in range(400_000):
        if (other := seen.setdefault(xxhash.xxh32_intdigest(f"w{k}"), k)) != k:
            break
    assert other != k
    assert rows(O.found(*frames(spark, [(1, f"a b c d w{k}", "en")], [(9, f"a b c d w{other}", "en")]))) == []
