import random

import pytest
from pyspark.sql import functions as F

from textmill.functions.draw import draw
from textmill.operators import manifest as M
from textmill.operators import metrics as E

CLIP = "clip_id bigint, audio string, text string, dur double, src string, speaker string, clip_group string, teacher string, lang string"


def clips(spark, *given):
    names = ("audio", "text", "dur", "src", "speaker", "clip_group", "teacher", "lang")
    base = {"audio": "a/x.mp3", "text": "some text", "dur": 1.0, "src": "cv", "speaker": None, "clip_group": None, "teacher": None, "lang": "en"}
    return spark.createDataFrame([(k, *[(base | g)[n] for n in names]) for k, g in enumerate(given)], CLIP)


def ids(df):
    return sorted(r.clip_id for r in df.select("clip_id").collect())


def test_durations(spark, rows):
    durs = spark.createDataFrame([("x.mp3", 1500), ("x.mp3", 2000), ("z.mp3", None), (None, 5)], "clip string, duration_ms int")
    df = clips(spark, {}, {"audio": "z.mp3"}, {"audio": None}, {"audio": "q"})
    assert rows(M.with_durations(df, durs), "clip_id", "seconds") == [(0, 2.0), (1, 0.0), (2, 0.0), (3, 0.0)]


def test_without_held(spark):
    held = clips(spark, {"text": "Held, text!", "speaker": "s" * 20}, {"text": " ", "speaker": None}, {"text": None, "speaker": " "})
    df = clips(spark, {"text": "held text"}, {"text": "free", "speaker": "s" * 16 + "other"}, {"text": "held text", "lang": "sq"}, {"text": "free"}, {"text": " "}, {"text": None})
    assert ids(M.without_held(df, held)) == [2, 3]
    assert ids(M.without_held(df, held.limit(0))) == [0, 1, 2, 3]


def test_gates(spark):
    df = clips(spark, {"dur": 29.5}, {"dur": 29.51}, {"dur": None}, {"audio": "b"})
    assert ids(M.short_enough(df, M.MOST_TRAIN)) == [0, 2, 3]
    assert ids(M.new_by_path(df, df.filter("clip_id = 0"))) == [3]
    assert ids(M.required(df)) == [0, 1, 2, 3]
    with pytest.raises(Exception, match="lacks"):
        M.required(clips(spark, {"audio": None})).collect()


def test_verified(spark, rows):
    df = clips(spark, {"text": "Çfarë është", "teacher": "cfare eshte!"}, {"text": "abcdefghij", "teacher": "abcdefgh"}, {"teacher": " "}, {"teacher": None}, {"text": "", "teacher": "x"})
    assert rows(M.verified(df, F.lit(0.15)), "clip_id", "cer") == [(0, 0.0)]
    assert rows(M.verified(df, F.lit(0.2)), "clip_id", "cer") == [(0, 0.0), (1, 0.2)]


@pytest.mark.parametrize("seed", range(4))
def test_capped_equals_greedy(spark, seed):
    rng = random.Random(seed)
    df = clips(spark, *[{"dur": rng.choice([None, 1.0, 2.5, 7.25, 20.0, 29.0]), "clip_group": rng.choice([None, "a", "b", "hot", "hot"])} for _ in range(150)])
    order = {r.clip_id: r.d for r in df.select("clip_id", draw(1, "cap", F.col("clip_id")).alias("d")).collect()}
    total, want = {}, []
    for r in sorted(df.collect(), key=lambda r: (order[r.clip_id], r.clip_id)):
        n = r.dur or 0.0
        if r.clip_group is not None:
            if total.get(r.clip_group, 0) + n > 72:
                continue
            total[r.clip_group] = total.get(r.clip_group, 0) + n
        want.append(r.clip_id)
    assert ids(M.capped(df, 0.02)) == sorted(want)


def test_samples(spark, rows):
    df = clips(spark, *[{"dur": float(k)} for k in range(60)])
    assert M.fixed_sample(df, 5).count() == 5 and M.fixed_sample(df, 0).count() == 31
    out = M.dev_split(df, 10)
    assert out.filter("part = 'dev'").count() == 3 and out.count() == 60
    assert M.dev_split(df.limit(0)).isEmpty() and M.dev_split(df.limit(1)).filter("part = 'dev'").count() == 1
    assert rows(M.hours(df))[0][:2] == ("cv", 60)
    assert spark.createDataFrame([(14.9,), (15.0,), (50.0,)], "h double").select(M.epochs(F.col("h"))).collect() == [(10,), (6,), (4,)]


def test_error_rates(spark):
    df = spark.createDataFrame([("m", "a b c d", "a b c d"), ("m", "e", "x y z"), ("m", "", ""), ("m", "ë", "e"), ("m", None, None)], "m string, r string, h string")
    got = E.error_rates(df, "r", "h", ("m",)).first()
    assert got.n == 5 and got.wer == pytest.approx(4 / 8) and got.cer == pytest.approx(6 / 11) and got.loose_cer == pytest.approx(5 / 11)
    assert E.similarities(df, "r", "h", ("m",)).first().similarity == pytest.approx(1 / 5)


def test_accuracies(spark, rows):
    df = spark.createDataFrame([("a", "x", ["x", "y"]), ("a", "y", ["x", "y"]), (None, "x", None), (" ", "q", ["q"])], "k string, gold string, best array<string>")
    got = {r[0]: r[1:] for r in rows(E.accuracies(df, F.col("gold"), F.col("best"), "k"))}
    assert got == {"ALL": (4, 0.5, 0.75), "a": (2, 0.5, 1.0)}
    counts = spark.createDataFrame([("k", "b", 2), ("k", "a", 2), ("k", "c", 9), ("k", "d", 1)], "key string, word string, n int")
    assert rows(E.top_k(counts, ("key",))) == [("k", ["c", "a", "b"])]


def test_tables(spark, rows):
    df = spark.createDataFrame([("m", "s", 0.5), ("m", "t", 0.25), ("n", "s", 0.1)], "model string, set string, wer double")
    assert rows(E.pivoted(df, "model", "set", "wer", ["s", "t"])) == [("m", "0.5000", "0.2500"), ("n", "0.1000", "n/a")]
    assert rows(E.mean_of_sets(df, "model", "wer")) == [("m", 0.375), ("n", 0.1)]
    steps = spark.createDataFrame([("m", 1, 0.3), ("m", 2, 0.2), ("m", 3, 0.2)], "model string, step int, wer double")
    assert rows(E.earliest_best(steps, ("model",), "step", "wer")) == [("m", 2, 0.2)]
    assert rows(E.merged_results(df, df.limit(1).withColumn("wer", F.lit(9.0)), ("model", "set")), "wer") == [(0.1,), (0.25,), (9.0,)]
    runs = spark.createDataFrame([("q", True, 5, "slow"), ("q", False, 1, "bad"), ("q", True, 3, "b"), ("q", True, 3, "a")], "q string, ok boolean, ms int, text string")
    assert rows(E.first_success(runs, ("q",), F.col("ok"), "ms", "text")) == [("q", "a")]


def test_words_are_compared_exactly_whatever_their_number(spark, monkeypatch):
    from textmill.functions import score as S

    a, b = " ".join(f"w{k}" for k in range(200)), " ".join(f"w{k}" if k % 9 else f"x{k}" for k in range(200))
    df = spark.createDataFrame([(a, b)], "a string, b string")
    for first in (S._FIRST, 0xD7F0, 0xFFF0):  # over the surrogates, beyond the first plane
        monkeypatch.setattr(S, "_FIRST", first)
        assert df.select(S.words_edited(F.col("a"), F.col("b"))).first()[0] == 23
    monkeypatch.setattr(S, "_FIRST", 0x110000 - 2048 - 100)
    with pytest.raises(Exception, match="too many words"):
        df.select(S.words_edited(F.col("a"), F.col("b"))).collect()


def test_cap_takes_all_clips_of_no_length_at_once(spark):
    rows = [(k, "g", 10.0 if k < 5 else None) for k in range(3000)]
    out = M.capped(spark.createDataFrame(rows, "clip_id int, clip_group string, dur double"), 25 / 3600)
    assert out.count() == 2995 + 2


@pytest.mark.parametrize("folded", [2, 500])
def test_cap_equals_brute_force(spark, monkeypatch, folded):
    monkeypatch.setattr(M, "FOLDED", folded)
    rng = random.Random(folded)
    rows = [(k, rng.choice("ab"), rng.choice([0.1, 0.4, 1.0, 3.0, 7.5, 20.0])) for k in range(300)]
    df = spark.createDataFrame(rows, "clip_id int, clip_group string, dur double")
    order = {r.clip_id: r.d for r in df.select("clip_id", draw(1, "cap", F.col("clip_id")).alias("d")).collect()}
    want, room = set(), {"a": 60.0, "b": 60.0}
    for k, g, s in sorted(rows, key=lambda r: (order[r[0]], r[0])):
        if round(s, 6) <= round(room[g], 6):
            want.add(k)
            room[g] -= s
    assert {r.clip_id for r in M.capped(df, 60 / 3600).collect()} == want
