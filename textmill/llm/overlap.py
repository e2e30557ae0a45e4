"""Problem 5: same or near-same records across splits.

The evaluation texts are kept in shards of like lengths, each with a compressed full-text index: the Burrows-Wheeler
transform of the shard's words as runs, the runs of each word in order with the number of places before them, and every
eighth entry of the suffix array. One backward step is one binary search among runs; a place is found by steps back to
the next entry kept. Training texts are streamed through the shards in blocks: all their windows are
searched backwards at once, and of each text those d + 1 disjoint windows are located that have the fewest places, where
d is the number of words in which a partner may differ; as one difference touches one window at most, each partner holds
one of them unchanged, at a place shifted by d at most. So no partner is lost, and windows that stand nowhere cost nothing.
The located places are merged to pairs of texts, and those are compared exactly by word edit distance in a band of width
2 d + 1, all pairs of the same lengths at once. In pairs that match all maximal matches of LEAST_RUN words at least are
searched, wherever they stand, merged and counted (counts() only).

A training text goes only to shards where it can have a partner: the hashes of d + 1 disjoint windows of it are joined with
those of all windows of the evaluation texts. Texts without any such window, usually most, go nowhere. Copies are found once a
task by a 128-bit hash, and everything up to the matches is about distinct texts; only then are the records of each joined.
Shards and blocks hold a bounded number of words, and the records of texts with very many copies are salted.
Words are compared by 64-bit hashes that kind and language are part of.

Defined cases: null texts and texts of fewer than five words, and rows of null lang, are not compared; repeated rows are
all reported; texts of any length are compared as a whole; extra columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.letters import words
from textmill.operators.skew import HOT_SHARE, attach
from textmill.session import materialize, spread

#: Fewest words of a text that is compared.
LEAST_WORDS = 5
#: Two texts match if they differ in at most 1 / DIFFER of the longer one's words.
DIFFER = 10
#: Fewest words of a maximal match that is counted: as many as the shortest window that is searched.
LEAST_RUN = 4
#: Words of evaluation texts in one index, and of training texts streamed through it in one task.
SHARD_WORDS, BLOCK_WORDS = 250_000, 500_000
#: Of the suffix array each entry is kept whose place is a multiple of this.
KEPT = 8
#: Words of texts whose hashes a task remembers, to leave out copies; beyond it forgets them.
_REMEMBERED = 500_000
_CHUNK = 2_000_000

_BOUNDS = [5, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100]
while _BOUNDS[-1] < 10**9:
    _BOUNDS.append(int(_BOUNDS[-1] * 1.1) + 1)
_EDGES = np.array(_BOUNDS)


def band(n: int) -> int:
    """Number of the length band of a text of n words."""
    return int(np.searchsorted(_EDGES, n, side="right"))


def longest_partner(n: int) -> int:
    """Most words of a text that can match one of n words: the largest m with m - m // DIFFER <= n."""
    m = n * DIFFER // (DIFFER - 1) + 1
    while m - m // DIFFER > n:
        m -= 1
    return m


def window(n: int) -> tuple[int, int]:
    """(k, d + 1): the words of a window of a text of n words, and how many disjoint ones are searched."""
    pieces = longest_partner(n) // DIFFER + 1
    return n // pieces, pieces


@cache
def windows_of_partners(m: int) -> tuple[int, ...]:
    """The window lengths of all texts that can match one of m words."""
    return tuple(sorted({window(n)[0] for n in range(max(LEAST_WORDS, m - m // DIFFER), longest_partner(m) + 1)}))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def grams(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each window of k codes."""
    out = np.full(len(codes) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        out = (out ^ (out >> np.uint64(29))) * _MIX + codes[j : len(codes) - k + 1 + j]
    return out ^ (out >> np.uint64(32))


class _Codes(dict):
    """Codes of the words of one kind and language, made as they are asked for."""

    def __init__(self, part: str) -> None:
        self.seed = xxhash.xxh64_intdigest(part)

    def __missing__(self, word: str) -> int:
        code = self[word] = xxhash.xxh64_intdigest(word, self.seed)
        return code


def _coded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, _Codes] = {}
    seen: set[tuple[bool, bytes]] = set()
    for b in batches:
        if len(seen) + sum(map(len, known.values())) > _REMEMBERED:
            known, seen = {}, set()
        rows, texts = [], []
        for kind, lang, held, id, text in zip(b["kind"], b["lang"], b["held"], b["id"], b["t"]):
            ws = words(text)
            if len(ws) < LEAST_WORDS:
                continue
            part = kind + "\x1f" + lang
            if part not in known:
                known[part] = _Codes(part)
            codes = np.array(list(map(known[part].__getitem__, ws)), dtype=np.uint64)
            t = hashlib.md5(codes, usedforsecurity=False).digest()
            first = (held, t) not in seen
            seen.add((held, t))
            rows.append((kind, held, id, t, len(ws), *_bands(len(ws)), first))
            texts.append(codes)
        if not rows:
            continue
        flat, data, found, at = np.concatenate(texts), [], [], 0
        of: dict[int, np.ndarray] = {}  # by length the hashes of all windows of the batch, those over the ends of texts too
        for (_, held, _, _, n, _, _, _, first), codes in zip(rows, texts):
            data.append(codes.tobytes() if first else None)
            mine = []
            for k, m, step in (_held_windows(n) if held else _train_windows(n)) if first else ():
                if k not in of:
                    of[k] = grams(flat, k).view(np.int64)
                mine.append(of[k][at : at + m : step])
            found.append(np.concatenate(mine) if len(mine) > 1 else mine[0] if mine else [])
            at += n
        yield pd.DataFrame(rows, columns=["kind", "held", "id", "t", "n", "band", "lo", "hi", "first"]).drop(columns="first").assign(w=data, grams=found)


@cache
def _bands(n: int) -> tuple[int, int, int]:
    """The band of texts of n words, and the lowest and highest one of partners."""
    return band(n), band(n - n // DIFFER), band(longest_partner(n))


@cache
def _train_windows(n: int) -> list[tuple[int, int, int]]:
    """(k, end, step): of a training text the windows whose hashes are looked up."""
    k, pieces = window(n)
    return [(k, k * (pieces - 1) + 1, k)]


@cache
def _held_windows(m: int) -> list[tuple[int, int, int]]:
    """(k, end, step): of an evaluation text all windows that a partner may look up."""
    return [(k, m - k + 1, 1) for k in windows_of_partners(m) if k <= m]


def coded(rows: DataFrame) -> DataFrame:
    """rows (kind, lang, held, id, t) as kind, held, id, t (hash of the words, kind and lang), n, band,
    the bands lo to hi of possible partners, and for the first of a
    task's copies w (word codes) and grams (hashes of windows): stored."""
    schema = "kind string, held boolean, id bigint, t binary, n int, band int, lo int, hi int, w binary, grams array<bigint>"
    return materialize(spread(rows.filter("t is not null and lang is not null and held is not null")).mapInPandas(_coded, schema), "coded")


class Index:
    """A compressed full-text index of texts, each an array of word codes."""

    def __init__(self, texts: list[np.ndarray]) -> None:
        m = len(texts)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.words, codes = np.unique(np.concatenate(texts), return_inverse=True)
        ends = np.cumsum(sizes + 1) - 1
        self.start = (ends - sizes).astype(np.int32)
        total = int(ends[-1]) + 1
        s = np.empty(total, dtype=np.int64)
        is_end = np.zeros(total, dtype=bool)
        is_end[ends] = True
        s[is_end] = np.arange(m)  # each text ends with a sign of its own
        s[~is_end] = codes + m
        self.first, self.size = m, total
        rank, k = s, 1
        while True:
            nxt = np.full(total, -1, dtype=np.int64)
            nxt[:-k] = rank[k:] if k < total else 0
            key = rank * (max(int(rank.max()), int(nxt.max())) + 2) + nxt + 1
            order = np.argsort(key, kind="stable")
            ordered = key[order]
            new = np.empty(total, dtype=np.int64)
            new[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
            rank, k = new, 2 * k
            if rank.max() == total - 1:
                break
        # the transform as runs: where each begins, its sign, and by sign and beginning how many of the sign stand before it
        bwt = s[order - 1]
        begins = np.concatenate([[0], np.flatnonzero(bwt[1:] != bwt[:-1]) + 1])
        signs, lengths = bwt[begins], np.diff(np.append(begins, total))
        by = np.argsort(signs, kind="stable")
        self.begins, self.signs = begins.astype(np.int32), signs.astype(np.int32)
        self.heads = signs[by] * (total + 1) + begins[by]
        self.ends = (begins + lengths)[by].astype(np.int32)
        self.before = np.concatenate([[0], np.cumsum(lengths[by])]).astype(np.int32)  # signs are sorted, so this is the row of the next suffix too
        kept = order % KEPT == 0
        self.marks = np.flatnonzero(kept).astype(np.int32)
        self.kept = order[kept].astype(np.int32)
        self.text_starts = self.start.astype(np.int64)

    def _before(self, signs: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rows of suffixes that begin with a lower sign, or with signs and lie before row at after one step back."""
        j = np.searchsorted(self.heads, signs * (self.size + 1) + at)  # runs of lower signs, or of this one that begin before at
        whole = self.before[j].astype(np.int64)
        last = np.maximum(j - 1, 0)
        over = np.where((j > 0) & (self.heads[last] // (self.size + 1) == signs), np.maximum(self.ends[last] - at, 0), 0)
        return whole - over

    def codes(self, flat: np.ndarray) -> np.ndarray:
        """Codes of words; -1 for words that stand in no text."""
        at = np.minimum(np.searchsorted(self.words, flat), len(self.words) - 1)
        return np.where(self.words[at] == flat, at + self.first, -1)

    def search(self, codes: np.ndarray, ends: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each window of k codes that ends at ends its interval of rows, by backward steps; empty if none."""
        lo, hi = np.zeros(len(ends), dtype=np.int64), np.zeros(len(ends), dtype=np.int64)
        live = np.arange(len(ends))
        a, z = np.zeros(len(ends), dtype=np.int64), np.full(len(ends), self.size, dtype=np.int64)
        for j in range(k):
            c = codes[ends[live] - j]
            ok = c >= 0
            live, c, a, z = live[ok], c[ok], a[ok], z[ok]
            a, z = self._before(c, a), self._before(c, z)
            ok = a < z
            live, a, z = live[ok], a[ok], z[ok]
            if not len(live):
                break
        lo[live], hi[live] = a, z
        return lo, hi

    def located(self, rows: np.ndarray) -> np.ndarray:
        """The places of rows: steps back until an entry is kept."""
        out, steps = np.empty(len(rows), dtype=np.int64), 0
        live, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(live):
            j = np.minimum(np.searchsorted(self.marks, at), len(self.marks) - 1)
            hit = self.marks[j] == at
            out[live[hit]] = self.kept[j[hit]] + steps
            live, at, steps = live[~hit], at[~hit], steps + 1
            if len(live):
                sign = self.signs[np.searchsorted(self.begins, at, side="right") - 1].astype(np.int64)
                at = self._before(sign, at)
        return out

    def text_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.text_starts, places, side="right") - 1


def within(a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Of rows of word codes a[i], b[i] whether their edit distance is at most most; in a band, rows leave once beyond it."""
    (m, x), y = a.shape, b.shape[1]
    good = np.zeros(m, dtype=bool)
    if abs(x - y) > most:
        return good
    if most == 0:
        return (a == b).all(axis=1)
    width, far = 2 * most + 1, most + 1
    live = np.arange(m)
    row = np.full((m, width), far, dtype=np.int32)  # row[:, q]: distance of a[:i] and b[:i + q - most]
    row[:, most : most + min(most, y) + 1] = np.arange(min(most, y) + 1)
    for i in range(1, x + 1):
        new = np.full_like(row, far)
        for q in range(max(0, most - i), min(width, y - i + most + 1)):
            j = i + q - most
            best = row[:, q] + (a[live, i - 1] != b[live, j - 1]) if j else np.full(len(live), far, dtype=np.int32)
            if q + 1 < width:
                best = np.minimum(best, row[:, q + 1] + 1)
            if q and j:
                best = np.minimum(best, new[:, q - 1] + 1)
            new[:, q] = np.minimum(best, i) if j == 0 else best
        row = new
        if i % 4 == 0:
            ok = row.min(axis=1) <= most
            live, row = live[ok], row[ok]
            if not len(live):
                return good
    good[live[row[:, y - x + most] <= most]] = True
    return good


#: Texts of more words than this are compared one pair at a time, by furthest reaching ends.
LONG_WORDS = 256
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _prefix_hashes(a: np.ndarray, powers: np.ndarray) -> np.ndarray:
    """Sums of words times powers of an odd base, modulo 2 ** 64, of all beginnings of a."""
    return np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((a.astype(np.uint64) + np.uint64(1)) * powers[: len(a)], dtype=np.uint64)])


def within_long(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Whether the edit distance of two long texts is at most most: for 0, 1, 2 ... edits the furthest end on each
    diagonal, all diagonals at once; equal runs are measured by bisection on hashes of beginnings."""
    x, y = len(a), len(b)
    if abs(x - y) > most:
        return False
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(x, y), _BASE, dtype=np.uint64)]), dtype=np.uint64)
    ha, hb = _prefix_hashes(a, powers), _prefix_hashes(b, powers)

    def run(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros(len(i), dtype=np.int64), np.minimum(x - i, y - j)
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = (ha[i + mid] - ha[i]) * powers[np.maximum(j - i, 0)] == (hb[j + mid] - hb[j]) * powers[np.maximum(i - j, 0)]
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    far = np.full(2 * most + 3, -2, dtype=np.int64)  # by diagonal j - i + most + 1: the furthest i
    for e in range(most + 1):
        k = np.arange(max(-e, -x), min(e, y) + 1)
        at = k + most + 1
        i = np.zeros(len(k), dtype=np.int64) if e == 0 else np.maximum(np.maximum(far[at] + 1, far[at + 1] + 1), far[at - 1])
        i = np.minimum(i, np.minimum(x, y - k))
        ok = (i >= 0) & (i + k >= 0)
        k, at, i = k[ok], at[ok], i[ok]
        i = i + run(i, i + k)
        new = far.copy()
        new[at] = np.maximum(new[at], i)
        far = new
        if far[y - x + most + 1] >= x:
            return True
    return False


def _covered(a: np.ndarray, b: np.ndarray, k: int) -> int:
    """Words of b that lie in maximal matches with a of k words at least: the words of b's windows of k words that stand in
    a, each word once."""
    if len(a) == len(b) and (a == b).all():
        return len(b)
    if k > min(len(a), len(b)):
        return 0
    codes = np.unique(np.concatenate([a, b]), return_inverse=True)[1].astype(np.int64)
    x, y, done = codes[: len(a)], codes[len(a) :], 1
    while done < k:  # codes of windows of twice the words, or of k
        step = min(done, k - done)
        wide = int(max(x.max(), y.max())) + 1
        x, y = x[: len(x) - step] * wide + x[step:], y[: len(y) - step] * wide + y[step:]
        codes = np.unique(np.concatenate([x, y]), return_inverse=True)[1].astype(np.int64)
        x, y, done = codes[: len(x)], codes[len(x) :], done + step
    starts = np.flatnonzero(np.isin(y, x))
    edges = np.zeros(len(b) + 1, dtype=np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + k, -1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def matches(train: list[np.ndarray], held: list[np.ndarray], covering: bool = True) -> np.ndarray:
    """(k, l, words): pairs of distinct texts train[k] and held[l] that match, with the words of held[l] that lie in
    maximal matches of LEAST_RUN words at least (0 without covering)."""
    sizes = np.array([len(t) for t in train])
    how = {int(n): window(int(n)) for n in np.unique(sizes)}
    index = Index(held)
    held_sizes = np.array([len(t) for t in held])
    codes = index.codes(np.concatenate(train))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    pairs = []
    for n, (k, pieces) in how.items():
        d, rows = pieces - 1, np.flatnonzero(sizes == n)
        for part in np.array_split(rows, max(1, len(rows) * n // _CHUNK + 1)):
            if not len(part):
                continue
            ends = starts[part][:, None] + np.arange(k - 1, n)[None, :]
            lo, hi = index.search(codes, ends.ravel(), k)
            count = (hi - lo).reshape(ends.shape)
            shifts = n - pieces * k + 1
            costs = np.stack([count[:, s : s + d * k + 1 : k].sum(axis=1) for s in range(shifts)], axis=1)
            shift = costs.argmin(axis=1)
            cols = shift[:, None] + np.arange(pieces)[None, :] * k
            flat = (np.arange(len(part))[:, None] * ends.shape[1] + cols).ravel()
            flat = flat[count.ravel()[flat] > 0]
            if not len(flat):
                continue
            for some in np.array_split(flat, int(count.ravel()[flat].sum()) // _CHUNK + 1):
                many = (hi - lo)[some]
                if not many.sum():
                    continue
                place = index.located(np.repeat(lo[some] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()))
                text = index.text_of(place)
                own, at = np.repeat(some // ends.shape[1], many), np.repeat(some % ends.shape[1], many)
                size = held_sizes[text]
                allowed = np.maximum(size, n) // DIFFER
                ok = (np.abs(size - n) <= allowed) & (np.abs(place - index.start[text] - at) <= allowed)
                pairs.append(np.unique(np.stack([part[own[ok]], text[ok]], axis=1), axis=0))
    if not pairs:
        return np.zeros((0, 3), dtype=np.int64)
    merged = np.unique(np.concatenate(pairs), axis=0)
    shape = np.stack([sizes[merged[:, 0]], held_sizes[merged[:, 1]]], axis=1)
    good = np.zeros(len(merged), dtype=bool)
    for x, y in np.unique(shape, axis=0):
        those = np.flatnonzero((shape[:, 0] == x) & (shape[:, 1] == y))
        if min(x, y) > LONG_WORDS:
            good[those] = [within_long(train[k], held[m], int(max(x, y)) // DIFFER) for k, m in merged[those]]
            continue
        for part in np.array_split(those, len(those) * int(x) // _CHUNK + 1):
            if len(part):
                good[part] = within(np.stack([train[k] for k in merged[part, 0]]), np.stack([held[k] for k in merged[part, 1]]), int(max(x, y)) // DIFFER)
    merged = merged[good]
    inside = [_covered(train[k], held[m], LEAST_RUN) for k, m in merged] if covering else np.zeros(len(merged))
    return np.column_stack([merged, np.array(inside, dtype=np.int64)])


def _searched(covering: bool):  # noqa: ANN202
    def search(train: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        a, b = train.drop_duplicates("t").reset_index(drop=True), held.drop_duplicates("t").reset_index(drop=True)
        if not len(a) or not len(b):
            found = np.zeros((0, 3), dtype=np.int64)
        else:
            codes = lambda f: [np.frombuffer(w, dtype=np.uint64) for w in f["w"]]
            found = matches(codes(a), codes(b), covering)
        return pd.DataFrame({"kind": a["kind"].to_numpy()[found[:, 0]], "train": a["t"].to_numpy()[found[:, 0]], "held": b["t"].to_numpy()[found[:, 1]], "n_words": found[:, 2]})

    return search


def _sharded(held: DataFrame) -> DataFrame:
    """The first copies of the evaluation texts with their shard: texts of like lengths, at most about SHARD_WORDS words each. The
    words by band, a few hundred rows at most, come to the driver."""
    sizes, first, shards = {r[0]: int(r[1]) for r in held.groupBy("band").agg(F.sum("n")).collect()}, 0, []
    for number in sorted(sizes):
        many = -(-sizes[number] // SHARD_WORDS)
        shards.append((number, first, many))
        first += many
    table = held.sparkSession.createDataFrame(shards, "band int, _first int, _many int")
    placed = held.join(F.broadcast(table), "band")
    return placed.withColumn("shard", F.col("_first") + F.pmod(F.xxhash64("t"), F.col("_many")).cast("int")).drop("_first", "_many")


def overlaps(rows: DataFrame, covering: bool = False) -> DataFrame:
    """kind, train, held (texts of coded() rows), n_words (0 without covering: of the held text the words in maximal matches of LEAST_RUN
    words at least): the pairs of distinct texts that match, stored."""
    firsts = rows.filter("w is not null")
    held = _sharded(firsts.filter("held"))
    stand = held.select(F.explode("grams").alias("g"), "shard", "band").distinct()
    train = firsts.filter("not held")
    seeds = train.select("kind", "id", "t", "n", "lo", "hi", F.explode("grams").alias("g"))
    visits = seeds.join(stand, "g").filter("band between lo and hi").groupBy("kind", "id", "shard").agg(F.max("n").alias("n"))
    visits = materialize(visits, "visits")
    loads = visits.groupBy("shard").agg(F.ceil(F.sum("n") / BLOCK_WORDS).cast("int").alias("blocks"))  # a row a shard
    groups = int(loads.agg(F.sum("blocks")).first()[0] or 0)
    parts = min(max(groups, 1), 100_000)
    loads = F.broadcast(loads)
    block = F.pmod(F.xxhash64("t"), F.col("blocks")).cast("int")
    a = train.select("kind", "id", "t", "w").join(visits.select("kind", "id", "shard"), ["kind", "id"]).join(loads, "shard").select("shard", block.alias("block"), "kind", "t", "w")
    b = held.join(loads, "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "t", "w")
    by = ["shard", "block"]
    a, b = (x.toDF(*x.columns).repartition(parts, *by) for x in (a, b))
    found = a.groupBy(*by).cogroup(b.groupBy(*by)).applyInPandas(lambda x, y: _searched(covering)(x, y), "kind string, train binary, held binary, n_words bigint")
    return materialize(found.groupBy("kind", "train", "held").agg(F.max("n_words").alias("n_words")), "matches")


def records(clips_train: DataFrame, clips_eval: DataFrame, pairs: DataFrame) -> DataFrame:
    """kind, lang, held, id, t: the texts to compare; kind tells what is compared with what."""
    held = F.when(F.col("split") == "train", False).when(F.col("split").isin("val", "test"), True)
    row = lambda df, kind, held, id, t: df.select(F.lit(kind).alias("kind"), F.col("lang").cast("string").alias("lang"), held.alias("held"), F.col(id).cast("long").alias("id"), F.col(t).cast("string").alias("t"))
    parts = [row(clips_train, "clips", F.lit(False), "clip_id", "text"), row(clips_eval, "clips", F.lit(True), "clip_id", "text"), row(pairs, "pairs.input", held, "pair_id", "input"), row(pairs, "pairs.output", held, "pair_id", "output")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _salts(members: DataFrame, total: int) -> DataFrame:
    """t, salts of texts with more than HOT_SHARE of all records, of which there are 1 / HOT_SHARE at most."""
    limit = max(1.0, total * HOT_SHARE)
    return members.groupBy("t").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit).select("t", F.ceil(F.col("_n") / limit).cast("int").alias("salts"))


def _with_ids(pairs: DataFrame, text: str, members: DataFrame, total: int, into: str) -> DataFrame:
    """pairs with the column into: the ids of the records (members: t, id) of each pair's text; those of hot texts are
    spread by a salt."""
    hot = materialize(_salts(members, total), "hot")
    salted = members.join(F.broadcast(hot), "t", "left").select(F.col("t").alias(text), F.col("id").alias(into), F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), F.col("salts"))).cast("int").alias("_s"))
    each = pairs.join(F.broadcast(hot.withColumnRenamed("t", text)), text, "left").withColumn("_s", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("salts"), F.lit(1)) - 1))).drop("salts")
    return each.join(salted, [text, "_s"]).drop("_s")


def found(clips_train: DataFrame, clips_eval: DataFrame, pairs: DataFrame) -> DataFrame:
    """tbl, id_a, id_b (id_a < id_b): one row for each pair of a training and an evaluation record that match."""
    rows = coded(records(clips_train, clips_eval, pairs))
    both, total = overlaps(rows), rows.count()
    train, held = (rows.filter(side).select("t", "id").join(both.select(F.col(c).alias("t")).distinct(), "t", "left_semi") for side, c in (("not held", "train"), ("held", "held")))
    each = _with_ids(_with_ids(both.select("kind", "train", "held"), "held", held, total, "held_id"), "train", train, total, "train_id")
    once = each.select(F.split("kind", r"\.")[0].alias("tbl"), F.least("train_id", "held_id").alias("id_a"), F.greatest("train_id", "held_id").alias("id_b"))
    return once.filter("id_a < id_b").distinct()


def counts(clips_train: DataFrame, clips_eval: DataFrame, pairs: DataFrame) -> DataFrame:
    """tbl, split, source, n_records (evaluation records that overlap with training), n_pairs, n_words (the most words of
    each record that lie in maximal matches, of LEAST_RUN words at least, with one training record, added up).

    Pairs are counted from the numbers of copies, not listed: of a pair record the partners by input and those by output, less those
    by both, which are counted by the combinations of texts that training records have.
    """
    rows = coded(records(clips_train, clips_eval, pairs))
    both, total = overlaps(rows, covering=True), rows.count()
    members = rows.select("kind", "held", "t", "id").distinct()
    copies = members.filter("not held").groupBy(F.col("t").alias("train")).agg(F.count(F.lit(1)).alias("c"))
    per_text = both.join(copies, "train").groupBy(F.col("held").alias("t")).agg(F.sum("c").alias("k"), F.max("n_words").alias("w"))
    sizes = members.filter("held").groupBy("t").agg(F.count(F.lit(1)).alias("m"))
    per_text = per_text.join(sizes, "t")
    each = materialize(attach(members.filter("held").select("kind", "t", "id"), per_text, ["t"], "m", total), "held")
    once = each.groupBy(F.split("kind", r"\.")[0].alias("tbl"), "id").agg(F.sum("k").alias("k"), F.max("w").alias("w"))
    side = lambda df, kind, t: df.filter(F.col("kind") == kind).select("id", F.col("t").alias(t))
    double = side(each, "pairs.input", "a").join(side(each, "pairs.output", "b"), "id")  # pair records with partners by both
    texts = double.select("a", "b").distinct()
    of = lambda kind, held, train: both.filter(F.col("kind") == kind).select(F.col("held").alias(held), F.col("train").alias(train))
    trained = members.filter("not held").join(both.select(F.col("train").alias("t")).distinct(), "t", "left_semi")
    combined = side(trained, "pairs.input", "x").join(side(trained, "pairs.output", "y"), "id").groupBy("x", "y").agg(F.count(F.lit(1)).alias("c"))
    shared = texts.join(of("pairs.input", "a", "x"), "a").join(of("pairs.output", "b", "y"), "b").join(combined, ["x", "y"]).groupBy("a", "b").agg(F.sum("c").alias("c"))
    less = double.join(shared, ["a", "b"]).groupBy("id").agg(F.sum("c").alias("c")).withColumn("tbl", F.lit("pairs"))
    once = once.join(less, ["tbl", "id"], "left").withColumn("k", F.col("k") - F.coalesce("c", F.lit(0))).drop("c")
    info = clips_eval.select(F.lit("clips").alias("tbl"), F.col("clip_id").alias("id"), "split", F.col("src").alias("source"))
    info = info.unionByName(pairs.select(F.lit("pairs").alias("tbl"), F.col("pair_id").alias("id"), "split", "source"))
    return once.join(info, ["tbl", "id"]).groupBy("tbl", "split", "source").agg(F.count(F.lit(1)).alias("n_records"), F.sum("k").alias("n_pairs"), F.sum("w").alias("n_words"))
