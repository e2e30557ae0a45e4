"""Problem 2: splits that keep related records together.

Records that share a key (speaker; lang and letters of the input) are one component; linked() follows links over several
keys. The components' weights are
balanced by largest differencing: the sets of bins with the most extreme differences are combined again and again, the
heaviest bin of one with the lightest of the other, until one set of many nearly equal bins is left; whole bins then go
to the splits by the target shares. The driver sees only the histogram of weights, whose length is at most
sqrt(2 x records): components of equal weight are interchangeable, and of each weight whole rounds fill all bins alike.

Defined cases: records with no key (null, blank or placeholder speakers, inputs without letters) are components of
one record each; shares are taken in proportion to their sum, null or negative ones as 0; with no records there are no
rows; a component heavier than a split's share goes to the split with the most room. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textmill.llm.letters import letters
from textmill.operators.skew import attach, running
from textmill.session import materialize, spread

#: Bins that the components are balanced into before the splits take whole bins.
BINS = 400
#: First characters of an id that decide who it is.
ID_CHARS = 16
#: Words that name nobody, as speaker ids; signs alone name nobody either.
PLACEHOLDERS = (
    "unknown", "anonymous", "anon", "n/a", "na", "none", "null", "nil", "nan", "nobody", "noname", "no name", "no speaker", "undefined",
    "unspecified", "not specified", "unnamed", "missing", "empty", "blank", "default", "guest", "user", "speaker", "speaker id", "client_id", "test", "tbd", "todo", "various", "other",
    "unknown speaker", "not available", "not known", "no id", "no one", "unidentified", "not given", "not provided", "withheld", "redacted", "unk", "<unk>", "[unknown]", "(unknown)", "desconocido", "desconocida", "anonimo", "anónimo", "ninguno", "άγνωστος", "άγνωστη", "ανώνυμος", "κανένας", "i panjohur", "e panjohur", "panjohur", "anonim", "askush",
)


def speaker_key(speaker: Column) -> Column:
    """Who a speaker id names: its first 16 characters without outer blanks, in lower case; null for nobody."""
    key = F.lower(F.substring(F.regexp_replace(speaker, r"^[\s\p{Z}\p{Cf}]+|[\s\p{Z}\p{Cf}]+$", ""), 1, ID_CHARS))
    bare = F.regexp_replace(key, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")
    cut = sorted({re.sub(r"^[\W_]+|[\W_]+$", "", p[:ID_CHARS]) for p in PLACEHOLDERS})
    return F.when((bare != "") & ~bare.isin(cut), key)


def _letters_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield batch.assign(key=[letters(t) or None for t in batch["key"]])


def records(clips_train: DataFrame, clips_eval: DataFrame, pairs: DataFrame) -> DataFrame:
    """tbl, rec_id, present (its split now), key (null: related to nothing) of clips and pairs."""
    clip = lambda df, tbl: df.select(F.lit(tbl).alias("tbl"), F.col("clip_id").alias("rec_id"), F.col("split").alias("present"), F.sha2(speaker_key("speaker"), 256).alias("key"))
    raw = pairs.select(F.lit("pairs").alias("tbl"), F.col("pair_id").alias("rec_id"), F.col("split").alias("present"), F.col("lang").cast("string").alias("lang"), F.col("input").cast("string").alias("key"))
    kept = spread(raw).mapInPandas(_letters_of, "tbl string, rec_id bigint, present string, lang string, key string")
    pair = kept.select("tbl", "rec_id", "present", F.when(F.col("key").isNotNull(), F.sha2(F.concat_ws("\x1f", F.coalesce("lang", F.lit("")), "key"), 256)).alias("key"))
    return clip(clips_train, "train_cv").unionByName(clip(clips_eval, "eval_cv")).unionByName(pair)


def components(rows: DataFrame) -> DataFrame:
    """unit (clips or pairs, split apart), comp, weight, has_train: one row a component of rows of records()."""
    unit = F.when(F.col("tbl") == "pairs", "pairs").otherwise("clips")
    comp = F.coalesce(F.unhex("key"), F.concat(F.lit("~"), F.col("tbl"), F.lit(":"), F.col("rec_id").cast("string")).cast("binary"))
    return rows.withColumn("unit", unit).withColumn("comp", comp)


def linked(rows: DataFrame, id: str, keys: list[str]) -> DataFrame:
    """rows with key and first_id (the smallest id): the same for all records that are linked, directly or over others, by equal
    values of one of the columns keys; null for records that have none of them. id is unique; columns of these names are replaced.

    Each round takes for every record the smallest one that shares a value with it, follows these to their ends by doubling, and goes
    on with one record for each end, so that the rounds shrink. Each is stored; hot values are attached by broadcast.
    """
    part = lambda k: F.sha2(F.concat(F.lit(k + "\x1f"), F.col(k).cast("string")), 256)
    links = rows.select(F.col(id).alias("rec"), F.explode(F.array(*[part(k) for k in keys])).alias("val")).filter("val is not null")
    links, labels = materialize(links.distinct(), "links"), None
    while True:
        total = links.count()
        least = links.groupBy("val").agg(F.min("rec").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        near = attach(links, least, ["val"], "n", total).groupBy("rec").agg(F.min("low").alias("label"))
        near, moved = materialize(near, "near"), True
        while moved:
            moved = not near.filter("label <> rec").isEmpty()
            if moved:  # a label that is no end is replaced by its own label
                ahead = near.filter("label <> rec").select(F.col("rec").alias("label"), F.col("label").alias("far"))
                sizes = near.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
                beyond = ahead.join(sizes, "label")
                jumped = attach(near, beyond, ["label"], "n", total, "left").select("rec", F.coalesce("far", "label").alias("label"), F.col("far").isNotNull().alias("moved"))
                jumped = materialize(jumped, "near")
                moved = not jumped.filter("moved").isEmpty()
                near = jumped.drop("moved")
        merged = near.filter("label <> rec")
        if labels is None:
            labels = near
        elif not merged.isEmpty():
            ends = merged.select(F.col("rec").alias("label"), F.col("label").alias("end")).join(labels.groupBy("label").agg(F.count(F.lit(1)).alias("n")), "label")
            labels = materialize(attach(labels, ends, ["label"], "n", labels.count(), "left").select("rec", F.coalesce("end", "label").alias("label")), "labels")
        if merged.isEmpty():
            break
        links = materialize(links.join(near, "rec", "left").select(F.coalesce("label", "rec").alias("rec"), "val").distinct(), "links")
    labels = links.select("rec").distinct().withColumn("label", F.col("rec")) if labels is None else labels
    alone = rows.select(F.col(id).alias("rec"), F.array_contains(F.array(*[F.col(k).isNotNull() for k in keys]), True).alias("any"))
    labels = alone.filter("any").join(labels, "rec", "left").select("rec", F.coalesce("label", "rec").alias("label"))
    return rows.drop("key", "first_id").join(labels.select(F.col("rec").alias(id), F.sha2(F.col("label").cast("string"), 256).alias("key"), F.col("label").alias("first_id")), id, "left")


def _kk(weights: list[tuple[int, int]], bins: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Largest differencing of (weight, count) into bins: of each weight the bins of its components, and the bins' sums.

    A count is less than bins. The two sets with the most extreme differences are combined: equal weights that come first
    begin in bins of their own, all at once; a single weight goes to the lightest bin of the other set, which only that bin's
    new rank is kept of; two sets of sums, of which there are fewer than weights, are added in opposite order.
    """
    if not weights:
        return [], np.zeros(bins, dtype=np.int64)
    # nodes: a weight's first components together; a set with one more component; two sets
    left, right, rank = array("q"), array("q"), array("q")
    orders: dict[int, np.ndarray] = {}
    sums: dict[int, np.ndarray] = {}
    counts = [c for _, c in weights]
    heap = [(-w, -1 - k) for k, (w, _) in enumerate(weights)]  # weights below 0, nodes from 0
    heapq.heapify(heap)

    def node(a: int, b: int, q: int, s: np.ndarray) -> None:
        left.append(a), right.append(b), rank.append(q)
        sums[len(left) - 1] = s
        heapq.heappush(heap, (-int(s[0]), len(left) - 1))

    while len(heap) > 1 or heap[0][1] < 0:
        top, a = heapq.heappop(heap)
        if a < 0:
            s = np.zeros(bins, dtype=np.int64)
            s[: counts[-1 - a]] = -top
            node(a, counts[-1 - a], -1, s)
            continue
        _, b = heapq.heappop(heap)
        s = sums.pop(a)
        if b < 0:
            v = int(s[-1]) + weights[-1 - b][0]
            q = bins - 1 - int(np.searchsorted(s[-2::-1], v, side="right")) if s[-1] < v else bins - 1
            q = max(0, q)
            s[q + 1 :] = s[q:-1].copy()
            s[q] = v
            s -= s[-1]
            node(a, b, q, s)
            counts[-1 - b] -= 1
            if counts[-1 - b]:
                heapq.heappush(heap, (-weights[-1 - b][0], b))
            continue
        s = s + sums.pop(b)[::-1]
        order = np.argsort(-s, kind="stable")
        orders[len(left)] = order.astype(np.int16 if bins < 1 << 15 else np.int64)
        s = s[order]
        node(a, b, -2, s - s[-1])
    bin_of: list[list[int]] = [[] for _ in weights]
    total, place = np.zeros(bins, dtype=np.int64), [(heap[0][1], np.arange(bins))]
    while place:
        at, where = place.pop()  # where[i]: the final bin of the node's i-th sum
        while True:
            a, b, q = left[at], right[at], rank[at]
            if q >= 0:  # the last component's bin is where its sum went
                bin_of[-1 - b].append(int(where[q]))
                where[q:] = np.append(where[q + 1 :], where[q])
                at = a
                continue
            if q == -1:
                bin_of[-1 - a].extend(where[:b].tolist())
            else:
                back = np.empty(bins, dtype=np.int64)
                back[orders.pop(at)] = where
                place += [(a, back), (b, back[::-1].copy())]
            break
    found = [np.array(x, dtype=np.int64) for x in bin_of]
    for (w, _), x in zip(weights, found):
        np.add.at(total, x, w)
    return found, total


def balance(histogram: dict[int, int], shares: dict[str, float], bins: int = BINS) -> tuple[dict[int, str], dict[int, np.ndarray], dict[int, int]]:
    """(split of each bin, bins of the left-over components of each weight, whole rounds of each weight).

    Of c components of a weight, c // bins rounds give one to each bin (component r to bin r % bins), as differencing does
    with as many equal weights as bins; the left-over ones are balanced by largest differencing.
    """
    rounds = {w: c // bins for w, c in histogram.items()}
    left = [(w, histogram[w] % bins) for w in sorted(histogram, reverse=True) if histogram[w] % bins]
    where, sums = _kk(left, bins)
    sums = sums + sum(w * r for w, r in rounds.items())
    names = sorted(shares, key=lambda n: (-shares[n], n))
    whole = sum(max(shares[n] or 0, 0) for n in names) or 1
    target = np.array([max(shares[n] or 0, 0) / whole * sums.sum() for n in names])
    got, split = np.zeros(len(names)), np.zeros(bins, dtype=int)
    for b in np.argsort(-sums, kind="stable"):
        split[b] = int(np.argmax(target - got))
        got[split[b]] += sums[b]
    for _ in range(4 * bins):  # moves and swaps of bins while they bring the shares nearer
        gap, best = got - target, (1e-9, None)
        for i in range(len(names)):
            for j in range(len(names)):
                if i == j:
                    continue
                mine, other = np.flatnonzero(split == i), np.flatnonzero(split == j)
                if not len(mine):
                    continue
                delta = np.concatenate([sums[mine], (sums[mine][:, None] - sums[other][None, :]).ravel()])  # from i to j
                better = gap[i] ** 2 + gap[j] ** 2 - (gap[i] - delta) ** 2 - (gap[j] + delta) ** 2
                k = int(np.argmax(better))
                if better[k] > best[0]:
                    a, b = (mine[k], None) if k < len(mine) else (mine[(k - len(mine)) // len(other)], other[(k - len(mine)) % len(other)])
                    best = (float(better[k]), (i, j, a, b, delta[k]))
        if best[1] is None:
            break
        i, j, a, b, d = best[1]
        split[a] = j
        if b is not None:
            split[b] = i
        got[i] -= d
        got[j] += d
    return {b: names[s] for b, s in enumerate(split)}, {w: bins_of for (w, _), bins_of in zip(left, where)}, rounds


def split_records(rows: DataFrame, plan: DataFrame, bins: int = BINS) -> DataFrame:
    """rows of records() with unit, has_train (the component has a training record now), bin and new_split.

    plan: split_name, share. The histogram of weights (at most sqrt(2 x records) rows a unit) comes to the driver.
    """
    spark = rows.sparkSession
    rows = materialize(components(rows), "records")
    total = rows.count()
    comps = rows.groupBy("unit", "comp").agg(F.count(F.lit(1)).alias("weight"), F.max(F.col("present") == "train").alias("has_train"))
    comps = materialize(comps, "components")
    shares = {r[0]: float(r[1] or 0) for r in plan.select("split_name", "share").collect() if r[0] is not None}
    bin_rows, left_rows = [], []
    histogram: dict[str, dict[int, int]] = {}
    for unit, w, n in comps.groupBy("unit", "weight").count().collect():
        histogram.setdefault(unit, {})[w] = n
    for unit, h in sorted(histogram.items()):
        split, left, rounds = balance(h, shares, bins)
        bin_rows += [(unit, b, s) for b, s in split.items()]
        left_rows += [pd.DataFrame({"unit": unit, "weight": w, "rank": rounds[w] * bins + np.arange(len(bs)), "left_bin": bs}) for w, bs in left.items()]
    splits = spark.createDataFrame(pd.DataFrame(bin_rows, columns=["unit", "bin", "new_split"]), "unit string, bin int, new_split string") if bin_rows else spark.createDataFrame([], "unit string, bin int, new_split string")
    left = spark.createDataFrame(pd.concat(left_rows) if left_rows else [], "unit string, weight bigint, rank bigint, left_bin int")
    ranked = running(comps, ["unit", "weight"], ["comp"], "rank")
    placed = ranked.join(left, ["unit", "weight", "rank"], "left").withColumn("bin", F.coalesce("left_bin", F.pmod("rank", F.lit(bins)).cast("int"))).drop("left_bin", "rank")
    placed = placed.join(F.broadcast(splits), ["unit", "bin"])  # bins x 2 rows
    return attach(rows, placed, ["unit", "comp"], "weight", total)


def shares_reached(assigned: DataFrame, plan: DataFrame) -> DataFrame:
    """unit, split_name, target, reached, n_records."""
    n = assigned.groupBy("unit", F.col("new_split").alias("split_name")).agg(F.count(F.lit(1)).alias("n_records"))
    whole = n.groupBy("unit").agg(F.sum("n_records").alias("_all"))
    want = plan.filter("split_name is not null").select("split_name", F.coalesce("share", F.lit(0.0)).alias("target"))
    return n.join(whole, "unit").join(want, "split_name", "left").select("unit", "split_name", "target", (F.col("n_records") / F.col("_all")).alias("reached"), "n_records")


def crossing(assigned: DataFrame) -> DataFrame:
    """tbl, rec_id of the evaluation records whose component has a training record under the present splits."""
    is_eval = (F.col("tbl") == "eval_cv") | ((F.col("tbl") == "pairs") & F.col("present").isin("val", "test"))
    return assigned.filter(is_eval & F.col("has_train")).select("tbl", "rec_id")
