"""Problem 6: filling containers of fixed capacity with items.

Minimum bin slack: each container takes the largest item left, and of all multisets of the other lengths left the one
that fills it closest to its capacity, found by subset sums in a bit set and traced back to counts. Items of one
length are interchangeable, so the driver packs the histogram of lengths only, which has at most capacity entries, and a
multiset is used as often as its counts allow. Items are then ranked within their length, in ranges, and each takes its place
by its rank. Pieces that fill a container alone need no packing: running sums number them.

Defined cases: null and empty texts have no tokens and no piece; only items longer than the capacity are split, into
whole containers and a rest that is packed like any item; null or non-positive capacities and null names give no containers; a
capacity over MOST_CAPACITY and more than MOST_PACKS packs are errors; ties in
length are broken by the id; repeated ids are repeated items; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.tokens import TOKENIZER, counted
from textmill.operators.skew import running
from textmill.session import materialize

#: Largest capacity: it bounds the histogram that the driver packs, and the table of patterns.
MOST_CAPACITY = 1 << 20
#: Most packs: every text goes into each of them.
MOST_PACKS = 1000
#: Most places of patterns that are broadcast; more are joined by a shuffle.
MOST_BROADCAST = 200_000
#: Most bytes of sums that are kept while one container is filled.
MOST_BYTES = 64_000_000


def _closest(left: dict[int, int], sizes: list[int], room: int) -> dict[int, int]:
    """The multiset of lengths left whose sum is closest to room from below. sizes: the lengths, longest first. The step that
    reached a sum first is found from the sums before each step, or, where these would take too much room, is noted for each sum."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    noted = (room // 8 + 1) * 2 * len(sizes) > MOST_BYTES
    via = np.full(room + 1 if noted else 0, -1, dtype=np.int32)
    for s in sizes:
        if s > room or not left.get(s):
            continue
        most, k = min(left[s], room // s), 1
        while most:
            k = min(k, most)
            steps.append((s, k, None if noted else reach))
            new = (reach << (s * k)) & mask & ~reach
            if noted and new:
                bits = np.unpackbits(np.frombuffer(new.to_bytes(room // 8 + 1, "little"), dtype=np.uint8), bitorder="little")
                via[np.flatnonzero(bits)] = len(steps) - 1
            reach |= new
            most -= k
            k *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    last = len(steps)
    while at:
        last = int(via[at]) if noted else next(j for j in range(last - 1, -1, -1) if not steps[j][2] >> at & 1)
        s, k, _ = steps[last]
        used[s] = used.get(s, 0) + k
        at -= s * k
    return used


def patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(lengths in a container with their counts, number of such containers): all items of the histogram, packed."""
    left = {s: n for s, n in histogram.items() if 0 < s <= capacity and n > 0}
    sizes, out, first = sorted(left, reverse=True), [], 0
    while first < len(sizes):
        top = sizes[first]
        if not left[top]:
            first += 1
            continue
        left[top] -= 1
        used = _closest(left, sizes[first:], capacity - top) if capacity > top else {}
        left[top] += 1
        used[top] = used.get(top, 0) + 1
        times = min(left[s] // k for s, k in used.items())
        for s, k in used.items():
            left[s] -= k * times
        out.append((used, times))
        if first % 64 == 0:
            sizes = sizes[:first] + [s for s in sizes[first:] if left[s]]
    return out


def packed(docs: DataFrame, packs: DataFrame, id: str = "doc_id", text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """pack_name, capacity, block_id, doc_id, piece, first_token, n_tokens: where each text, or piece of one, lies."""
    spark = docs.sparkSession
    sized = materialize(counted(docs, id, text, [], path).filter("n_tokens > 0").withColumnRenamed(id, "doc_id"), "sizes")
    listed = packs.select("pack_name", "capacity").filter("pack_name is not null and capacity > 0").distinct().limit(MOST_PACKS + 1).collect()
    if len(listed) > MOST_PACKS:
        raise ValueError(f"more than {MOST_PACKS} packs")
    wanted = [(r[0], int(r[1])) for r in listed]
    if over := [name for name, capacity in wanted if capacity > MOST_CAPACITY]:
        raise ValueError(f"packs of a capacity over {MOST_CAPACITY}: {over[:10]}")
    each_pack = F.array(*[F.struct(F.lit(k).alias("pack"), F.lit(name).alias("pack_name"), F.lit(capacity).alias("capacity")) for k, (name, capacity) in enumerate(wanted)]).cast("array<struct<pack:int,pack_name:string,capacity:int>>")
    each = sized.withColumn("_p", F.explode(each_pack)).select("doc_id", F.col("n_tokens").alias("whole"), "_p.*")  # every text goes into every pack
    each = each.withColumn("full", F.expr("whole div capacity")).withColumn("rest", F.expr("cast(whole % capacity as int)"))
    items = each.filter("rest > 0").select("pack", "pack_name", "capacity", "doc_id", F.col("full").alias("piece"), (F.col("full") * F.col("capacity")).alias("first_token"), F.col("rest").alias("n_tokens"))
    histograms: dict[int, dict[int, int]] = {}
    for pack, size, n in items.groupBy("pack", "n_tokens").count().collect():  # less than capacity rows a pack
        histograms.setdefault(pack, {})[size] = n
    rows, blocks = [], []
    for pack, (_, capacity) in enumerate(wanted):
        block, rank = 0, {}
        for used, times in patterns(histograms.get(pack, {}), capacity):
            for s, k in used.items():
                start = rank.get(s, 0)
                rows.append((pack, s, start, start + k * times, k, block))
                rank[s] = start + k * times
            block += times
        blocks.append((pack, block))
    schema = "pack int, n_tokens int, lo bigint, hi bigint, k int, block bigint"
    places = spark.createDataFrame(pd.DataFrame(rows, columns=[c.split(" ")[0] for c in schema.split(", ")]), schema) if rows else spark.createDataFrame([], schema)
    if len(rows) <= MOST_BROADCAST:
        places = F.broadcast(places)
    keys = ["pack", "n_tokens"]
    placed = running(items, keys, ["doc_id", "piece"], "rank").join(places, keys).filter("rank >= lo and rank < hi")
    packed_items = placed.select("pack_name", "capacity", (F.col("block") + F.expr("(rank - lo) div k")).alias("block_id"), "doc_id", "piece", "first_token", "n_tokens")
    # the pieces that fill a block alone are numbered after the others, by running sums over their texts
    long = running(each.filter("full > 0").select("pack", "pack_name", "capacity", "doc_id", "full"), ["pack"], ["doc_id"], "before", F.col("full"))
    after = F.broadcast(spark.createDataFrame(blocks, "pack int, _blocks bigint"))  # MOST_PACKS rows at most
    full = long.join(after, "pack").withColumn("piece", F.explode(F.expr("sequence(0L, full - 1)")))
    full = full.select("pack_name", "capacity", (F.col("_blocks") + F.col("before") + F.col("piece")).alias("block_id"), "doc_id", "piece", (F.col("piece") * F.col("capacity")).alias("first_token"), F.col("capacity").alias("n_tokens"))
    return packed_items.unionByName(full)


def least_blocks(histogram: dict[int, int], capacity: int) -> int:
    """A number of blocks that no packing of the items can fall below: over all thresholds a, items of more than half a block
    need blocks of their own, and items of a at least go into what these leave only beside those of at most capacity - a."""
    size = np.array(sorted(histogram), dtype=np.int64)
    n = np.array([histogram[s] for s in size.tolist()], dtype=np.int64)
    counts, sums = np.concatenate([[0], np.cumsum(n)]), np.concatenate([[0], np.cumsum(n * size)])
    a = np.concatenate([[1], size[size <= capacity // 2]])
    upto = lambda x: np.searchsorted(size, x, side="right")
    half, top, low = upto(capacity // 2), upto(capacity - a), np.searchsorted(size, a)
    alone, beside = counts[-1] - counts[top], counts[top] - counts[half]
    rest = sums[half] - sums[low] - (beside * capacity - (sums[top] - sums[half]))
    return int((alone + beside + np.maximum(0, -(-rest // capacity))).max()) if len(size) else 0


def _bounds(key: tuple, sizes: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"pack_name": [key[0]], "capacity": [key[1]], "least_blocks": [least_blocks(dict(zip(sizes["n_tokens"].tolist(), sizes["n"].tolist())), int(key[1]))]})


def fill(places: DataFrame) -> DataFrame:
    """pack_name, capacity, n_blocks, n_tokens, fullest, filled (share of the room used), least_blocks (no packing has fewer)."""
    places = materialize(places, "places")
    sums = places.groupBy("pack_name", "capacity", "block_id").agg(F.sum("n_tokens").alias("t"))
    out = sums.groupBy("pack_name", "capacity").agg(F.count(F.lit(1)).alias("n_blocks"), F.sum("t").alias("n_tokens"), F.max("t").alias("fullest"))
    sizes = places.groupBy("pack_name", "capacity", "n_tokens").agg(F.count(F.lit(1)).alias("n"))  # at most capacity rows a pack
    bounds = sizes.groupBy("pack_name", "capacity").applyInPandas(_bounds, "pack_name string, capacity int, least_blocks bigint")
    return out.join(bounds, ["pack_name", "capacity"]).select("pack_name", "capacity", "n_blocks", "n_tokens", "fullest", (F.col("n_tokens") / (F.col("n_blocks") * F.col("capacity"))).alias("filled"), "least_blocks")
