"""Problem 1: duplicates hidden by formatting.

Records are brought to a canonical form (characters composed, letter case, white space and punctuation dropped, JSON
fields taken by name), hashed to 128 bits, and counted by hash with map-side combining. A second, independent 64-bit
checksum of the canonical form travels with each hash; records whose hashes agree but whose checksums don't are a
collision, and form groups of their own.

Defined cases: null and blank texts, and lines that aren't a JSON object, have no key and are nobody's copy; a pair
record needs letters in input and output; missing or non-text fields count as empty; an empty table gives no rows;
other columns of the tables are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.letters import letters
from textmill.operators.skew import attach
from textmill.session import materialize, spread

KEY = "h binary, chk bigint"
#: Parts of a canonical form are joined by this, which no part holds.
_BAR = "\x1f"


def _hashed(parts: tuple[str, ...] | None) -> tuple[bytes | None, int | None]:
    if parts is None:
        return None, None
    form = _BAR.join(parts).encode()
    return hashlib.md5(form, usedforsecurity=False).digest(), int.from_bytes(hashlib.blake2b(form, digest_size=8).digest(), "little", signed=True)


def clip_form(lang: str | None, text: str | None) -> tuple[str, ...] | None:
    """Canonical form of a clip: its lang and the letters of its text."""
    kept = letters(text)
    return (lang or "", kept) if kept else None


def line_form(raw: str | None) -> tuple[str, ...] | None:
    """Canonical form of a JSONL pair record, whatever the order of its fields; None if the line isn't a JSON object."""
    try:
        record = json.loads(raw or "")
    except ValueError:
        return None
    if not isinstance(record, dict):
        return None
    text = lambda k: v if isinstance(v := record.get(k), str) else ""
    a, b = letters(text("input")), letters(text("output"))
    return (text("lang").strip().lower(), text("mode").strip().lower(), a, b) if a and b else None


def _keys(form: Callable) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_hashed(form(*row)) for row in zip(*[batch[c] for c in batch.columns[1:]])]
            out = pd.DataFrame({"id": batch["id"], "h": [x for x, _ in found], "chk": pd.array([y for _, y in found], dtype="Int64")})
            yield out[out["h"].notna()]

    return keyed


def keyed_clips(clips: DataFrame, id: str = "clip_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """id, h, chk of each clip that has letters."""
    df = clips.select(F.col(id).cast("long").alias("id"), F.col(lang).cast("string").alias("l"), F.col(text).cast("string").alias("t"))
    return df.filter("t is not null and id is not null").mapInPandas(_keys(clip_form), f"id bigint, {KEY}")


def keyed_lines(lines: DataFrame, id: str = "line_id", raw: str = "raw") -> DataFrame:
    """id, h, chk of each line that holds a pair record with letters in input and output."""
    df = lines.select(F.col(id).cast("long").alias("id"), F.col(raw).cast("string").alias("t"))
    return df.filter("t is not null and id is not null").mapInPandas(_keys(line_form), f"id bigint, {KEY}")


def groups(keyed: DataFrame) -> DataFrame:
    """One row for each distinct record: tbl, h, chk, first_id (the smallest), n (copies counted, itself included)."""
    return keyed.groupBy("tbl", "h", "chk").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))


def collisions(keyed: DataFrame) -> DataFrame:
    """Hashes that stand for more than one canonical form, with the number of forms; normally none."""
    return keyed.groupBy("tbl", "h").agg(F.min("chk").alias("lo"), F.max("chk").alias("hi")).filter("lo <> hi").select("tbl", F.hex("h").alias("h"))


def both(clips: DataFrame, lines: DataFrame) -> DataFrame:
    """The keyed records of both tables, stored, with tbl."""
    a = keyed_clips(spread(clips)).withColumn("tbl", F.lit("train_cv"))
    return materialize(a.unionByName(keyed_lines(spread(lines)).withColumn("tbl", F.lit("pair_lines"))), "keyed")


def copies(keyed: DataFrame) -> DataFrame:
    """tbl, first_id, copy_id: each record that repeats the one with the smallest id. keyed must be stored."""
    total = keyed.count()
    many = groups(keyed).filter("n > 1")
    return attach(keyed, many, ["tbl", "h", "chk"], "n", total).filter("id <> first_id").select("tbl", "first_id", F.col("id").alias("copy_id"))
