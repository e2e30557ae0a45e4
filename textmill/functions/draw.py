"""Deterministic uniform draws: the same for any partitioning, and the same in other SQL engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def draw(seed: int, salt: str, *key: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of the MD5 of seed, salt and key, joined by bars."""
    joined = F.concat_ws("|", F.lit(str(seed)), F.lit(salt), *[k.cast("string") for k in key])
    return F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def draw_sql(seed: int, salt: str, *key: str) -> str:
    """The same draw as DuckDB SQL."""
    parts = ", ".join(["'" + str(seed) + "'", "'" + salt + "'", *[f"CAST({k} AS VARCHAR)" for k in key]])
    return f"(CAST(('0x' || substr(md5(concat_ws('|', {parts})), 1, 8)) AS BIGINT) / 4294967296.0)"
