"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.session import spread

#: Ranks of a byte-level BPE: a line each with the token in base64 and its rank.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how these tokenizers split texts before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@cache
def encoding(path: str):  # noqa: ANN201
    """The tokenizer in the file path, loaded once a process."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def counted(docs: DataFrame, id: str, text: str, keep: list[str], path: str = TOKENIZER) -> DataFrame:
    """id, the columns keep, and n_tokens of each text; null texts have 0 tokens."""
    df = docs.select(id, *keep, F.col(text).cast("string").alias("_t"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields[:-1]) + ", n_tokens bigint"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = encoding(path)
        for b in batches:
            sizes = [len(known.encode_ordinary(t)) if t else 0 for t in b["_t"]]
            yield b.drop(columns="_t").assign(n_tokens=pd.Series(sizes, index=b.index, dtype="int64"))

    return spread(df).mapInPandas(count, schema)
