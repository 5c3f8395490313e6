"""Sizes of texts in tokens of a public tokenizer, read from its vocabulary file; never trained here."""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbra.session import ship, spread

#: Vocabulary file; every executor must see it under this path.
VOCABULARY = os.environ.get("LUMBRA_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(2)
def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def sized(documents: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """documents with `n_tokens`, of the whole text; a null text has 0 tokens, as an empty one."""
    ship(documents.sparkSession)

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        t = tokenizer(vocabulary)
        return texts.map(lambda x: len(t.encode_ordinary(x)) if x else 0).astype("int64")

    return spread(documents).withColumn("n_tokens", count(F.col(text)))
