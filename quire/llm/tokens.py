"""Sizes of texts in tokens of a public tokenizer; its vocabulary file is a parameter."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_VOCABULARY = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
# Fixed value: the published pre-tokenisation pattern of this family of byte-level vocabularies.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, vocabulary: str = DEFAULT_VOCABULARY) -> Column:
    """Tokens of each text; null and empty texts have 0.  Arrow-batched, whole texts."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoding(vocabulary).encode_ordinary
        for s in batches:
            yield pd.Series([len(encode(x)) if x else 0 for x in s], dtype="int64")

    return count(text)
