"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

#: Rank file of the tokenizer on the driver, which gives it to the executors.
VOCABULARY = os.environ.get("ZONEWRIGHT_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
# Fixed value: the pattern that splits text before the merges of that rank file.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LOADED: dict = {}


def _encoding(path: str):
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path] = tiktoken.Encoding("public", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def token_count(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Tokens of the whole text; null and empty texts have none.

    The tokenizer is no JVM expression, so texts go to Python in Arrow batches. Special tokens in
    a text are ordinary text.
    """

    spark = SparkSession.getActiveSession()
    ship_package(spark)
    spark.sparkContext.addFile(vocabulary)  # once, however often it is asked for
    name = os.path.basename(vocabulary)

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoding(SparkFiles.get(name))
        for texts in batches:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)
