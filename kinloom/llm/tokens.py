"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Vocabulary file of a public tokenizer; a parameter everywhere.
TOKENIZER = os.environ.get("KINLOOM_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")


@functools.lru_cache(maxsize=4)
def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def _shipped(spark: SparkSession, path: str) -> str:
    """Send the vocabulary to the executors; the name it has there."""
    sc = spark.sparkContext
    sent = sc.__dict__.setdefault("_kinloom_vocabularies", set())
    if path not in sent and os.path.exists(path):
        sc.addFile(path)
        sent.add(path)
    return os.path.basename(path)


def with_token_counts(df: DataFrame, text: str, out: str = "n_tokens", tokenizer: str = TOKENIZER) -> DataFrame:
    """Add ``out``, the number of tokens of the whole text; a null text has 0. An existing column ``out`` is replaced.

    ``tokenizer``: a vocabulary file on the driver, which is sent to the executors.
    """
    name = _shipped(df.sparkSession, tokenizer)

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load(tokenizer if os.path.exists(tokenizer) else SparkFiles.get(name))
        for series in batches:
            sizes: list[int] = []
            values = ["" if t is None else t for t in series]
            for start in range(0, len(values), 64):
                sizes += [len(e) for e in model.encode_batch_fast(values[start : start + 64], add_special_tokens=False)]
            yield pd.Series(sizes, dtype="int64")

    return df.withColumn(out, count(F.col(text).cast("string")))
