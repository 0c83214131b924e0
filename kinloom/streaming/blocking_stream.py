"""Candidates for arriving records: micro-batches of pool records against a static key table of the clean source.

An extension: the batch pipeline has no streaming part. State is none, so late or repeated records need no watermark; the
sink is written per batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kinloom.functions.text import add_views
from kinloom.operators.blocking import record_keys


def static_key_table(clean: DataFrame, largest: int) -> DataFrame:
    """``country, key, t, ids``: keys of the clean source in at most ``largest`` records, with those records (so a bounded list)."""
    keys = record_keys(clean)
    kept = keys.groupBy("country", "key").agg(F.count("*").alias("df")).where(F.col("df") <= largest)
    return keys.join(kept, ["country", "key"], "left_semi").groupBy("country", "key", "t").agg(F.collect_list("id").alias("ids"))


def arriving_candidates(stream: DataFrame, key_table: DataFrame) -> DataFrame:
    """``cand_id, source1_entity_id, t, key`` of each arriving record and each clean record that shares a key: a stream-static join."""
    keys = record_keys(add_views(stream)).withColumnRenamed("id", "cand_id")
    return keys.join(key_table, ["country", "key", "t"]).select("cand_id", F.explode("ids").alias("source1_entity_id"), "t", "key")


def run_to_folder(stream: DataFrame, key_table: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Append the candidates of all data that is there, then stop."""
    return arriving_candidates(stream, key_table).writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
