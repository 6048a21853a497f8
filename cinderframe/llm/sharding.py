"""Sharding by jump consistent hashing (Lamping and Veach, 2014).

A stable key and the number of shards decide the shard; no ring table is kept. Appending a shard moves rows only into
the new one. Slots number the rows of a shard from 0 without gaps, in the order of (bucket, key, size, checksum).

Equal rows are counted before anything is shuffled, so a row that repeats any number of times is one row in each
shuffle; only (key, size, checksum, shard) travel, never texts.

Defined results: a null key is hashed like any other value and so has one shard; a null text has no bytes and the
checksum 0; rows that tie in all returned columns get successive slots; an empty table gives an empty result; only the
key and the text of the input are used, so other columns of any name do no harm.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from cinderframe.llm.common import stash

#: Rows that one bucket of a shard has about; a bucket is numbered in one task.
BUCKET_ROWS = 100_000
#: Slots of one row that are listed at once.
RANGE = 10_000


def jump(key: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key."""
    key = key.astype(np.uint64)
    b, j = np.full(len(key), -1, np.int64), np.zeros(len(key), np.int64)
    live = np.arange(len(key))
    while len(live):
        b[live] = j[live]
        key[live] = key[live] * np.uint64(2862933555777941757) + np.uint64(1)
        step = (key[live] >> np.uint64(33)).astype(np.float64) + 1.0
        j[live] = ((b[live] + 1) * (float(1 << 31) / step)).astype(np.int64)
        live = live[j[live] < shards]
    return b


def jump_hash(key: Column, shards: int) -> Column:
    """The shard, 0 to shards - 1, of a column of 64-bit hashes."""

    @F.pandas_udf(T.IntegerType())
    def shard(k: pd.Series) -> pd.Series:
        return pd.Series(jump(k.to_numpy(), shards).astype(np.int32))

    return shard(key)


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law ('key'), shard, slot, grown_shard: one row for each row of docs."""
    body = F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")
    rows = (
        docs.select(F.col(key).alias("doc_id"), (F.octet_length(body) + 16).cast("bigint").alias("size"), F.crc32(body).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32")
        .agg(F.count("*").alias("n"))
        .withColumn("h", F.xxhash64("doc_id"))
    )
    rows = stash(rows.select("doc_id", "size", "text_crc32", "n", jump_hash(F.col("h"), shards).alias("shard"), jump_hash(F.col("h"), shards + 1).alias("grown_shard")), "shards")
    buckets = max(1, rows.count() // (shards * BUCKET_ROWS))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "size", "text_crc32"), F.lit(buckets)))
    within = W.partitionBy("shard", "bucket").orderBy("doc_id", "size", "text_crc32").rowsBetween(W.unboundedPreceding, -1)
    # a row for each bucket: shards * buckets, a row for every BUCKET_ROWS rows of the input
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "bucket").agg(F.sum("n").alias("n")).select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    placed = rows.withColumn("first", F.coalesce(F.sum("n").over(within), F.lit(0))).join(starts, ["shard", "bucket"])
    # a row that repeats often is cut into ranges, so that no array holds all of its slots
    placed = placed.withColumn("from", F.col("start") + F.col("first")).withColumn("to", F.col("from") + F.col("n") - 1)
    placed = placed.withColumn("at", F.explode(F.sequence("from", "to", F.lit(RANGE).cast("bigint"))))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence(F.col("at"), F.least(F.col("at") + RANGE - 1, F.col("to")))).alias("slot"),
        "grown_shard",
    )
