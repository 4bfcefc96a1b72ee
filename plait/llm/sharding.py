"""Sharding by a two-pass external shuffle.

Pass 1 scatters every record by seeded hashes: its shard is the one of the greatest hash of (seed, id, shard), so that one
more shard takes records only into itself, and within the shard it goes to one of several buckets, whose number is
set so that a bucket fits in memory.  Buckets are dealt to tasks as ranges of (shard, bucket), so that a task writes to one or two shards.
Pass 2 puts each bucket into a fixed order, shuffles it by a Fisher-Yates permutation with a seed of its own and writes it.  The files of a shard, in the
order of their names, hold its records in the order of their slots: a record's slot is the number of records in the buckets before its own plus its place there.

Equal texts are not kept together: a record's shard is a function of its id and the number of shards alone.

Defined results: a null id is one key like any other; a null text has no bytes; repeated rows keep a slot each (fully equal ones share a bucket); a shard
may be empty; an empty table gives an empty folder; the text's bytes plus 16 are a record's size; other columns are
ignored, whatever their names, and a result column of the id column's name gets a trailing underscore.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import free_names, new_path, release


@dataclass(frozen=True)
class Settings:
    shards: int = 40
    bucket_bytes: int = 32 << 20
    least_buckets: int = 4
    seed: int = 20240229


def _weights(key: Column, first: int, end: int, seed: int) -> list[Column]:
    return [F.struct(F.xxhash64(F.lit(seed), key, F.lit(i)).alias("h"), F.lit(i).alias("i")) for i in range(first, end)]


def shard_of(key: Column, shards: int, seed: int) -> Column:
    """The shard by greatest hash, a function of the key and the number of shards."""
    return F.array_max(F.array(*_weights(key, 0, shards, seed)))["i"]


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A uniform permutation of 0 to n - 1: swap each place, from the last down, with one drawn at or below it."""
    order = np.arange(n)
    draws = np.random.Generator(np.random.PCG64(seed)).random(n)
    for i in range(n - 1, 0, -1):
        j = int(draws[i] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return order


def shuffle_shards(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """Writes the shuffled shards as Parquet folders shard=N (id, text, size, text_crc32, bucket, place, grown_shard) and
    returns the written table with ``slot``, which is read from the counts of the buckets."""
    s = settings
    spark = docs.sparkSession
    path = path or new_path(spark, "shards")
    text = F.col(text_col).cast("string")
    key = F.col(id_col)
    size = (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long")
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    buckets = max(s.least_buckets, math.ceil(total / s.shards / s.bucket_bytes))
    rows = docs.select(key.alias("id"), text.alias("text"), size.alias("size"), F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), F.array_max(F.array(*_weights(key, 0, s.shards, s.seed))).alias("best"))
    grown = F.greatest(F.col("best"), _weights(F.col("id"), s.shards, s.shards + 1, s.seed)[0])["i"]
    rows = rows.select("id", "text", "size", "text_crc32", F.col("best.i").alias("shard"), grown.alias("grown_shard"), F.pmod(F.xxhash64(F.lit(s.seed + 1), "id", "text_crc32", "size"), F.lit(buckets)).cast("int").alias("bucket"))
    schema = "id {0}, text string, size long, text_crc32 long, bucket int, place long, grown_shard int, shard int".format(rows.schema["id"].dataType.simpleString())

    def second(table: pa.Table) -> pa.Table:
        release()
        table = table.sort_by([("id", "ascending"), ("text_crc32", "ascending"), ("size", "ascending")])
        shard, bucket = table.column("shard")[0].as_py(), table.column("bucket")[0].as_py()
        table = table.take(pa.array(fisher_yates(table.num_rows, [s.seed, shard, bucket])))
        return table.append_column("place", pa.array(np.arange(table.num_rows))).select(["id", "text", "size", "text_crc32", "bucket", "place", "grown_shard", "shard"])

    shuffled = rows.repartitionByRange("shard", "bucket").groupBy("shard", "bucket").applyInArrow(second, schema)
    shuffled.sortWithinPartitions("shard", "bucket", "place").write.partitionBy("shard").parquet(path)
    out = spark.read.schema(shuffled.schema).parquet(path)
    counts = out.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).cast("long").alias("offset"))
    slotted = out.join(offsets, ["shard", "bucket"]).withColumn("slot", F.col("offset") + F.col("place"))
    own = ["size", "text_crc32", "bucket", "place", "slot", "grown_shard", "shard"]
    return slotted.select(F.col("id").alias(id_col), F.col("text").alias(text_col), *[F.col(c).alias(name) for c, name in zip(own, free_names(own, [id_col, text_col]))])
