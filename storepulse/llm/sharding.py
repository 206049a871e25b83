"""Sharding by a two-pass external shuffle, with DataFrame operations only.

Pass one scatters the records uniformly into buckets that fit in memory: the
bucket is a seeded hash of the whole record and of its number among identical
rows, so that neither rows with one key nor rows repeated without end meet in one bucket. Pass
two reads one bucket per task, sorts it, permutes it by Fisher-Yates
(``shuffle`` with a seed) and numbers it. The buckets one after another are a
random order of the whole table, which is cut into shards of equal length:
the law ``rows``, counts at most one apart.

The order is a function of the rows, the seed and the bucket size alone:
buckets are sorted before they are permuted, and the bucket number is the
partition number. A retried task gives the same rows.

Nulls: null text counts 8 bytes and has a null checksum; null columns add
nothing to the hash. Columns of the input with names of result columns are
replaced. An empty table gives no rows. Map columns cannot be compared, which
counting identical rows needs; convert them first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storepulse.llm.common import set_aside

#: Production parameters.
SHARDS = 24
SEED = 6
BUCKET_BYTES = 32 << 20
#: The start of each bucket (16 bytes) is broadcast up to this many buckets, joined beyond.
BROADCAST_BUCKETS = 1 << 20
#: Identical rows that one task writes out; more are dealt to several.
COPIES = 1 << 16
#: Bytes that a record counts besides its text.
OVERHEAD = 8
_OWN = {"_n", "_part", "_copy", "_hash", "_bucket", "_rows", "_row", "_slot", "_start", "_position"}
RESULT = ("position", "size", "law", "shard", "slot", "grown_shard")


def record_size(text: str = "text") -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long")


def external_shuffle(
    records: DataFrame,
    total_bytes: int,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``records`` with ``position``: the place (from 0) of each row in a seeded random order of all rows."""
    records, restored = set_aside(records, _OWN)
    columns = records.columns
    n_buckets = max(1, math.ceil(total_bytes / bucket_bytes))
    counted = records.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    dealt = counted.filter(F.col("_n") > COPIES).withColumn("_part", F.explode(F.sequence(F.lit(0), F.expr(f"(_n - 1) div {COPIES}L"))))
    dealt = dealt.repartition(F.col("_part"), F.xxhash64(*columns))
    dealt = counted.filter(F.col("_n") <= COPIES).withColumn("_part", F.lit(0).cast("long")).unionByName(dealt)
    copies = F.sequence(F.expr(f"_part * {COPIES}L + 1"), F.least("_n", F.expr(f"(_part + 1) * {COPIES}L")))
    scattered = dealt.withColumn("_copy", F.explode(copies)).drop("_part")
    scattered = scattered.withColumn("_hash", F.xxhash64(F.lit(seed), *columns, "_copy"))
    scattered = scattered.withColumn("_bucket", F.pmod("_hash", F.lit(n_buckets)).cast("int"))
    # One row for each bucket, so this sort sees a row for every bucket_bytes of input.
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = scattered.groupBy("_bucket").count().select(
        "_bucket", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_start")
    )
    buckets = (
        scattered.repartitionById(n_buckets, F.col("_bucket"))
        .groupBy("_bucket")
        .agg(F.sort_array(F.collect_list(F.struct("_hash", "_copy", *columns))).alias("_rows"))
        .withColumn("_rows", F.shuffle("_rows", seed=seed))
    )
    return (
        buckets.select("_bucket", F.posexplode("_rows").alias("_slot", "_row"))
        .join(F.broadcast(starts) if n_buckets <= BROADCAST_BUCKETS else starts, "_bucket")
        .select(*[F.col(f"_row.`{c}`").alias(c) for c in columns], (F.col("_start") + F.col("_slot")).alias("_position"))
        .select(*restored, F.col("_position").alias("position"))
    )


def shard_rows(
    docs: DataFrame,
    columns: list[str],
    shards: int = SHARDS,
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``columns`` of every row of ``docs`` with size, text_crc32, law, shard, slot and grown_shard."""
    keep = [c for c in columns if c.lower() not in (*RESULT, "text_crc32")]
    records = docs.select(*keep, record_size().alias("size"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))
    n, total = records.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    shuffled = external_shuffle(records, total, seed, bucket_bytes)
    shard = F.expr(f"position * {shards}L div {max(n, 1)}L")
    first = F.expr(f"(shard * {n}L + {shards - 1}L) div {shards}L")
    return (
        shuffled.withColumn("shard", shard)
        .withColumn("slot", F.col("position") - first)
        .withColumn("shard", F.col("shard").cast("int"))
        .withColumn("law", F.lit("rows"))
        .withColumn("grown_shard", F.lit(None).cast("int"))
        .drop("position")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write one folder for each shard; its files, in the order of their names, hold the rows in slot order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
