"""Landing extracts as month-partitioned parquet.

Invoices and targets are landed under ``<path>/<partition_col>=yyyy-MM/``.
A report reads them back with :func:`storepulse.sources.readers.read_landed`
and the span of its windows, so whole months outside the span are pruned
at planning time (no listing or opening of their files). Months are UTC months, whatever
the session's time zone.

Rows are rebalanced by month before they are written: small months end up in few files, and
adaptive execution splits a month holding a large share of the data over
many tasks. ``max_records_per_file`` bounds file size. With
``replace_months=True`` the write uses dynamic partition overwrite:
re-landing a month replaces that month only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import MICROS_PER_DAY

MONTH_FORMAT = "yyyy-MM"


def month_of(ts_col: str) -> Column:
    """UTC month of a timestamp, from its distance to the epoch."""
    day = F.floor(F.unix_micros(F.col(ts_col).cast("timestamp")) / F.lit(MICROS_PER_DAY)).cast("int")
    return F.date_format(F.date_from_unix_date(day), MONTH_FORMAT)


def land_by_month(
    df: DataFrame,
    path: str,
    ts_col: str,
    partition_col: str = "invoice_month",
    replace_months: bool = True,
    max_records_per_file: int = 5_000_000,
) -> str:
    """Write ``df`` as parquet partitioned by the month of ``ts_col``."""
    out = df.withColumn(partition_col, month_of(ts_col)).hint("rebalance", partition_col)
    writer = (
        out.write.mode("overwrite" if replace_months else "append")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(partition_col)
    )
    if replace_months:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def land_bucketed(df: DataFrame, path: str, table: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as parquet bucketed and sorted by ``key``, known to the session as ``table``.

    Frames landed with the same key and number of buckets join, and group, by the
    key without an exchange: rows of a key lie in files of one bucket. The rows are
    shuffled once, here; a bucket that a hot key makes large is split over several tasks
    and files by adaptive execution. The number of buckets is to be chosen for the size of the largest
    frame (some 200 MB a bucket), as readers have a task a bucket.
    """
    spread = df.hint("rebalance", buckets, key)
    spread.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def attach_bucketed(spark: SparkSession, path: str, schema: T.StructType, table: str, key: str, buckets: int) -> DataFrame:
    """A landing of :func:`land_bucketed` made known to another session; nothing is read or written."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"DROP TABLE IF EXISTS `{table}`")  # the name alone: the landing stays, its path was given
    spark.sql(
        f"CREATE TABLE `{table}` ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
        f"LOCATION '{path}'"
    )
    return spark.table(table)
