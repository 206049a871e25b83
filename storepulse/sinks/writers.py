"""Publishing report frames.

A batch of reports is written under its own run folder,
``<root>/runs/<run>/<report>``, and becomes the current one only when its
manifest is added as the last step. A batch that fails leaves no manifest, so readers go
on with the former batch. A report is range-partitioned by window and
then key and sorted within each range, so its files in the order of their names are the report in
order. How many files follows from its size: adaptive execution merges neighbouring ranges up
to the advisory size, so a small report is one file and one of a billion
stores is written by many tasks. Per-lot tables keep their partitioning.
"""

from __future__ import annotations

import time
import uuid
from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FORMATS = ("parquet", "csv", "json")


def write_report(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    files: int | None = None,
    partition_by: Sequence[str] | None = None,
    sort_by: Sequence[str] | None = None,
) -> str:
    """Write one report: in order over ranges of ``sort_by`` (``files`` of them, or as many as its size asks for), else as it is partitioned."""
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    out = df
    if sort_by:
        ranged = df.repartitionByRange(*sort_by) if files is None else df.repartitionByRange(files, *sort_by)
        out = ranged.sortWithinPartitions(*sort_by)
    elif files is not None:
        # A shuffle of finished rows: coalescing would also pull the last aggregation into these tasks.
        out = df.repartition(files)
    writer = out.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def report_order(columns: Sequence[str]) -> list[str]:
    """Window first, then the key and what follows it."""
    return sorted(columns, key=lambda c: c != "window_seq")


def publish(
    reports: Mapping[str, DataFrame],
    root: str,
    fmt: str = "parquet",
    large: Sequence[str] = (),
    run_id: str | None = None,
    written: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Write every report of a batch under its run folder, then the batch's manifest; returns the paths.

    Names in ``large`` keep their partitions and order. ``written`` names
    reports of this batch that the caller has already written.
    """
    root, run = root.rstrip("/"), run_id or new_run()
    out = dict(written or {})
    for name, df in reports.items():
        path = f"{root}/runs/{run}/{name}"
        if name in large:
            out[name] = write_report(df, path, fmt)
        else:
            out[name] = write_report(df, path, fmt, sort_by=report_order(df.columns))
    if out:
        spark = next(iter(reports.values())).sparkSession
        rows = [(run, name, path, fmt) for name, path in sorted(out.items())]
        manifest = spark.createDataFrame(rows, "run string, report string, path string, format string")
        manifest.coalesce(1).write.mode("errorifexists").json(f"{root}/manifests/{run}")
    return out


def new_run() -> str:
    """Run names sort by time."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def published_runs(spark: SparkSession, root: str) -> list[str]:
    """Manifest folders of the batches published under ``root``, the latest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/manifests")
    fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not fs.exists(folder):
        return []
    return sorted((s.getPath().toString() for s in fs.listStatus(folder)), reverse=True)


def read_published(spark: SparkSession, root: str, report: str, ordered: bool = False) -> DataFrame:
    """The report of the last batch that was published whole; ``ordered``: by window and key.

    Manifests are read from the latest back to the first that has the report.
    """
    last = None
    for manifest in published_runs(spark, root):
        listed = spark.read.schema("run string, report string, path string, format string").json(manifest)
        last = listed.filter(F.col("report") == report).first()
        if last is not None:
            break
    if last is None:
        raise ValueError(f"no published report {report!r} under {root}")
    reader = spark.read.format(last["format"])
    if last["format"] == "csv":
        reader = reader.option("header", True).option("inferSchema", True)
    df = reader.load(last["path"])
    return df.orderBy(*report_order(df.columns)) if ordered else df
