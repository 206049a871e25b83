"""Spark session settings the reports rely on.

* UTC session time zone: every timestamp is compared and truncated in UTC.
* AQE on, with partition coalescing and skew-join splitting: aggregated
  report frames are tiny, so post-shuffle partitions are merged; a hot
  join key on the lineitem side is split across tasks.
* Broadcast only through the planner's own size check
  (``autoBroadcastJoinThreshold`` from file statistics, AQE from runtime
  shuffle sizes); no operator forces a broadcast of a frame that grows with
  data. The static threshold is kept small (2 MB) so that only
  dimension-sized tables qualify: a fact table is never picked as the build
  side just because a small test file happens to fit.
* No UI server.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.autoBroadcastJoinThreshold": str(2 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # Generated stage methods above HotSpot's JIT limit run interpreted; with
    # this cap such a stage falls back to per-expression codegen instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "storepulse",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the report defaults.

    On a cluster leave ``master`` unset (the launcher decides) and size
    ``shuffle_partitions`` to the data: with AQE coalescing, a generous
    number costs little on small report aggregates.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULTS)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    It must be a folder that the driver and all executors share; without the
    setting (or a checkpoint directory set on the context) this is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        raise ValueError("no staging folder: set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir() or configured


def stage_path(spark: SparkSession, name: str) -> str:
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/staged/{name}"


def stage(df, name: str):
    """Write a frame to the shared checkpoint folder and read it back.

    Cuts lineage durably: if executors are lost afterwards, downstream
    reports re-read the parquet instead of recomputing the joins.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def explain_text(df, mode: str = "formatted") -> str:
    """The physical plan as text (for plan checks in tests)."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
