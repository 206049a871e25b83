"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the size and shingle contracts: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share, from ``spark.checkpoint.dir``.

    Where it is unset, the context's checkpoint folder; where there is none
    either, a local master (tests) gets a private one, and a cluster an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not configured and not context.getCheckpointDir():
        if not re.match(r"local($|\[)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="storepulse-llm-"))
    return (configured or context.getCheckpointDir()).rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet to the shared folder and read it back.

    Cuts the lineage: executors lost later cost a re-read, not a recomputation.
    The shuffle files of the write are of no more use then and go at its end, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEAN_UP, None)
    spark.conf.set(_CLEAN_UP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEAN_UP)
        else:
            spark.conf.set(_CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: str | Column) -> Column:
    """Number of runs without ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def seeded_hash(seed: int, *columns: str) -> Column:
    """60-bit hash of the seed and the columns as text, from MD5 so that any SQL engine can repeat it."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, with underscores appended until no column of ``df`` has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def set_aside(df: DataFrame, names: Collection[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with its columns of these names (in any case) renamed, and the selection that gives all of its columns back."""
    aside = {c: free_name(df, f"_own_{c}") for c in df.columns if c.lower() in names}
    return df.withColumnsRenamed(aside), [F.col(f"`{aside.get(c, c)}`").alias(c) for c in df.columns]
