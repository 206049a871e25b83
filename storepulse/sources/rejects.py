"""Reject channel: records that cannot be used go aside with a reason, and are counted.

A record with a null measure is kept (sums skip it). One that lacks a key or a
date, or whose date cannot be read, is rejected: it would belong to no report. A
record that has none of the identifying fields is no record of the extract at
all (an error document, another extract) and stops the job.

``land`` writes an extract once, records and rejects apart, counts both in the same
pass by an observation, and stops the job if more are rejected than the limit allows, so
that a broken feed isn't published as a quiet week.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from typing import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASON = "reject_reason"


class TooManyRejects(ValueError):
    """More records of an extract were rejected than its limit allows."""


def missing(*paths: str) -> dict[str, Column]:
    """Rules that reject a record without one of these fields."""
    return {f"no {p}": F.col(p).isNull() for p in paths}


def marked(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """``df`` with ``reject_reason``: the first rule (a condition) that a record meets, null if none."""
    reason = F.coalesce(*[F.when(bad, F.lit(name)) for name, bad in rules.items()])
    return df.withColumn(REASON, reason)


def accepted(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    return marked(df, rules).filter(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(reject_reason, record): the rejected records as JSON text."""
    bad = marked(df, rules).filter(F.col(REASON).isNotNull())
    return bad.select(REASON, F.to_json(F.struct(*df.columns)).alias("record"))


def counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(reject_reason, records) by reason, accepted records under a null reason; one small row a task is shuffled."""
    return marked(df, rules).groupBy(REASON).agg(F.count(F.lit(1)).alias("records"))


@dataclass(frozen=True)
class Landed:
    """An extract that was landed: its records, its rejects, and how many of each."""

    records: DataFrame
    rejects: DataFrame
    n_records: int
    n_rejects: int
    by_reason: dict[str, int]


def land(df: DataFrame, rules: Mapping[str, Column], path: str, what: str, most: float = 0.01) -> Landed:
    """Write ``df`` under ``path`` in one pass, rejects apart; an error if over ``most`` of all records are rejected."""
    spark, seen = df.sparkSession, Observation(f"{what}-{uuid.uuid4().hex}")
    rows = marked(df, rules)
    each = {f"r{i}": F.count(F.when(F.col(REASON) == name, F.lit(1))).alias(f"r{i}") for i, name in enumerate(rules)}
    rows = rows.observe(seen, F.count(F.lit(1)).alias("n"), *each.values())
    rows.withColumn("rejected", F.col(REASON).isNotNull()).write.partitionBy("rejected").parquet(path)
    got = seen.get
    by_reason = {name: got[f"r{i}"] for i, name in enumerate(rules) if got[f"r{i}"]}
    bad = sum(by_reason.values())
    if bad > most * got["n"]:
        raise TooManyRejects(f"{what}: {bad} of {got['n']} records rejected ({by_reason}), over the limit of {most:.2%}; they lie in {path}")
    back = spark.read.schema(f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in rows.schema.fields)}, rejected boolean").parquet(path)
    good = back.filter(~F.col("rejected")).drop(REASON, "rejected")
    aside = back.filter(F.col("rejected")).select(REASON, F.to_json(F.struct(*df.columns)).alias("record"))
    return Landed(good, aside, got["n"] - bad, bad, by_reason)
