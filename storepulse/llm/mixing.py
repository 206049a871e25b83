"""Mixing sources to target weights by capped water-filling.

A source with weight ``w`` and cap ``c`` (``max_epochs`` times its size) gets
``min(c, w * level)``, where ``level`` is what is left for the sources that are
not clamped, divided by their weights. With the sources sorted by ``c / w`` the
clamped ones are a prefix, and the level is the largest of the quotients
``(total - caps before) / (weights from here on)``: they rise while sources are
clamped and fall afterwards. So no loop is needed.

A target is then taken as whole repetitions of every document of the source
and one fractional repetition: documents in the order of a seeded hash until
the remainder is reached, the last one in part. Whether a document belongs to
it depends on its own hash and one threshold hash for its source, so the
documents are never sorted and a hot source is not one task: (source, hash
range) sums find the range with the threshold, and only the documents in
that range are summed by hash.

Nulls: null text has size 0; a null source is a source of its own, the last;
a null doc_id hashes as empty text. Repeated rows are separate documents with the
same hash; where the threshold falls on them they share the remainder by
size. An empty table gives no rows. Other columns pass through unless they
carry the name of a result column, which is then replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storepulse.llm.common import n_words, seeded_hash, set_aside, staged

#: Production parameters.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
SEED = 20
#: 60-bit hashes fall into this many equal ranges.
RANGES = 4096
_RESULT = {"size", "source_size", "target", "copies", "part", "taken", "h", "s", "whole", "cut", "room", "at_cut"}
_RANGE_WIDTH = (1 << 60) // RANGES


def source_targets(sizes: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """(source, source_size) -> also ``target`` (double), ``whole`` (repetitions) and ``rest`` (words).

    Weights repeat over the sources in code-point order, null last. One row
    per source: the sorts below see sources, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(
        F.array(*[F.lit(int(w)) for w in weights]),
        (F.row_number().over(by_name) - 1) % len(weights) + 1,
    ).cast("long")
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    return (
        sizes.withColumn("weight", weight)
        .withColumn("cap", F.col("source_size") * max_epochs)
        .withColumn("quotient", left.cast("double") / F.sum("weight").over(onward).cast("double"))
        .withColumn("level", F.max("quotient").over(everything))
        .withColumn("target", F.least(F.col("cap").cast("double"), F.col("weight") * F.col("level")))
        .withColumn("want", F.floor("target"))
        .withColumn("whole", F.when(F.col("source_size") > 0, F.expr("want div source_size")).otherwise(0))
        .withColumn("rest", F.when(F.col("source_size") > 0, F.expr("want % source_size")).otherwise(0))
        .select("source", "source_size", "target", "whole", "rest")
    )


def _thresholds(slim: DataFrame, targets: DataFrame) -> DataFrame:
    """Add to each source the hash at which its fractional repetition ends.

    ``cut``: the first hash whose documents do not all fit; ``room``: words
    left there; ``at_cut``: words of the documents with that hash. Sources
    without a rest have null.
    """
    in_range = F.expr(f"h div {_RANGE_WIDTH}L")
    by_range = slim.groupBy("source", in_range.alias("r")).agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)
    found = (
        by_range.withColumn("done", F.coalesce(F.sum("words").over(before), F.lit(0)))
        .join(targets.filter("rest > 0").withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .filter("done <= rest and rest < done + words")
        .select("s", "r", "done", "rest")
    )
    by_hash = (
        slim.withColumn("r_doc", in_range)
        .join(found, F.col("source").eqNullSafe(F.col("s")) & (F.col("r_doc") == F.col("r")))
        .groupBy("s", "h", "done", "rest")
        .agg(F.sum("size").alias("words"))
    )
    before = Window.partitionBy("s").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        by_hash.withColumn("start", F.col("done") + F.coalesce(F.sum("words").over(before), F.lit(0)))
        .filter("start <= rest and rest < start + words")
        .select("s", F.col("h").alias("cut"), (F.col("rest") - F.col("start")).alias("room"), F.col("words").alias("at_cut"))
    )
    return targets.join(cuts, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "rest")


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: size, source_size, target, ``copies`` (whole ones), ``part`` (words of one more) and taken."""
    rows = docs.drop(*[c for c in docs.columns if c.lower() in _RESULT])
    sized = rows.withColumn("size", n_words("text")).withColumn("h", seeded_hash(seed, "doc_id"))
    slim = staged(sized.select("source", "size", "h"), "mix")
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = staged(_thresholds(slim, source_targets(sizes, weights, max_epochs)), "mix-plan")
    plan = plan.withColumnRenamed("source", "s")
    joined = sized.join(plan, F.col("source").eqNullSafe(F.col("s")))
    return (
        joined.withColumn("copies", F.col("whole") + F.when(F.col("h") < F.col("cut"), 1).otherwise(0))
        .withColumn("part", F.when(F.col("h") == F.col("cut"), F.expr("size * room div at_cut")).otherwise(0))
        .withColumn("taken", F.col("copies") * F.col("size") + F.col("part"))
        .drop("s", "whole", "cut", "room", "at_cut", "h")
    )


def _partly(seed: int) -> Column:
    """Seeded draw by which a fractional repetition becomes a whole one in the corpus.

    By doc_id and text, so that documents that share an id, or have none, are drawn each for itself.
    """
    return (F.col("part") > 0) & (seeded_hash(seed + 1, "doc_id", "text") * 1.0 / float(1 << 60) < F.col("part") / F.col("size"))


def repeated(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it.

    A document cut short would be a new, broken text: where ``mix`` takes a
    part (one hash per source) the document is repeated wholly or not, by a
    seeded draw with that part as its chance. A document without words costs
    the mix nothing and stays once.
    """
    rows, columns = set_aside(docs, _RESULT | {"_n", "_copy"})
    n = F.when(F.col("size") == 0, 1).otherwise(F.col("copies") + F.when(_partly(seed), 1).otherwise(0)).cast("int")
    return (
        mix(rows, weights, max_epochs, seed)
        .withColumn("_n", n)
        .filter("_n > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
        .select(*columns)
    )
