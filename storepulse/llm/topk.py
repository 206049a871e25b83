"""Exact top-k inner-product search by tiled matrix products.

Components become integers, ``floor(SCALE * x)`` with x as double, so scores are exact
integers. Candidates are dealt by hash to tiles and queries to blocks; every block
meets every tile once, as one task's matrix product, from which each query
keeps its best ``k``. The lists are then merged as a tree, ``FAN_IN`` at a
time, until each query has one. Nothing is broadcast, and a task holds one tile and one block.

Identical rows are counted before they are dealt, so one vector that stands
very often is one row with a count (``k`` copies at most can be among the best
``k``, which is exact); equal vectors under different ids spread by their ids.

Rows whose vec_id is null, or whose vector is null or holds null or non-finite
components, take no part. A query's own row is every row with its vec_id;
a query row that is repeated asks once. Vectors of different lengths are never
compared. Ties go to the smaller vec_id. Products are taken in double precision while no
sum can reach 2**53, in 64-bit integers otherwise. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storepulse.llm.common import staged

#: Production parameters.
K = 5
SCALE = 256
EVERY = 50
TILE_ROWS = 8192
BLOCK_ROWS = 2048
FAN_IN = 32
#: Queries of a block whose scores against a tile are held at once.
_STRIP = 256

_FOUND = "q long, query_id long, tile int, vec_id long, score long, copies int"


def quantised(vector: str, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def complete(vector: str) -> Column:
    """Whether the vector and all its components are there and finite."""
    return F.coalesce(F.forall(vector, lambda x: F.abs(x.cast("double")) < float("inf")), F.lit(False))


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.flatten().to_numpy().reshape(n, -1)


def best_of_tile(queries: np.ndarray, own: np.ndarray, tile: np.ndarray, ids: np.ndarray, k: int):
    """(row of query, column of tile, score) of each query's best ``k``; columns must come in ascending order of ids."""
    limit = float(np.abs(queries).max(initial=0)) * float(np.abs(tile).max(initial=0)) * max(1, tile.shape[1])
    exact = limit < 2.0**53
    kind, least = (np.float64, -np.inf) if exact else (np.int64, np.iinfo(np.int64).min)
    columns = np.ascontiguousarray(tile.T, kind)
    found = []
    for at in range(0, len(queries), _STRIP):
        scores = queries[at : at + _STRIP].astype(kind) @ columns
        barred = own[at : at + _STRIP, None] == ids[None, :]
        scores[barred] = least
        left = (~barred).sum(axis=1)
        rows = np.arange(len(scores))
        for turn in range(min(k, len(ids))):
            best = scores.argmax(axis=1)  # the first of equals, so the smallest id
            ok = left > turn
            found.append((rows[ok] + at, best[ok], scores[rows[ok], best[ok]].astype(np.int64)))
            scores[rows, best] = least
    return [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 3


def _search(k: int):
    def run(key: tuple, tile: pa.Table, block: pa.Table) -> pa.Table:
        schema = pa.schema([(n, pa.int32() if n in ("tile", "copies") else pa.int64()) for n in ("q", "query_id", "tile", "vec_id", "score", "copies")])
        if not len(tile) or not len(block):
            return schema.empty_table()
        order = np.argsort(tile.column("vec_id").to_numpy(), kind="stable")
        ids = tile.column("vec_id").to_numpy()[order]
        copies = tile.column("copies").to_numpy()[order]
        own = block.column("query_id").to_numpy()
        row, col, score = best_of_tile(_matrix(block.column("v"), len(block)), own, _matrix(tile.column("v"), len(tile))[order], ids, k)
        return pa.table(
            [
                block.column("q").to_numpy()[row], own[row], np.full(len(row), key[1].as_py(), np.int32),
                ids[col], score, copies[col],
            ],
            schema=schema,
        )

    return run


def _best(found: DataFrame, k: int, *within: str) -> DataFrame:
    by = Window.partitionBy("q", *within).orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("place", F.row_number().over(by)).filter(F.col("place") <= k)


def top_k(
    vectors: DataFrame,
    k: int = K,
    every: int = EVERY,
    scale: int = SCALE,
    tile_rows: int = TILE_ROWS,
    block_rows: int = BLOCK_ROWS,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the best ``k`` rows for each row whose vec_id is divisible by ``every``."""
    usable = vectors.filter(F.col("vec_id").isNotNull() & complete("embedding"))
    rows = usable.select(F.col("vec_id").cast("long").alias("vec_id"), quantised("embedding", scale).alias("v"))
    counted = rows.groupBy("vec_id", "v").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"))
    counted = staged(counted.withColumn("dim", F.size("v")), "topk-rows")
    asked = counted.filter(F.col("vec_id") % every == 0).withColumn("q", F.monotonically_increasing_id())
    asked = staged(asked.select("q", F.col("vec_id").alias("query_id"), "v", "dim"), "topk-queries")
    tiles = max(1, -(-counted.count() // tile_rows))
    blocks = max(1, -(-asked.count() // block_rows))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        df = df.withColumn(own, F.pmod(F.xxhash64("v", "query_id" if own == "block" else "vec_id"), F.lit(n_own)).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))))

    key = ["dim", "tile", "block"]
    left = dealt(counted, "tile", tiles, "block", blocks).groupBy(*key)
    right = dealt(asked, "block", blocks, "tile", tiles).groupBy(*key)
    found = left.cogroup(right).applyInArrow(_search(k), _FOUND)
    lists = tiles
    while lists > 1:  # a level of the tree: fan_in lists of a query become one
        found = _best(found.withColumn("tile", F.expr(f"tile div {fan_in}").cast("int")), k, "tile").drop("place")
        lists = -(-lists // fan_in)
    each = _best(found, k).withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    by = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id", "copy")
    ranked = each.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
