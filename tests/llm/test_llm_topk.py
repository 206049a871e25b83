"""Exact top-k against all scores in plain Python."""

import math
import random

import pytest

from storepulse.llm import topk


def plain(rows, k=5, every=50):
    ok = [(i, tuple(math.floor(256 * float(x)) for x in v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v in sorted({r for r in ok if r[0] % every == 0}):
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for j, w in ok if j != i and len(w) == len(v))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(scored[:k])]
    return sorted(out)


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def vectors(n=400, dim=8, seed=0):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1) for _ in range(dim)]) for i in range(n)]


@pytest.mark.parametrize("tile,block,fan", [(8192, 2048, 32), (30, 3, 2)])
def test_against_all_scores(spark, tile, block, fan):
    same = [0.5] * 8
    rows = vectors() + [(1000 + i, same) for i in range(150)] + [(1050, same)] * 9
    rows += [(2000, [math.nan] * 8), (2050, [math.inf] + same[1:]), (2100, None), (None, same), (2150, [None] * 8), (2200, [1.0, 2.0]), (2250, []), (2251, [])]
    out = topk.top_k(table(spark, rows), tile_rows=tile, block_rows=block, fan_in=fan)
    assert sorted(map(tuple, out.collect())) == plain(rows)


def test_few_rows_and_none(spark):
    rows = vectors(3)
    assert sorted(map(tuple, topk.top_k(table(spark, rows)).collect())) == plain(rows)
    assert topk.top_k(table(spark, [])).collect() == []
    assert topk.top_k(table(spark, [(0, [1.0])])).collect() == []


def test_large_components_stay_exact(spark):
    rows = [(50 * i, [3e6 + i * 7.25, -2e6 + i, 1.5e6]) for i in range(20)]
    assert sorted(map(tuple, topk.top_k(table(spark, rows)).collect())) == plain(rows)
