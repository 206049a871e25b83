"""Core operators against brute-force Python on random small fixtures."""

import datetime as dt
import math
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import LOT_SCHEMA, ts
from storepulse.functions.dates import reporting_windows
from storepulse.operators import inventory
from storepulse.operators.windowed import Exclusion, windowed_totals
from pyspark.sql import functions as F

AS_OF = ts(2001, 8, 1, 12)
WINDOWS = reporting_windows(AS_OF)
KEYS = st.sampled_from(["A", "B", "C", None])
TERR = st.sampled_from(["T1", "BAD", None])
VALUES = st.one_of(st.none(), st.floats(min_value=-1000, max_value=1000, allow_nan=False).map(lambda x: round(x, 2)))
# instants from 2001-03-25 to 2001-08-03, second resolution
WHEN = st.integers(min_value=0, max_value=131 * 86400).map(lambda s: ts(2001, 3, 25) + dt.timedelta(seconds=s))

ROWS = st.lists(st.tuples(WHEN, KEYS, TERR, VALUES), min_size=0, max_size=25)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def _brute(rows, running):
    """Per (key, window): present?, total -- following the per-window frame semantics."""
    out = {}
    for w in WINDOWS:
        groups = defaultdict(list)
        for when, key, terr, v in rows:
            if key is None or terr == "BAD":
                continue
            if w.start <= when <= w.end:
                groups[key].append(v)
        for k, vals in groups.items():
            out[(k, w.seq)] = sum(x for x in vals if x is not None)
    if not running:
        return out
    cum = {}
    for k in {k for k, _ in out}:
        acc, seen = 0.0, False
        for w in WINDOWS:
            if (k, w.seq) in out:
                seen = True
                acc += out[(k, w.seq)]
            if seen:
                cum[(k, w.seq)] = acc
    return cum


@SETTINGS
@given(rows=ROWS, running=st.booleans())
def test_windowed_totals_match_brute_force(spark, rows, running):
    df = spark.createDataFrame(rows, "ts timestamp, k string, terr string, v double")
    out = windowed_totals(df, "ts", {"v": F.col("v")}, WINDOWS, keys=["k"],
                          exclude=Exclusion("terr", ("BAD",)), running=running, digits=None, suffix="")
    got = {(r.k, r.window_seq): r.v for r in out.collect()}
    want = _brute(rows, running)
    assert set(got) == set(want)
    for key, val in want.items():
        assert math.isclose(got[key], val, rel_tol=1e-9, abs_tol=1e-9)


@SETTINGS
@given(rows=ROWS)
def test_ungrouped_totals_have_every_window(spark, rows):
    df = spark.createDataFrame(rows, "ts timestamp, k string, terr string, v double")
    out = windowed_totals(df, "ts", {"v": F.col("v")}, WINDOWS, digits=None, suffix="")
    got = {r.window_seq: r.v for r in out.collect()}
    for w in WINDOWS:
        want = sum(v for when, _, _, v in rows if v is not None and w.start <= when <= w.end)
        assert math.isclose(got[w.seq], want, rel_tol=1e-9, abs_tol=1e-9)


LOT = st.tuples(
    st.sampled_from(["A", "B", None]),                                   # category
    TERR,                                                                 # territory
    st.sampled_from(["creditnote", "InStock", "Sold", None]),             # status
    st.floats(min_value=0, max_value=100, allow_nan=False).map(lambda x: round(x, 1)),   # rate
    st.integers(min_value=0, max_value=50).map(float),                   # subqty
    st.integers(min_value=0, max_value=50).map(float),                   # soldqty
    st.one_of(st.none(), st.integers(min_value=-200 * 24, max_value=400 * 24)),          # invoice age, hours
)


def _brute_grid(lots):
    keys = {c for c, t, *_ in lots if c is not None and t != "BAD"}
    out = {(k, b): 0.0 for k in keys for b in range(1, 5)}
    for cat, terr, status, rate, sub, sold, hours in lots:
        if cat is None or terr == "BAD" or hours is None:
            continue
        days = math.floor(hours / 24)
        if days <= 1:
            continue
        b = 1 if days <= 45 else 2 if days <= 90 else 3 if days <= 135 else 4
        qty = sub - (sold - (sub if status == "creditnote" else 0))
        out[(cat, b)] += qty * rate
    return out


@SETTINGS
@given(lots=st.lists(LOT, min_size=0, max_size=25))
def test_age_grid_matches_brute_force(spark, lots):
    rows = [(None, terr, cat, status, rate, sub, sold, None,
             None if h is None else AS_OF - dt.timedelta(hours=h))
            for cat, terr, status, rate, sub, sold, h in lots]
    df = spark.createDataFrame(rows, LOT_SCHEMA)
    out = inventory.inventory_age_grid(df, AS_OF, "category", ("BAD",), digits=None)
    got = {(r.category, r.bucket_seq): r.value_lakh * 1e5 for r in out.collect()}
    want = _brute_grid(lots)
    assert set(got) == set(want)
    for key, val in want.items():
        assert math.isclose(got[key], val, rel_tol=1e-9, abs_tol=1e-6)
