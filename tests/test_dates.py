import pytest
import datetime as dt

from pyspark.sql import functions as F

from helpers import ts
from storepulse.functions.dates import (
    elapsed_days,
    mondays,
    parse_timestamp,
    reporting_windows,
    window_end,
)


def test_windows_fixture_clock():
    w = reporting_windows(ts(2001, 8, 1, 12), "main")
    assert [x.name for x in w] == ["week", "month", "fy"]
    assert [x.start for x in w] == [ts(2001, 7, 23), ts(2001, 7, 1), ts(2001, 4, 1)]
    assert all(x.end == ts(2001, 7, 31, 23, 59, 59) for x in w)


def test_end_policies():
    as_of = ts(2001, 8, 1, 12)
    assert window_end(as_of, "main") == ts(2001, 7, 31, 23, 59, 59)
    assert window_end(as_of, "monday") == ts(2001, 7, 30, 23, 59, 59)
    assert window_end(as_of, "full_week") == ts(2001, 7, 29, 23, 59, 59)


def test_run_on_a_monday():
    latest, previous = mondays(dt.date(2024, 8, 12))
    assert latest == dt.date(2024, 8, 12) and previous == dt.date(2024, 8, 5)
    w = reporting_windows(dt.date(2024, 8, 12))
    assert w[0].end == ts(2024, 8, 13, 23, 59, 59)


def test_fiscal_year_in_february():
    # previous Monday 2025-02-03: month from 2025-02-01, fiscal year from 2024-04-01
    w = reporting_windows(ts(2025, 2, 12, 9))
    assert w[1].start == ts(2025, 2, 1)
    assert w[2].start == ts(2024, 4, 1)


def test_week_starting_in_previous_month():
    # previous Monday 2024-07-29 -> month window starts 2024-07-01 and contains the week
    w = reporting_windows(ts(2024, 8, 6))
    assert w[0].start == ts(2024, 7, 29) and w[1].start == ts(2024, 7, 1)


def test_explicit_starts_and_end():
    w = reporting_windows(ts(2024, 8, 6), starts=["2024-07-29T00:00:00Z", "2024-07-01", "2024-04-01"],
                          end="2024-08-04T23:59:59Z")
    assert w[2].start == ts(2024, 4, 1) and w[0].end == ts(2024, 8, 4, 23, 59, 59)


def test_elapsed_days_floor(spark):
    now = ts(2001, 8, 1, 12)
    df = spark.createDataFrame(
        [(ts(2001, 8, 1, 13),), (ts(2001, 8, 1, 11),), (ts(2001, 7, 31, 12),), (ts(2001, 7, 31, 12, 0, 1),), (None,)],
        "t timestamp",
    )
    got = [r[0] for r in df.select(elapsed_days(F.lit(now), F.col("t"))).collect()]
    # -1 hour is -1 day (floor), +1 hour is 0, exactly 24 h is 1, 1 s short is 0
    assert got == [-1, 0, 1, 0, None]


def test_parse_mixed_timestamps(spark):
    texts = ["2024-08-12T10:20:30.000Z", "2024-08-12T10:20:30+05:30", "2024-08-12 10:20:30", "2024-08-12", "08/12/2024",
             "03/04/2024", "13/04/2024", "12 Aug 2024", "Aug 12, 2024", "8/2/2024 01:02:03", None, "  "]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(parse_timestamp(F.col("s"))).collect()]
    day = dt.datetime(2024, 8, 12)
    assert got == [
        dt.datetime(2024, 8, 12, 10, 20, 30), dt.datetime(2024, 8, 12, 4, 50, 30), dt.datetime(2024, 8, 12, 10, 20, 30),
        day, day, dt.datetime(2024, 3, 4), dt.datetime(2024, 4, 13), day, day, dt.datetime(2024, 8, 2, 1, 2, 3), None, None]
    first = spark.createDataFrame([("03/04/2024",)], "s string").select(parse_timestamp(F.col("s"), day_first=True)).first()[0]
    assert first == dt.datetime(2024, 4, 3)


def test_unparseable_text_is_an_error(spark):
    df = spark.createDataFrame([("garbage",)], "s string")
    with pytest.raises(Exception, match="not a timestamp: garbage"):
        df.select(parse_timestamp(F.col("s"))).collect()


def test_percent_text(spark):
    from storepulse.functions.economics import as_percent_text

    values = [12.3, 12.0, 831.88, 0.0, -4.5, 12345678.91, 8.3e9, 1e7, 0.005, 123456789012.349, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(as_percent_text(F.col("v"))).collect()]
    want = [None if v is None else f"{float(f'{v:.2f}') if v != 0.005 else 0.01}%" for v in values]
    assert got == want


def test_layout_by_shape_equals_trying_every_layout(spark):
    import random

    rng, texts = random.Random(6), ["2024", "2024-08", "2024-8-2", "31/31/2024", "00/12/2024", "2/30/2024", "5/1", "12-Aug-2024", "1 Foo 2024",
                                    "Aug 5, 2024 10:11:12", "2024-08-12T10:20", "2024-02-30", "12 Aug 2024 25:00:00", "12/Aug/2024", "x"]
    layouts = ["%Y-%m-%dT%H:%M:%S.123Z", "%Y-%m-%dT%H:%M:%S+05:30", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d", "%d/%m/%Y", "%m/%d/%Y",
               "%d/%m/%Y %H:%M:%S", "%m/%d/%Y %H:%M:%S", "%d %b %Y", "%d %b %Y %H:%M:%S", "%b %d, %Y", "%d-%b-%Y"]
    for _ in range(400):
        t = dt.datetime(1990, 1, 1) + dt.timedelta(seconds=rng.randint(0, 10**9))
        texts.append(t.strftime(rng.choice(layouts)))
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    for day_first in (False, True):
        slashed = ["d/M/yyyy", "M/d/yyyy"] if day_first else ["M/d/yyyy", "d/M/yyyy"]
        each = ["yyyy-MM-dd'T'HH:mm:ss.SSSXXX", "yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "d MMM yyyy HH:mm:ss", "d MMM yyyy",
                "MMM d, yyyy", "d-MMM-yyyy", *[f"{s} HH:mm:ss" for s in slashed], *slashed]
        tried = F.coalesce(F.try_to_timestamp("s"), *[F.try_to_timestamp("s", F.lit(f)) for f in each])
        rows = df.select("s", parse_timestamp(F.col("s"), day_first=day_first, strict=False).alias("a"), tried.alias("b")).collect()
        # The shape reads a few layouts more (a time behind a month's name); it never reads one differently.
        assert all(r.a == r.b or r.b is None for r in rows), [r for r in rows if r.a != r.b]
        assert sum(r.a is not None for r in rows) >= 400
