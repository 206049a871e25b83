"""Reporting windows and day arithmetic.

The clock is always a parameter (``as_of``); no operator reads the wall
clock, so a report is reproducible and every task of a job sees the same
instant.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

UTC = dt.timezone.utc
MICROS_PER_DAY = 86_400_000_000

END_POLICIES = ("main", "monday", "full_week")


@dataclass(frozen=True)
class ReportWindow:
    """An inclusive ``[start, end]`` timestamp range with a name and a rank."""

    seq: int
    name: str
    start: dt.datetime
    end: dt.datetime

    def contains(self, ts: Column) -> Column:
        return ts.between(F.lit(self.start), F.lit(self.end))


def as_utc(value: dt.datetime | dt.date | str) -> dt.datetime:
    """Normalise a date, naive datetime (taken as UTC) or ISO text to aware UTC."""
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if value.tzinfo is None:
        return value.replace(tzinfo=UTC)
    return value.astimezone(UTC)


def mondays(as_of: dt.datetime | dt.date) -> tuple[dt.date, dt.date]:
    """(latest Monday on or before ``as_of``, the Monday a week before it)."""
    day = as_utc(as_of).date()
    latest = day - dt.timedelta(days=day.weekday())
    return latest, latest - dt.timedelta(days=7)


def fiscal_year_start(day: dt.date) -> dt.date:
    """1 April of the April-March fiscal year that contains ``day``."""
    year = day.year if day.month >= 4 else day.year - 1
    return dt.date(year, 4, 1)


def window_end(as_of: dt.datetime | dt.date, policy: str = "main") -> dt.datetime:
    """Inclusive end instant of the reporting period.

    ``main``: the day after the latest Monday, 23:59:59 (the weekly job's
    behaviour, so the "week" spans nine days); ``monday``: the latest
    Monday, 23:59:59; ``full_week``: the Sunday before it, 23:59:59.
    """
    latest, _ = mondays(as_of)
    shift = {"main": 1, "monday": 0, "full_week": -1}
    if policy not in shift:
        raise ValueError(f"end_policy must be one of {END_POLICIES}, got {policy!r}")
    day = latest + dt.timedelta(days=shift[policy])
    return dt.datetime(day.year, day.month, day.day, 23, 59, 59, tzinfo=UTC)


def reporting_windows(
    as_of: dt.datetime | dt.date,
    end_policy: str = "main",
    end: dt.datetime | str | None = None,
    starts: Sequence[dt.datetime | str] | None = None,
) -> list[ReportWindow]:
    """Week, month-to-date and fiscal-year-to-date windows sharing one end.

    Week starts on the previous Monday, month on the 1st of that Monday's
    month, fiscal year on the 1st of April before it. ``end`` and ``starts``
    override the computed instants.
    """
    _, previous = mondays(as_of)
    computed = (
        previous,
        previous.replace(day=1),
        fiscal_year_start(previous),
    )
    chosen = [as_utc(s) for s in starts] if starts is not None else [as_utc(d) for d in computed]
    if len(chosen) != 3:
        raise ValueError("starts must hold three instants: week, month, fiscal year")
    stop = as_utc(end) if end is not None else window_end(as_of, end_policy)
    names = ("week", "month", "fy")
    return [ReportWindow(i + 1, n, s, stop) for i, (n, s) in enumerate(zip(names, chosen))]


def window_span(windows: Iterable[ReportWindow]) -> tuple[dt.datetime, dt.datetime]:
    """Smallest range covering every window (one pushed-down scan bound)."""
    ws = list(windows)
    return min(w.start for w in ws), max(w.end for w in ws)


def elapsed_days(later: Column, earlier: Column) -> Column:
    """Whole elapsed 24-hour periods, floored (-1 hour gives -1)."""
    diff = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(diff / F.lit(MICROS_PER_DAY))


def calendar_days(later: Column, earlier: Column) -> Column:
    """Difference of calendar dates, as a long."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("long")


def timestamp_lit(value: dt.datetime | dt.date | str) -> Column:
    return F.lit(as_utc(value))


def parse_timestamp(col: Column, formats: Sequence[str] | None = None, day_first: bool = False, strict: bool = True) -> Column:
    """Parse text timestamps written in any of several layouts.

    The text's shape says its layout, so each row is parsed once: ISO-8601 (offsets and
    ``Z`` included), names of months, or slashes. Slashed dates are month first
    unless ``day_first``; the other reading is left for those whose numbers
    cannot be read that way. Null and blank text gives null; other text that no
    layout fits is an error, or null unless ``strict``. Explicit ``formats`` are tried in order, after ISO-8601.
    """
    text = F.trim(col.cast("string"))
    if formats is not None:
        parsed = F.coalesce(F.try_to_timestamp(text), *[F.try_to_timestamp(text, F.lit(f)) for f in formats])
    else:
        parsed = _parsed_by_shape(text, day_first)
    if not strict:
        return parsed
    error = F.raise_error(F.concat(F.lit("not a timestamp: "), text)).cast("timestamp")
    return F.when(text.isNull() | (text == F.lit("")), F.lit(None).cast("timestamp")).otherwise(F.coalesce(parsed, error))


#: Shape of a text and its layout; tried in this order, without a time of day and with one.
_NAMED_LAYOUTS = (
    (r"^\d{1,2} [A-Za-z]{3} \d{4}", "d MMM yyyy"),
    (r"^[A-Za-z]{3} \d{1,2}, \d{4}", "MMM d, yyyy"),
    (r"^\d{1,2}-[A-Za-z]{3}-\d{4}", "d-MMM-yyyy"),
)
_TIME = " HH:mm:ss"


def _parsed_by_shape(text: Column, day_first: bool) -> Column:
    """The timestamp by the one layout that fits the text's shape; null where none does."""
    timed = F.substring(text, -3, 1) == F.lit(":")

    def by(layout: str) -> Column:
        return F.when(timed, F.try_to_timestamp(text, F.lit(layout + _TIME))).otherwise(F.try_to_timestamp(text, F.lit(layout)))

    leading, second = F.substring_index(text, "/", 1), F.substring_index(F.substring_index(text, "/", 2), "/", -1)
    first_over, second_over = (F.try_to_number(F.lpad(n, 2, "0"), F.lit("99")) > 12 for n in (leading, second))
    day_leads = ~F.coalesce(second_over, F.lit(False)) if day_first else F.coalesce(first_over, F.lit(False))
    parsed = F.when(F.substring(text, 5, 1) == F.lit("-"), F.try_to_timestamp(text))
    parsed = parsed.when(F.instr(text, "/") > 0, F.when(day_leads, by("d/M/yyyy")).otherwise(by("M/d/yyyy")))
    for shape, layout in _NAMED_LAYOUTS:
        parsed = parsed.when(text.rlike(shape), by(layout))
    return parsed.otherwise(F.try_to_timestamp(text))
