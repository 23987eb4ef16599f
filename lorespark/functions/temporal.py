"""Text dates and date-times: validation, comparable keys, as-of predicates, relative phrases."""

from __future__ import annotations

import calendar
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SHAPES = re.compile(r"(\d{4})-(\d\d)-(\d\d)(?:T(\d\d):(\d\d):(\d\d)(?:Z|\+00:00))?")


def check_temporal(value: str | None) -> str | None:
    """A date or UTC date-time in canonical form; empty and None pass; anything else raises ValueError."""
    if not value:
        return value
    m = SHAPES.fullmatch(value)
    if not m:
        raise ValueError(f"not an ISO date or UTC date-time: {value!r}")
    year, month, day = (int(x) for x in m.groups()[:3])
    if not 1 <= month <= 12 or not 1 <= day <= calendar.monthrange(max(year, 1), month)[1]:
        raise ValueError(f"no such day: {value!r}")
    if m[4] and not (int(m[4]) < 24 and int(m[5]) < 60 and int(m[6]) < 60):
        raise ValueError(f"no such time: {value!r}")
    return value.replace("+00:00", "Z")


def _day_only(c: Column) -> Column:
    return (F.length(c) == 10) & (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")


def start_key(c: Column) -> Column:
    return F.when(_day_only(c), F.concat(c, F.lit("T00:00:00Z"))).otherwise(c)


def end_key(c: Column) -> Column:
    return F.when(_day_only(c), F.concat(c, F.lit("T23:59:59Z"))).otherwise(c)


def valid_at(as_of: str | None, start: str = "valid_from", end: str = "valid_to") -> Column:
    """Whether the closed interval holds `as_of`; null bounds are open, no `as_of` holds always."""
    as_of = check_temporal(as_of)
    if not as_of:
        return F.lit(True)
    at = as_of if "T" in as_of else f"{as_of}T00:00:00Z"
    a, b = F.col(start), F.col(end)
    return (a.isNull() | (start_key(a) <= at)) & (b.isNull() | (end_key(b) >= at))


def relative_days(c: Column) -> Column:
    """struct(days, tolerance) of the first relative phrase that a question holds, by this order; null without any."""
    q = F.lower(c)
    number = lambda pattern: F.regexp_extract(q, pattern, 1).cast("int")
    days, weeks, months = r"(\d+)\s+days?\s+ago", r"(\d+)\s+weeks?\s+ago", r"(\d+)\s+months?\s+ago"
    # Phrases, days back and tolerances, in order of precedence.
    rules = [
        (days, number(days), 2), (r"a\s+couple\s+(?:of\s+)?days?\s+ago", F.lit(2), 2), ("yesterday", F.lit(1), 1),
        (r"a\s+week\s+ago", F.lit(7), 3), (weeks, number(weeks) * 7, 5), (r"last\s+week", F.lit(7), 3),
        (r"a\s+month\s+ago", F.lit(30), 7), (months, number(months) * 30, 10), (r"last\s+month", F.lit(30), 7),
        (r"last\s+year", F.lit(365), 30), (r"a\s+year\s+ago", F.lit(365), 30), ("recently", F.lit(14), 14),
    ]
    return F.coalesce(*[F.when(q.rlike(p), F.struct(d.cast("int").alias("days"), F.lit(t).alias("tolerance"))) for p, d, t in rules])


def temporal_boost(delta: Column, tolerance: Column, most: float = 0.40) -> Column:
    """Full boost inside the tolerance, then linearly down to none at three times the tolerance."""
    fading = most * (1.0 - (delta - tolerance) / (tolerance * 2.0))
    return F.when(delta <= tolerance, F.lit(most)).when(delta <= tolerance * 3, fading).otherwise(F.lit(0.0))
