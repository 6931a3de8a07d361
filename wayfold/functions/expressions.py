"""Column expressions shared by the operators. All null-propagating unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros(later, earlier) -> Column:
    """later - earlier in whole microseconds."""
    return F.timestamp_diff("MICROSECOND", col(earlier), col(later))


def minutes(later, earlier) -> Column:
    return micros(later, earlier) / F.lit(60e6)


def since_epoch(ts) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH), col(ts))


def whole_minute(ts) -> Column:
    """Whether a time has no seconds; false for null."""
    return F.coalesce(since_epoch(ts) % 60_000_000 == 0, F.lit(False))


def floor_hour(ts) -> Column:
    """The hour's start, still without a time zone."""
    return F.date_trunc("HOUR", col(ts)).cast("timestamp_ntz")


def quantile(values, q: float) -> Column:
    """Exact, with linear interpolation; null for no values."""
    return F.percentile(col(values), F.lit(q))


def quantile_if(values, condition, q: float) -> Column:
    return F.percentile(F.when(condition, col(values)), F.lit(q))


def round2(x) -> Column:
    """Two decimals, halves up, in plain double arithmetic."""
    return F.floor(col(x) * 100 + F.lit(0.5)) / F.lit(100.0)


def per_100k(count, rides) -> Column:
    """Null without rides."""
    return F.try_divide(col(count) * F.lit(100000.0), col(rides))


def share(condition) -> Column:
    """Share of rows where the condition holds; null counts as not."""
    return F.avg(F.coalesce(condition, F.lit(False)).cast("int"))


def bins(value, edges: list, labels: list[str], right: bool = True, other: str | None = None) -> Column:
    """A label for each stretch between edges, other outside and for null. right: stretches hold
    their upper edge."""
    v, out = col(value), F.lit(other).cast("string")
    for low, high, label in reversed(list(zip(edges[:-1], edges[1:], labels, strict=True))):
        inside = (v > low) & (v <= high) if right else (v >= low) & (v < high)
        out = F.when(inside, F.lit(label)).otherwise(out)
    return out


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    h = F.pow(F.sin((p2 - p1) / 2), F.lit(2.0)) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(col(lon2) - col(lon1)) / 2), F.lit(2.0))
    return F.lit(2 * 6371.0) * F.asin(F.sqrt(h))


def flat_km(lat1, lon1, lat2, lon2) -> Column:
    """Equirectangular distance for near points, 111 km a degree."""
    dlat, dlon = col(lat1) - col(lat2), (col(lon1) - col(lon2)) * F.cos(F.radians(col(lat1)))
    return F.lit(111.0) * F.sqrt(dlat * dlat + dlon * dlon)


def clean(text) -> Column:
    return F.lower(F.trim(col(text)))


def differs(a, b) -> Column:
    """True also if either side is null."""
    a, b = col(a), col(b)
    return a.isNull() | b.isNull() | (a != b)
