"""Column-expression helpers shared by the operators.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# time grain and calendar conventions
# --------------------------------------------------------------------------


def hour_floor(ts) -> Column:
    """``DATE_TRUNC('hour', ts)`` for a zone-less timestamp, built from its
    fields so the result does not depend on the session time zone
    (``date_trunc`` goes through session-local time)."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.lit(0), F.lit(0))


def day_floor(ts) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.dayofmonth(ts), F.lit(0), F.lit(0), F.lit(0))


def month_floor(ts) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.make_timestamp_ntz(F.year(ts), F.month(ts), F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def ntz_literal(value) -> Column:
    """A zone-less timestamp literal. ``F.lit(naive datetime)`` would go
    through the Python process's local zone; text → TIMESTAMP_NTZ does not."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


_EPOCH_NTZ = "1970-01-01 00:00:00"


def ntz_to_instant(ts) -> Column:
    """Zone-less wall time → the TIMESTAMP instant with that wall time in UTC
    (epoch microseconds, no session-zone conversion). Watermarks and
    ``window`` need TIMESTAMP; this keeps hour/day windows on the data's own
    clock whatever the session time zone."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), ts))


def instant_to_ntz(ts) -> Column:
    """Inverse of ``ntz_to_instant``."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def dow_sunday0(ts) -> Column:
    """Postgres ``EXTRACT(DOW)``: 0 = Sunday … 6 = Saturday (views)."""
    return (F.dayofweek(ts) - 1).cast("bigint")


def weekday_monday0(ts) -> Column:
    """Python ``weekday()``: 0 = Monday … 6 = Sunday (pandas operators)."""
    return F.weekday(ts).cast("bigint")


def is_weekend_sunday0(ts) -> Column:
    return dow_sunday0(ts).isin(0, 6)


def is_weekend_monday0(ts) -> Column:
    return weekday_monday0(ts) >= 5


def day_name(ts) -> Column:
    """English day name, ``Monday`` … ``Sunday``."""
    return F.date_format(ts, "EEEE")


# --------------------------------------------------------------------------
# numeric contract with the oracle
# --------------------------------------------------------------------------


def mean(c) -> Column:
    """Average as ``round(sum / count, 6)`` in double — reproducible in DuckDB
    bit for bit (decimal ``avg`` widens differently in the two engines)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double")), 6)


def dsum(c) -> Column:
    """Exact decimal sum, returned as double."""
    c = F.col(c) if isinstance(c, str) else c
    return F.sum(c).cast("double")


def pearson(x, y) -> Column:
    """Null-safe Pearson correlation: pairs with a NULL on
    either side are dropped, and a constant side (undefined r) gives 0 rather
    than the ANSI divide-by-zero that ``corr`` raises. Rounded to 6 places."""
    x = F.col(x) if isinstance(x, str) else x
    y = F.col(y) if isinstance(y, str) else y
    xx = F.when(y.isNotNull(), x.cast("double"))
    yy = F.when(x.isNotNull(), y.cast("double"))
    r = F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))
    return F.round(F.coalesce(r, F.lit(0.0)), 6)


# --------------------------------------------------------------------------
# cleaning rules (C04) and small ladders
# --------------------------------------------------------------------------


def clean_numeric(c, lo: float, hi: float) -> Column:
    """Parse to double; NULL when unparsable, NaN or outside [lo, hi]."""
    c = F.col(c) if isinstance(c, str) else c
    v = c.try_cast("double")
    return F.when(v.between(F.lit(float(lo)), F.lit(float(hi))), v)


def clean_text(c, max_len: int | None = None, default: str | None = "") -> Column:
    """Trim (and cut to ``max_len`` if given); NULL text becomes ``default``."""
    c = F.col(c) if isinstance(c, str) else c
    t = F.trim(c.cast("string"))
    t = t if max_len is None else F.substring(t, 1, max_len)
    return t if default is None else F.coalesce(t, F.lit(default))


def season_of_month(m) -> Column:
    """Meteorological seasons of the pattern module."""
    return (F.when(m.isin(12, 1, 2), F.lit("Winter"))
            .when(m.isin(3, 4, 5), F.lit("Spring"))
            .when(m.isin(6, 7, 8), F.lit("Summer"))
            .when(m.isin(9, 10, 11), F.lit("Fall")))


def congestion_of_speed(speed) -> Column:
    """S10, per flow item: < 20 severe, < 40 moderate, else light."""
    return (F.when(speed < 20, F.lit("severe"))
            .when(speed < 40, F.lit("moderate"))
            .otherwise(F.lit("light")))


def first_nonzero(*cols) -> Column:
    """First value that is neither NULL nor 0, else 0."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in cols], F.lit(0.0))


def bbox(lat, lon, radius_km) -> dict[str, Column]:
    """The traffic service's own bounding-box approximation.
    ``lon_delta`` divides by |lat|; it grows without bound towards the equator,
    where the box takes all longitudes (360 degrees to either side)."""
    lat_delta = radius_km / 111.0
    lon_delta = F.least(F.coalesce(F.try_divide(F.lit(radius_km), 111.0 * F.abs(lat) / 90.0), F.lit(360.0)),
                        F.lit(360.0))
    return {"south": lat - lat_delta, "west": lon - lon_delta,
            "north": lat + lat_delta, "east": lon + lon_delta}


EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in km."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dp, dl = p2 - p1, F.radians(lon2) - F.radians(lon1)
    a = F.sin(dp / 2) ** 2 + F.cos(p1) * F.cos(p2) * F.sin(dl / 2) ** 2
    return 2 * EARTH_RADIUS_KM * F.asin(F.least(F.sqrt(a), F.lit(1.0)))
