"""Column functions: times, text, distances, probabilities and transforms. All stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"

#: Text formats of the feeds, as patterns (fixed values).
TIME_FORMATS = {
    "minute": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$",
    "second": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "iso": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$",
}

#: County of each island (fixed values).
COUNTY_OF_ISLAND = {"BI": "BI", "OA": "OA", "KA": "KA", "MA": "MN", "KO": "MN", "LA": "MN", "MO": "MN"}

EARTH_RADIUS_M = 6_371_008.8


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_utc(text: Column | str, kind: str) -> Column:
    """UTC text to a zoneless timestamp; null where it isn't of the given kind (H1)."""
    text = _col(text)
    plain = F.regexp_replace(text, "Z$", "")
    return F.when(text.rlike(TIME_FORMATS[kind]), plain.try_cast("timestamp_ntz"))


def local_time(ts: Column | str, hours: int = 10, seconds: int = 1) -> Column:
    """Local standard time (UTC - hours, no daylight saving), less a second so that midnight closes its day (H2)."""
    return _col(ts) - F.expr(f"INTERVAL {hours} HOURS") - F.expr(f"INTERVAL {seconds} SECONDS")


def seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970 of a zoneless timestamp, whatever the session's zone."""
    return F.timestamp_diff("SECOND", F.expr(EPOCH), _col(ts))


def from_seconds(n: Column) -> Column:
    return F.timestamp_add("SECOND", n.cast("long"), F.expr(EPOCH))


def floor_time(ts: Column | str, step: int) -> Column:
    """Start of the step (in seconds) that holds ts; 3600 truncates to the hour (H3)."""
    s = seconds(ts)
    return from_seconds(s - F.pmod(s, F.lit(step)))


def round_time(ts: Column | str, step: int = 600) -> Column:
    """Nearest multiple of step seconds, half up (H3)."""
    s = seconds(ts) + step // 2
    return from_seconds(s - F.pmod(s, F.lit(step)))


def month_start(date: Column | str) -> Column:
    return F.trunc(_col(date), "month")


def days_of_month(date: Column | str) -> Column:
    """All dates of the month of `date` (H4)."""
    return F.sequence(month_start(date), F.last_day(_col(date)))


def file_key(date: Column | str) -> Column:
    """YYYY_MM, as monthly files are named (H4)."""
    return F.date_format(_col(date), "yyyy_MM")


def wide_name(date: Column | str) -> Column:
    """XYYYY.MM.DD, as a day's column is named in wide tables."""
    return F.concat(F.lit("X"), F.date_format(_col(date), "yyyy.MM.dd"))


def round_scaled(value: Column | str, places: int) -> Column:
    """value to `places` by rounding its multiple, halves away from zero: 0.285 is below the half as a double and becomes 0.28,
    while Spark's round takes its decimal text and gives 0.29."""
    return F.round(_col(value) * 10.0**places, 0) / 10.0**places


def cents(value: Column | str) -> Column:
    """Value in hundredths as an integer, for sums that don't depend on their order."""
    return F.round(_col(value) * 100).cast("long")


def inches_to_mm(value: Column | str) -> Column:
    return _col(value) * 25.4


def county_of(island: Column | str) -> Column:
    """County code of an island code, null for others."""
    island = _col(island)
    return reduce(lambda c, kv: c.when(island == kv[0], kv[1]), COUNTY_OF_ISLAND.items(), F)  # type: ignore[arg-type]


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Great-circle metres on a sphere; within 0.6 % of the ellipsoid (H6)."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def planar(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance in the units of the coordinates (H7)."""
    return F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution, by the rational approximation 26.2.17 of Abramowitz and Stegun (error < 7.5e-8)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) * 0.3989422804014327 * poly
    return F.when(z >= 0, 1 - upper).otherwise(upper)


def rain_probability(rf: Column, meanlog: Column, sdlog: Column, pop: Column) -> Column:
    """Zero-inflated log-normal probability of at most rf; pop is the chance of rain (H8)."""
    wet = (1 - pop) + pop * normal_cdf((F.ln(F.when(rf > 0, rf).otherwise(1.0)) - meanlog) / sdlog)
    return F.when(rf > 0, wet).otherwise(1 - pop)


def guarded_mean(mean: Column) -> Column:
    """A mean of zero becomes 0.001, so that it can divide."""
    return F.when(mean == 0, 0.001).otherwise(mean)


def log_plain(rf: Column) -> Column:
    return F.ln(rf + 1)


def log_ratio(rf: Column, mean: Column) -> Column:
    return F.ln((rf + mean) / mean)


def back_plain(y: Column) -> Column:
    """Inverse of log_plain, not below 0; the exponent is clamped to 700."""
    return F.greatest(F.exp(F.least(y, F.lit(700.0))) - 1, F.lit(0.0))


def back_ratio(y: Column, mean: Column) -> Column:
    return F.greatest((F.exp(F.least(y, F.lit(700.0))) - 1) * mean, F.lit(0.0))


def daily_label(share: Column) -> Column:
    """Quality label of a day from MAE over the largest rain."""
    return (
        F.when(share <= 0.02, "high").when(share <= 0.04, "good").when(share <= 0.06, "moderate").when(share <= 0.08, "low")
    ).otherwise("lowest")


def monthly_label(r2: Column) -> Column:
    """Quality label of a month from R squared."""
    return F.when(r2 >= 0.8, "high").when(r2 >= 0.6, "good").when(r2 >= 0.4, "moderate").when(r2 >= 0.2, "low").otherwise("lowest")


def rank_in(value: Column | str, order: list[str]) -> Column:
    """Position in a list, unknown values last."""
    at = F.array_position(F.array(*(F.lit(x) for x in order)), _col(value))
    return F.when(at > 0, at).otherwise(2**31 - 1).cast("long")
