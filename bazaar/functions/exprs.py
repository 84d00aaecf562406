"""Row-level column expressions (all JVM built-ins, whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed business values.
MICROS_PER_DAY = 86_400_000_000.0
DAYS_PER_AVG_MONTH = 30.436875          # 365.2425 / 12, numpy's 'M' unit
EARTH_RADIUS_KM = 6371.0
REVIEW_COST_BRL = {1: 100, 2: 50, 3: 40, 4: 0, 5: 0}
MONTHLY_FEE_BRL = 80.0
SALES_CUT = 0.10
IT_COST_TOTAL_BRL = 500_000.0
STAR_NAMES = {5: "five", 4: "four", 3: "three", 2: "two", 1: "one"}


# Money is summed exactly as DECIMAL, then returned as DOUBLE: the total is
# then independent of partitioning and summation order (reproducible results
# on any cluster layout).  Ten decimals hold every source value exactly.
MONEY_DECIMAL = "decimal(28,10)"


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def days_between(start, end) -> Column:
    """(end - start) in fractional days, exact to the microsecond; null-safe."""
    return F.timestamp_diff("MICROSECOND", c(start), c(end)) / F.lit(MICROS_PER_DAY)


def micros_between(start, end) -> Column:
    return F.timestamp_diff("MICROSECOND", c(start), c(end))


def mean_days(start, end) -> Column:
    """Aggregate: mean of (end - start) in days, averaged over exact integer
    microseconds (order-independent) and converted once."""
    return F.avg(micros_between(start, end)) / F.lit(MICROS_PER_DAY)


def money_sum(x) -> Column:
    """Aggregate: exact sum of a money column (DOUBLE result; NULL if all NULL)."""
    return F.sum(c(x).cast(MONEY_DECIMAL)).cast("double")


def whole_days_between(start, end) -> Column:
    """``Timedelta.days``: floor of the day difference (-1 h -> -1)."""
    return F.floor(F.timestamp_diff("MICROSECOND", c(start), c(end)) / F.lit(MICROS_PER_DAY)).cast("double")


def positive_or_zero(x) -> Column:
    """``x if x > 0 else 0``: a NULL input fails ``x > 0`` and becomes 0."""
    x = c(x)
    return F.when(x > 0, x).otherwise(F.lit(0.0))


def clip_lower_zero(x) -> Column:
    """``Series.clip(lower=0)``: NULL stays NULL (``greatest`` alone skips nulls)."""
    x = c(x)
    return F.when(x.isNotNull(), F.greatest(x, F.lit(0.0)))


def star_flag(score, k: int) -> Column:
    """1 if score == k else 0 (NULL score -> 0)."""
    return F.when(c(score) == k, F.lit(1)).otherwise(F.lit(0))


def promoter_score(score, null_as_zero: bool = True) -> Column:
    """5 -> 1, 4 -> 0, below 4 -> -1.  The function form maps NULL to 0, the
    dictionary form keeps NULL."""
    s = c(score)
    e = F.when(s == 5, F.lit(1)).when(s < 4, F.lit(-1))
    return e.otherwise(F.lit(0)) if null_as_zero else e.when(s == 4, F.lit(0))


def review_cost(score) -> Column:
    """Estimated BRL cost of a review score (unknown / NULL -> 0)."""
    s = c(score)
    e = None
    for k, v in REVIEW_COST_BRL.items():
        if v:
            e = (F.when(s == k, F.lit(v)) if e is None else e.when(s == k, F.lit(v)))
    return e.otherwise(F.lit(0))


def haversine_km(lon1, lat1, lon2, lat2) -> Column:
    """Great-circle distance in km between (lon1, lat1) and (lon2, lat2)."""
    lo1, la1, lo2, la2 = (F.radians(c(v)) for v in (lon1, lat1, lon2, lat2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    # rounding can lift an antipodal pair a little above 1
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a)))


def months_between_avg(first, last) -> Column:
    """round((last - first) / average month), half to even like numpy."""
    return F.rint(days_between(first, last) / F.lit(DAYS_PER_AVG_MONTH))


def round_half_even(x, digits: int = 2) -> Column:
    """numpy/pandas ``round``: scale, round half to even on the binary value,
    unscale (``2.675 -> 2.67``, unlike decimal HALF_EVEN)."""
    k = float(10 ** digits)
    return F.rint(c(x) * F.lit(k)) / F.lit(k)


# -- time-bucket labels (pandas resample edges) ------------------------------

def week_label_sun(ts) -> Column:
    """``resample('W')``: Monday..Sunday weeks labelled by their Sunday."""
    return F.next_day(F.date_sub(F.to_date(c(ts)), 1), "Sun")


def week_label_mon(ts) -> Column:
    """``resample('W-MON')``: Tuesday..Monday weeks labelled by their Monday."""
    return F.next_day(F.date_sub(F.to_date(c(ts)), 1), "Mon")


def month_end_label(ts) -> Column:
    """``resample('M')``: calendar months labelled by their last day."""
    return F.last_day(F.to_date(c(ts)))


BUCKETS = {
    "W": (week_label_sun, "7 days"),
    "W-SUN": (week_label_sun, "7 days"),
    "W-MON": (week_label_mon, "7 days"),
    "M": (month_end_label, "1 month"),
}
