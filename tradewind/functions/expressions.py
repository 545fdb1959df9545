"""Column expressions shared by the operators. All are built-in functions, none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean Earth diameter in km, price bucket upper bounds, weekday names (Monday first),
# and the number of hash buckets of the train/holdout split.
EARTH_DIAMETER_KM = 12742.0
PRICE_BUCKETS = ((30, "LOW"), (100, "MEDIUM"), (300, "HIGH"))
PRICE_BUCKET_TOP = "VERY_HIGH"
PRICE_BUCKET_NULL = "UNKNOWN"
WEEKDAY_NAMES = ("Понедельник", "Вторник", "Среда", "Четверг", "Пятница", "Суббота", "Воскресенье")
HASH_BUCKETS = 10_000

UNKNOWN = "unknown"


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or NULL."""
    return F.when(condition, 1).otherwise(0)


def count_if(condition: Column) -> Column:
    """Rows on which the condition is true; a NULL condition does not count."""
    return F.count_if(condition)


def avg_money(name: str) -> Column:
    """Average of amounts in cents: a whole sum divided once, the same in any order of the rows."""
    cents = F.round(F.col(name) * 100).cast("bigint")
    return F.try_divide(F.sum(cents).cast("double"), F.count(cents)) / 100


def safe_div(numerator: Column, denominator: Column) -> Column:
    """Ratio, NULL for a zero denominator."""
    return F.try_divide(numerator, denominator)


def pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """Rounded percentage, NULL for a zero denominator."""
    return F.round(F.try_divide(F.lit(100.0) * numerator, denominator), digits)


def percentile(column: Column | str, q: float = 0.95) -> Column:
    """Exact interpolated percentile as an aggregate.

    Its buffer holds the distinct values of a group, so use it for groups known to be small;
    ``ranking.grouped_percentile`` gives the same numbers for groups of any size.
    """
    return F.percentile(column, q)


def string_agg_distinct(column: Column | str, delimiter: str = ", ") -> Column:
    """Distinct values, sorted and joined; NULL (not '') for a group without values."""
    return joined_set(F.collect_set(column), delimiter)


def joined_set(values: Column | str, delimiter: str = ", ") -> Column:
    """A set, sorted and joined; NULL (not '') for an empty one."""
    return F.when(F.size(values) > 0, F.array_join(F.array_sort(values), delimiter))


def to_date_col(ts: Column | str) -> Column:
    return F.to_date(ts)


def hour_of(ts: Column | str) -> Column:
    return F.hour(ts)


def dow_of(ts: Column | str) -> Column:
    """ISO weekday, Monday = 1 … Sunday = 7."""
    return F.weekday(ts) + 1


def month_of(ts: Column | str) -> Column:
    return F.month(ts)


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar days from start to end: midnights crossed, not full 24-hour spans."""
    return F.datediff(end, start)


def weekday_name(dow: Column) -> Column:
    """Name of an ISO weekday number; NULL outside 1–7."""
    name = None
    for number, label in enumerate(WEEKDAY_NAMES, start=1):
        name = (F if name is None else name).when(dow == number, label)
    return name


def price_bucket(amount: Column) -> Column:
    bucket = F.when(amount.isNull(), PRICE_BUCKET_NULL)
    for upper, label in PRICE_BUCKETS:
        bucket = bucket.when(amount < upper, label)
    return bucket.otherwise(PRICE_BUCKET_TOP)


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of two points given in radians; NULL in, NULL out."""
    half_lat = F.sin((lat2 - lat1) / 2)
    half_lon = F.sin((lon2 - lon1) / 2)
    chord = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    # Rounding can push antipodal points above 1, where asin is NaN. least() skips NULLs, so a
    # missing coordinate is kept NULL explicitly.
    bounded = F.when(chord.isNotNull(), F.least(F.lit(1.0), chord))
    return F.lit(EARTH_DIAMETER_KM) * F.asin(F.sqrt(bounded))


def hash_bucket(key: Column | str, seed: int) -> Column:
    """Bucket 0 … 9999 of a key: the first 32 bits of md5("key|split|seed") modulo 10,000."""
    column = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(column.cast("string"), F.lit(f"|split|{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % HASH_BUCKETS
