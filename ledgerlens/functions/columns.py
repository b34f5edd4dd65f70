"""Column expressions of the curation, feature and scoring steps.

All are built-in Spark expressions (whole-stage codegen, no Python UDF).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """num / NULLIF(den, 0); NULL on zero or NULL."""
    return F.try_divide(col(num).cast("double"), F.nullif(col(den).cast("double"), F.lit(0.0)))


def hour_of(ts: str | Column) -> Column:
    """Hour of a UTC timestamp."""
    return F.hour(col(ts)).cast("int")


def day_of_week0(ts: str | Column) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6 (P5)."""
    return (F.dayofweek(col(ts)) - 1).cast("int")


def minutes_between(prev: str | Column, cur: str | Column) -> Column:
    """Whole minutes cur - prev, truncated toward zero, sign kept."""
    return F.timestamp_diff("MINUTE", col(prev), col(cur)).cast("long")


def flag(pred: Column) -> Column:
    """1 when ``pred`` holds, 0 when it is false or NULL."""
    return F.when(pred, F.lit(1)).otherwise(F.lit(0)).cast("int")


def join_non_empty(parts: Sequence[str | Column], sep: str = " ") -> Column:
    """Space-join the parts, dropping NULL and '' (P10).

    ``concat_ws`` skips NULL but keeps '', which would leave double spaces.
    """
    arr = F.array(*[col(p).cast("string") for p in parts])
    return F.array_join(F.filter(arr, lambda x: x.isNotNull() & (x != F.lit(""))), sep)


def ratio_abs(num: str | Column, den: str | Column, eps: float = 1e-6) -> Column:
    """num / (|den| + eps): the model feature amt_to_bal."""
    return col(num).cast("double") / (F.abs(col(den).cast("double")) + F.lit(eps))


def seconds_between(prev: str | Column, cur: str | Column) -> Column:
    """Fractional seconds cur - prev."""
    return (F.unix_micros(col(cur).cast("timestamp")) - F.unix_micros(col(prev).cast("timestamp"))) / F.lit(1e6)


def lenient_timestamp(c: str | Column) -> Column:
    """String -> UTC timestamp, NULL when it does not parse.

    Date, or date and time to the minute or finer, with an optional zone
    (Z, +hh, +hhmm, +hh:mm); without one the time is taken as UTC.
    """
    s = F.trim(col(c).cast("string"))
    shape = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(:\d{2}(?:\.\d{1,6})?)?)?\s*(Z|[+-]\d{2}(?::?\d{2})?)?$"
    day, minute, second, zone = (F.regexp_extract(s, shape, k) for k in (1, 2, 3, 4))
    digits = F.regexp_replace(zone, "[^0-9]", "")
    offset = (F.when(zone.startswith("-"), -1).otherwise(1)
              * (F.coalesce(F.substring(digits, 1, 2).try_cast("int"), F.lit(0)) * 60
                 + F.coalesce(F.substring(digits, 3, 2).try_cast("int"), F.lit(0))))
    clock = F.concat(F.when(minute == "", "00:00").otherwise(minute), F.when(second == "", ":00").otherwise(second))
    local = F.concat(day, F.lit(" "), clock).try_cast(T.TimestampNTZType())
    return local - F.make_dt_interval(F.lit(0), F.lit(0), offset, F.lit(0))


def lenient_double(c: str | Column) -> Column:
    """Anything -> double, NULL when it is no decimal number, NaN or infinity."""
    s = F.trim(col(c).cast("string"))
    return F.when(s.rlike(r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf|infinity)$"), s.try_cast("double"))


def empty_to_null(c: str | Column) -> Column:
    """Trimmed string, '' -> NULL."""
    return F.nullif(F.trim(col(c).cast("string")), F.lit(""))


def finite_or_clamped(c: str | Column, big: float = 1.7976931348623157e308 / 2) -> Column:
    """NaN -> 0, +inf -> big, -inf -> -big (P25)."""
    x = col(c)
    return (F.when(F.isnan(x), F.lit(0.0))
            .when(x == F.lit(float("inf")), F.lit(big))
            .when(x == F.lit(float("-inf")), F.lit(-big))
            .otherwise(x))


def decision(score: str | Column, threshold: float | Column) -> Column:
    """1 when score >= threshold."""
    thr = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (col(score) >= thr).cast("int")


def kpi(value: str | Column) -> Column:
    """Three decimals, '-' when missing."""
    x = col(value).cast("double")
    return F.when(x.isNull(), F.lit("-")).otherwise(F.format_string("%.3f", x))
