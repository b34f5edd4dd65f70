"""Profiling: describe tables, head, class balance, shape, distinct counts.

Every statistic is a distributed aggregate.  Numeric quartiles are exact
(``operators.quantiles``); categorical tops come from one shuffle over a long
(column, value) form with map-side partial counts, so a hot value is counted
before it moves.  Only the per-column summary rows (one per column) reach the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import Stat, quantiles, number

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                 T.DecimalType)
DATETIME_TYPES = (T.TimestampType, T.TimestampNTZType, T.DateType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def datetime_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, DATETIME_TYPES) and f.name not in exclude]


DESCRIBE_NUMERIC_SCHEMA = ("column_name string, count bigint, mean double, std double, min double, "
                           "p25 double, p50 double, p75 double, max double")


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A3: count, mean, std (n-1), min, 25/50/75 % (interpolated), max per column."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], DESCRIBE_NUMERIC_SCHEMA)
    x = df.select(*[number(c).alias(c) for c in cols])
    row = {}
    for i, c in enumerate(cols):
        row.update({f"n{i}": F.count(c), f"m{i}": F.avg(c), f"s{i}": F.stddev_samp(c),
                    f"lo{i}": F.min(c), f"hi{i}": F.max(c)})
    # moments ride along in the quantiles' first pass (one scan fewer)
    qs = quantiles(x, [Stat(c, p, "cont") for c in cols for p in (0.25, 0.5, 0.75)], extra=row)
    out = []
    for i, c in enumerate(cols):
        out.append((c, row[f"n{i}"], row[f"m{i}"], row[f"s{i}"], row[f"lo{i}"],
                    qs[3 * i], qs[3 * i + 1], qs[3 * i + 2], row[f"hi{i}"]))
    return spark.createDataFrame(out, DESCRIBE_NUMERIC_SCHEMA)


def _long_form(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value) for every non-null string cell."""
    arr = F.array(*[F.struct(F.lit(c).alias("k"), F.col(c).cast("string").alias("v")) for c in cols])
    return (df.select(F.explode(arr).alias("kv")).select(F.col("kv.k").alias("column_name"),
                                                           F.col("kv.v").alias("value"))
            .filter(F.col("value").isNotNull()))


def describe_categorical(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A4: count, unique, top (most frequent; ties -> smallest value), freq."""
    cols = list(cols) if cols is not None else string_columns(df)
    counts = _long_form(df, cols).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("c"))
    top = F.min(F.struct((-F.col("c")).alias("negc"), F.col("value").alias("v")))
    return (counts.groupBy("column_name")
            .agg(F.sum("c").alias("count"), F.count(F.lit(1)).alias("unique"), top.alias("t"))
            .select("column_name", "count", "unique", F.col("t.v").alias("top"),
                    (-F.col("t.negc")).alias("freq")))


def describe_datetime(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """A5: count, mean, min, 25/50/75 % and max of timestamp columns.

    Computed on epoch microseconds; interpolated values are floored to whole
    microseconds.
    """
    cols = list(cols) if cols is not None else datetime_columns(df)
    spark = df.sparkSession
    schema = ("column_name string, count bigint, mean timestamp_ntz, min timestamp_ntz, p25 timestamp_ntz, "
              "p50 timestamp_ntz, p75 timestamp_ntz, max timestamp_ntz")
    if not cols:
        return spark.createDataFrame([], schema)
    x = df.select(*[F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in cols])
    row = {}
    for i, c in enumerate(cols):
        # Exact integer sum (a double sum of ~1e15 values drifts by microseconds).
        row.update({f"n{i}": F.count(c), f"s{i}": F.sum(F.col(c).cast("decimal(38,0)")),
                    f"lo{i}": F.min(c), f"hi{i}": F.max(c)})
    # moments ride along in the quantiles' first pass
    qs = quantiles(x, [Stat(c, p, "cont") for c in cols for p in (0.25, 0.5, 0.75)], extra=row)
    out = []
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        mean = int(row[f"s{i}"]) // n if n else None
        vals = [mean, row[f"lo{i}"], qs[3 * i], qs[3 * i + 1], qs[3 * i + 2], row[f"hi{i}"]]
        out.append((c, row[f"n{i}"], *[None if v is None else int(v // 1) for v in vals]))
    raw = spark.createDataFrame(out, "column_name string, count bigint, mean bigint, min bigint, p25 bigint, "
                                     "p50 bigint, p75 bigint, max bigint")
    return raw.select("column_name", "count",
                      *[F.timestamp_micros(k).cast("timestamp_ntz").alias(k)
                        for k in ("mean", "min", "p25", "p50", "p75", "max")])


def head(df: DataFrame, n: int = 5, order: Sequence[str] = ("TransactionID",)) -> DataFrame:
    """The first ``n`` rows by ``order`` (a top-n: Spark plans TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def class_balance(df: DataFrame, target: str = "is_fraud") -> DataFrame:
    """Rows per class, sorted by class."""
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("count")).orderBy(target)


def shape(df: DataFrame, target: str = "is_fraud") -> DataFrame:
    """Row count, column count and positives."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).cast("bigint").alias("n_cols"),
                  F.coalesce(F.sum(F.col(target).cast("long")), F.lit(0)).cast("bigint").alias("positives"))


def distinct_counts(df: DataFrame, cols: Sequence[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per string column (exact, or HLL++ when ``approx``)."""
    cols = list(cols) if cols is not None else string_columns(df)
    lf = _long_form(df, cols)
    if approx:
        return lf.groupBy("column_name").agg(F.approx_count_distinct("value").alias("n_distinct"))
    return lf.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n_distinct"))
