"""Order-dependent operators that stay parallel when one key is hot.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task; a key holding a third of the table then runs in a single task.
Here every ordered computation is split on an extra *bucket* column that is
non-decreasing along the ordering (a range of (key, order) values, a hash
prefix).  Rows are processed in (key, bucket) windows, and a narrow per-bucket
table -- one row per (key, bucket) -- carries the running totals from one
bucket to the next.  The big side is shuffled once, on (key, bucket); the
bucket table is joined back on the same keys, so the join reuses that
partitioning and AQE broadcasts it whenever its measured size is small.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

_B = "_ll_bucket"


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


_LONG_MIN = -(2 ** 63)


def _default_for(dt: T.DataType) -> Column:
    if isinstance(dt, T.StringType):
        return F.lit("")
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                       T.DecimalType, T.BooleanType)):
        return F.lit(0).cast(dt)
    return F.lit(None).cast(dt)


def _normalized(df: DataFrame, keys: Sequence[str], bucket: Column) -> tuple[DataFrame, list[str]]:
    """Non-null partition keys: each nullable key becomes (value or default,
    is-null) and a NULL bucket becomes the smallest long (it sorts first, like
    NULL in the ordering).  Windows, the per-bucket aggregate and the join
    back then use plain equality on the same columns, so the big side is
    shuffled once and the join reuses that partitioning."""
    out_keys = []
    types = {f.name: f for f in df.schema.fields}
    for i, k in enumerate(keys):
        f = types[k]
        if f.nullable:
            d = _default_for(f.dataType)
            if isinstance(f.dataType, (T.StringType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                                       T.FloatType, T.DoubleType, T.DecimalType, T.BooleanType)):
                df = df.withColumn(f"_nk{i}", F.coalesce(F.col(k), d)).withColumn(f"_nn{i}", F.col(k).isNull())
            else:
                df = df.withColumn(f"_nk{i}", F.coalesce(F.col(k).cast("string"), F.lit(""))) \
                       .withColumn(f"_nn{i}", F.col(k).isNull())
            out_keys += [f"_nk{i}", f"_nn{i}"]
        else:
            out_keys.append(k)
    df = df.withColumn(_B, F.coalesce(bucket.cast("long"), F.lit(_LONG_MIN).cast("long")))
    return df, out_keys


def _drop_norm(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_nk") or c.startswith("_nn")], _B)


def with_key_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "_ll_range",
                    rows_per_range: int = 250_000, n: int | None = None) -> DataFrame:
    """Range-partition ``df`` once on (keys, order), write it, and number the ranges in ``out``.

    A range holds about ``rows_per_range`` rows however the rows are spread:
    ties of the leading columns, bursts of one key and quiet stretches of
    another are cut at the same row count, because the cut points are full
    (keys, order) values.  Inside a key the number is non-decreasing along
    ``order``, so it is a bucket for every ordered operator here; a range is
    contiguous, so there are at most keys + ranges (key, range) pairs.
    ``n``, when the caller knows the row count, saves the count.
    """
    if n is None:
        n = df.count()
    ranges = max(1, -(-n // rows_per_range))
    cut = df.repartitionByRange(ranges, *keys, *order).withColumn(out, F.spark_partition_id().cast("long"))
    return materialize(cut, "key_ranges")


def numbered_rows(df: DataFrame, order: Sequence, name: str = "rn", rows_per_range: int = 250_000) -> DataFrame:
    """1-based position of each row in ``order`` over the whole table.

    Rows are moved once: ranges of ``order`` values are sorted and written with the position inside the range, and the
    one row for each range that counts the rows before it is added after.
    """
    ranges = max(1, -(-df.count() // rows_per_range))
    cut = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumns(
        {"_ll_range": F.spark_partition_id().cast("long"), "_ll_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1})
    cut = materialize(cut, "numbered_rows")
    sizes = cut.groupBy("_ll_range").agg(F.max("_ll_pos").alias("_ll_n"))
    every = Window.partitionBy(F.lit(0)).orderBy("_ll_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_ll_range", F.coalesce(F.sum("_ll_n").over(every), F.lit(0)).alias("_ll_before"))
    return cut.join(F.broadcast(before), "_ll_range").withColumn(name, F.col("_ll_before") + F.col("_ll_pos")).drop(
        "_ll_range", "_ll_pos", "_ll_before")


def hash_bits(n: int, rows_per_bucket: int = 250_000) -> int:
    """Bits of a hash prefix that cuts ``n`` rows into buckets of about ``rows_per_bucket`` or fewer."""
    return 4 * max(1, math.ceil(math.log(max(1, n / rows_per_bucket), 16)))


def hash_bucket(col: Column | str, bits: int) -> Column:
    """Leading ``bits`` bits of an md5 hex string, as a non-negative long.

    For an order defined by that md5 string, the bucket is non-decreasing.
    """
    c = F.col(col) if isinstance(col, str) else col
    digits = (bits + 3) // 4
    return F.conv(F.substring(c, 1, digits), 16, 10).cast("long")


def running_sums(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence,
                 values: dict[str, Column], totals: bool = True) -> DataFrame:
    """Inclusive running sums of ``values`` within ``keys`` in ``order``.

    ``bucket`` must be non-decreasing along ``order`` inside a key.  Adds one
    column per entry of ``values`` (the running sum) and, if ``totals``, a
    ``<name>_total`` column with the sum over the whole key.
    """
    names = list(values)
    base, keys = _normalized(df, list(keys), bucket)
    for n, c in values.items():
        base = base.withColumn(f"_v_{n}", c)
    w_local = (Window.partitionBy(*keys, _B).orderBy(*_cols(order))
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = base
    for n in names:
        local = local.withColumn(f"_l_{n}", F.sum(f"_v_{n}").over(w_local))

    per_bucket = base.groupBy(*keys, _B).agg(*[F.sum(f"_v_{n}").alias(f"_b_{n}") for n in names])
    w_prev = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offs = [F.coalesce(F.sum(f"_b_{n}").over(w_prev), F.lit(0)).alias(f"_o_{n}") for n in names]
    tots = [F.sum(f"_b_{n}").over(Window.partitionBy(*keys)).alias(f"_t_{n}") for n in names] if totals else []
    per_bucket = per_bucket.select(*keys, _B, *offs, *tots)

    out = local.join(per_bucket, keys + [_B])
    for n in names:
        out = out.withColumn(n, F.col(f"_o_{n}") + F.col(f"_l_{n}"))
        if totals:
            out = out.withColumn(f"{n}_total", F.col(f"_t_{n}"))
    drop = [f"_{p}_{n}" for n in names for p in ("v", "l", "o", "t")]
    return _drop_norm(out.drop(*drop))


def row_number_within(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence,
                      name: str = "rn", count_name: str | None = "n") -> DataFrame:
    """1-based position of each row inside its key, plus the key's row count."""
    out = running_sums(df, keys, bucket, order, {name: F.lit(1).cast("long")}, totals=count_name is not None)
    if count_name is not None:
        out = out.withColumnRenamed(f"{name}_total", count_name)
    return out


def lag_within(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence,
               value: str, name: str) -> DataFrame:
    """``lag(value, 1)`` within ``keys`` in ``order``, without one task per key.

    Inside a (key, bucket) window the plain lag applies; the first row of a
    bucket takes the last value of the nearest earlier non-empty bucket of the
    same key, found on the per-bucket table.
    """
    order_cols = _cols(order)
    base, keys = _normalized(df, list(keys), bucket)
    w = Window.partitionBy(*keys, _B).orderBy(*order_cols)
    local = (base.withColumn("_lag_local", F.lag(value, 1).over(w))
             .withColumn("_lag_first", F.row_number().over(w) == 1))
    # Last value of each bucket: the max of struct(order..., value); when the
    # lagged value is the leading order column a plain max (hash aggregate) does.
    lead_is_value = isinstance(order[0], str) and order[0] == value
    if lead_is_value:
        last = F.max(F.col(value))
    else:
        last = F.max(F.struct(*[c.alias(f"_k{i}") for i, c in enumerate(order_cols)],
                              F.col(value).alias("_val")))["_val"]
    per_bucket = base.groupBy(*keys, _B).agg(last.alias("_last"))
    w_prev = Window.partitionBy(*keys).orderBy(_B)
    per_bucket = per_bucket.select(*keys, _B, F.lag(F.col("_last"), 1).over(w_prev).alias("_lag_prev"))
    out = local.join(per_bucket, keys + [_B])
    out = out.withColumn(name, F.when(F.col("_lag_first"), F.col("_lag_prev")).otherwise(F.col("_lag_local")))
    return _drop_norm(out.drop("_lag_local", "_lag_first", "_lag_prev"))


def trailing_rows(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence,
                  item: Column, length: int, name: str) -> DataFrame:
    """Array of ``item`` over the last ``length`` rows of the key (current row last).

    Within a (key, bucket) window a bounded frame collects the items; rows
    near the start of a bucket prepend the tail of earlier buckets.  Each
    bucket contributes at most ``length - 1`` items to that tail, so the
    per-bucket table stays bounded no matter how hot a key is.
    """
    order_cols = _cols(order)
    k = length - 1
    base, keys = _normalized(df, list(keys), bucket)
    base = base.withColumn("_item", item)
    w = Window.partitionBy(*keys, _B).orderBy(*order_cols)
    local = (base.withColumn("_seq_local", F.collect_list("_item").over(w.rowsBetween(-k, 0)))
             .withColumn("_pos_local", F.row_number().over(w)))
    if k == 0:
        return _drop_norm(local.withColumn(name, F.col("_seq_local")).drop("_item", "_seq_local", "_pos_local"))
    # Tail of every bucket: its last k items, in order.
    w_desc = Window.partitionBy(*keys, _B).orderBy(*[c.desc() for c in order_cols])
    tails = (base.withColumn("_rpos", F.row_number().over(w_desc)).filter(F.col("_rpos") <= k)
             .groupBy(*keys, _B)
             .agg(F.sort_array(F.collect_list(F.struct(F.col("_rpos").alias("r"), F.col("_item").alias("x"))),
                               asc=False).alias("_tail")))
    tails = tails.withColumn("_tail", F.transform("_tail", lambda s: s["x"]))
    # Concatenate the tails of the k preceding buckets and keep the last k items.
    w_prev = Window.partitionBy(*keys).orderBy(_B).rowsBetween(-k, -1)
    tails = tails.select(*keys, _B, F.flatten(F.collect_list("_tail").over(w_prev)).alias("_prev"))
    tails = tails.withColumn("_prev", F.slice("_prev", F.greatest(F.size("_prev") - k + 1, F.lit(1)), k))
    out = local.join(tails, keys + [_B])
    full = F.concat(F.coalesce(F.col("_prev"), F.array()), F.col("_seq_local"))
    merged = F.when(F.col("_pos_local") <= k,
                    F.slice(full, F.greatest(F.size(full) - length + 1, F.lit(1)), length)
                    ).otherwise(F.col("_seq_local"))
    return _drop_norm(out.withColumn(name, merged).drop("_item", "_seq_local", "_pos_local", "_prev"))
