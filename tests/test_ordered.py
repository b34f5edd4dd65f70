"""Bucketed ordered operators agree with plain windows, also on a hot key."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators.ordered import (hash_bits, lag_within, row_number_within, running_sums, trailing_rows,
                                          with_key_ranges)


def _data(spark, n=600, seed=3):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else (None if i % 47 == 0 else f"k{rnd.randint(0, 20)}")
        rows.append((i, key, rnd.randint(0, 500), float(rnd.random())))
    return spark.createDataFrame(rows, "id long, key string, t long, v double")


def _rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_running_sums_match_window(spark):
    df = _data(spark).repartition(5)
    w = Window.partitionBy("key").orderBy("t", "id")
    want = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("s"),
                     F.row_number().over(w).alias("rn"), F.count(F.lit(1)).over(Window.partitionBy("key")).alias("n"))
    got = running_sums(df, ["key"], F.floor(F.col("t") / 37), ["t", "id"], {"s": F.col("v")})
    got = row_number_within(got, ["key"], F.floor(F.col("t") / 37), ["t", "id"], "rn", "n")
    a = {r["id"]: (round(r["s"], 9), r["rn"], r["n"]) for r in want.collect()}
    b = {r["id"]: (round(r["s"], 9), r["rn"], r["n"]) for r in got.collect()}
    assert a == b


def test_lag_matches_window_any_partitioning(spark):
    df = _data(spark)
    w = Window.partitionBy("key").orderBy("t", "id")
    want = _rows(df.select("id", F.lag("v").over(w).alias("prev")), ["id", "prev"])
    for parts in (1, 7):
        got = lag_within(df.repartition(parts), ["key"], F.floor(F.col("t") / 50), ["t", "id"], "v", "prev")
        assert _rows(got, ["id", "prev"]) == want
    # lagging the leading order column itself uses the plain-max path
    want_t = _rows(df.select("id", F.lag("t").over(w).alias("pt")), ["id", "pt"])
    got_t = lag_within(df, ["key"], F.floor(F.col("t") / 50), ["t", "id"], "t", "pt")
    assert _rows(got_t, ["id", "pt"]) == want_t


def test_trailing_rows_match_frame(spark):
    df = _data(spark, 300)
    w = Window.partitionBy("key").orderBy("t", "id").rowsBetween(-3, 0)
    want = {r["id"]: list(r["s"]) for r in df.select("id", F.collect_list("id").over(w).alias("s")).collect()}
    got = trailing_rows(df, ["key"], F.floor(F.col("t") / 20), ["t", "id"], F.col("id"), 4, "s")
    assert {r["id"]: list(r["s"]) for r in got.collect()} == want


def _check_ranges(df, keys, order, target):
    """Ranges of bounded size, few (key, range) pairs, non-decreasing along the order."""
    n = df.count()
    ranged = with_key_ranges(df, keys, order, "b", rows_per_range=target)
    ranges = -(-n // target)
    sizes = [r["count"] for r in ranged.groupBy("b").count().collect()]
    assert sum(sizes) == n and max(sizes) <= 2 * target
    assert ranged.select(*keys, "b").distinct().count() <= df.select(*keys).distinct().count() + ranges
    rows = sorted((tuple((r[c] is not None, r[c]) for c in [*keys, *order]), r["b"]) for r in ranged.collect())
    assert all(x[1] <= y[1] for x, y in zip(rows, rows[1:]))
    return ranged


def test_ranges_of_a_bursty_key(spark):
    """One row in 2014 and 20,000 rows within one hour of 2024."""
    burst = spark.range(20_000).select(F.lit("k").alias("key"), F.timestamp_millis(F.lit(1_720_000_000_000) + F.col("id") * 180).alias("t"), "id")
    early = spark.range(1).select(F.lit("k").alias("key"), F.timestamp_seconds(F.lit(1_400_000_000)).alias("t"), F.lit(-1).cast("long").alias("id"))
    _check_ranges(burst.unionByName(early), ["key"], ["t", "id"], 1000)


def test_ranges_with_one_time_for_a_third(spark):
    df = spark.range(15_000).select((F.col("id") % 4).alias("key"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("t"), "id")
    _check_ranges(df, ["key"], ["t", "id"], 700)


def test_ranges_of_a_hot_key_among_many(spark):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("key"), (F.col("id") * 60).alias("t"), "id")
    ranged = _check_ranges(df, ["key"], ["t", "id"], 500)
    assert ranged.filter("key = 'hot'").select("b").distinct().count() > 5
    w = Window.partitionBy("key").orderBy("t", "id")
    want = _rows(df.select("id", F.coalesce(F.lag("id").over(w), F.lit(-1)).alias("p")), ["id", "p"])
    got = lag_within(ranged, ["key"], F.col("b"), ["t", "id"], "id", "p").withColumn("p", F.coalesce("p", F.lit(-1)))
    assert _rows(got, ["id", "p"]) == want


def test_global_ranges(spark):
    df = spark.range(5000).withColumn("x", (F.col("id") * 7919 % 10).cast("double"))
    ranged = _check_ranges(df, [], ["x", "id"], 500).withColumn("g", F.lit(0))
    got = row_number_within(ranged, ["g"], F.col("b"), ["x", "id"], "rn", None)
    want = df.select("id", F.row_number().over(Window.orderBy("x", "id")).alias("rn"))
    assert _rows(got, ["id", "rn"]) == _rows(want, ["id", "rn"])


def test_hash_bits_follow_the_rows():
    assert hash_bits(1) == 4 and hash_bits(250_000 * 16) == 4 and hash_bits(250_000 * 17) == 8 and hash_bits(10**12) == 24


def test_numbered_rows_move_once(spark):
    """Positions over the whole table equal a sort, with ties of all columns, over several ranges; no hash shuffle of the rows."""
    from ledgerlens.operators.ordered import numbered_rows
    rows = [(None if i % 17 == 0 else i * 7919 % 101, i % 5) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    out = numbered_rows(df, ["a", "b"], rows_per_range=130)
    got = [(r["a"], r["b"]) for r in sorted(out.collect(), key=lambda r: r["rn"])]
    assert got == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(r["rn"] for r in out.collect()) == list(range(1, 2001))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_ll_bucket" not in plan and "SortMergeJoin" not in plan
