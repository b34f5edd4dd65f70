"""Reproducible train / val / test splits as one ``split`` column (SP1-SP5, W3, U1).

Randomness is a hash: rows (or accounts) are ranked by md5(id || ':' ||
seed), so the result does not depend on partitioning, task order or
retries.  Ranks come from ``operators.ordered`` with buckets taken from the
leading bits of that hash, as many as the row count asks for: a stratum
holding 94% of the rows is spread over (stratum, bucket) windows of a bounded
number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ACCOUNT_COL, ID_COL, RANDOM_SEED, TARGET_COL, TEST_SIZE, TIME_COL, VAL_SIZE
from ..session import materialize
from .ordered import hash_bits, hash_bucket, row_number_within, with_key_ranges

TRAIN, VAL, TEST = "train", "val", "test"


def seeded_hash(c: str, seed: int = RANDOM_SEED) -> Column:
    """md5 of the value and the seed (same digest in Spark and DuckDB)."""
    return F.md5(F.concat(F.col(c).cast("string"), F.lit(f":{seed}")))


def _assign(rank: Column, n: Column, test_size: float, val_ratio: float | None) -> Column:
    n_test = F.ceil(F.lit(float(test_size)) * n)
    if val_ratio is None:
        return F.when(rank <= n_test, F.lit(TEST)).otherwise(F.lit(TRAIN))
    n_val = F.ceil(F.lit(float(val_ratio)) * (n - n_test))
    return (F.when(rank <= n_test, F.lit(TEST))
            .when(rank <= n_test + n_val, F.lit(VAL))
            .otherwise(F.lit(TRAIN)))


def stratified_split(df: DataFrame, label: str = TARGET_COL, id_col: str = ID_COL,
                     test_size: float = TEST_SIZE, val_size: float | None = VAL_SIZE,
                     seed: int = RANDOM_SEED) -> DataFrame:
    """SP1 / SP4: per stratum, the first ceil(test*n) rows by hash are test,
    then ceil(val/(1-test) * rest) are val, the remainder train.

    ``val_size=None`` gives a two-way (train/test) split.
    """
    h = seeded_hash(id_col, seed)
    x = df.withColumn("_h", h)
    x = row_number_within(x, [label], hash_bucket("_h", hash_bits(df.count())), ["_h", id_col], name="_r", count_name="_n")
    val_ratio = None if val_size is None else val_size / (1.0 - test_size)
    return x.withColumn("split", _assign(F.col("_r"), F.col("_n"), test_size, val_ratio)).drop("_h", "_r", "_n")


def group_split(df: DataFrame, group: str = ACCOUNT_COL, test_size: float = TEST_SIZE,
                val_size: float = VAL_SIZE, seed: int = RANDOM_SEED) -> DataFrame:
    """SP2: whole groups (accounts) go to one split; ratios count groups.

    The distinct groups are ranked by hash; the (group -> split) table is
    joined back on the group key (AQE broadcasts it when its measured size
    allows and splits a hot group's partition otherwise).
    """
    g = df.select(F.col(group).cast("string").alias("_g")).distinct()
    g = materialize(g.withColumn("_h", seeded_hash("_g", seed)).withColumn("_k", F.lit(0)), "split_groups")
    g = row_number_within(g, ["_k"], hash_bucket("_h", hash_bits(g.count())), ["_h", "_g"], name="_r", count_name="_n")
    val_ratio = val_size / (1.0 - test_size)
    g = g.select("_g", _assign(F.col("_r"), F.col("_n"), test_size, val_ratio).alias("split"))
    return (df.join(g, df[group].cast("string").eqNullSafe(g["_g"]), "left").drop("_g"))


def _round_half_even(x: Column) -> Column:
    return F.bround(x, 0)


def time_split(df: DataFrame, account: str = ACCOUNT_COL, time: str = TIME_COL, id_col: str = ID_COL,
               val_frac: float = VAL_SIZE, test_frac: float = TEST_SIZE) -> DataFrame:
    """W3 / SP3: per account, in (time, id) order: train first, then val, then
    the latest rows test.  n_test = max(1, round(n*test)), n_val likewise
    (half-even rounding), n_train = max(0, n - n_val - n_test).
    """
    added = account not in df.columns
    if added:  # W1: time order only -> one key, still cut into ranges
        df = df.withColumn(account, F.lit("__all__"))
    x = with_key_ranges(df, [account], [time, id_col])
    x = row_number_within(x, [account], F.col("_ll_range"), [time, id_col], name="_r", count_name="_n").drop("_ll_range")
    if added:
        x = x.drop(account)
    n = F.col("_n")
    n_test = F.greatest(F.lit(1), _round_half_even(n * F.lit(float(test_frac))).cast("long"))
    n_val = F.greatest(F.lit(1), _round_half_even(n * F.lit(float(val_frac))).cast("long"))
    n_train = F.greatest(F.lit(0), n - n_val - n_test)
    split = (F.when(F.col("_r") <= n_train, F.lit(TRAIN))
             .when(F.col("_r") <= n_train + n_val, F.lit(VAL))
             .otherwise(F.lit(TEST)))
    return x.withColumn("split", split).drop("_r", "_n")


def split(df: DataFrame, strategy: str = "random", **kw) -> DataFrame:
    """SP5: dispatch on ``random`` / ``group`` / ``time`` (default random)."""
    s = (strategy or "random").lower()
    if s == "group":
        return group_split(df, **kw)
    if s == "time":
        return time_split(df, **kw)
    return stratified_split(df, **kw)


def pieces(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three splits as separate DataFrames (their unionByName is ``df``)."""
    return tuple(df.filter(F.col("split") == s).drop("split") for s in (TRAIN, VAL, TEST))
