"""Features, per-account windows and schema-driven column selection.

P12-P21, A2, W1, W2, W4.  Per-account order (account, time, id) is never a
global sort in one task: each consumer runs a window on (account, range) through
``operators.ordered``, so one hot account is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as C
from ..schema import (ACCOUNT_COL, ID_COL, LEAKY_COLUMNS, PREV_TIME_COL, ROLE_DROP_COLUMNS, TARGET_COL,
                      TIME_COL, TS)
from ..session import materialize
from .ordered import lag_within, row_number_within, trailing_rows, with_key_ranges
from .profile import NUMERIC_TYPES
from .quantiles import median

# -------------------------------------------------------------- P13-P16, A2


def secs_since_prev_median(df: DataFrame) -> float | None:
    """A2: exact median of the seconds between a transaction and the previous one."""
    if PREV_TIME_COL not in df.columns or TIME_COL not in df.columns:
        return None
    d = df.select(C.seconds_between(PREV_TIME_COL, TIME_COL).alias("d"))
    return median(d, "d")


def add_simple_features(df: DataFrame, secs_median: float | None = None, fit_median: bool = True,
                        log1p: bool = False) -> DataFrame:
    """Presence-guarded model features.

    * ``amt_to_bal`` = amount / (|balance| + 1e-6), overwriting the curated
      column of the same name;
    * ``secs_since_prev`` = fractional seconds since the previous
      transaction, NULL -> the median of that delta (``secs_median``, or the
      exact median over ``df`` when ``fit_median``);
    * ``logins_log1p`` = LoginAttempts with NULL -> 0 (the source applies no
      log; ``log1p=True`` applies one).
    """
    out = df
    cols = set(df.columns)
    if "TransactionAmount" in cols and "AccountBalance" in cols:
        out = out.withColumn("amt_to_bal", C.ratio_abs("TransactionAmount", "AccountBalance"))
    if PREV_TIME_COL in cols and TIME_COL in cols:
        if secs_median is None and fit_median:
            secs_median = secs_since_prev_median(df)
        delta = C.seconds_between(PREV_TIME_COL, TIME_COL)
        out = out.withColumn("secs_since_prev", F.coalesce(delta, F.lit(secs_median).cast("double")))
    if "LoginAttempts" in cols:
        x = F.coalesce(F.col("LoginAttempts"), F.lit(0)).cast("double")
        out = out.withColumn("logins_log1p", F.log1p(x) if log1p else x)
    return out


# -------------------------------------------------------------- P12, W2

CARD_EPOCH = "2019-01-01 00:00:00"


def card_canonical(card: DataFrame, row_col: str = "row_id", accounts: int = 10000) -> DataFrame:
    """P12 + W2: the card data set in the canonical transaction columns.

    ``Amount`` -> TransactionAmount, ``Class`` -> is_fraud (int), id
    ``ULB_<row>``, time = 2019-01-01 + ``Time`` seconds, account
    ``ULB_ACC_<row % accounts>``, previous time = lag within the account by
    (time, row), ``nlp_text`` = '' when absent; Time and V* are kept.
    """
    row = F.col(row_col)
    base_s = F.unix_seconds(F.lit(CARD_EPOCH).cast("timestamp"))
    out = card.withColumnsRenamed({"Amount": "TransactionAmount", "Class": TARGET_COL}).withColumn(TARGET_COL, F.col(TARGET_COL).cast("int"))
    time = F.timestamp_seconds(base_s + F.col("Time")).cast(TS)
    # rows move without the columns that follow from Time and the row number
    out = with_key_ranges(out, [F.pmod(row, F.lit(accounts))], [time, row])
    out = out.withColumns({TIME_COL: time, "_account": F.pmod(row, F.lit(accounts))})
    out = lag_within(out, ["_account"], F.col("_ll_range"), [TIME_COL, row_col], TIME_COL, PREV_TIME_COL).drop("_ll_range")
    names = [c for c in out.columns if c not in ("_account", TIME_COL, PREV_TIME_COL)]
    out = out.select(*names, F.concat(F.lit("ULB_"), row.cast("string")).alias(ID_COL), TIME_COL,
                     F.concat(F.lit("ULB_ACC_"), F.col("_account").cast("string")).alias(ACCOUNT_COL), PREV_TIME_COL)
    if "nlp_text" not in out.columns:
        out = out.withColumn("nlp_text", F.lit(""))
    return out


# -------------------------------------------------------------- W4


def build_sequences(df: DataFrame, feature_cols: Sequence[str], length: int = 10) -> DataFrame:
    """For each row at position >= ``length`` in its account, the last
    ``length`` rows' feature vectors (oldest first) and the row's label.

    Accounts shorter than ``length`` give no rows (only full windows).
    """
    item = F.array(*[F.col(c).cast("double") for c in feature_cols])
    keys, order = [ACCOUNT_COL], [TIME_COL, ID_COL]
    if ACCOUNT_COL not in df.columns:  # W1: time order only -> one key, still cut into ranges
        df = df.withColumn(ACCOUNT_COL, F.lit("__all__"))
    x = df.select(ACCOUNT_COL, TIME_COL, ID_COL, TARGET_COL, *feature_cols)
    x = with_key_ranges(x, keys, order)
    # the position is read by both branches of the trailing rows: written once
    x = materialize(row_number_within(x, keys, F.col("_ll_range"), order, name="pos", count_name=None), "positions")
    x = trailing_rows(x, keys, F.col("_ll_range"), order, item, length, "seq")
    return (x.filter(F.col("pos") >= length)
            .select(ACCOUNT_COL, ID_COL, "pos", "seq", F.col(TARGET_COL).alias("label")))


# -------------------------------------------------------------- P17-P21


def model_drop_columns(df: DataFrame, drop_leaky: bool = True, extra: Sequence[str] = ()) -> list[str]:
    """P17 (+P20 via ``extra``): role columns, leaky flags and extra columns present in ``df``."""
    cols = list(ROLE_DROP_COLUMNS) + (list(LEAKY_COLUMNS) if drop_leaky else []) + list(extra)
    return [c for c in cols if c in df.columns]


def typed_columns(df: DataFrame, exclude: Sequence[str] = (TARGET_COL,)) -> tuple[list[str], list[str]]:
    """(numeric, categorical) column names, each sorted by name, minus ``exclude``."""
    num = sorted(f.name for f in df.schema.fields
                 if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in exclude)
    cat = sorted(f.name for f in df.schema.fields
                 if isinstance(f.dataType, T.StringType) and f.name not in exclude)
    return num, cat


def high_cardinality_columns(df: DataFrame, cols: Sequence[str] | None = None, limit: int = 100,
                             approx: bool = False) -> list[str]:
    """String columns with more than ``limit`` distinct non-null values.

    One aggregate over all candidate columns (exact ``count_distinct`` or
    HyperLogLog++).
    """
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    cols = list(cols)
    if not cols:
        return []
    fn = F.approx_count_distinct if approx else F.count_distinct
    row = df.agg(*[fn(F.col(c)).alias(f"d{i}") for i, c in enumerate(cols)]).first()
    return [c for i, c in enumerate(cols) if row[f"d{i}"] > limit]


def model_frame_columns(df: DataFrame, drop_leaky: bool = True, extra_drop: Sequence[str] = (),
                        drop_high_cardinality: bool = False) -> tuple[list[str], list[str]]:
    """P17-P20 combined: the (numeric, categorical) inputs of the tabular model."""
    drop = model_drop_columns(df, drop_leaky, extra_drop)
    if drop_high_cardinality:
        cand = [f.name for f in df.schema.fields
                if isinstance(f.dataType, T.StringType) and f.name not in drop]
        drop += high_cardinality_columns(df, cand)
    kept = df.drop(*drop)
    return typed_columns(kept)


def common_numeric_columns(a: DataFrame, b: DataFrame,
                           drop: Sequence[str] = tuple(ROLE_DROP_COLUMNS)) -> list[str]:
    """Numeric columns of ``a`` (minus ``drop``) that are numeric in ``b`` too, sorted."""
    num_b = {f.name for f in b.schema.fields if isinstance(f.dataType, NUMERIC_TYPES)}
    return sorted(f.name for f in a.schema.fields
                  if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in drop and f.name in num_b)
