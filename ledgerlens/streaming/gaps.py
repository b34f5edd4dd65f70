"""The time since an account's previous transaction, kept as state of a stream.

The state is one row for each account: the time of its latest transaction so far. Rows of a micro-batch are taken in
order of (time, id) within the account; the first of them looks at the state. The gap is the difference to the row before
in that order, so a row that arrives in a later batch than its successor has a negative one, as in the batch form.

With ``expire_days``, a transaction so long after the one before counts as an account's first, and the state of an account
goes once the stream's event time (its watermark) is that far beyond it; rows that arrive so late that the watermark has passed them are
dropped. Without it, accounts are kept for good and no row is dropped.

State lives in the checkpoint, so a query that is started again goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_MICROS_A_DAY = 86_400_000_000
OUTPUT = "AccountID string, TransactionID string, TransactionDate timestamp_ntz, PreviousTransactionDate timestamp_ntz, secs_since_prev double"


def account_gaps(stream: DataFrame, expire_days: int | None = None) -> DataFrame:
    """(AccountID, TransactionID, TransactionDate, PreviousTransactionDate, secs_since_prev) of every row, in arrival order.

    Rows without a time or an account have no gap and leave no state.
    """
    micros = F.unix_micros(F.col("TransactionDate").cast("timestamp"))
    if expire_days is not None:
        stream = (stream.withColumn("TransactionDate", F.col("TransactionDate").cast("timestamp"))
                  .withWatermark("TransactionDate", f"{expire_days} days"))
    rows = stream.select("AccountID", "TransactionID", micros.alias("at"), *(["TransactionDate"] if expire_days is not None else []))

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last = state.get[0] if state.exists else None
        rows = pd.concat(list(parts)).sort_values(["at", "TransactionID"], na_position="last")
        at = rows["at"].astype("Int64")
        before = at.shift(1)
        if len(before):
            before.iloc[0] = last if last is not None else pd.NA
        before[at.isna()] = pd.NA
        gap = at - before
        if key[0] is None:
            before[:] = gap[:] = pd.NA
        if expire_days is not None:
            gone = (gap > expire_days * _MICROS_A_DAY).fillna(False).astype(bool)
            before[gone] = gap[gone] = pd.NA
        if key[0] is not None and at.notna().any():
            latest = int(at.dropna().iloc[-1])
            state.update((latest,))
            if expire_days is not None:
                state.setTimeoutTimestamp(max((latest + expire_days * _MICROS_A_DAY) // 1000, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"AccountID": rows["AccountID"], "TransactionID": rows["TransactionID"], "at": at, "before": before,
                            "secs": (gap / 1e6).astype("Float64")})
    out = rows.groupBy("AccountID").applyInPandasWithState(
        step, "AccountID string, TransactionID string, at bigint, before bigint, secs double", "last bigint", "append",
        GroupStateTimeout.NoTimeout if expire_days is None else GroupStateTimeout.EventTimeTimeout)

    def wall(c: str):
        return F.timestamp_micros(c).cast("timestamp_ntz")
    return out.select("AccountID", "TransactionID", wall("at").alias("TransactionDate"), wall("before").alias("PreviousTransactionDate"),
                      F.col("secs").alias("secs_since_prev"))
