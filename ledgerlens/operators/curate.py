"""Curation: typed, trimmed raw rows -> rule flags -> weak label.

The table-wide cut-offs (p90/p95) are exact quantiles computed by
``operators.quantiles`` in three narrow distributed passes; the four numbers
come back to the driver and enter the plan as literals, so the flagging step
is a single map-only projection (the one-row statistics "cross join" folds
into constants).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..schema import (CURATED_COLUMNS, FLAG_COLUMNS, LABEL_SOURCE, RAW_SCHEMA, TEXT_PARTS,
                      TRIMMED_COLUMNS)
from .quantiles import Stat, quantiles


def typed(raw: DataFrame) -> DataFrame:
    """P1/P2 plus the row-local derived columns (P3-P6): the ``base`` step."""
    cols = []
    for f in RAW_SCHEMA.fields:
        c = F.col(f.name).cast(f.dataType)
        if f.name in TRIMMED_COLUMNS:
            c = F.trim(c)
        cols.append(c.alias(f.name))
    return raw.select(
        *cols,
        C.safe_ratio("TransactionAmount", "AccountBalance").alias("amt_to_bal"),
        C.hour_of(F.col("TransactionDate").cast(RAW_SCHEMA["TransactionDate"].dataType)).alias("txn_hour"),
        C.day_of_week0(F.col("TransactionDate").cast(RAW_SCHEMA["TransactionDate"].dataType)).alias("txn_dow"),
        C.minutes_between(F.col("PreviousTransactionDate").cast(RAW_SCHEMA["PreviousTransactionDate"].dataType),
                          F.col("TransactionDate").cast(RAW_SCHEMA["TransactionDate"].dataType)
                          ).alias("minutes_since_prev"),
    )


@dataclass(frozen=True)
class CurationStats:
    amount_p90: float | None
    amount_p95: float | None
    ratio_p95: float | None
    logins_p95: float | None


def curation_stats(base: DataFrame) -> CurationStats:
    """A1: the four cut-offs, exact, in one set of passes over three columns."""
    vals = quantiles(base, [Stat("TransactionAmount", 0.90), Stat("TransactionAmount", 0.95),
                            Stat("amt_to_bal", 0.95), Stat("LoginAttempts", 0.95)])
    return CurationStats(*vals)


def stats_frame(spark, stats: CurationStats) -> DataFrame:
    """The cut-offs as a one-row DataFrame (for reports)."""
    return spark.createDataFrame(
        [(stats.amount_p90, stats.amount_p95, stats.ratio_p95,
          None if stats.logins_p95 is None else int(stats.logins_p95))],
        "amount_p90 double, amount_p95 double, ratio_p95 double, logins_p95 bigint")


def _lit(v, t="double"):
    return F.lit(v).cast(t)


def apply_rules(base: DataFrame, s: CurationStats) -> DataFrame:
    """P7-P11 on typed rows, given the cut-offs."""
    amt, ratio, logins = F.col("TransactionAmount"), F.col("amt_to_bal"), F.col("LoginAttempts")
    weekend = F.col("txn_dow").isin(0, 6)
    logins_cut = F.greatest(_lit(s.logins_p95, "long"), F.lit(3).cast("long"))
    flags = {
        "flag_high_amount": C.flag(amt >= _lit(s.amount_p95)),
        "flag_high_ratio": C.flag(ratio >= _lit(s.ratio_p95)),
        "flag_many_logins": C.flag(logins >= logins_cut),
        "flag_night": C.flag(F.col("txn_hour").between(0, 5)),
        "flag_rapid_repeat_high": C.flag(F.col("minutes_since_prev").isNotNull()
                                         & (F.col("minutes_since_prev") <= 2)
                                         & (amt >= _lit(s.amount_p90))),
        "flag_weekend_high": C.flag(weekend & (amt >= _lit(s.amount_p90))),
    }
    ruled = base.select("*", C.flag(weekend).alias("is_weekend"),
                        *[v.alias(k) for k, v in flags.items()])
    score = sum((F.col(f) for f in FLAG_COLUMNS[1:]), F.col(FLAG_COLUMNS[0]))
    return ruled.select(
        "*",
        score.cast("int").alias("risk_score"),
        C.flag(score >= 2).alias("is_fraud"),
        C.join_non_empty(TEXT_PARTS).alias("nlp_text"),
        F.lit(LABEL_SOURCE).alias("label_source"),
    ).select(*CURATED_COLUMNS)


def curate(raw: DataFrame, stats: CurationStats | None = None) -> DataFrame:
    """Raw transactions -> the 30-column curated table."""
    base = typed(raw)
    if stats is None:
        stats = curation_stats(base)
    return apply_rules(base, stats)
