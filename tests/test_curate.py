"""Curation rules on golden rows (row-local columns; cut-offs passed as literals)."""

import datetime as dt

from ledgerlens.operators.curate import CurationStats, apply_rules, curate, typed
from ledgerlens.schema import CURATED_COLUMNS, RAW_SCHEMA

T = dt.datetime


def _raw(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_golden_row(spark):
    # First row of the published EDA sample: amount 1431.3, balance 1058.13,
    # 2023-09-04 18:46:40 with a previous date of 2024-11-04 08:11:20.
    row = ("TX000476", "AC00464", 1431.3, T(2023, 9, 4, 18, 46, 40), "Debit", "Oklahoma City", "D000563",
           "7.105.184.86", "M082", "ATM", 18, "Student", 168, 1, 1058.13, T(2024, 11, 4, 8, 11, 20))
    stats = CurationStats(amount_p90=800.0, amount_p95=1000.0, ratio_p95=1.0, logins_p95=1.0)
    out = apply_rules(typed(_raw(spark, [row])), stats).first()
    assert out["amt_to_bal"] == 1.3526693317456266
    assert out["txn_hour"] == 18 and out["is_weekend"] == 0
    assert out["minutes_since_prev"] == -614244
    flags = [out[c] for c in ("flag_high_amount", "flag_high_ratio", "flag_many_logins", "flag_night",
                              "flag_rapid_repeat_high", "flag_weekend_high")]
    assert flags == [1, 1, 0, 0, 1, 0]
    assert out["risk_score"] == 3 and out["is_fraud"] == 1
    assert out["nlp_text"] == "Debit Oklahoma City ATM M082 D000563 7.105.184.86"
    assert out["label_source"] == "heuristic_v2"


def test_nulls_zero_balance_and_text(spark):
    rows = [
        ("1", "A", 10.0, T(2024, 1, 6, 3, 0, 0), " x ", None, "", "  ", None, "web", 30, " y ", 5, 9, 0.0, None),
        ("2", "A", 99.0, T(2024, 1, 6, 3, 1, 0), None, None, None, None, None, None, None, None, None, None,
         -5.0, T(2024, 1, 6, 3, 0, 0)),
    ]
    out = {r["TransactionID"]: r for r in curate(_raw(spark, rows)).collect()}
    a, b = out["1"], out["2"]
    assert list(curate(_raw(spark, rows)).columns) == CURATED_COLUMNS
    assert a["amt_to_bal"] is None                    # zero balance -> NULL ratio
    assert a["TransactionType"] == "x" and a["nlp_text"] == "x web"  # trimmed; NULL and '' dropped
    assert a["minutes_since_prev"] is None and a["flag_rapid_repeat_high"] == 0
    assert a["is_weekend"] == 1 and a["flag_night"] == 1  # Saturday 03:00
    assert a["flag_many_logins"] == 1                 # 9 >= greatest(p95, 3)
    assert b["amt_to_bal"] == 99.0 / -5.0 and b["minutes_since_prev"] == 1
    assert b["nlp_text"] == ""
