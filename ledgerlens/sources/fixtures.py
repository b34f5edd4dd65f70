"""Adapters that derive transaction-shaped inputs from the driver tables.

``transactions``: events (+ customer, nation) as raw transactions, with
planted empty strings, NULLs, zero balances, first-in-account NULL dates and
rapid repeats.  ``card_transactions_raw``: lineitem as the anonymised card
data set (Time, V1..V4, Amount, Class).  ``predictions``: deterministic
scores over curated rows, for the metric operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import lag_within, numbered_rows, with_key_ranges
from ..schema import RAW_COLUMNS, TS
from .tables import table


def _s(c: Column) -> Column:
    return c.cast("string")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transactions (16 columns of RAW_SCHEMA) derived from ``events``.

    The previous-transaction time is the account's previous event, computed
    per (account, range) window with a carried-over last value; ranges hold equal
    numbers of events (``with_key_ranges``), so an account with a third of all
    events is still spread over many tasks.
    """
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # customer / nation are dimension tables: joined on their keys, AQE picks
    # broadcast when their measured size allows, sort-merge otherwise.
    j = (e.join(c, e.user_id == c.c_custkey, "left")
         .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))
    eid, uid = F.col("event_id"), F.col("user_id")
    j = j.drop("c_custkey", "c_nationkey", "n_nationkey")  # the keys end here: they don't move with the rows
    j = with_key_ranges(j, ["user_id"], ["ts", "event_id"])
    j = lag_within(j, ["user_id"], F.col("_ll_range"), ["ts", "event_id"], "ts", "_prev_ts")
    return j.select(
        _s(eid).alias("TransactionID"),
        _s(uid).alias("AccountID"),
        F.col("value").alias("TransactionAmount"),
        F.col("ts").cast(TS).alias("TransactionDate"),
        F.col("event_type").alias("TransactionType"),
        F.col("n_name").alias("Location"),
        F.concat(F.lit("D"), _s(eid % 97)).alias("DeviceID"),
        F.when(eid % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("10.0.0."), _s(uid % 250))).alias("IP_Address"),
        F.when(eid % 13 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("M"), _s(eid % 100))).alias("MerchantID"),
        F.col("c_mktsegment").alias("Channel"),
        (F.lit(18) + uid % 60).cast("long").alias("CustomerAge"),
        F.col("c_mktsegment").alias("CustomerOccupation"),
        (F.lit(10) + eid % 290).cast("long").alias("TransactionDuration"),
        F.when(eid % 17 == 0, F.lit(5)).otherwise(F.lit(1) + eid % 2).cast("long").alias("LoginAttempts"),
        F.when(eid % 101 == 0, F.lit(0.0)).otherwise(F.col("c_acctbal")).alias("AccountBalance"),
        F.when(eid % 19 == 0, F.col("ts") - F.expr("INTERVAL 90 SECONDS"))
         .otherwise(F.col("_prev_ts")).cast(TS).alias("PreviousTransactionDate"),
    ).select(*RAW_COLUMNS)


# Same adapter as DuckDB SQL (oracle side).
TRANSACTIONS_SQL = """
SELECT CAST(e.event_id AS VARCHAR) AS TransactionID, CAST(e.user_id AS VARCHAR) AS AccountID,
       e.value AS TransactionAmount, e.ts AS TransactionDate, e.event_type AS TransactionType,
       n.n_name AS Location, concat('D', CAST(e.event_id % 97 AS VARCHAR)) AS DeviceID,
       CASE WHEN e.event_id % 11 = 0 THEN '' ELSE concat('10.0.0.', CAST(e.user_id % 250 AS VARCHAR)) END AS IP_Address,
       CASE WHEN e.event_id % 13 = 0 THEN NULL ELSE concat('M', CAST(e.event_id % 100 AS VARCHAR)) END AS MerchantID,
       c.c_mktsegment AS Channel, CAST(18 + e.user_id % 60 AS BIGINT) AS CustomerAge,
       c.c_mktsegment AS CustomerOccupation, CAST(10 + e.event_id % 290 AS BIGINT) AS TransactionDuration,
       CAST(CASE WHEN e.event_id % 17 = 0 THEN 5 ELSE 1 + e.event_id % 2 END AS BIGINT) AS LoginAttempts,
       CASE WHEN e.event_id % 101 = 0 THEN CAST(0 AS DOUBLE) ELSE c.c_acctbal END AS AccountBalance,
       CASE WHEN e.event_id % 19 = 0 THEN e.ts - INTERVAL 90 SECOND
            ELSE lag(e.ts) OVER (PARTITION BY e.user_id ORDER BY e.ts, e.event_id) END AS PreviousTransactionDate
FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
              LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
"""


def card_transactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem shaped as the card data set, with an explicit ``row_id``.

    Time = l_orderkey, V1..V4 = quantity, extendedprice, discount, tax,
    Amount = l_extendedprice, Class = (discount >= 0.1 and returnflag 'R').
    ``row_id`` (0-based) orders rows by all columns, because (orderkey,
    linenumber) is not unique; it plays the role of the file row index.
    """
    li = table(spark, sf_dir, "lineitem")
    # A global row number: ranges of all order columns, so no single task sees
    # the table, whatever one order key holds.  The card columns are all made of
    # order columns, so they follow after the rows have moved.
    df = numbered_rows(li, li.columns, name="_rn")
    return df.select(
        F.col("l_orderkey").cast("double").alias("Time"),
        F.col("l_quantity").alias("V1"), F.col("l_extendedprice").alias("V2"),
        F.col("l_discount").alias("V3"), F.col("l_tax").alias("V4"),
        F.col("l_extendedprice").alias("Amount"),
        F.when((F.col("l_discount") >= 0.1) & (F.col("l_returnflag") == "R"), 1).otherwise(0).alias("Class"),
        (F.col("_rn") - 1).alias("row_id"))


CARD_RAW_SQL = """
SELECT CAST(l_orderkey AS DOUBLE) AS "Time", l_quantity AS V1, l_extendedprice AS V2, l_discount AS V3,
       l_tax AS V4, l_extendedprice AS Amount,
       CAST(CASE WHEN l_discount >= 0.1 AND l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS "Class",
       row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                          l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) - 1 AS row_id
FROM lineitem
"""


def predictions(curated: DataFrame, moduli=(97, 53)) -> DataFrame:
    """(id, model, label, score) for deterministic score models over curated rows.

    score = floor(((amount % m) / m) * 100) / 100 for model ``m<m>``: two
    decimals, many ties, label = is_fraud.
    """
    amt = F.col("TransactionAmount")
    base = curated.select(F.col("TransactionID").alias("id"), F.col("is_fraud").alias("label"), amt)
    out = None
    for m in moduli:
        score = F.floor(((amt % F.lit(m)) / F.lit(float(m))) * F.lit(100)) / F.lit(100.0)
        part = base.select("id", F.lit(f"m{m}").alias("model"), "label", score.alias("score"))
        out = part if out is None else out.unionByName(part)
    return out


def predictions_sql(src: str = "curated", moduli=(97, 53)) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT TransactionID AS id, 'm{m}' AS model, is_fraud AS label, "
        f"floor(((TransactionAmount % {m}) / CAST({m} AS DOUBLE)) * 100) / CAST(100 AS DOUBLE) AS score FROM {src}"
        for m in moduli)
