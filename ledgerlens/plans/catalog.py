"""Registered queries: each reads the driver tables of ``sf_dir``.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLE_SQL[name]`` (the
DuckDB statement over the same tables) share column names and types.
Doubles that come out of multi-row arithmetic are rounded to 6 places on
both sides, so summation order cannot change the compared value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import calibrate as cal
from ..operators import curate as cur
from .warehouse import shared
from ..sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn
    return deco


def r6(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


# ---------------------------------------------------------------- shared SQL

RAW_CTE = f"raw AS ({fx.TRANSACTIONS_SQL})"

# SURVEY P1, P2, P4-P6: the raw row with its typed, trimmed and derived columns.
BASE_CTE = """
base AS (
  SELECT TransactionID::VARCHAR AS TransactionID, AccountID::VARCHAR AS AccountID,
         TransactionAmount::DOUBLE AS TransactionAmount, TransactionDate::TIMESTAMP AS TransactionDate,
         CustomerAge::BIGINT AS CustomerAge, TransactionDuration::BIGINT AS TransactionDuration,
         LoginAttempts::BIGINT AS LoginAttempts, AccountBalance::DOUBLE AS AccountBalance,
         PreviousTransactionDate::TIMESTAMP AS PreviousTransactionDate,
         trim(COLUMNS('^(TransactionType|Location|DeviceID|IP_Address|MerchantID|Channel|CustomerOccupation)$')),
         if(AccountBalance = 0, NULL, TransactionAmount / AccountBalance) AS amt_to_bal,
         extract('hour' FROM TransactionDate)::INTEGER AS txn_hour,
         extract('dow' FROM TransactionDate)::INTEGER AS txn_dow,
         date_sub('minute', PreviousTransactionDate, TransactionDate) AS minutes_since_prev
  FROM raw)"""

# A1: the four cut-offs.
STATS_CTE = """
stats AS (
  SELECT q_amount[1] AS amount_p90, q_amount[2] AS amount_p95, ratio_p95, logins_p95
  FROM (SELECT quantile_disc(TransactionAmount, [0.90, 0.95]) AS q_amount, quantile_disc(amt_to_bal, 0.95) AS ratio_p95,
               quantile_disc(LoginAttempts, 0.95) AS logins_p95 FROM base))"""

# A list of the six conditions makes the flags, their sum and the label.
CURATED_CTE = """
flagged AS (
  SELECT b.*, list_transform(
           [TransactionAmount >= amount_p95, amt_to_bal >= ratio_p95, LoginAttempts >= greatest(logins_p95, 3), txn_hour <= 5,
            minutes_since_prev <= 2 AND TransactionAmount >= amount_p90,
            txn_dow % 6 = 0 AND TransactionAmount >= amount_p90], lambda c: coalesce(c, false)::INTEGER) AS flags
  FROM base b, stats),
curated AS (
  SELECT * EXCLUDE (flags, txn_dow), coalesce(txn_dow % 6 = 0, false)::INTEGER AS is_weekend,
         flags[1] AS flag_high_amount, flags[2] AS flag_high_ratio, flags[3] AS flag_many_logins, flags[4] AS flag_night,
         flags[5] AS flag_rapid_repeat_high, flags[6] AS flag_weekend_high, list_sum(flags)::INTEGER AS risk_score,
         (list_sum(flags) >= 2)::INTEGER AS is_fraud,
         array_to_string(list_filter([TransactionType, Location, Channel, MerchantID, DeviceID, IP_Address],
                                     lambda x: x <> ''), ' ') AS nlp_text,
         'heuristic_v2' AS label_source
  FROM flagged)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


CURATED_WITH = with_ctes(RAW_CTE, BASE_CTE, STATS_CTE, CURATED_CTE)


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows (the ingested table), written once per session."""
    return shared(spark, sf_dir, "raw", lambda: fx.transactions(spark, sf_dir))


def curated_lazy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cur.curate(raw(spark, sf_dir))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The curated table (the S8 sink), written once per session and read by
    every downstream flow, as in the source system."""
    return shared(spark, sf_dir, "curated", lambda: curated_lazy(spark, sf_dir))


# ---------------------------------------------------------------- sources

@register("raw_transactions", with_ctes(RAW_CTE) + "SELECT * FROM raw")
def q_raw_transactions(spark, sf_dir):
    """The raw transaction rows derived from the driver tables."""
    return fx.transactions(spark, sf_dir)


# ---------------------------------------------------------------- curation

@register("curate", CURATED_WITH + "SELECT * FROM curated")
def q_curate(spark, sf_dir):
    """Flagship: P1-P11, A1, J1 -> the 30-column curated table (written once as
    the session's curated table, which every downstream query reads)."""
    return curated(spark, sf_dir)


@register("curate_stats", with_ctes(RAW_CTE, BASE_CTE, STATS_CTE)
          + "SELECT amount_p90, amount_p95, ratio_p95, CAST(logins_p95 AS BIGINT) AS logins_p95 FROM stats")
def q_curate_stats(spark, sf_dir):
    """A1: the exact p90/p95 cut-offs of amount, ratio and logins."""
    base = cur.typed(raw(spark, sf_dir))
    return cur.stats_frame(spark, cur.curation_stats(base))


# ---------------------------------------------------------------- profiling

from ..operators import profile as prof  # noqa: E402
from ..schema import CURATED_COLUMNS  # noqa: E402

CURATED_NUMERIC = ["TransactionAmount", "CustomerAge", "TransactionDuration", "LoginAttempts", "AccountBalance",
                   "amt_to_bal", "txn_hour", "is_weekend", "minutes_since_prev", "flag_high_amount",
                   "flag_high_ratio", "flag_many_logins", "flag_night", "flag_rapid_repeat_high",
                   "flag_weekend_high", "risk_score", "is_fraud"]
CURATED_STRING = ["TransactionID", "AccountID", "TransactionType", "Location", "DeviceID", "IP_Address",
                  "MerchantID", "Channel", "CustomerOccupation", "nlp_text", "label_source"]
CURATED_DATETIME = ["TransactionDate", "PreviousTransactionDate"]


def _describe_numeric_sql(cols, src="curated"):
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS count, round(avg({x}), 6) AS mean, "
            f"round(stddev_samp({x}), 6) AS std, round(min({x}), 6) AS min, "
            f"round(quantile_cont({x}, 0.25), 6) AS p25, round(quantile_cont({x}, 0.5), 6) AS p50, "
            f"round(quantile_cont({x}, 0.75), 6) AS p75, round(max({x}), 6) AS max FROM {src}")
    return "\nUNION ALL ".join(parts)


def _round_cols(df, cols):
    return df.select(*[r6(c).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("profile_numeric", CURATED_WITH + _describe_numeric_sql(CURATED_NUMERIC))
def q_profile_numeric(spark, sf_dir):
    """A3: numeric describe of the curated table."""
    d = prof.describe_numeric(curated(spark, sf_dir), CURATED_NUMERIC)
    return _round_cols(d, ["mean", "std", "min", "p25", "p50", "p75", "max"])


def _describe_categorical_sql(cols, src="curated"):
    parts = []
    for c in cols:
        parts.append(
            f"SELECT '{c}' AS column_name, sum(c) AS count, count(*) AS \"unique\", "
            f"arg_min(v, (-c, v)) AS top, max(c) AS freq "
            f"FROM (SELECT {c} AS v, count(*) AS c FROM {src} WHERE {c} IS NOT NULL GROUP BY {c})")
    return "\nUNION ALL ".join(f"SELECT column_name, CAST(count AS BIGINT) AS count, CAST(\"unique\" AS BIGINT) "
                               f"AS \"unique\", top, CAST(freq AS BIGINT) AS freq FROM ({p})" for p in parts)


@register("profile_categorical", CURATED_WITH + _describe_categorical_sql(CURATED_STRING))
def q_profile_categorical(spark, sf_dir):
    """A4: categorical describe (count, unique, top, freq) of the curated table."""
    return prof.describe_categorical(curated(spark, sf_dir), CURATED_STRING)


def _describe_datetime_sql(cols, src="curated"):
    parts = []
    for c in cols:
        us = f"epoch_us({c})"

        def ts(e):
            return f"make_timestamp(CAST(floor({e}) AS BIGINT))"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS count, "
            f"make_timestamp(CAST(sum(CAST({us} AS HUGEINT)) // count({c}) AS BIGINT)) AS mean, "
            f"{ts(f'min({us})')} AS min, {ts(f'quantile_cont({us}, 0.25)')} AS p25, "
            f"{ts(f'quantile_cont({us}, 0.5)')} AS p50, {ts(f'quantile_cont({us}, 0.75)')} AS p75, "
            f"{ts(f'max({us})')} AS max FROM {src}")
    return "\nUNION ALL ".join(parts)


@register("profile_datetime", CURATED_WITH + _describe_datetime_sql(CURATED_DATETIME))
def q_profile_datetime(spark, sf_dir):
    """A5: datetime describe (count, mean, min, quartiles, max)."""
    return prof.describe_datetime(curated(spark, sf_dir), CURATED_DATETIME)


@register("head", CURATED_WITH + "SELECT * FROM curated ORDER BY TransactionID LIMIT 5")
def q_head(spark, sf_dir):
    """First five curated rows by TransactionID (the top-n is the feature)."""
    return prof.head(curated(spark, sf_dir), 5)


@register("class_balance", CURATED_WITH + "SELECT is_fraud, count(*) AS count FROM curated GROUP BY is_fraud")
def q_class_balance(spark, sf_dir):
    """Rows per class."""
    return prof.class_balance(curated(spark, sf_dir))


@register("shape", CURATED_WITH + f"SELECT count(*) AS n_rows, CAST({len(CURATED_COLUMNS)} AS BIGINT) AS n_cols, "
          "CAST(coalesce(sum(is_fraud), 0) AS BIGINT) AS positives FROM curated")
def q_shape(spark, sf_dir):
    """Rows, columns, positives."""
    return prof.shape(curated(spark, sf_dir))


@register("distinct_counts", CURATED_WITH + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM curated" for c in CURATED_STRING))
def q_distinct_counts(spark, sf_dir):
    """Exact distinct values per string column."""
    return prof.distinct_counts(curated(spark, sf_dir), CURATED_STRING)


# ---------------------------------------------------------------- features and windows

from ..operators import features as feat  # noqa: E402

FEATURES_CTE = """
feat0 AS (
  SELECT * REPLACE (TransactionAmount / (abs(AccountBalance) + 1e-6) AS amt_to_bal),
         (epoch_us(TransactionDate) - epoch_us(PreviousTransactionDate)) / 1e6 AS _d,
         CAST(coalesce(LoginAttempts, 0) AS DOUBLE) AS logins_log1p
  FROM curated),
feat_med AS (SELECT quantile_cont(_d, 0.5) AS _m FROM feat0),
features AS (SELECT feat0.* EXCLUDE (_d), coalesce(_d, _m) AS secs_since_prev FROM feat0, feat_med)"""

FEATURES_WITH = with_ctes(RAW_CTE, BASE_CTE, STATS_CTE, CURATED_CTE, FEATURES_CTE)


def features(spark, sf_dir):
    return feat.add_simple_features(curated(spark, sf_dir))


@register("features", FEATURES_WITH + "SELECT * REPLACE (round(secs_since_prev, 6) AS secs_since_prev) FROM features")
def q_features(spark, sf_dir):
    """P13-P16 + A2: amt_to_bal (abs form), secs_since_prev (median-filled), logins_log1p."""
    return features(spark, sf_dir).withColumn("secs_since_prev", r6("secs_since_prev"))


@register("secs_median", FEATURES_WITH + "SELECT round(_m, 6) AS secs_median FROM feat_med")
def q_secs_median(spark, sf_dir):
    """A2: exact global median of the previous-transaction delta (seconds)."""
    m = feat.secs_since_prev_median(curated(spark, sf_dir))
    return spark.createDataFrame([(m,)], "secs_median double").select(r6("secs_median").alias("secs_median"))


CARD_CTE = f"""
card_raw AS ({fx.CARD_RAW_SQL}),
card_canon AS (
  SELECT "Time", V1, V2, V3, V4, Amount AS TransactionAmount, "Class" AS is_fraud, row_id,
         'ULB_' || CAST(row_id AS VARCHAR) AS TransactionID,
         TIMESTAMP '2019-01-01 00:00:00' + to_microseconds(CAST(round("Time" * 1000000) AS BIGINT)) AS TransactionDate,
         'ULB_ACC_' || CAST(row_id % 10000 AS VARCHAR) AS AccountID
  FROM card_raw),
card AS (
  SELECT *, lag(TransactionDate) OVER (PARTITION BY AccountID ORDER BY TransactionDate, row_id)
              AS PreviousTransactionDate,
         '' AS nlp_text
  FROM card_canon)"""


def card(spark, sf_dir):
    return feat.card_canonical(shared(spark, sf_dir, "card_raw", lambda: fx.card_transactions_raw(spark, sf_dir)))


@register("card_transactions", with_ctes(CARD_CTE) + "SELECT * FROM card")
def q_card_transactions(spark, sf_dir):
    """S7 + P12 + W2: lineitem as the card data set, canonical columns, lag per account."""
    return card(spark, sf_dir)


SEQ_FEATURES = ["TransactionAmount", "AccountBalance", "TransactionDuration", "LoginAttempts"]


@register("sequences", CURATED_WITH.rstrip() + """,
seqs AS (
  SELECT AccountID, TransactionID,
         row_number() OVER (PARTITION BY AccountID ORDER BY TransactionDate, TransactionID) AS pos,
         list([CAST(TransactionAmount AS DOUBLE), CAST(AccountBalance AS DOUBLE), CAST(TransactionDuration AS DOUBLE),
               CAST(LoginAttempts AS DOUBLE)])
           OVER (PARTITION BY AccountID ORDER BY TransactionDate, TransactionID
                 ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS seq,
         is_fraud AS label
  FROM curated)
SELECT * FROM seqs WHERE pos >= 10""")
def q_sequences(spark, sf_dir):
    """W4 (+W1 order): last 10 rows' features per account, label of the last row."""
    return feat.build_sequences(curated(spark, sf_dir), SEQ_FEATURES, 10)


MODEL_NUM = ["AccountBalance", "CustomerAge", "LoginAttempts", "TransactionAmount", "TransactionDuration",
             "amt_to_bal", "is_weekend", "logins_log1p", "minutes_since_prev", "secs_since_prev", "txn_hour"]
MODEL_CAT = ["AccountID", "Channel", "CustomerOccupation", "DeviceID", "IP_Address", "Location", "MerchantID",
             "TransactionType", "label_source"]


@register("model_frame", FEATURES_WITH + "SELECT " + ", ".join(
    [f"round({c}, 6) AS {c}" if c in ("AccountBalance", "TransactionAmount", "amt_to_bal", "logins_log1p",
                                       "secs_since_prev") else c for c in MODEL_NUM] + MODEL_CAT + ["is_fraud"])
    + " FROM features")
def q_model_frame(spark, sf_dir):
    """P17 + P18: role/leaky columns dropped, numerics then categoricals, each name-sorted."""
    f = features(spark, sf_dir)
    num, cat = feat.model_frame_columns(f)
    doubles = {x.name for x in f.schema.fields if x.dataType.typeName() == "double"}
    return f.select(*[r6(c).alias(c) if c in doubles else F.col(c) for c in num], *cat, "is_fraud")


@register("card_model_frame", with_ctes(CARD_CTE) + "SELECT \"Time\", TransactionAmount, V1, V2, V3, V4, "
          "row_id, is_fraud FROM card")
def q_card_model_frame(spark, sf_dir):
    """On the card data set, string columns with > 100 distinct values are dropped."""
    c = card(spark, sf_dir)
    num, cat = feat.model_frame_columns(c, drop_leaky=False, drop_high_cardinality=True)
    return c.select(*num, *cat, "is_fraud")


# ---------------------------------------------------------------- splits

from ..operators import split as sp  # noqa: E402

VAL_RATIO = 0.15 / (1.0 - 0.15)


def _strat_sql(test, val_ratio, src="curated", label="is_fraud", idc="TransactionID"):
    n_test = f"ceil(CAST({test!r} AS DOUBLE) * _n)"
    val = "" if val_ratio is None else (
        f"WHEN _r <= {n_test} + ceil(CAST({val_ratio!r} AS DOUBLE) * (_n - {n_test})) THEN 'val' ")
    return f"""
, ranked AS (
  SELECT {idc}, {label},
         row_number() OVER (PARTITION BY {label} ORDER BY md5(CAST({idc} AS VARCHAR) || ':42'), {idc}) AS _r,
         count(*) OVER (PARTITION BY {label}) AS _n
  FROM {src})
SELECT {idc}, {label}, CASE WHEN _r <= {n_test} THEN 'test' {val}ELSE 'train' END AS split FROM ranked"""


@register("split_random", CURATED_WITH.rstrip() + _strat_sql(0.15, VAL_RATIO).replace("\n, ranked", ",\nranked", 1))
def q_split_random(spark, sf_dir):
    """SP1: stratified 70/15/15 by hash rank within each class."""
    return sp.stratified_split(curated(spark, sf_dir)).select("TransactionID", "is_fraud", "split")


@register("split_stratified_80_20", CURATED_WITH.rstrip() + _strat_sql(0.2, None).replace("\n, ranked", ",\nranked", 1))
def q_split_80_20(spark, sf_dir):
    """SP4: stratified 80/20 (cross-dataset training split)."""
    return sp.stratified_split(curated(spark, sf_dir), test_size=0.2, val_size=None).select(
        "TransactionID", "is_fraud", "split")


@register("split_group", CURATED_WITH.rstrip() + f""",
groups AS (SELECT DISTINCT CAST(AccountID AS VARCHAR) AS g FROM curated),
granked AS (SELECT g, row_number() OVER (ORDER BY md5(g || ':42'), g) AS _r, count(*) OVER () AS _n FROM groups),
gsplit AS (
  SELECT g, CASE WHEN _r <= ceil(CAST(0.15 AS DOUBLE) * _n) THEN 'test'
                 WHEN _r <= ceil(CAST(0.15 AS DOUBLE) * _n)
                           + ceil(CAST({VAL_RATIO!r} AS DOUBLE) * (_n - ceil(CAST(0.15 AS DOUBLE) * _n))) THEN 'val'
                 ELSE 'train' END AS split
  FROM granked)
SELECT c.TransactionID, c.AccountID, s.split FROM curated c LEFT JOIN gsplit s ON c.AccountID IS NOT DISTINCT FROM s.g""")
def q_split_group(spark, sf_dir):
    """SP2: no account in two splits; 70/15/15 of accounts."""
    return sp.group_split(curated(spark, sf_dir)).select("TransactionID", "AccountID", "split")


@register("split_time", CURATED_WITH.rstrip() + """,
pos AS (
  SELECT TransactionID, AccountID,
         row_number() OVER (PARTITION BY AccountID ORDER BY TransactionDate, TransactionID) AS _r,
         count(*) OVER (PARTITION BY AccountID) AS _n
  FROM curated),
sizes AS (
  SELECT *, greatest(1, CAST(round_even(_n * CAST(0.15 AS DOUBLE), 0) AS BIGINT)) AS _t,
            greatest(1, CAST(round_even(_n * CAST(0.15 AS DOUBLE), 0) AS BIGINT)) AS _v
  FROM pos)
SELECT TransactionID, AccountID,
       CASE WHEN _r <= greatest(0, _n - _v - _t) THEN 'train'
            WHEN _r <= greatest(0, _n - _v - _t) + _v THEN 'val' ELSE 'test' END AS split
FROM sizes""")
def q_split_time(spark, sf_dir):
    """W3 / SP3: per-account chronological split (half-even rounding)."""
    return sp.time_split(curated(spark, sf_dir)).select("TransactionID", "AccountID", "split")


@register("split_sizes", CURATED_WITH.rstrip() + _strat_sql(0.15, VAL_RATIO).replace("\n, ranked", ",\nranked", 1)
          .replace("SELECT TransactionID, is_fraud, CASE", "SELECT split, is_fraud, count(*) AS n FROM (SELECT "
                   "TransactionID, is_fraud, CASE") + ") GROUP BY split, is_fraud")
def q_split_sizes(spark, sf_dir):
    """U1 + SP5: the split pieces (dispatch 'random') and their class counts."""
    s = sp.split(curated(spark, sf_dir), "random")
    tr, va, te = sp.pieces(s)
    u = (tr.withColumn("split", F.lit("train")).unionByName(va.withColumn("split", F.lit("val")))
         .unionByName(te.withColumn("split", F.lit("test"))))
    return u.groupBy("split", "is_fraud").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- metrics

from ..operators import metrics as mt  # noqa: E402

METRICS_CTE = f"""
pred AS ({fx.predictions_sql()}),
st AS (SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
       FROM pred GROUP BY model, score),
cum AS (
  SELECT *, sum(pos) OVER w AS cpos, sum(neg) OVER w AS cneg,
         sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N
  FROM st WINDOW w AS (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ge AS (SELECT *, P - cpos + pos AS tp_ge, N - cneg + neg AS fp_ge FROM cum),
pts AS (SELECT model, score AS threshold, tp_ge / (tp_ge + fp_ge) AS precision,
               CASE WHEN P > 0 THEN tp_ge / P ELSE CAST(1 AS DOUBLE) END AS recall FROM ge),
f1pts AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                         ELSE CAST(0 AS DOUBLE) END AS f1 FROM pts),
best AS (SELECT model, arg_max(threshold, (f1, -threshold)) AS best, max(f1) AS best_f1 FROM f1pts GROUP BY model),
cm AS (
  SELECT model, count(*) FILTER (WHERE label = 0 AND score < 0.5) AS tn,
         count(*) FILTER (WHERE label = 0 AND score >= 0.5) AS fp,
         count(*) FILTER (WHERE label = 1 AND score < 0.5) AS fn,
         count(*) FILTER (WHERE label = 1 AND score >= 0.5) AS tp,
         count(*) FILTER (WHERE label = 1) AS support, count(*) AS n
  FROM pred GROUP BY model),
cls AS (
  SELECT *, coalesce(CAST(tp + tn AS DOUBLE) / nullif(tn + fp + fn + tp, 0), 0) AS accuracy,
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
         coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
         coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1
  FROM cm),
rk AS (
  SELECT model,
         CASE WHEN max(P) > 0 AND max(N) > 0
              THEN sum(pos * (cneg - neg * CAST(0.5 AS DOUBLE))) / (max(P) * max(N)) ELSE 0 END AS roc_auc,
         CASE WHEN max(P) > 0 AND max(N) > 0
              THEN sum(pos * (tp_ge / (tp_ge + fp_ge))) / max(P) ELSE 0 END AS pr_auc
  FROM ge GROUP BY model),
records AS (
  SELECT c.model AS name, r.roc_auc, r.pr_auc, c.f1, c.precision, c.recall, c.accuracy,
         CAST(0.5 AS DOUBLE) AS threshold, c.tn, c.fp, c.fn, c.tp, c.support, c.n
  FROM cls c JOIN rk r ON c.model = r.model)"""

METRICS_WITH = CURATED_WITH.rstrip() + ",\n" + METRICS_CTE.strip() + "\n"


def predictions(spark, sf_dir):
    return shared(spark, sf_dir, "predictions", lambda: mt.clean(fx.predictions(curated(spark, sf_dir))))


R6 = lambda *cs: ", ".join(f"round({c}, 6) AS {c}" for c in cs)


def scores(spark, sf_dir):
    """The score table of the predictions, written once per session for all metric queries."""
    return shared(spark, sf_dir, "scores", lambda: mt.score_table(predictions(spark, sf_dir)))


def records(spark, sf_dir):
    """The metric records of the predictions."""
    return mt.evaluate(predictions(spark, sf_dir), st=scores(spark, sf_dir))


def _r6(df, *cs):
    return df.select(*[r6(c).alias(c) if c in cs else F.col(c) for c in df.columns])


@register("metrics_confusion", METRICS_WITH + "SELECT model, CAST(tn AS BIGINT) AS tn, CAST(fp AS BIGINT) AS fp, "
          "CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, CAST(support AS BIGINT) AS support, "
          "CAST(n AS BIGINT) AS n FROM cm")
def q_metrics_confusion(spark, sf_dir):
    """E1 + E15: confusion counts at 0.5, support and n, per model."""
    return mt.confusion(predictions(spark, sf_dir), 0.5)


@register("metrics_classification", METRICS_WITH + "SELECT model, " + R6("accuracy", "precision", "recall", "f1")
          + " FROM cls")
def q_metrics_classification(spark, sf_dir):
    """Accuracy, precision, recall, f1 (zero division -> 0)."""
    c = mt.classification_metrics(mt.confusion(predictions(spark, sf_dir), 0.5))
    return _r6(c.select("model", "accuracy", "precision", "recall", "f1"), "accuracy", "precision", "recall", "f1")


@register("metrics_ranking", METRICS_WITH + "SELECT model, " + R6("roc_auc", "pr_auc") + " FROM rk")
def q_metrics_ranking(spark, sf_dir):
    """E3 + E4: ROC AUC (ties = 1/2) and average precision (step sum)."""
    return _r6(mt.ranking_metrics(predictions(spark, sf_dir), scores(spark, sf_dir)), "roc_auc", "pr_auc")


@register("roc_curve", METRICS_WITH + "SELECT model, score AS threshold, "
          "round(coalesce(fp_ge / nullif(N, 0), 0), 6) AS fpr, round(coalesce(tp_ge / nullif(P, 0), 0), 6) AS tpr FROM ge "
          "UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM ge")
def q_roc_curve(spark, sf_dir):
    """E5: ROC points at every distinct score and the start point (0, 0)."""
    return _r6(mt.roc_points(predictions(spark, sf_dir), scores(spark, sf_dir)), "fpr", "tpr")


@register("pr_curve", METRICS_WITH + "SELECT model, threshold, " + R6("precision", "recall") + " FROM pts "
          "UNION ALL SELECT DISTINCT model, CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE) FROM pts")
def q_pr_curve(spark, sf_dir):
    """PR points plus the closing (precision 1, recall 0) point."""
    return _r6(mt.pr_points(predictions(spark, sf_dir), scores(spark, sf_dir)), "precision", "recall")


@register("best_threshold", METRICS_WITH + "SELECT model, best AS threshold, round(best_f1, 6) AS best_f1 FROM best")
def q_best_threshold(spark, sf_dir):
    """F1-optimal threshold (aligned with its PR point)."""
    return _r6(mt.best_f1_threshold(predictions(spark, sf_dir), scores(spark, sf_dir)), "best_f1")


@register("best_threshold_compat", METRICS_WITH + """SELECT b.model,
       coalesce((SELECT max(threshold) FROM f1pts p WHERE p.model = b.model AND p.threshold < b.best),
                CAST(0.5 AS DOUBLE)) AS threshold, round(b.best_f1, 6) AS best_f1 FROM best b""")
def q_best_threshold_compat(spark, sf_dir):
    """E7 (compat): the source's one-step-lower threshold, 0.5 at the bottom."""
    return _r6(mt.best_f1_threshold(predictions(spark, sf_dir), scores(spark, sf_dir), compat=True), "best_f1")


@register("tuned_confusion", METRICS_WITH + """SELECT p.model,
       CAST(count(*) FILTER (WHERE label = 0 AND score < best) AS BIGINT) AS tn,
       CAST(count(*) FILTER (WHERE label = 0 AND score >= best) AS BIGINT) AS fp,
       CAST(count(*) FILTER (WHERE label = 1 AND score < best) AS BIGINT) AS fn,
       CAST(count(*) FILTER (WHERE label = 1 AND score >= best) AS BIGINT) AS tp,
       max(best) AS threshold, round(max(best_f1), 6) AS best_f1
FROM pred p JOIN best b ON p.model = b.model GROUP BY p.model""")
def q_tuned_confusion(spark, sf_dir):
    """Confusion at the F1-optimal threshold."""
    t = mt.tuned_confusion(predictions(spark, sf_dir), st=scores(spark, sf_dir))
    return _r6(t.select("model", "tn", "fp", "fn", "tp", "threshold", "best_f1"), "best_f1")


@register("reliability_curve", METRICS_WITH.rstrip() + """,
edges AS (
  SELECT model, quantile_cont(score, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM pred GROUP BY model)
SELECT p.model, CAST(len(list_filter(e, lambda x: x < p.score)) AS INTEGER) AS bin,
       round(avg(score), 6) AS mean_score, round(avg(CAST(label AS DOUBLE)), 6) AS frac_pos, count(*) AS n
FROM pred p JOIN edges USING (model) GROUP BY p.model, bin""")
def q_reliability_curve(spark, sf_dir):
    """10 quantile bins, mean score and observed rate, empty bins absent."""
    return _r6(mt.reliability_curve(predictions(spark, sf_dir)), "mean_score", "frac_pos")


@register("brier", METRICS_WITH + "SELECT model, round(avg((score - label) * (score - label)), 6) AS brier "
          "FROM pred GROUP BY model")
def q_brier(spark, sf_dir):
    """E12 (raw): mean squared error of the score."""
    return _r6(mt.brier(predictions(spark, sf_dir)), "brier")


@register("metric_records", METRICS_WITH + "SELECT name, " + R6("roc_auc", "pr_auc", "f1", "precision", "recall",
                                                                "accuracy") + ", threshold, CAST(tn AS BIGINT) AS tn, "
          "CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tp AS BIGINT) AS tp, "
          "CAST(support AS BIGINT) AS support, CAST(n AS BIGINT) AS n FROM records")
def q_metric_records(spark, sf_dir):
    """E1-E4 + E15: the per-model metric record (cm flattened for comparison)."""
    r = records(spark, sf_dir)
    r = r.select("name", "roc_auc", "pr_auc", "f1", "precision", "recall", "accuracy", "threshold",
                 "cm.tn", "cm.fp", "cm.fn", "cm.tp", "support", "n")
    return _r6(r, "roc_auc", "pr_auc", "f1", "precision", "recall", "accuracy")


@register("metrics_comparison", METRICS_WITH + "SELECT name AS model, " + R6("accuracy", "precision", "recall", "f1",
                                                                            "roc_auc") + " FROM records")
def q_metrics_comparison(spark, sf_dir):
    """Wide comparison table (five metrics per model, missing = 0)."""
    long = mt.to_long(records(spark, sf_dir))
    return _r6(mt.comparison_table(long), "accuracy", "precision", "recall", "f1", "roc_auc")


@register("model_ranking", METRICS_WITH + """SELECT name,
       CAST(row_number() OVER (ORDER BY coalesce(pr_auc, -1) DESC, coalesce(f1, -1) DESC,
                                        coalesce(roc_auc, -1) DESC, name) AS INTEGER) AS rank,
       round(pr_auc, 6) AS pr_auc, round(f1, 6) AS f1, round(roc_auc, 6) AS roc_auc,
       CAST(coalesce(floor(100 * pr_auc / nullif(max(pr_auc) OVER (), 0)), 0) AS INTEGER) AS pr_width,
       CAST(coalesce(floor(100 * f1 / nullif(max(f1) OVER (), 0)), 0) AS INTEGER) AS f1_width
FROM records""")
def q_model_ranking(spark, sf_dir):
    """Models ranked by (pr_auc, f1, roc_auc); bar widths."""
    r = mt.rank_models(records(spark, sf_dir))
    return _r6(r.withColumn("rank", F.col("rank").cast("int")), "pr_auc", "f1", "roc_auc")


@register("best_model", METRICS_WITH + "SELECT 'pr_auc' AS by, name FROM records "
          "ORDER BY pr_auc DESC, f1 DESC, roc_auc DESC, name LIMIT 1")
def q_best_model(spark, sf_dir):
    """Best model by (pr_auc, f1, roc_auc) and the criterion used."""
    return mt.best_model(records(spark, sf_dir))


@register("best_model_f1", METRICS_WITH + "SELECT name FROM records ORDER BY f1 DESC, name LIMIT 1")
def q_best_model_f1(spark, sf_dir):
    """Best model by f1 alone."""
    return mt.best_by_f1(records(spark, sf_dir))


THRESHOLD_GRID = [round(0.05 * i, 2) for i in range(1, 20)]


@register("threshold_grid_best", METRICS_WITH.rstrip() + """,
grid AS (
  SELECT CAST(i AS INTEGER) AS trial, round(0.05 * i, 2) AS thr FROM range(1, 20) t(i)),
trials AS (
  SELECT p.model, g.trial, g.thr,
         coalesce(CAST(2 * count(*) FILTER (WHERE label = 1 AND score >= g.thr) AS DOUBLE)
                  / nullif(count(*) FILTER (WHERE label = 1) + count(*) FILTER (WHERE score >= g.thr), 0), 0) AS f1
  FROM pred p, grid g GROUP BY p.model, g.trial, g.thr)
SELECT model, trial, thr, round(f1, 6) AS f1 FROM trials
QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1 DESC, trial) = 1""")
def q_threshold_grid_best(spark, sf_dir):
    """For each model the argmax of validation f1 over a grid of trials (first trial wins ties).

    The trials are decision thresholds 0.05..0.95; every trial is one
    conditional count in a single aggregate over the predictions.
    """
    aggs = []
    for i, t in enumerate(THRESHOLD_GRID, start=1):
        tp = F.count(F.when((F.col("label") == 1) & (F.col("score") >= t), 1))
        pp = F.count(F.when(F.col("score") >= t, 1))
        pos = F.count(F.when(F.col("label") == 1, 1))
        aggs.append(F.struct(F.lit(i).alias("trial"), F.lit(t).alias("thr"),
                             mt._div0(2 * tp, pos + pp).alias("f1")))
    trials = (predictions(spark, sf_dir).groupBy("model").agg(F.array(*aggs).alias("t"))
              .select("model", F.explode("t").alias("t")).select("model", "t.*"))
    return _r6(mt.best_trial(trials, "f1", "trial", by=["model"]), "f1")


@register("merged_metrics", METRICS_WITH.rstrip() + """,
tuned AS (
  SELECT p.model AS name, coalesce(CAST(2 * count(*) FILTER (WHERE label = 1 AND score >= best) AS DOUBLE)
         / nullif(count(*) FILTER (WHERE label = 1) + count(*) FILTER (WHERE score >= best), 0), 0) AS f1,
         max(best) AS threshold
  FROM pred p JOIN best b ON p.model = b.model GROUP BY p.model)
SELECT coalesce(t.name, r.name) AS name,
       CASE WHEN t.name IS NOT NULL THEN NULL ELSE round(r.roc_auc, 6) END AS roc_auc,
       CASE WHEN t.name IS NOT NULL THEN NULL ELSE round(r.pr_auc, 6) END AS pr_auc,
       round(CASE WHEN t.name IS NOT NULL THEN t.f1 ELSE r.f1 END, 6) AS f1,
       CASE WHEN t.name IS NOT NULL THEN NULL ELSE round(r.precision, 6) END AS precision,
       CASE WHEN t.name IS NOT NULL THEN NULL ELSE round(r.recall, 6) END AS recall,
       CASE WHEN t.name IS NOT NULL THEN NULL ELSE round(r.accuracy, 6) END AS accuracy,
       CASE WHEN t.name IS NOT NULL THEN t.threshold ELSE r.threshold END AS threshold,
       coalesce(CASE WHEN t.name IS NOT NULL THEN t.threshold ELSE r.threshold END, 0.5) AS picked_threshold
FROM records r FULL OUTER JOIN tuned t ON r.name = t.name""")
def q_merged_metrics(spark, sf_dir):
    """J2 / S13 + E14: combined records merged with a per-model record (per-model
    wins), then the threshold fallback chain."""
    p = predictions(spark, sf_dir)
    legacy = records(spark, sf_dir)
    thr = mt.best_f1_threshold(p, scores(spark, sf_dir))
    tuned = mt.classification_metrics(mt.confusion(
        p.join(thr.select("model", F.col("threshold").alias("_t")), "model"),
        F.col("_t"))).join(thr.select("model", "threshold"), "model")
    per_model = tuned.select(F.col("model").alias("name"), "f1", "threshold")
    m = mt.merge_metric_sources(legacy, per_model)
    m = m.withColumn("picked_threshold", mt.pick_threshold(m))
    return _r6(m, "roc_auc", "pr_auc", "f1", "precision", "recall", "accuracy")


# ---------------------------------------------------------------- transformers

from pyspark.ml.functions import vector_to_array  # noqa: E402

from ..operators import transform as tf  # noqa: E402

TRAIN_CTE = _strat_sql(0.15, VAL_RATIO).replace("\n, ranked", "ranked", 1).split("\nSELECT")[0]
SPLIT_CTE = TRAIN_CTE.strip() + """,
splits AS (
  SELECT f.*, CASE WHEN _r <= ceil(CAST(0.15 AS DOUBLE) * _n) THEN 'test'
                   WHEN _r <= ceil(CAST(0.15 AS DOUBLE) * _n)
                             + ceil(CAST(%r AS DOUBLE) * (_n - ceil(CAST(0.15 AS DOUBLE) * _n))) THEN 'val'
                   ELSE 'train' END AS split
  FROM features f JOIN ranked r USING (TransactionID))""" % VAL_RATIO

SPLIT_WITH = with_ctes(RAW_CTE, BASE_CTE, STATS_CTE, CURATED_CTE, FEATURES_CTE, SPLIT_CTE)


def split_features(spark, sf_dir):
    """Features with the stratified random split column (written once per session)."""
    return shared(spark, sf_dir, "split_features", lambda: sp.stratified_split(features(spark, sf_dir)))


SCALE_COLS = ["AccountBalance", "CustomerAge", "LoginAttempts", "TransactionAmount", "TransactionDuration",
              "amt_to_bal", "minutes_since_prev", "secs_since_prev", "txn_hour"]


@register("standardize", SPLIT_WITH.rstrip() + """,
sstats AS (
  SELECT """ + ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}, coalesce(nullif(stddev_pop(CAST({c} AS DOUBLE)), 0), 1) "
                         f"AS s_{c}" for c in SCALE_COLS) + """ FROM splits WHERE split = 'train')
SELECT TransactionID, """ + ", ".join(f"round((CAST({c} AS DOUBLE) - m_{c}) / s_{c}, 6) AS num__{c}" for c in SCALE_COLS)
          + " FROM splits, sstats")
def q_standardize(spark, sf_dir):
    """Population-std scaling fitted on the train split, applied to all rows."""
    df = split_features(spark, sf_dir)
    m = tf.PopulationScaler(inputCols=SCALE_COLS, outputCols=[f"num__{c}" for c in SCALE_COLS]).fit(
        df.filter(F.col("split") == "train"))
    out = m.transform(df)
    return out.select("TransactionID", *[r6(f"num__{c}").alias(f"num__{c}") for c in SCALE_COLS])


ONEHOT_COLS = ["Channel", "Location"]


def _cat_sql(c):
    return (f"CASE WHEN {c} IS NULL THEN '{tf.NULL_TOKEN}' WHEN CAST({c} AS VARCHAR) = '' THEN '{tf.EMPTY_TOKEN}' "
            f"ELSE CAST({c} AS VARCHAR) END")


@register("one_hot", SPLIT_WITH.rstrip() + ",\n" + ", ".join(
    f"cats_{c} AS (SELECT list(DISTINCT {_cat_sql(c)} ORDER BY {_cat_sql(c)}) AS k FROM splits WHERE split = 'train')"
    for c in ONEHOT_COLS) + "\nSELECT TransactionID, " + ", ".join(
    f"list_transform(cats_{c}.k, lambda v: CASE WHEN {_cat_sql(c)} = v "
    f"THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS cat__{c}" for c in ONEHOT_COLS)
    + " FROM splits, " + ", ".join(f"cats_{c}" for c in ONEHOT_COLS))
def q_one_hot(spark, sf_dir):
    """T2 (+T3 stages): sorted-category one-hot fitted on train; unknown -> zeros."""
    df = split_features(spark, sf_dir)
    pipe = tf.tabular_pipeline([], ONEHOT_COLS, output="features")
    m = pipe.fit(df.filter(F.col("split") == "train"))
    sizes = m.stages[-1].getOrDefault("sizes")
    entries = vector_to_array("features")
    return m.transform(df).select("TransactionID", *[
        F.slice(entries, 1 + sum(sizes[:k]), sizes[k]).alias(f"cat__{c}") for k, c in enumerate(ONEHOT_COLS)])


IMPUTE_COLS = ["minutes_since_prev", "TransactionAmount"]


@register("impute_scale", SPLIT_WITH.rstrip() + ",\nimeds AS (SELECT " + ", ".join(
    f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med_{c}" for c in IMPUTE_COLS) + """ FROM splits WHERE split = 'train'),
imputed AS (SELECT TransactionID, split, """ + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), med_{c}) AS i_{c}" for c in IMPUTE_COLS) + """ FROM splits, imeds),
istats AS (SELECT """ + ", ".join(f"avg(i_{c}) AS m_{c}, coalesce(nullif(stddev_pop(i_{c}), 0), 1) AS s_{c}"
                                  for c in IMPUTE_COLS) + """ FROM imputed WHERE split = 'train')
SELECT TransactionID, """ + ", ".join(f"round((i_{c} - m_{c}) / s_{c}, 6) AS num__{c}" for c in IMPUTE_COLS)
          + " FROM imputed, istats")
def q_impute_scale(spark, sf_dir):
    """T4: exact-median imputation then population scaling, fitted on train."""
    df = split_features(spark, sf_dir)
    pipe = tf.tabular_pipeline(IMPUTE_COLS, [], impute=True)
    m = pipe.fit(df.filter(F.col("split") == "train"))
    out = m.transform(df)
    return out.select("TransactionID", *[r6(f"num__{c}").alias(f"num__{c}") for c in IMPUTE_COLS])


@register("tfidf_idf", SPLIT_WITH.rstrip() + """,
docs AS (
  SELECT TransactionID, regexp_extract_all(lower(coalesce(nlp_text, '')), '\\b\\w\\w+\\b') AS t
  FROM splits WHERE split = 'train'),
grams AS (
  SELECT TransactionID, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])))
         AS term
  FROM docs),
tt AS (SELECT term, count(*) AS tf, count(DISTINCT TransactionID) AS df FROM grams GROUP BY term),
nd AS (SELECT count(*) AS n FROM docs),
top AS (SELECT term, tf, df, row_number() OVER (ORDER BY tf DESC, term) - 1 AS idx FROM tt
        ORDER BY tf DESC, term LIMIT 5000)
SELECT CAST(idx AS INTEGER) AS idx, term, CAST(tf AS BIGINT) AS tf, CAST(df AS BIGINT) AS df,
       round(ln((1 + n) / (1 + df)) + 1, 6) AS idf
FROM top, nd""")
def q_tfidf_idf(spark, sf_dir):
    """T5: vocabulary (top 5,000 1-/2-grams by corpus count) with tf, df and smooth idf."""
    df = split_features(spark, sf_dir).filter(F.col("split") == "train")
    _, vocab = tf.fit_tfidf(df, "nlp_text")
    return vocab.withColumn("idf", r6("idf"))


# ---------------------------------------------------------------- balancing

from ..operators import balance as bal  # noqa: E402
from ..sources.tables import table  # noqa: E402

MINORITY_LABEL = 0


def minority_points(spark, sf_dir):
    """Embeddings of one label (the minority class against the rest)."""
    e = table(spark, sf_dir, "embeddings")
    return e.filter(F.col("label") == MINORITY_LABEL).select(F.col("vec_id").alias("id"),
                                                             F.col("embedding").alias("vec"))


# J4 in SQL: every pair of the rows of m(id, vec), and the five of smallest (distance, id).
KNN_CTES = """
options AS (
  SELECT s.id, o.id AS nn_id, sqrt(list_sum(list_transform(range(1, len(s.vec) + 1),
                                            lambda i: (s.vec[i] - o.vec[i]) * (s.vec[i] - o.vec[i])))) AS dist
  FROM m s JOIN m o ON s.id <> o.id),
nearest AS (
  SELECT id, nn_id, CAST(row_number() OVER (PARTITION BY id ORDER BY dist, nn_id) AS INTEGER) AS nn_rank, dist
  FROM options QUALIFY nn_rank <= 5)"""

MINORITY_CTE = "m AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings WHERE label = 0)"


@register("knn_minority", with_ctes(MINORITY_CTE, KNN_CTES)
          + "SELECT id, nn_id, nn_rank, round(dist, 6) AS dist FROM nearest")
def q_knn_minority(spark, sf_dir):
    """The 5 nearest neighbours of every point inside the minority class."""
    return bal.knn(minority_points(spark, sf_dir), 5).withColumn("dist", r6("dist"))


@register("smote_rows", with_ctes(MINORITY_CTE, KNN_CTES, f"""
sized AS (SELECT (SELECT count(*) FROM m) AS m,
                 (SELECT max(c) - min(c) FROM (SELECT count(*) AS c FROM embeddings GROUP BY label = 0)) AS need),
numbered AS (SELECT id, row_number() OVER (ORDER BY md5(concat(CAST(id AS VARCHAR), ':{bal.RANDOM_SEED}')), CAST(id AS VARCHAR)) AS pos FROM m),
digests AS (SELECT j, md5(concat('{bal.RANDOM_SEED}:', CAST(j AS VARCHAR))) AS h FROM range((SELECT need FROM sized)) r(j)),
draws AS (
  SELECT j, CAST(concat('0x', h[1:8]) AS BIGINT) % (SELECT m FROM sized) + 1 AS pos, CAST(concat('0x', h[9:16]) AS BIGINT) % 5 + 1 AS nn_rank,
         CAST(concat('0x', h[17:24]) AS BIGINT) / 4294967296.0::DOUBLE AS u FROM digests)""") + """
SELECT concat('syn_', CAST(d.j AS VARCHAR)) AS id, b.id AS base_id, n.nn_id, round(d.u, 6) AS u,
       array_to_string(list_transform(range(1, len(x.vec) + 1),
         lambda i: printf('%.4f', round(x.vec[i] + d.u * (y.vec[i] - x.vec[i]), 4) + 0.0)), ' ') AS vec
FROM draws d JOIN numbered b USING (pos) JOIN nearest n ON n.id = b.id AND n.nn_rank = d.nn_rank
JOIN m x ON x.id = b.id JOIN m y ON y.id = n.nn_id""")
def q_smote_rows(spark, sf_dir):
    """SP6: every synthetic row of the minority class: its base, neighbour, step and vector."""
    pts = minority_points(spark, sf_dir)
    sizes = [r["n"] for r in table(spark, sf_dir, "embeddings").groupBy(F.col("label") == MINORITY_LABEL)
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    rows = pts.select("id", bal.sparse(F.col("vec"), pts.schema["vec"].dataType).alias("v"))
    made = materialize(bal.synthetic(rows, max(sizes) - min(sizes)), "smote_rows")
    text = F.array_join(F.transform(bal._dense(F.col("v")), lambda x: F.format_string("%.4f", F.round(x, 4) + F.lit(0.0))), " ")
    return made.select("id", "base_id", "nn_id", F.round("u", 6).alias("u"), text.alias("vec"))


@register("smote_counts", """
WITH l AS (SELECT CASE WHEN label = 0 THEN 1 ELSE 0 END AS label FROM embeddings),
c AS (SELECT label, count(*) AS n FROM l GROUP BY label),
mx AS (SELECT max(n) AS m FROM c)
SELECT c.label, CAST(mx.m AS BIGINT) AS n, CAST(mx.m - c.n AS BIGINT) AS n_synthetic FROM c, mx""")
def q_smote_counts(spark, sf_dir):
    """SP6 + U2: class counts after SMOTE (minority raised to the majority count)."""
    e = table(spark, sf_dir, "embeddings")
    pts = e.select(F.col("vec_id").alias("id"),
                   F.when(F.col("label") == MINORITY_LABEL, 1).otherwise(0).alias("label"),
                   F.col("embedding").alias("vec"))
    out = bal.smote(pts, "label", "vec", "id", k=5)
    return out.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                    F.count(F.when(F.col("synthetic"), 1)).alias("n_synthetic"))


@register("class_weights", CURATED_WITH + """SELECT is_fraud, count(*) AS n,
       round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS balanced_weight,
       round(CASE WHEN is_fraud = 1 THEN
         coalesce((SELECT CASE WHEN sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) = 0 THEN NULL
                               WHEN CAST(sum(CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END) AS DOUBLE)
                                    / sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) > 3
                               THEN CAST(sum(CASE WHEN is_fraud = 0 THEN 1 ELSE 0 END) AS DOUBLE)
                                    / sum(CASE WHEN is_fraud = 1 THEN 1 ELSE 0 END) END FROM curated), 1.0)
         ELSE 1.0 END, 6) AS pos_weight
FROM curated GROUP BY is_fraud""")
def q_class_weights(spark, sf_dir):
    """A10 + A11: balanced class weights and the scale_pos_weight weight column."""
    c = curated(spark, sf_dir)
    wb = bal.with_balanced_weight(c, "is_fraud", "balanced_weight")
    wp, _ = bal.with_pos_weight(wb, "is_fraud", "pos_weight")
    return (wp.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("n"),
                                       F.first("balanced_weight").alias("balanced_weight"),
                                       F.first("pos_weight").alias("pos_weight"))
            .select("is_fraud", "n", r6("balanced_weight").alias("balanced_weight"),
                    r6("pos_weight").alias("pos_weight")))


# ---------------------------------------------------------------- models (statistical checks: no SQL oracle)

from ..operators import models as mdl  # noqa: E402
from . import train as tr  # noqa: E402
from .warehouse import memo  # noqa: E402


def prepared(spark, sf_dir):
    return memo(spark, sf_dir, "prepared", lambda: tr.prepare(curated(spark, sf_dir)))


def gbt_model(spark, sf_dir):
    return memo(spark, sf_dir, "gbt", lambda: tr.train_tabular(prepared(spark, sf_dir)))


def text_model(spark, sf_dir):
    return memo(spark, sf_dir, "nlp", lambda: tr.train_text(split_features(spark, sf_dir)))


def gbt_val_scores(spark, sf_dir):
    return shared(spark, sf_dir, "gbt_val_scores",
                  lambda: tr.scored(gbt_model(spark, sf_dir), prepared(spark, sf_dir).val, "xgb"))


@register("gbt_metrics")
def q_gbt_metrics(spark, sf_dir):
    """M1 (+SP6 SMOTE, T3 preprocessor) with E1-E4/E15 on the validation split."""
    return mt.evaluate(gbt_val_scores(spark, sf_dir))


@register("gbt_feature_importance")
def q_gbt_feature_importance(spark, sf_dir):
    """M6: used features of the boosted trees, by importance."""
    return mdl.feature_importance(gbt_model(spark, sf_dir), prepared(spark, sf_dir).names)


@register("gbt_tuned_threshold")
def q_gbt_tuned_threshold(spark, sf_dir):
    """E7 + E8 on the model's validation probabilities (aligned and compat thresholds)."""
    s = gbt_val_scores(spark, sf_dir)
    a = mt.tuned_confusion(s).withColumn("rule", F.lit("aligned"))
    b = mt.tuned_confusion(s, compat=True).withColumn("rule", F.lit("compat"))
    return a.unionByName(b)


@register("calibration_brier")
def q_calibration_brier(spark, sf_dir):
    """Brier score of raw, Platt and isotonic probabilities (validation)."""
    s = gbt_val_scores(spark, sf_dir)
    p = cal.isotonic(s, cal.platt(s, s))
    return p.groupBy("model").agg(F.avg((F.col("score") - F.col("label")) ** 2).alias("brier_raw"),
                                  F.avg((F.col("p_platt") - F.col("label")) ** 2).alias("brier_platt"),
                                  F.avg((F.col("p_iso") - F.col("label")) ** 2).alias("brier_isotonic"))


@register("nlp_metrics")
def q_nlp_metrics(spark, sf_dir):
    """M2: TF-IDF + balanced logistic regression, validation metrics."""
    model, _ = text_model(spark, sf_dir)
    return mt.evaluate(tr.scored(model, tr.text_rows(split_features(spark, sf_dir), "val"), "nlp"))


@register("nlp_top_terms")
def q_nlp_top_terms(spark, sf_dir):
    """M7: 20 most positive and 20 most negative terms of the text model."""
    model, vocab = text_model(spark, sf_dir)
    return mdl.top_terms(model.stages[-1], vocab, 20)


# ---------------------------------------------------------------- files, streams, scoring

from ..operators import scoring as sc  # noqa: E402
from ..session import materialize, scratch_path  # noqa: E402
from ..sources import files as io  # noqa: E402
from ..streaming import ingest as ing  # noqa: E402


NULL_MARKER = "\\N"


def _write_raw_csv(spark, sf_dir, path, by_day=True):
    r = raw(spark, sf_dir)
    if by_day:
        # clustered by day first: a task writes the files of its few days, not one file a day
        r = r.withColumn("txn_day", F.date_format("TransactionDate", "yyyy-MM-dd")).repartitionByRange("txn_day", "TransactionID")
    w = (r.write.mode("overwrite").option("header", True).option("nullValue", NULL_MARKER)
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    if by_day:
        w = w.partitionBy("txn_day")
    w.csv(path)


@register("csv_load_report", with_ctes(RAW_CTE) + "SELECT strftime(TransactionDate, '%Y-%m-%d') AS txn_day, "
          "count(*) AS rows FROM raw GROUP BY 1")
def q_csv_load_report(spark, sf_dir):
    """S1 + S3 + S4: raw rows written as CSV (one folder per day), read back with
    the fixed schema, rows per loaded file summed per day folder."""
    path = scratch_path(spark, "csv_drop")
    _write_raw_csv(spark, sf_dir, path)
    df = io.read_transactions_csv(spark, path, null_value=NULL_MARKER)
    rep = io.load_report(df)
    day = F.regexp_extract("source_file", r"txn_day=([0-9-]+)", 1)
    return rep.groupBy(day.alias("txn_day")).agg(F.sum("rows").alias("rows"))


@register("ingest_stream", with_ctes(RAW_CTE) + "SELECT * FROM raw")
def q_ingest_stream(spark, sf_dir):
    """S2 (+F1 path filter): CSV drops under incoming/ appended by a checkpointed
    file stream (availableNow); decoy files outside the prefix or with another
    suffix are ignored."""
    root = scratch_path(spark, "landing")
    _write_raw_csv(spark, sf_dir, f"{root}/incoming/batch1", by_day=True)
    # decoys: a non-CSV file under the prefix, and every row again outside it
    spark.createDataFrame([("not a transaction",)], "x string").write.text(f"{root}/incoming/notes")
    _write_raw_csv(spark, sf_dir, f"{root}/elsewhere/incoming", by_day=False)
    table, ckpt, rep = f"{root}/table", f"{root}/_checkpoint", f"{root}/_report"
    q = ing.ingest(spark, root, table, ckpt, rep, null_value=NULL_MARKER)
    q.awaitTermination()
    return ing.read_ingested(spark, table)


def _requests_sql_fields():
    return """CAST(TransactionID AS VARCHAR) AS TransactionID, AccountID,
       CASE WHEN CAST(TransactionID AS BIGINT) % 29 = 0 THEN NULL ELSE TransactionAmount END AS TransactionAmount,
       CASE WHEN CAST(TransactionID AS BIGINT) % 23 = 0 THEN NULL ELSE TransactionDate END AS TransactionDate,
       TransactionType, Location, DeviceID, IP_Address, MerchantID, Channel,
       CAST(CustomerAge AS DOUBLE) AS CustomerAge, CustomerOccupation,
       CAST(TransactionDuration AS DOUBLE) AS TransactionDuration, CAST(LoginAttempts AS DOUBLE) AS LoginAttempts,
       AccountBalance, PreviousTransactionDate, nlp_text"""


def request_json(df):
    """Requests as JSON text: dates as strings, padded text, some malformed values."""
    tid = F.col("TransactionID").cast("long")
    fields = []
    for c in df.columns:
        x = F.col(c)
        if c in ("TransactionDate", "PreviousTransactionDate"):
            x = F.date_format(x, "yyyy-MM-dd HH:mm:ss.SSSSSS")
            if c == "TransactionDate":
                x = F.when(tid % 23 == 0, F.lit("not-a-date")).otherwise(x)
        elif c == "TransactionAmount":
            x = F.when(tid % 29 == 0, F.lit("n/a")).otherwise(x.cast("string"))
        elif c in ("Location", "TransactionType"):
            x = F.concat(F.lit("  "), x, F.lit(" "))
        else:
            x = x.cast("string")
        fields.append(x.alias(c))
    return df.select(F.to_json(F.struct(*fields)).alias("value"))


REQUEST_COLS = ["TransactionID", "AccountID", "TransactionAmount", "TransactionDate", "TransactionType", "Location",
                "DeviceID", "IP_Address", "MerchantID", "Channel", "CustomerAge", "CustomerOccupation",
                "TransactionDuration", "LoginAttempts", "AccountBalance", "PreviousTransactionDate", "nlp_text"]


@register("request_typing", CURATED_WITH + "SELECT " + _requests_sql_fields() + " FROM curated")
def q_request_typing(spark, sf_dir):
    """S11 + P22: JSON requests parsed with the request schema and typed leniently
    (unparsable dates / numbers -> NULL, text trimmed)."""
    req = io.parse_requests(request_json(curated(spark, sf_dir).select(*REQUEST_COLS)))
    return sc.type_requests(req)


@register("scored_requests")
def q_scored_requests(spark, sf_dir):
    """M8 (+P23-P25, P28, E14): all transactions sent as JSON requests and scored by
    the fitted preprocessor and boosted trees at the tuned threshold."""
    prep = prepared(spark, sf_dir)
    model = gbt_model(spark, sf_dir)
    thr_row = mt.best_f1_threshold(gbt_val_scores(spark, sf_dir)).first()
    threshold = float(thr_row["threshold"]) if thr_row is not None else mt.DEFAULT_THRESHOLD
    req = io.parse_requests(request_json(curated(spark, sf_dir).select(*REQUEST_COLS)))
    return sc.score_requests(req, prep.preproc, model, threshold, prep.secs_median)


@register("nlp_documents_metrics")
def q_nlp_documents_metrics(spark, sf_dir):
    """M2 + T5 on whole documents: documents joined with their labels (label =
    toxic), stratified 80/20 by hash, TF-IDF (1-/2-grams, 5,000 terms) +
    balanced logistic regression, held-out metrics."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("is_fraud"))
    d = docs.join(labels, "doc_id").withColumn("TransactionID", F.col("doc_id").cast("string"))
    d = shared(spark, sf_dir, "doc_split", lambda: sp.stratified_split(d, test_size=0.2, val_size=None))
    train = d.filter(F.col("split") == "train").withColumn("label", F.col("is_fraud").cast("double"))
    test = d.filter(F.col("split") == "test").withColumn("label", F.col("is_fraud").cast("double"))
    model, _ = mdl.fit_text_model(train, "text", "label")
    return mt.evaluate(tr.scored(model, test, "nlp_documents"))
