"""Evaluation metrics over (model, label, score) rows.

Every metric is a grouped aggregate keyed by ``model``, so any number of
models is evaluated in one pass.  Curve metrics (ROC AUC, average precision,
curves, the F1-optimal threshold) first collapse rows to one row per
(model, distinct score) -- a map-side-combined aggregate, so a score shared
by a third of the rows costs one row -- and then take running sums over
score with ``operators.ordered.running_sums``: the running order is split
into approximate-quantile score ranges, never a single global window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import decision
from ..session import materialize
from .ordered import running_sums, with_key_ranges
from .quantiles import Stat, quantiles

MODEL = "model"
DEFAULT_THRESHOLD = 0.5


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0.0 when b is 0 (the source's zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def clean(pred: DataFrame, label: str = "label", score: str = "score", group: str = MODEL) -> DataFrame:
    g = F.col(group) if group in pred.columns else F.lit("model").alias(group)
    return (pred.select(g.alias(group), F.col(label).cast("int").alias("label"),
                        F.col(score).cast("double").alias("score"))
            .filter(F.col("label").isNotNull() & F.col("score").isNotNull()))


# ------------------------------------------------------------------ E1, E2, E15

def confusion(pred: DataFrame, threshold: float | Column | None = DEFAULT_THRESHOLD,
              predicted: str | None = None) -> DataFrame:
    """E1 (+E15): tn, fp, fn, tp, support (positives) and n per model.

    Either ``predicted`` names a 0/1 prediction column, or the prediction is
    ``score >= threshold`` (a literal, or a column such as a joined
    per-model threshold).
    """
    p = F.col(predicted).cast("int") if predicted else decision("score", threshold)
    y = F.col("label")
    x = pred.select(MODEL, y.alias("y"), p.alias("p"))
    return x.groupBy(MODEL).agg(
        F.count(F.when((F.col("y") == 0) & (F.col("p") == 0), 1)).alias("tn"),
        F.count(F.when((F.col("y") == 0) & (F.col("p") == 1), 1)).alias("fp"),
        F.count(F.when((F.col("y") == 1) & (F.col("p") == 0), 1)).alias("fn"),
        F.count(F.when((F.col("y") == 1) & (F.col("p") == 1), 1)).alias("tp"),
        F.count(F.when(F.col("y") == 1, 1)).alias("support"),
        F.count(F.lit(1)).alias("n"),
    )


def classification_metrics(cm: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, f1 from E1 counts (0 on zero division)."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    precision = _div0(tp, tp + fp)
    recall = _div0(tp, tp + fn)
    return cm.select("*",
                     _div0(tp + tn, tn + fp + fn + tp).alias("accuracy"),
                     precision.alias("precision"), recall.alias("recall"),
                     _div0(2 * tp, 2 * tp + fp + fn).alias("f1"))


# ------------------------------------------------------------------ curve tables

def score_table(pred: DataFrame, rows_per_bucket: int = 250_000) -> DataFrame:
    """One row per (model, distinct score): pos, neg, running counts up to and
    including the score (cpos, cneg) and the model totals (P, N)."""
    st = pred.groupBy(MODEL, "score").agg(
        F.count(F.when(F.col("label") == 1, 1)).alias("pos"),
        F.count(F.when(F.col("label") == 0, 1)).alias("neg"))
    # counted and walked: the distinct-score table is written once before it is cut into ranges
    st = with_key_ranges(materialize(st, "score_table"), [MODEL], ["score"], "_sb", rows_per_bucket)
    cum = running_sums(st, [MODEL], F.col("_sb"), ["score"], {"cpos": F.col("pos"), "cneg": F.col("neg")})
    return cum.withColumnsRenamed({"cpos_total": "P", "cneg_total": "N"}).drop("_sb")


def _ge_counts(st: DataFrame) -> DataFrame:
    """Positives / negatives with score >= this score."""
    return st.withColumns({"tp_ge": F.col("P") - F.col("cpos") + F.col("pos"),
                           "fp_ge": F.col("N") - F.col("cneg") + F.col("neg")})


def _ranking_sums() -> list[Column]:
    """Aggregates over the rows of ``_ge_counts`` that ``_ranking`` turns into E3 and E4."""
    auc_term = F.col("pos") * (F.col("cneg") - F.col("neg") * F.lit(0.5))
    ap_term = F.col("pos") * _div0(F.col("tp_ge"), F.col("tp_ge") + F.col("fp_ge"))
    return [F.sum(auc_term).alias("_auc"), F.sum(ap_term).alias("_ap"), F.first("P").alias("_pos"), F.first("N").alias("_neg")]


def _ranking() -> list[Column]:
    p, n = F.col("_pos"), F.col("_neg")
    two = (p > 0) & (n > 0)
    return [F.when(two, F.col("_auc") / p / n).otherwise(F.lit(0.0)).alias("roc_auc"),
            F.when(two, F.col("_ap") / p).otherwise(F.lit(0.0)).alias("pr_auc")]


def ranking_metrics(pred: DataFrame, st: DataFrame | None = None) -> DataFrame:
    """E3 + E4 per model: ROC AUC (ties count one half) and average precision
    (step sum of precision over recall increments, not a trapezoid); both 0.0
    when only one class is present."""
    st = _ge_counts(st if st is not None else score_table(pred))
    return st.groupBy(MODEL).agg(*_ranking_sums()).select(MODEL, *_ranking())


def roc_points(pred: DataFrame, st: DataFrame | None = None) -> DataFrame:
    """E5: (threshold, fpr, tpr) at every distinct score, plus the start point
    (0, 0) above the highest score, with a NULL threshold."""
    st = _ge_counts(st if st is not None else score_table(pred))
    pts = st.select(MODEL, F.col("score").alias("threshold"),
                    _div0(F.col("fp_ge"), F.col("N")).alias("fpr"),
                    _div0(F.col("tp_ge"), F.col("P")).alias("tpr"))
    start = st.select(MODEL).distinct().select(MODEL, F.lit(None).cast("double").alias("threshold"),
                                               F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def pr_points(pred: DataFrame, st: DataFrame | None = None) -> DataFrame:
    """(threshold, precision, recall) at every distinct score, plus the
    closing point (precision 1, recall 0) with a NULL threshold."""
    st = _ge_counts(st if st is not None else score_table(pred))
    recall = F.when(F.col("P") > 0, F.col("tp_ge") / F.col("P")).otherwise(F.lit(1.0))
    pts = st.select(MODEL, F.col("score").alias("threshold"),
                    _div0(F.col("tp_ge"), F.col("tp_ge") + F.col("fp_ge")).alias("precision"),
                    recall.alias("recall"))
    end = st.select(MODEL).distinct().select(MODEL, F.lit(None).cast("double").alias("threshold"),
                                               F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def best_f1_threshold(pred: DataFrame, st: DataFrame | None = None, compat: bool = False) -> DataFrame:
    """The threshold maximising F1 on the PR points (ties: lowest threshold).

    ``compat=True`` reproduces the source's choice of the next lower distinct
    score (0.5 when the best is already the lowest).
    """
    pts = pr_points(pred, st).filter(F.col("threshold").isNotNull())
    p, r = F.col("precision"), F.col("recall")
    pts = pts.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)))
    best = pts.groupBy(MODEL).agg(F.max_by(F.struct("threshold", "f1"),
                                           F.struct(F.col("f1"), (-F.col("threshold")).alias("nt"))).alias("b"))
    best = best.select(MODEL, F.col("b.threshold").alias("best"), F.col("b.f1").alias("best_f1"))
    if not compat:
        return best.select(MODEL, F.col("best").alias("threshold"), "best_f1")
    lower = (pts.join(best, MODEL).filter(F.col("threshold") < F.col("best"))
             .groupBy(MODEL).agg(F.max("threshold").alias("prev")))
    return (best.join(lower, MODEL, "left")
            .select(MODEL, F.coalesce(F.col("prev"), F.lit(DEFAULT_THRESHOLD)).alias("threshold"), "best_f1"))


def tuned_confusion(pred: DataFrame, compat: bool = False, st: DataFrame | None = None) -> DataFrame:
    """Confusion counts at each model's F1-optimal threshold."""
    thr = best_f1_threshold(pred, st, compat=compat)
    joined = pred.join(thr.select(MODEL, F.col("threshold").alias("_thr")), MODEL)
    return confusion(joined, F.col("_thr")).join(thr, MODEL)


# ------------------------------------------------------------------ E9, E12

def reliability_curve(pred: DataFrame, n_bins: int = 10) -> DataFrame:
    """Quantile-binned reliability curve per model.

    Bin edges are the exact interpolated score percentiles at k/n_bins; a
    score's bin is the number of interior edges strictly below it.  Empty
    bins do not appear.  The edges of all models come from one set of
    quantile passes (one masked score column per model) and are joined as a
    small table (n_bins - 1 numbers per model).
    """
    spark = pred.sparkSession
    models = sorted(r[0] for r in pred.select(MODEL).distinct().collect())
    masked = pred.select(*[F.when(F.col(MODEL) == m, F.col("score")).alias(f"_s{i}") for i, m in enumerate(models)])
    stats = [Stat(f"_s{i}", k / n_bins, "cont") for i in range(len(models)) for k in range(1, n_bins)]
    edges = quantiles(masked, stats) if models else []
    per = n_bins - 1
    rows = [(m, [float(e) for e in edges[i * per:(i + 1) * per]]) for i, m in enumerate(models)]
    edges_df = spark.createDataFrame(rows, f"{MODEL} string, edges array<double>")
    binned = pred.join(edges_df, MODEL).withColumn(
        "bin", F.size(F.filter("edges", lambda e: e < F.col("score"))))
    return binned.groupBy(MODEL, "bin").agg(F.avg("score").alias("mean_score"),
                                            F.avg(F.col("label").cast("double")).alias("frac_pos"),
                                            F.count(F.lit(1)).alias("n"))


def brier(pred: DataFrame, prob: str = "score") -> DataFrame:
    """Mean squared difference between probability and label."""
    return pred.groupBy(MODEL).agg(F.avg((F.col(prob) - F.col("label")) ** 2).alias("brier"))


# ------------------------------------------------------------------ metric records

def evaluate(pred: DataFrame, threshold: float = DEFAULT_THRESHOLD, st: DataFrame | None = None) -> DataFrame:
    """E1-E4 + E15 as one metric record per model (name, ..., cm struct); ``st`` is their score table, if there is one.

    One aggregate over the distinct scores gives the counts at the threshold and the curve sums, so nothing is joined.
    """
    st = _ge_counts(st if st is not None else score_table(pred))
    hit = decision("score", threshold) == 1

    def count(side: str, predicted: Column) -> Column:
        return F.sum(F.when(predicted, F.col(side)).otherwise(F.lit(0)))
    cm = st.groupBy(MODEL).agg(
        count("neg", ~hit).alias("tn"), count("neg", hit).alias("fp"), count("pos", ~hit).alias("fn"), count("pos", hit).alias("tp"),
        F.sum("pos").alias("support"), F.sum(F.col("pos") + F.col("neg")).alias("n"), *_ranking_sums())
    return classification_metrics(cm.select("*", *_ranking())).select(
        F.col(MODEL).alias("name"), "roc_auc", "pr_auc", "f1", "precision", "recall", "accuracy",
        F.lit(float(threshold)).alias("threshold"),
        F.struct("tn", "fp", "fn", "tp").alias("cm"), "support", "n")


METRIC_ORDER = ["accuracy", "precision", "recall", "f1", "roc_auc"]


def to_long(records: DataFrame, metrics: Sequence[str] = ("accuracy", "precision", "recall", "f1", "roc_auc",
                                                          "pr_auc")) -> DataFrame:
    """Metric records -> (model, metric, value)."""
    present = [m for m in metrics if m in records.columns]
    return records.select(F.col("name").alias(MODEL),
                          F.explode(F.array(*[F.struct(F.lit(m).alias("metric"),
                                                       F.col(m).cast("double").alias("value"))
                                              for m in present])).alias("kv")
                          ).select(MODEL, "kv.metric", "kv.value")


def comparison_table(long: DataFrame, order: Sequence[str] = METRIC_ORDER) -> DataFrame:
    """One row per model, the five comparison metrics as columns, missing = 0."""
    return (long.groupBy(MODEL).pivot("metric", list(order)).agg(F.first("value"))
            .fillna(0.0, subset=list(order)))


def pick_threshold(records: DataFrame, default: float = DEFAULT_THRESHOLD) -> Column:
    """First present of best_threshold, threshold, thr, opt_threshold; else default."""
    keys = [k for k in ("best_threshold", "threshold", "thr", "opt_threshold") if k in records.columns]
    return F.coalesce(*[F.col(k).cast("double") for k in keys], F.lit(float(default)))


# ------------------------------------------------------------------ W6-W9, J2

def _m1(c: str) -> Column:
    return F.coalesce(F.col(c).cast("double"), F.lit(-1.0))


def rank_models(records: DataFrame) -> DataFrame:
    """Rank by (pr_auc, f1, roc_auc) desc, missing = -1 (ties: name);
    bar widths int(100 * x / max) for pr_auc and f1 (max over present values, 1 if none;
    0 where the maximum is 0)."""
    # Model tables are one row per model: a single ordered window is bounded by the model count.
    w = Window.orderBy(_m1("pr_auc").desc(), _m1("f1").desc(), _m1("roc_auc").desc(), F.col("name"))
    allw = Window.partitionBy()
    out = records.select(
        "name", "pr_auc", "f1", "roc_auc",
        F.row_number().over(w).alias("rank"),
        F.coalesce(F.max("pr_auc").over(allw), F.lit(1.0)).alias("_mpr"),
        F.coalesce(F.max("f1").over(allw), F.lit(1.0)).alias("_mf1"))
    width = lambda c, m: F.when(F.col(c).isNull(), F.lit(0)).otherwise(
        F.coalesce(F.floor(F.try_divide(F.lit(100.0) * F.col(c), F.col(m))).cast("int"), F.lit(0)))
    return out.select("name", "rank", "pr_auc", "f1", "roc_auc",
                      width("pr_auc", "_mpr").alias("pr_width"), width("f1", "_mf1").alias("f1_width"))


def best_model(records: DataFrame) -> DataFrame:
    """The first of ``rank_models`` and the criterion that ranked it: 'pr_auc' if any
    model has one, else 'f1', else 'roc_auc'.  No row for no models."""
    has = {c: F.max(F.col(c).isNotNull().cast("int")) == 1 for c in ("pr_auc", "f1")}
    by = F.when(has["pr_auc"], F.lit("pr_auc")).when(has["f1"], F.lit("f1")).otherwise(F.lit("roc_auc"))
    return (records.agg(by.alias("by"), _first_name("pr_auc", "f1", "roc_auc").alias("name"))
            .filter(F.col("name").isNotNull()))


def _first_name(*by: str) -> Column:
    """The name that is highest by these metrics; the smaller name wins ties, as in ``rank_models``."""
    return F.min_by("name", F.struct(*[(-_m1(c)).alias(f"k{i}") for i, c in enumerate(by)], F.col("name")))


def best_by_f1(records: DataFrame) -> DataFrame:
    """The model with the highest f1 (ties: the smaller name).  No row for no models."""
    return records.agg(_first_name("f1").alias("name")).filter(F.col("name").isNotNull())


def best_trial(trials: DataFrame, score: str = "f1", order: str = "trial", by: list[str] | None = None) -> DataFrame:
    """Argmax of ``score`` over a tuning grid (for each value of ``by``), the first trial winning ties."""
    row = F.struct(*[F.col(c) for c in trials.columns])
    best = trials.groupBy(*(by or [])).agg(F.min_by(row, F.struct((-F.col(score)).alias("s"), F.col(order))).alias("_t"))
    return best.filter(F.col("_t").isNotNull()).select("_t.*")


def merge_metric_sources(legacy: DataFrame, per_model: DataFrame) -> DataFrame:
    """Union of a combined metrics source and per-model records keyed
    by name; the per-model record wins; only records holding at least one of
    pr_auc / f1 / roc_auc are kept."""
    cols = ["roc_auc", "pr_auc", "f1", "precision", "recall", "accuracy", "threshold"]

    def norm(df):
        # a combined record without a name stands for the default model
        name = F.coalesce(F.col("name"), F.lit("xgb")) if "name" in df.columns else F.lit("xgb")
        return df.select(name.alias("name"), *[(F.col(c) if c in df.columns else F.lit(None)).cast("double").alias(c)
                                               for c in cols])

    def has_metric(df):
        return df.filter(F.col("pr_auc").isNotNull() | F.col("f1").isNotNull() | F.col("roc_auc").isNotNull())

    left = has_metric(norm(legacy)).alias("l")
    right = norm(per_model).alias("r")
    j = left.join(right, F.col("l.name") == F.col("r.name"), "full_outer")
    take_r = F.col("r.name").isNotNull()
    return j.select(F.coalesce(F.col("r.name"), F.col("l.name")).alias("name"),
                    *[F.when(take_r, F.col(f"r.{c}")).otherwise(F.col(f"l.{c}")).alias(c) for c in cols])
