"""Metrics against brute-force definitions."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import metrics as mt


def _pred(spark, n=400, seed=11):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.3)
        s = round(min(1.0, max(0.0, rnd.gauss(0.4 + 0.3 * y, 0.2))), 2)
        rows.append(("a", y, s))
        rows.append(("b", y, round(rnd.random(), 1)))
    return spark.createDataFrame(rows, "model string, label int, score double")


def _brute(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))
    ap = 0.0
    for t in sorted({s for _, s in rows}, reverse=True):
        tp = sum(1 for y, s in rows if y == 1 and s >= t)
        fp = sum(1 for y, s in rows if y == 0 and s >= t)
        ap += sum(1 for y, s in rows if y == 1 and s == t) / len(pos) * tp / (tp + fp)
    return auc, ap


def test_auc_ap_bruteforce(spark):
    df = _pred(spark).repartition(5)
    got = {r["model"]: (r["roc_auc"], r["pr_auc"]) for r in mt.ranking_metrics(df).collect()}
    for m in ("a", "b"):
        rows = [(r["label"], r["score"]) for r in df.filter(F.col("model") == m).collect()]
        auc, ap = _brute(rows)
        assert got[m][0] == pytest.approx(auc, abs=1e-12)
        assert got[m][1] == pytest.approx(ap, abs=1e-12)


def test_one_class_gives_zero(spark):
    df = spark.createDataFrame([("m", 1, 0.2), ("m", 1, 0.9)], "model string, label int, score double")
    r = mt.ranking_metrics(df).first()
    assert r["roc_auc"] == 0.0 and r["pr_auc"] == 0.0


def test_auc_invariant_under_monotone_map(spark):
    df = _pred(spark)
    a = mt.ranking_metrics(df).orderBy("model").collect()
    b = mt.ranking_metrics(df.withColumn("score", F.col("score") * 3 + 1)).orderBy("model").collect()
    assert [r["roc_auc"] for r in a] == pytest.approx([r["roc_auc"] for r in b])


def test_confusion_and_f1_threshold(spark):
    df = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.8), ("m", 1, 0.6), ("m", 0, 0.3), ("m", 1, 0.3)],
                               "model string, label int, score double")
    cm = mt.classification_metrics(mt.confusion(df, 0.5)).first()
    assert (cm["tn"], cm["fp"], cm["fn"], cm["tp"]) == (1, 1, 1, 2)
    assert cm["f1"] == pytest.approx(2 / 3)
    best = mt.best_f1_threshold(df).first()
    # thresholds ascending: 0.3 (p=.6,r=1 f1=.75), 0.6 (p=2/3,r=2/3), 0.8, 0.9
    assert best["threshold"] == 0.3 and best["best_f1"] == pytest.approx(0.75)
    assert mt.best_f1_threshold(df, compat=True).first()["threshold"] == 0.5
    pts = mt.pr_points(df).filter(F.col("threshold").isNull()).first()
    assert (pts["precision"], pts["recall"]) == (1.0, 0.0)


def test_reliability_bins(spark):
    df = _pred(spark)
    out = mt.reliability_curve(df).collect()
    assert all(0 <= r["bin"] <= 9 for r in out)
    for m in ("a", "b"):
        assert sum(r["n"] for r in out if r["model"] == m) == 400


def test_best_model_rules(spark):
    rec = spark.createDataFrame([("x", 0.5, 0.9, 0.7), ("y", 0.6, 0.1, 0.6), ("z", None, 0.95, 0.5)],
                                "name string, pr_auc double, f1 double, roc_auc double")
    assert mt.best_model(rec).first()["name"] == "y"
    assert mt.best_by_f1(rec).first()["name"] == "z"
    ranks = {r["name"]: r["rank"] for r in mt.rank_models(rec).collect()}
    assert ranks == {"y": 1, "x": 2, "z": 3}


def test_merge_sources_per_model_wins(spark):
    legacy = spark.createDataFrame([("xgb", 0.5, 0.4, 0.9), ("nlp", 0.1, 0.2, 0.6), ("bad", None, None, None)],
                                   "name string, pr_auc double, f1 double, roc_auc double")
    per = spark.createDataFrame([("xgb", 0.7, 0.8)], "name string, pr_auc double, f1 double")
    m = {r["name"]: r for r in mt.merge_metric_sources(legacy, per).collect()}
    assert set(m) == {"xgb", "nlp"} and m["xgb"]["pr_auc"] == 0.7 and m["xgb"]["roc_auc"] is None
    flat = spark.createDataFrame([(0.3, 0.2)], "pr_auc double, f1 double")
    assert [r["name"] for r in mt.merge_metric_sources(flat, per.limit(0)).collect()] == ["xgb"]


def test_evaluate_of_a_literal_model_name(spark):
    """Records of frames whose model name is a literal: right, and planned without a nested loop."""
    df = _pred(spark).filter(F.col("model") == "a").withColumn("model", F.lit("only"))
    out = mt.evaluate(df, 0.5)
    r = out.first()
    rows = [(x["label"], x["score"]) for x in df.collect()]
    auc, ap = _brute(rows)
    tp, fp = (sum(y == k and s >= 0.5 for y, s in rows) for k in (1, 0))
    assert (r["cm"]["tp"], r["cm"]["fp"], r["support"], r["n"]) == (tp, fp, sum(y for y, _ in rows), len(rows))
    assert r["name"] == "only" and r["roc_auc"] == pytest.approx(auc) and r["pr_auc"] == pytest.approx(ap)
    assert r["precision"] == pytest.approx(tp / (tp + fp))
    assert "NestedLoop" not in out._jdf.queryExecution().executedPlan().toString()
