"""Importance, top terms, missing text and the balance policy against plain Python (M6, M7, W5, P27, SP7)."""

import math
import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.sql import functions as F

from ledgerlens.operators import balance as bal
from ledgerlens.operators import models as mdl
from ledgerlens.operators import transform as tf


def test_importance_of_used_features_in_order(spark):
    names = spark.createDataFrame([(k, f"num__f{k}") for k in range(4)], "position int, name string")
    model = SimpleNamespace(featureImportances=SparseVector(6, [0, 2, 3, 5], [0.2, 0.0, 0.5, 0.3]))
    got = [tuple(r) for r in mdl.feature_importance(model, names).collect()]
    assert got == [("num__f3", 0.5), ("f5", 0.3), ("num__f0", 0.2)]


def test_top_terms_of_both_signs(spark):
    rnd = random.Random(2)
    weights = [round(rnd.uniform(-2, 2), 1) for _ in range(40)]
    vocab = spark.createDataFrame([(k, f"t{k:02}") for k in range(40)], "idx int, term string")
    got = mdl.top_terms(SimpleNamespace(coefficients=DenseVector(weights)), vocab, 7).collect()
    rows = [(w, f"t{k:02}") for k, w in enumerate(weights)]
    want = ([("positive", t, w) for w, t in sorted(rows, key=lambda r: (-r[0], r[1]))[:7]]
            + [("negative", t, w) for w, t in sorted(rows)[:7]])
    assert sorted(map(tuple, got)) == sorted(want)


def test_text_model_optimum_with_missing_text(spark):
    """P27 + M2: NULL text is empty; the fitted coefficients have a vanishing gradient of the weighted, penalised loss."""
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        y = int(rnd.random() < 0.3)
        words = [rnd.choice(["alpha", "beta", "gamma", "delta"] + (["fraud"] * 3 if y else ["fine"])) for _ in range(6)]
        rows.append((i, None if i % 50 == 0 else " ".join(words), float(y)))
    df = spark.createDataFrame(rows, "id int, text string, label double")
    model, vocab = mdl.fit_text_model(df.withColumn("text", F.coalesce("text", F.lit(""))), "text", "label")
    out = model.transform(df.withColumn("text", F.coalesce("text", F.lit("")))).orderBy("id").collect()
    x = np.array([r["tfidf"].toArray() for r in out])
    assert not x[0].any() and np.allclose(np.linalg.norm(x[1:50], axis=1), 1)
    y = np.array([r["label"] for r in out])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    lr = model.stages[-1]
    p = 1 / (1 + np.exp(-(x @ lr.coefficients.toArray() + lr.intercept)))
    gradient = x.T @ (w * (p - y)) / w.sum() + lr.coefficients.toArray() / len(y)
    assert np.abs(gradient).max() < 1e-4 and abs((w * (p - y)).sum() / w.sum()) < 1e-4


def test_term_counts_equal_brute_force(spark):
    """T5: corpus counts and document frequencies; rows are documents, also equal ones."""
    texts = ["a bb cc bb", "bb cc", None, "", "BB-cc dd ee", "bb cc", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "nlp_text string").repartition(3)
    got = {r["term"]: (r["tf"], r["df"]) for r in tf.term_table(tf.terms(df)).collect()}
    tfs, dfs = Counter(), Counter()
    for t in texts:
        words = re.findall(r"\b\w\w+\b", (t or "").lower())
        grams = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
        tfs.update(grams)
        dfs.update(set(grams))
    assert got == {t: (tfs[t], dfs[t]) for t in tfs}
    _, vocab = tf.fit_tfidf(df, max_features=3)
    top = sorted(tfs, key=lambda t: (-tfs[t], t))[:3]
    assert [r["term"] for r in vocab.orderBy("idx").collect()] == top
    assert all(r["idf"] == pytest.approx(math.log((1 + len(texts)) / (1 + dfs[r["term"]])) + 1) for r in vocab.collect())


def test_balance_policy():
    assert [bal.use_smote(p, d) for p in ("always", "auto", "never", None) for d in ("primary", "ulb")] == [
        True, True, True, False, False, False, True, False]


def test_text_flow_builds_no_tabular_vectors(spark):
    """M2 reads id, label and text of the split rows: no encoder, no Python step in its scans."""
    from ledgerlens.plans import train as tr
    split = spark.createDataFrame([("1", 0, None, "train"), ("2", 1, "night fraud", "train"), ("3", 0, "day", "train"), ("4", 1, "x", "val")],
                                  "TransactionID string, is_fraud int, nlp_text string, split string")
    rows = tr.text_rows(split, "train")
    assert rows.columns == ["TransactionID", "label", "nlp_text"]
    assert "InArrow" not in rows._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in rows.orderBy("TransactionID").collect()] == [("1", 0.0, ""), ("2", 1.0, "night fraud"), ("3", 0.0, "day")]
    model, vocab = tr.train_text(split)
    assert {r["term"] for r in vocab.collect()} == {"night", "fraud", "night fraud", "day"}
    assert tr.scored(model, tr.text_rows(split, "val"), "nlp").count() == 1
