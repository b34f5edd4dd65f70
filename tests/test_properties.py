"""Property tests (generated inputs, few examples: each one runs Spark jobs)."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerlens.operators.quantiles import Stat, quantiles
from ledgerlens.operators.split import stratified_split

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=300),
       st.sampled_from([0.0, 0.1, 0.33, 0.5, 0.9, 1.0]))
def test_quantiles_exact(spark, xs, p):
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(3)
    vals = sorted(x for x in xs if x is not None)
    d, c = quantiles(df, [Stat("x", p, "disc"), Stat("x", p, "cont")], ranges=8)
    if not vals:
        assert d is None and c is None
        return
    assert d == vals[max(1, math.ceil(p * len(vals))) - 1]
    assert abs(c - float(np.quantile(np.array(vals), p))) < 1e-9


@SETTINGS
@given(st.lists(st.integers(0, 1), min_size=1, max_size=400), st.integers(1, 6))
def test_split_disjoint_complete_any_partitioning(spark, labels, parts):
    rows = [(str(i), y) for i, y in enumerate(labels)]
    df = spark.createDataFrame(rows, "TransactionID string, is_fraud int")
    a = {r["TransactionID"]: r["split"] for r in stratified_split(df.repartition(parts)).collect()}
    b = {r["TransactionID"]: r["split"] for r in stratified_split(df.coalesce(1)).collect()}
    assert a == b and set(a) == {r[0] for r in rows}
    assert set(a.values()) <= {"train", "val", "test"}


@SETTINGS
@given(st.integers(3, 40), st.integers(41, 120))
def test_smote_equalises(spark, n_min, n_maj):
    from ledgerlens.operators.balance import smote
    rng = np.random.default_rng(n_min * 1000 + n_maj)
    rows = [(f"m{i}", 1, rng.normal(size=3).tolist()) for i in range(n_min)]
    rows += [(f"M{i}", 0, rng.normal(size=3).tolist()) for i in range(n_maj)]
    df = spark.createDataFrame(rows, "id string, label int, vec array<double>")
    if n_min <= 5:  # fewer than k + 1 minority rows are refused, not left unbalanced
        with pytest.raises(ValueError, match="minority"):
            smote(df, k=5)
        return
    out = smote(df, k=5)
    counts = {r["label"]: r["c"] for r in out.groupBy("label").agg(F.count("*").alias("c")).collect()}
    assert counts == {0: n_maj, 1: n_maj}
