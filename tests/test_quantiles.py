"""Exact quantiles against numpy, with few and many ranges."""

import math
import random

import numpy as np
import pytest

from ledgerlens.operators.quantiles import Stat, median, quantiles


@pytest.mark.parametrize("ranges", [1024, 2, 20])
def test_quantiles_match_numpy(spark, ranges):
    rnd = random.Random(ranges)
    a = [round(rnd.gauss(0, 10), 1) for _ in range(1500)] + [3.0] * 500 + [None] * 30
    b = [float(rnd.randint(1, 5)) for _ in range(2030)]
    df = spark.createDataFrame(list(zip(a, b)), "a double, b double").repartition(6)
    ps = [0.0, 0.01, 0.25, 0.5, 0.9, 0.95, 1.0]
    stats = [Stat(c, p, k) for c in ("a", "b") for p in ps for k in ("disc", "cont")]
    got = quantiles(df, stats, ranges=ranges)
    for s, g in zip(stats, got):
        x = np.array([v for v in (a if s.col == "a" else b) if v is not None])
        if s.kind == "disc":
            k = max(1, math.ceil(s.p * len(x)))
            assert g == np.sort(x)[k - 1], s
        else:
            assert g == pytest.approx(float(np.quantile(x, s.p)), abs=1e-9), s


def test_empty_and_single(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert quantiles(df, [Stat("x", 0.5)]) == [None]
    one = spark.createDataFrame([(4.0,)], "x double")
    assert median(one, "x") == 4.0


def test_hot_value_and_infinities(spark):
    """A value held by most rows, the values around it, and infinite ones."""
    xs = [1.0] * 4000 + [0.5, 2.0, math.inf, -math.inf, math.nan] * 20
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(4)
    known = np.sort([x for x in xs if not math.isnan(x)])
    ps = [0.001, 0.005, 0.01, 0.5, 0.985, 0.99, 0.999]
    for ranges in (4, 1024):
        got = quantiles(df, [Stat("x", p) for p in ps], ranges=ranges)
        assert got == [known[max(1, math.ceil(p * len(known))) - 1] for p in ps]


def test_walk_is_cut_into_ranges(spark, monkeypatch):
    """The running count of step 4 over many small ranges."""
    from ledgerlens.operators import ordered, quantiles as q
    monkeypatch.setattr(q, "with_key_ranges", lambda df, keys, order, n: ordered.with_key_ranges(df, keys, order, rows_per_range=10, n=n))
    df = spark.range(3000).selectExpr("cast(id * 7 % 3001 as double) as x")
    xs = sorted(i * 7 % 3001 for i in range(3000))
    assert quantiles(df, [Stat("x", p) for p in (0.1, 0.37, 0.9)], ranges=4) == [xs[math.ceil(p * 3000) - 1] for p in (0.1, 0.37, 0.9)]
