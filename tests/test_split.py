"""Split properties: disjoint, complete, group-pure, sizes per formula."""

import random

from pyspark.sql import functions as F

from ledgerlens.operators.split import group_split, stratified_split, time_split


def _df(spark, n=2000):
    rnd = random.Random(7)
    rows = [(str(i), f"acc{rnd.randint(0, 60) if i % 4 else 0}", int(rnd.random() < 0.08), i * 60)
            for i in range(n)]
    return (spark.createDataFrame(rows, "TransactionID string, AccountID string, is_fraud int, s long")
            .withColumn("TransactionDate", F.timestamp_seconds("s").cast("timestamp_ntz")))


def test_stratified_sizes_and_partition_invariance(spark):
    df = _df(spark)
    a = {r["TransactionID"]: r["split"] for r in stratified_split(df.repartition(1)).collect()}
    b = {r["TransactionID"]: r["split"] for r in stratified_split(df.repartition(9)).collect()}
    assert a == b and len(a) == 2000
    counts = {}
    for r in df.collect():
        counts.setdefault(r["is_fraud"], []).append(a[r["TransactionID"]])
    import math
    for lab, splits in counts.items():
        n = len(splits)
        n_test = math.ceil(0.15 * n)
        n_val = math.ceil((0.15 / 0.85) * (n - n_test))
        assert splits.count("test") == n_test and splits.count("val") == n_val


def test_group_split_no_account_crosses(spark):
    out = group_split(_df(spark)).groupBy("AccountID").agg(F.countDistinct("split").alias("k"))
    assert out.filter(F.col("k") > 1).count() == 0


def test_time_split_sizes(spark):
    df = _df(spark)
    out = time_split(df).collect()
    per = {}
    for r in out:
        per.setdefault(r["AccountID"], []).append((r["TransactionDate"], r["TransactionID"], r["split"]))
    for acc, rows in per.items():
        rows.sort()
        n = len(rows)
        t = max(1, round(n * 0.15))
        v = max(1, round(n * 0.15))
        tr = max(0, n - v - t)
        want = ["train"] * tr + ["val"] * min(v, n - tr) + ["test"] * max(0, n - tr - v)
        assert [s for _, _, s in rows] == want, acc


def test_time_split_single_row_is_val(spark):
    df = spark.createDataFrame([("1", "solo", 0, 0)], "TransactionID string, AccountID string, is_fraud int, s long")
    df = df.withColumn("TransactionDate", F.timestamp_seconds("s").cast("timestamp_ntz"))
    assert time_split(df).first()["split"] == "val"


def test_time_split_without_account_orders_by_time(spark):
    df = spark.createDataFrame([(str(i), 0, i) for i in range(20)], "TransactionID string, is_fraud int, s long")
    df = df.withColumn("TransactionDate", F.timestamp_seconds("s").cast("timestamp_ntz"))
    out = {r["TransactionID"]: r["split"] for r in time_split(df).collect()}
    assert "AccountID" not in time_split(df).columns
    assert [out[str(i)] for i in range(20)] == ["train"] * 14 + ["val"] * 3 + ["test"] * 3
