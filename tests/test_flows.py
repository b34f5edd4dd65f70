"""Sinks, export, scoring (batch and stream), tuning, ablation and cross-dataset flows
on the smallest driver tables (small tree counts where a test only checks plumbing)."""

import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import columns as C
from ledgerlens.operators import metrics as mt
from ledgerlens.operators import models as mdl
from ledgerlens.operators import scoring as sc
from ledgerlens.plans import catalog as cat
from ledgerlens.plans import train as tr
from ledgerlens.sources import files as io
from ledgerlens.streaming import ingest as ing

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def prep(spark):
    return tr.prepare(cat.curated(spark, SF))


@pytest.fixture(scope="module")
def small_model(prep):
    return tr.train_tabular(prep, maxIter=5)


def test_curated_sink_partitions_and_pruning(spark):
    d = tempfile.mkdtemp(prefix="ll-sink-")
    c = cat.curated(spark, SF)
    io.write_curated(c, f"{d}/curated", partitions=4)
    days = sorted(os.path.basename(p) for p in glob.glob(f"{d}/curated/versions/*/txn_date=*"))
    assert days and all(x.startswith("txn_date=") for x in days)
    back = io.read_curated(spark, f"{d}/curated", day_from="2024-01-10", day_to="2024-01-12")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    want = c.filter(F.to_date("TransactionDate").between("2024-01-10", "2024-01-12")).count()
    assert back.count() == want
    io.write_table(c.limit(5), f"{d}/t", "WRITE_APPEND")
    io.write_table(c.limit(5), f"{d}/t", "WRITE_APPEND")
    assert spark.read.parquet(f"{d}/t").count() == 10
    io.write_table(c.limit(5), f"{d}/t", "WRITE_TRUNCATE")
    assert spark.read.parquet(f"{d}/t").count() == 5
    with pytest.raises(Exception):
        io.write_table(c.limit(5), f"{d}/t", "WRITE_EMPTY")


def test_result_sinks_and_export(spark, prep):
    d = tempfile.mkdtemp(prefix="ll-out-")
    rec = mt.evaluate(mt.clean(cat.predictions(spark, SF)))
    io.write_json(rec, f"{d}/metrics")
    line = json.loads(open(glob.glob(f"{d}/metrics/part-*.json")[0]).readline())
    assert set(line["cm"]) == {"tn", "fp", "fn", "tp"}
    io.write_csv(rec.drop("cm"), f"{d}/metrics_csv")
    assert spark.read.option("header", True).csv(f"{d}/metrics_csv").count() == 2
    io.export_instances(prep.val, "features", 3, f"{d}/instances")
    doc = json.loads(open(glob.glob(f"{d}/instances/part-*.json")[0]).read())
    assert len(doc["instances"]) == 3 and len(doc["instances"][0]) == prep.names.count()


def test_dataset_dispatch(spark):
    assert "is_fraud" in io.load_dataset(spark, "primary", SF).columns
    assert "V1" in io.load_dataset(spark, "ulb", SF).columns
    with pytest.raises(ValueError):
        io.load_dataset(spark, "other", SF)
    assert io.accepts_object("incoming/a.csv") and io.accepts_object("incoming/b.csv.gz")
    assert not io.accepts_object("incoming/c.json") and not io.accepts_object("other/a.csv")


def test_scoring_batch_equals_stream(spark, prep, small_model):
    d = tempfile.mkdtemp(prefix="ll-score-")
    rows = cat.curated(spark, SF).join(prep.test.select("TransactionID"), "TransactionID").select(*cat.REQUEST_COLS)
    cat.request_json(rows).write.text(f"{d}/requests")
    batch = sc.score_requests(io.read_requests(spark, f"{d}/requests"), prep.preproc, small_model, 0.5,
                              prep.secs_median)
    q = ing.score_stream(spark, f"{d}/requests", f"{d}/scored", f"{d}/ckpt", prep.preproc, small_model, 0.5,
                         prep.secs_median)
    q.awaitTermination()
    streamed = spark.read.parquet(f"{d}/scored")
    a = sorted((r["TransactionID"], round(r["score"], 9), r["decision"]) for r in batch.collect())
    b = sorted((r["TransactionID"], round(r["score"], 9), r["decision"]) for r in streamed.collect())
    assert a == b and len(a) == prep.test.count()
    assert all(0.0 <= s <= 1.0 for _, s, _ in a)


def test_form_values_and_kpi(spark):
    df = spark.createDataFrame([(" 12 ", "", " x ", None)], "a string, b string, c string, d double")
    r = df.select(C.lenient_double(C.empty_to_null("a")).alias("a"), C.lenient_double(C.empty_to_null("b")).alias("b"),
                  C.kpi(F.lit(0.12345)).alias("k"), C.kpi("d").alias("kd"),
                  C.finite_or_clamped(F.lit(float("nan"))).alias("n")).first()
    assert (r["a"], r["b"], r["k"], r["kd"], r["n"]) == (12.0, None, "0.123", "-", 0.0)
    t = spark.createDataFrame([("2024-05-03T14:12:00Z", "bad")], "x string, y string")
    r = t.select(C.lenient_timestamp("x").alias("x"), C.lenient_timestamp("y").alias("y")).first()
    assert str(r["x"]) == "2024-05-03 14:12:00" and r["y"] is None


def test_tuning_grid_and_best_trial(spark, prep):
    b = tr.balanced(prep.train, "never")
    trials = mdl.tune_gbt(b, prep.val, grid={"maxDepth": [2, 3], "stepSize": [0.1]}, max_iter=3)
    assert trials.count() == 2
    best = mt.best_trial(trials).first()
    assert best["f1"] == max(r["f1"] for r in trials.collect())


def test_ablation_and_cross_domain(spark):
    c = cat.curated(spark, SF)
    ab = tr.ablation(c, maxIter=3)
    assert {r["variant"] for r in ab.collect()} == {"baseline", "ablated"}
    cd = tr.cross_domain(c, cat.card(spark, SF), maxIter=3)
    dirs = {(r["direction"], r["split"]) for r in cd.collect()}
    assert dirs == {("primary_to_ulb", "val"), ("primary_to_ulb", "test"),
                    ("ulb_to_primary", "val"), ("ulb_to_primary", "test")}


def test_preprocessor_persistence_roundtrip(spark, prep):
    from ledgerlens.operators import transform as tf
    d = tempfile.mkdtemp(prefix="ll-pipe-")
    tf.save_pipeline(prep.preproc, f"{d}/preproc")
    back = tf.load_pipeline(f"{d}/preproc")
    x = cat.split_features(spark, SF).drop("split").limit(50)
    from pyspark.ml.functions import vector_to_array
    a = [list(r[0]) for r in prep.preproc.transform(x).select(vector_to_array("features")).orderBy(F.lit(1)).collect()]
    b = [list(r[0]) for r in back.transform(x).select(vector_to_array("features")).orderBy(F.lit(1)).collect()]
    assert sorted(a) == sorted(b)
    assert sc.expected_inputs(back) == sc.expected_inputs(prep.preproc) == (prep.numeric, prep.categorical)


@pytest.mark.parametrize("name, rounds, fits", [("ablation", 200, 2), ("gbt_tuning", 300, 24)])
def test_whole_rounds(spark, monkeypatch, name, rounds, fits):
    """The registered flows boost the library's rounds, not a few of them."""
    import __spark_entry__ as E

    seen, plain = [], mdl.boost

    def boost(data, **k):
        seen.append(k["maxIter"])
        return plain(data, **{**k, "maxIter": 1, "maxDepth": 1})
    monkeypatch.setattr(mdl, "boost", boost)
    E.queries()[name](spark, SF).collect()
    assert seen == [rounds] * fits
