"""Wrong answers and crashes of earlier versions, each with the case that showed it."""

import math

import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.functions import columns as C
from ledgerlens.operators import metrics as mt
from ledgerlens.operators.balance import scale_pos_weight, smote
from ledgerlens.operators.profile import describe_numeric
from ledgerlens.operators.quantiles import Stat, quantiles
from ledgerlens.operators.scoring import coerce_inputs, sanitize
from ledgerlens.plans import warehouse


def test_auc_of_billions_of_rows(spark):
    big = 4_000_000_000
    st = spark.createDataFrame([("m", 0.1, 0, big, 0, big, big, big), ("m", 0.9, big, 0, big, big, big, big)],
                               "model string, score double, pos long, neg long, cpos long, cneg long, P long, N long")
    r = mt.ranking_metrics(None, st=st).first()
    assert r["roc_auc"] == 1.0 and r["pr_auc"] == 1.0


def test_nan_is_missing(spark):
    x = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,)], "a double")
    assert quantiles(x, [Stat("a", 0.5, "disc"), Stat("a", 0.5, "cont")]) == [1.0, 2.0]
    r = describe_numeric(x).first()
    assert r["count"] == 2 and r["mean"] == 2.0 and r["p50"] == 2.0 and r["max"] == 3.0


def records(spark, rows):
    return spark.createDataFrame(rows, "name string, pr_auc double, f1 double, roc_auc double")


def test_ranking_ties_and_zero_maxima(spark):
    same = records(spark, [("b", 0.0, 0.0, 0.0), ("a", 0.0, 0.0, 0.0)])
    top = mt.rank_models(same).orderBy("rank").first()
    assert (top["name"], top["pr_width"], top["f1_width"]) == ("a", 0, 0)
    assert mt.best_model(same).first()["name"] == "a" and mt.best_by_f1(same).first()["name"] == "a"
    assert mt.best_model(same.filter("false")).count() == 0 and mt.best_by_f1(same.filter("false")).count() == 0
    by = mt.best_model(records(spark, [("a", None, None, 0.4), ("b", None, None, 0.6)])).first()
    assert (by["by"], by["name"]) == ("roc_auc", "b")


def test_roc_start_point(spark):
    pred = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.2)], "model string, label int, score double")
    pts = [(r["threshold"], r["fpr"], r["tpr"]) for r in mt.roc_points(pred).collect()]
    assert (None, 0.0, 0.0) in pts and len(pts) == 3


def test_lenient_typing(spark):
    rows = [("2024-05-06T14:12:00+02:00", "12d"), ("2024-05-06T14:12", "12f"), ("2024-05-06 14:12:01.25Z", " -1.5e3 "),
            ("2024-05-06 01:00:00-0130", "NaN"), ("2024-05-06", ".5"), ("2024-13-06", "1,5"), ("soon", ""), (None, None)]
    got = spark.createDataFrame(rows, "t string, x string").select(
        C.lenient_timestamp("t").cast("string").alias("t"), C.lenient_double("x").alias("x")).collect()
    assert [r["t"] for r in got] == ["2024-05-06 12:12:00", "2024-05-06 14:12:00", "2024-05-06 14:12:01.25",
                                     "2024-05-06 02:30:00", "2024-05-06 00:00:00", None, None, None]
    assert [r["x"] for r in got[:3]] == [None, None, -1500.0] and math.isnan(got[3]["x"])
    assert [r["x"] for r in got[4:]] == [0.5, None, None, None]


def test_numeric_time_stays_numeric(spark):
    x = spark.createDataFrame([(406.0, "2024-01-01 00:00:10", "7")], "Time double, seen_date string, n string")
    r = coerce_inputs(x, ["Time", "seen_date", "n", "absent"], []).first()
    assert (r["Time"], r["seen_date"], r["n"], r["absent"]) == (406.0, 1704067210.0, 7.0, None)


def test_sanitized_vector(spark):
    x = spark.createDataFrame([([float("nan"), float("inf"), -float("inf"), 1.0],)], "a array<double>")
    r = x.select(vector_to_array(sanitize(array_to_vector(F.col("a")))).alias("v")).first()["v"]
    assert r[0] == 0.0 and r[1] == -r[2] > 1e300 and r[3] == 1.0


def test_smote_needs_neighbours(spark):
    x = spark.createDataFrame([(str(k), int(k == 0), [float(k)]) for k in range(4)], "id string, label int, vec array<double>")
    with pytest.raises(ValueError, match="minority"):
        smote(x, k=1)
    assert scale_pos_weight(10, 0) is None and scale_pos_weight(9, 3) is None and scale_pos_weight(10, 2) == 5.0


def test_shared_tables_follow_their_input(spark, tmp_path):
    folder = str(tmp_path)
    spark.range(3).write.parquet(f"{folder}/t.parquet")

    def build():
        return spark.read.parquet(f"{folder}/t.parquet")
    assert warehouse.shared(spark, folder, "probe", build).count() == 3
    spark.range(5).write.mode("overwrite").parquet(f"{folder}/t.parquet")
    assert warehouse.shared(spark, folder, "probe", build).count() == 5


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        applicationId, master = "app-1", "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_absent_request_fields_have_defaults(spark):
    """What is left out has its default; what is null, or in no object, has none."""
    from ledgerlens.sources import files as io
    rows = ['{"TransactionID": "1"}', '{"TransactionID": "2", "TransactionAmount": null, "LoginAttempts": 4, "nlp_text": null}', "no json", None]
    got = io.parse_requests(spark.createDataFrame([(r,) for r in rows], "value string")).select(
        "TransactionID", "TransactionAmount", "LoginAttempts", "nlp_text", "AccountBalance").collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        ("1", "0.0", "0", "", None), ("2", None, "4", None, None), (None, None, None, None, None), (None, None, None, None, None)], key=str)
