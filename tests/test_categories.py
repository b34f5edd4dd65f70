"""The category table: order, unknown values, hot and many values, saving and loading."""

import tempfile

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ledgerlens.operators import categories as ct
from ledgerlens.operators import transform as tf


def test_vectors_and_names(spark):
    train = spark.createDataFrame([(1, 2.0, "b", "x"), (2, None, "a", None), (3, 4.0, "ä", ""), (4, 0.0, "b", "x")],
                                  "id int, n double, c string, d string").repartition(3)
    model = tf.tabular_pipeline(["n"], ["c", "d"], scale=False, missing=-1.0).fit(train)
    names = [r["name"] for r in tf.feature_names(model, spark).orderBy("position").collect()]
    assert names == ["num__n", "cat__c_a", "cat__c_b", "cat__c_ä", "cat__d___empty__", "cat__d___null__", "cat__d_x"]
    ask = train.union(spark.createDataFrame([(5, 1.5, "new", "x")], train.schema)).withColumn("old", F.lit("kept"))
    got = {r["id"]: (r["features"].toArray().tolist(), r["old"]) for r in model.transform(ask).collect()}
    assert got == {1: ([2, 0, 1, 0, 0, 0, 1], "kept"), 2: ([-1, 1, 0, 0, 0, 1, 0], "kept"), 3: ([4, 0, 0, 1, 1, 0, 0], "kept"),
                   4: ([0, 0, 1, 0, 0, 0, 1], "kept"), 5: ([1.5, 0, 0, 0, 0, 0, 1], "kept")}


def test_saved_model_takes_its_table_along(spark):
    rows = spark.range(50).select(F.concat(F.lit("v"), F.col("id") % 7).alias("c"))
    model = Pipeline(stages=[ct.CategoryEncoder(inputCols=["c"], numericCols=[])]).fit(rows)
    path = tempfile.mkdtemp(prefix="ll-cat-") + "/model"
    model.save(path)
    again = PipelineModel.load(path)
    assert again.stages[0].getOrDefault("path").startswith(path)
    assert again.transform(rows).select("c", "features").exceptAll(model.transform(rows).select("c", "features")).count() == 0


def test_many_values_and_a_hot_one(spark, monkeypatch):
    """Ranks cut into many ranges; the numbers are dense and in order, and no list of values is on the driver."""
    from ledgerlens.operators import ordered
    monkeypatch.setattr(ct, "with_key_ranges", lambda df, keys, order: ordered.with_key_ranges(df, keys, order, rows_per_range=100))
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id"))).alias("a"),
                                    (F.col("id") % 5).cast("string").alias("b"))
    out = ct.numbered(rows, ["a", "b"]).orderBy("position", "idx").collect()
    a = [r["value"] for r in out if r["position"] == 0]
    assert a == sorted(a) and [r["idx"] for r in out if r["position"] == 0] == list(range(4001)) and len(out) == 4006
    model = ct.CategoryEncoder(inputCols=["a", "b"], numericCols=[]).fit(rows)
    assert model.getOrDefault("sizes") == [4001, 5]
    got = model.transform(rows).select("features")
    assert got.first()[0].size == 4006 and not got.schema["features"].metadata


def test_no_rows(spark):
    rows = spark.createDataFrame([], "n double, c string")
    model = tf.tabular_pipeline(["n"], ["c"], scale=False).fit(rows)
    assert model.transform(spark.createDataFrame([(1.0, "x")], "n double, c string")).first()["features"].toArray().tolist() == [1.0]
