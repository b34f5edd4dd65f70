"""File-stream ingest: each file once, new drops only, decoys ignored, report per file."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlens.plans import catalog as cat
from ledgerlens.streaming import ingest as ing

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_ingest_exactly_once_and_incremental(spark):
    root = tempfile.mkdtemp(prefix="ll-landing-")
    table, ckpt, rep = f"{root}/table", f"{root}/_ckpt", f"{root}/_report"
    raw = cat.raw(spark, SF)
    n = raw.count()
    cat._write_raw_csv(spark, SF, f"{root}/incoming/a", by_day=False)
    spark.createDataFrame([("x",)], "v string").write.text(f"{root}/incoming/notes")  # not *.csv
    ing.ingest(spark, root, table, ckpt, rep, null_value=cat.NULL_MARKER).awaitTermination()
    assert ing.read_ingested(spark, table).count() == n
    # the same files again (redelivered event): nothing new
    ing.ingest(spark, root, table, ckpt, rep, null_value=cat.NULL_MARKER).awaitTermination()
    assert ing.read_ingested(spark, table).count() == n
    # a new drop: only its rows are added
    raw.filter(F.col("AccountID") == "1").write.option("header", True).option("nullValue", cat.NULL_MARKER) \
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").csv(f"{root}/incoming/b")
    extra = raw.filter(F.col("AccountID") == "1").count()
    ing.ingest(spark, root, table, ckpt, rep, null_value=cat.NULL_MARKER).awaitTermination()
    assert ing.read_ingested(spark, table).count() == n + extra
    report = spark.read.parquet(rep)
    assert report.agg(F.sum("rows")).first()[0] == n + extra
    assert report.filter(F.col("source_file").contains("/notes/")).count() == 0
