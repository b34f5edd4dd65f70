"""Atomic replacement of a table, the load ledger and keyed state over restarts."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from ledgerlens.schema import RAW_SCHEMA
from ledgerlens.sources import files as io
from ledgerlens.sources import ledger, versions
from ledgerlens.streaming import gaps


def test_a_dying_writer_leaves_the_old_table(spark):
    path = tempfile.mkdtemp(prefix="ll-versions-") + "/table"
    assert versions.current_version(spark, path) is None
    versions.replace_table(spark, path, lambda p: spark.range(10).write.parquet(p))

    def dies(folder):
        spark.range(100).write.parquet(folder)  # all rows are there, but the job goes on and dies
        spark.range(5).select(F.raise_error(F.lit("lost"))).write.parquet(f"{folder}/more")
    old = spark.read.parquet(versions.current_version(spark, path))
    with pytest.raises(Exception, match="lost"):
        versions.replace_table(spark, path, dies)
    assert spark.read.parquet(versions.current_version(spark, path)).count() == 10
    versions.replace_table(spark, path, lambda p: spark.range(20).write.parquet(p))
    assert old.count() == 10  # an open reader keeps its version
    assert spark.read.parquet(versions.current_version(spark, path)).count() == 20
    assert versions.remove_versions(spark, path) == 2 and len(os.listdir(f"{path}/versions")) == 1
    assert spark.read.parquet(versions.current_version(spark, path)).count() == 20


def _land(spark, root, name, ids):
    os.makedirs(os.path.dirname(f"{root}/incoming/{name}"), exist_ok=True)
    head = ",".join(f.name for f in RAW_SCHEMA.fields)
    with open(f"{root}/incoming/{name}", "w") as f:
        f.write(head + "\n" + "".join(f"{i}" + "," * (len(RAW_SCHEMA.fields) - 1) + "\n" for i in ids))


def test_ledger_loads_each_generation_once(spark):
    root = tempfile.mkdtemp(prefix="ll-ledger-")
    table = f"{root}/table"
    assert ledger.load_new(spark, root, table) is None and ledger.read_loaded(spark, table).count() == 0
    _land(spark, root, "a.csv", range(3))
    _land(spark, root, "deep/b.csv", range(10, 12))
    _land(spark, root, "empty.csv", [])
    _land(spark, root, "notes.txt", range(50))
    assert ledger.load_new(spark, root, table) == 1 and ledger.load_new(spark, root, table) is None
    _land(spark, root, "a.csv", range(20, 25))  # replaced
    os.makedirs(f"{table}/rows/load=2/x")  # what a load that died has left
    assert ledger.load_new(spark, root, table) == 2 and ledger.load_new(spark, root, table) is None
    got = ledger.read_loaded(spark, table)
    assert sorted((int(r["TransactionID"]), r["load"]) for r in got.collect()) == (
        [(i, 1) for i in (0, 1, 2, 10, 11)] + [(i, 2) for i in range(20, 25)])
    rows = {(r["object"].rsplit("/", 1)[1], r["load"]): (r["rows"], r["generation"]) for r in ledger.read_ledger(spark, table).collect()}
    assert {k: v[0] for k, v in rows.items()} == {("a.csv", 1): 3, ("b.csv", 1): 2, ("empty.csv", 1): 0, ("a.csv", 2): 5}
    assert rows["a.csv", 1][1] != rows["a.csv", 2][1]
    # a load whose ledger part was never finished isn't seen, and is loaded again
    os.unlink(f"{table}/ledger/load=2/_SUCCESS")
    assert ledger.read_loaded(spark, table).count() == 5
    assert ledger.load_new(spark, root, table) == 2 and ledger.read_loaded(spark, table).count() == 10


def test_curated_sink_is_replaced(spark):
    path = tempfile.mkdtemp(prefix="ll-curated-") + "/curated"
    rows = spark.range(40).select(F.col("id").cast("string").alias("AccountID"),
                                  F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, cast(id % 4 as int))").alias("TransactionDate"))
    io.write_curated(rows, path, partitions=3)
    io.write_curated(rows.limit(8), path, partitions=3)
    assert io.read_curated(spark, path).count() == 8
    assert io.read_curated(spark, path, "2024-01-02", "2024-01-02").select("txn_date").distinct().count() <= 1


def _run(spark, root, expire=None):
    stream = spark.readStream.schema("AccountID string, TransactionID string, TransactionDate timestamp_ntz").parquet(f"{root}/in")
    q = (gaps.account_gaps(stream, expire).writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()


@pytest.mark.parametrize("expire", [None, 2])
def test_gaps_go_on_after_a_restart(spark, expire):
    root = tempfile.mkdtemp(prefix="ll-gaps-")
    first = [("a", "1", "2024-01-01 00:00:00"), ("a", "2", "2024-01-01 00:00:10.5"), ("b", "3", "2024-01-01 00:01:00"), ("b", "4", None),
             (None, "5", "2024-01-01 00:00:00")]
    second = [("a", "6", "2024-01-02 00:00:10.5"), ("b", "7", "2024-01-05 00:01:00"), ("c", "8", "2024-01-05 00:00:00"),
              (None, "9", "2024-01-05 00:00:00")]
    for rows in (first, second):
        frame = spark.createDataFrame(rows, "AccountID string, TransactionID string, t string")
        frame.select("AccountID", "TransactionID", F.col("t").cast("timestamp_ntz").alias("TransactionDate")).write.mode("append").parquet(f"{root}/in")
        _run(spark, root, expire)
    got = {r["TransactionID"]: r["secs_since_prev"] for r in spark.read.parquet(f"{root}/out").collect()}
    want = {"1": None, "2": 10.5, "3": None, "4": None, "5": None, "6": 86400.0, "7": None if expire else 4 * 86400.0, "8": None, "9": None}
    assert got == want
