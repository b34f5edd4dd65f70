"""Loading objects once for each generation.

The raw table is a folder of loads and a ledger of what each of them took:

    <table>/rows/load=<n>/...      rows with ``object`` and ``generation``
    <table>/ledger/load=<n>/...    (object, generation, rows)

An object is a file under ``incoming/`` ending in .csv or .csv.gz; its generation is its modification time and length. A call
of ``load_new`` lists the objects, leaves out those whose generation the ledger has, and appends the rows of the
others: an event that is delivered again loads nothing, a replaced object loads again, as a new generation. The
ledger part is written last, and readers take the loads that the ledger names, so rows and ledger become visible
together; a load that dies half-way is written over by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_SCHEMA
from .files import CSV_SUFFIXES, FILE_PREFIX, read_transactions_csv
from .versions import _path

LEDGER = "object string, generation string, rows bigint, load int"


def objects(spark: SparkSession, root: str) -> DataFrame:
    """(object, generation) of the files that the path filter accepts, from the listing alone."""
    fs, folder = _path(spark, f"{root.rstrip('/')}/{FILE_PREFIX}")
    if not fs.exists(folder):
        return spark.createDataFrame([], "object string, generation string")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
              .option("pathGlobFilter", "*{" + ",".join(CSV_SUFFIXES) + "}").load(folder.toString()))
    return listed.select(F.col("path").alias("object"),
                         F.concat_ws(":", F.unix_micros("modificationTime"), "length").alias("generation"))


def read_ledger(spark: SparkSession, table: str) -> DataFrame:
    """(object, generation, rows, load) of every committed load."""
    fs, folder = _path(spark, f"{table.rstrip('/')}/ledger")
    if not fs.exists(folder):
        return spark.createDataFrame([], LEDGER)
    # a part that is still being written, or whose writer died, has no success mark
    done = [s.getPath().toString() for s in fs.listStatus(folder)
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    if not done:
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).option("basePath", folder.toString()).parquet(*done)


def load_new(spark: SparkSession, root: str, table: str, sep: str = ",", null_value: str = "", multi_line: bool = True) -> int | None:
    """Append the rows of new objects and new generations; returns the number of the load, None if there is nothing new."""
    known = read_ledger(spark, table)
    fresh = objects(spark, root).join(known, ["object", "generation"], "left_anti").collect()  # the paths a reader is given
    if not fresh:
        return None
    number = (known.agg(F.max("load")).first()[0] or 0) + 1
    rows_at, ledger_at = (f"{table.rstrip('/')}/{part}/load={number}" for part in ("rows", "ledger"))
    rows = read_transactions_csv(spark, [r["object"] for r in fresh], sep=sep, null_value=null_value, multi_line=multi_line)
    generation = F.concat_ws(":", F.unix_micros(F.col("_metadata.file_modification_time")), F.col("_metadata.file_size"))
    (rows.select("*", F.col("_metadata.file_path").alias("object"), generation.alias("generation"))
     .write.mode("overwrite").parquet(rows_at))
    counted = spark.read.parquet(rows_at).groupBy("object", "generation").agg(F.count(F.lit(1)).alias("rows"))
    # an object without rows is taken as well
    taken = spark.createDataFrame([(r["object"], r["generation"]) for r in fresh], "object string, generation string")
    (counted.unionByName(taken.withColumn("rows", F.lit(0).cast("long"))).groupBy("object", "generation").agg(F.sum("rows").alias("rows"))
     .write.mode("overwrite").parquet(ledger_at))
    return number


def read_loaded(spark: SparkSession, table: str) -> DataFrame:
    """The raw rows of all committed loads, with object, generation and load."""
    loads = sorted(r["load"] for r in read_ledger(spark, table).select("load").distinct().collect())
    schema = RAW_SCHEMA.simpleString()[len("struct<"):-1].replace(":", " ") + ", object string, generation string, load int"
    if not loads:
        return spark.createDataFrame([], schema)
    base = f"{table.rstrip('/')}/rows"
    return spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/load={n}" for n in loads])
