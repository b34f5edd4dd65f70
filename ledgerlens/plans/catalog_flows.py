"""Registered queries of sources, sinks, scoring steps and model flows.

The same contract as ``catalog``: each query reads the driver tables, and its
DuckDB statement over the same tables shares names and types.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import calibrate as cal
from ..operators import features as feat
from ..operators import metrics as mt
from ..operators import models as mdl
from ..operators import scoring as sc
from ..operators import transform as tf
from ..schema import ID_LIKE_COLUMNS
from ..session import materialize, scratch_path
from ..sources import files as io
from ..sources import fixtures as fx
from ..sources import ledger
from ..streaming import gaps
from . import catalog as cat
from . import train as tr
from .catalog import CURATED_WITH, METRICS_WITH, RAW_CTE, SPLIT_WITH, r6, register, with_ctes

RAW_WITH = with_ctes(RAW_CTE)

# ---------------------------------------------------------------- sinks and sources


@register("curated_sink", CURATED_WITH + """SELECT strftime(TransactionDate, '%Y-%m-%d') AS day, count(*) AS n,
       CAST(sum(is_fraud) AS BIGINT) AS n_fraud FROM curated
WHERE CAST(TransactionDate AS DATE) BETWEEN (SELECT CAST(min(TransactionDate) AS DATE) + 1 FROM curated)
                                        AND (SELECT CAST(max(TransactionDate) AS DATE) - 1 FROM curated) GROUP BY 1""")
def q_curated_sink(spark, sf_dir):
    """S8 + S5: the curated table written by day and read back for all days but the first and the last."""
    path = scratch_path(spark, "curated_sink")
    curated = cat.curated(spark, sf_dir)
    io.write_curated(curated, path)
    ends = curated.agg(F.date_add(F.min("TransactionDate").cast("date"), 1).cast("string").alias("a"),
                       F.date_sub(F.max("TransactionDate").cast("date"), 1).cast("string").alias("b")).first()
    got = io.read_curated(spark, path, ends["a"], ends["b"])
    return got.groupBy(F.date_format("txn_date", "yyyy-MM-dd").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("is_fraud").cast("long")).alias("n_fraud"))


@register("write_modes", RAW_WITH + """SELECT step, CASE step WHEN 'append' THEN 2 * n ELSE n END AS n
FROM (SELECT count(*) AS n FROM raw), (VALUES ('append'), ('truncate'), ('refused')) s(step)""")
def q_write_modes(spark, sf_dir):
    """Appending twice doubles a table, truncating replaces it, writing if empty refuses a table that is there."""
    rows = cat.raw(spark, sf_dir).select("TransactionID", "TransactionAmount")
    appended, replaced = scratch_path(spark, "write_modes"), scratch_path(spark, "write_modes")
    io.write_table(rows, appended, "WRITE_EMPTY")
    io.write_table(rows, appended, "WRITE_APPEND")
    io.write_table(rows, replaced, "WRITE_APPEND")
    io.write_table(rows, replaced, "WRITE_TRUNCATE")
    try:
        io.write_table(rows, replaced, "WRITE_EMPTY")
        refused = "overwritten"
    except Exception as error:  # noqa: BLE001 - the writer's own error for a path that exists
        if "EXISTS" not in str(error).upper():
            raise
        refused = "refused"
    parts = [("append", appended), ("truncate", replaced), (refused, replaced)]
    out = None
    for step, path in parts:
        one = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).select(F.lit(step).alias("step"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@register("ingest_ledger", RAW_WITH.rstrip() + """,
parts AS (SELECT CAST(CAST(TransactionID AS BIGINT) % 8 AS INTEGER) AS part, count(*) AS n FROM raw GROUP BY 1)
SELECT part, 1 AS load, n AS rows FROM parts UNION ALL SELECT 0, 2, n FROM parts WHERE part = 1""")
def q_ingest_ledger(spark, sf_dir):
    """S2 + S3: objects loaded once for each generation: an event repeated loads nothing, a replaced object loads again."""
    root = scratch_path(spark, "ledger_landing")
    raw = cat.raw(spark, sf_dir).withColumn("part", F.col("TransactionID").cast("long") % 8)
    (raw.repartition("part").write.option("header", True).option("nullValue", cat.NULL_MARKER)
     .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS").partitionBy("part").csv(f"{root}/incoming"))
    table = f"{root}/table"
    part = F.regexp_extract("object", "part=([0-9]+)", 1).cast("int")
    ledger.load_new(spark, root, table, null_value=cat.NULL_MARKER)
    if ledger.load_new(spark, root, table, null_value=cat.NULL_MARKER) is not None:
        raise RuntimeError("a repeated event was loaded again")
    # the object of part 0 is replaced by the content of part 1
    place = {r["part"]: r["object"] for r in ledger.objects(spark, root).select(part.alias("part"), "object").collect()}
    _copy_object(spark, place[1], place[0])
    ledger.load_new(spark, root, table, null_value=cat.NULL_MARKER)
    return ledger.read_loaded(spark, table).groupBy(part.alias("part"), "load").agg(F.count(F.lit(1)).alias("rows"))


def _copy_object(spark, source, target):
    """One object written over another; its rows are read as text by Spark's file system, whichever that is."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    a, b = hadoop.Path(source), hadoop.Path(target)
    hadoop.FileUtil.copy(a.getFileSystem(conf), a, b.getFileSystem(conf), b, False, True, conf)


@register("account_gaps_stream", RAW_WITH + """SELECT AccountID, TransactionID, TransactionDate, lag(TransactionDate) OVER w AS PreviousTransactionDate,
       (epoch_us(TransactionDate) - epoch_us(lag(TransactionDate) OVER w)) / 1000000.0::DOUBLE AS secs_since_prev
FROM raw WINDOW w AS (PARTITION BY AccountID ORDER BY TransactionDate, TransactionID)""")
def q_account_gaps_stream(spark, sf_dir):
    """W2 + P14 + M8 as a stream: previous time and gap of every transaction from keyed state, over two runs of the query."""
    root = scratch_path(spark, "account_gaps")
    raw = cat.raw(spark, sf_dir).select("AccountID", "TransactionID", "TransactionDate")
    middle = raw.agg(F.percentile_approx("TransactionDate", 0.5)).first()[0]
    for half in (F.col("TransactionDate") <= F.lit(middle), F.col("TransactionDate") > F.lit(middle)):
        raw.where(half).write.mode("append").parquet(f"{root}/in")
        stream = gaps.account_gaps(spark.readStream.schema(raw.schema).parquet(f"{root}/in"))
        query = (stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
                 .outputMode("append").trigger(availableNow=True).start())
        query.awaitTermination()  # the second run goes on from the first one's state
    return spark.read.parquet(f"{root}/out")


AWKWARD = "concat(Location, ' \"x\", ', chr(10), '; ', Channel)"


@register("csv_roundtrip", RAW_WITH + f"SELECT * REPLACE ({AWKWARD} AS Location) FROM raw")
def q_csv_roundtrip(spark, sf_dir):
    """S1 + S9: rows with quotes, delimiters and newlines in their text, written as CSV and read with the fixed schema."""
    path = scratch_path(spark, "csv_roundtrip")
    text = F.concat("Location", F.lit(' "x", \n; '), "Channel")
    io.write_csv(cat.raw(spark, sf_dir).withColumn("Location", text), path, null_value=cat.NULL_MARKER)
    return io.read_transactions_csv(spark, path, null_value=cat.NULL_MARKER)


@register("metric_files", METRICS_WITH + """SELECT name, round(roc_auc, 6) AS roc_auc, round(f1, 6) AS f1, threshold,
       CAST(tn AS BIGINT) AS tn, CAST(tp AS BIGINT) AS tp FROM records""")
def q_metric_files(spark, sf_dir):
    """S10 + S13: metric records written as JSON, nested counts kept, and collected from their files."""
    path = scratch_path(spark, "metric_files")
    io.write_json(cat.records(spark, sf_dir), path)
    got = io.read_metrics(spark, path)
    return got.select("name", r6("roc_auc").alias("roc_auc"), r6("f1").alias("f1"), "threshold", "cm.tn", "cm.tp")


INSTANCE_COLS = ["TransactionAmount", "CustomerAge", "LoginAttempts"]


@register("instances", CURATED_WITH.rstrip() + """,
first AS (
  SELECT row_number() OVER (ORDER BY AccountID, TransactionDate, TransactionID) - 1 AS pos, * FROM curated)
SELECT CAST(pos AS INTEGER) AS pos, TransactionAmount AS x0, CAST(CustomerAge AS DOUBLE) AS x1, CAST(LoginAttempts AS DOUBLE) AS x2
FROM first WHERE pos < 25""")
def q_instances(spark, sf_dir):
    """The first 25 feature rows in curated order as one instances document (the 25 are the feature), read back."""
    path = scratch_path(spark, "instances")
    rows = VectorAssembler(inputCols=INSTANCE_COLS, outputCol="features").transform(cat.curated(spark, sf_dir))
    io.export_instances(rows, "features", 25, path)
    doc = spark.read.schema("instances array<array<double>>").json(path)
    return doc.select(F.posexplode("instances").alias("pos", "x")).select(
        "pos", *[F.col("x")[k].alias(f"x{k}") for k in range(len(INSTANCE_COLS))])


@register("card_csv", f"SELECT \"Time\", Amount, \"Class\", V1, V4, row_id FROM ({fx.CARD_RAW_SQL})")
def q_card_csv(spark, sf_dir):
    """S7 + P12: the card file found under its second path, read with the 31-column schema, with contiguous row ids in file order."""
    root = scratch_path(spark, "card_csv")
    raw = fx.card_transactions_raw(spark, sf_dir)
    wide = raw.select(*[F.col(c) if c in raw.columns else F.lit(None).cast("double").alias(c) for c in io.CARD_COLUMNS], "row_id")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = wide.repartitionByRange(parts, "row_id").sortWithinPartitions("row_id").drop("row_id")
    io.write_csv(ordered, f"{root}/backup/creditcard.csv")
    card = io.read_card_csv(spark, [f"{root}/data/creditcard.csv", f"{root}/backup/creditcard.csv"])
    return card.select("Time", "Amount", "Class", "V1", "V4", "row_id")


@register("dataset_dispatch", CURATED_WITH.rstrip() + f""",
card AS ({fx.CARD_RAW_SQL})
SELECT 'primary' AS name, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS n_fraud FROM curated
UNION ALL SELECT 'ulb', count(*), CAST(sum("Class") AS BIGINT) FROM card""")
def q_dataset_dispatch(spark, sf_dir):
    """Both data sets by name."""
    out = None
    for name in ("primary", "ulb"):
        one = io.load_dataset(spark, name, sf_dir).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_fraud").cast("long")).alias("n_fraud"))
        one = one.select(F.lit(name).alias("name"), "n", "n_fraud")
        out = one if out is None else out.unionByName(one)
    return out


# ---------------------------------------------------------------- scoring steps


@register("form_typing", CURATED_WITH + """SELECT TransactionID, nullif(trim(IP_Address), '') AS IP_Address, nullif(trim(MerchantID), '') AS MerchantID,
       CASE WHEN CAST(TransactionID AS BIGINT) % 7 = 0 THEN NULL ELSE TransactionAmount END AS TransactionAmount FROM curated""")
def q_form_typing(spark, sf_dir):
    """Blank form fields are missing, the others are typed."""
    tid = F.col("TransactionID").cast("long")
    form = cat.curated(spark, sf_dir).select(
        "TransactionID", F.when(F.col("IP_Address").isNull(), "  ").otherwise(F.concat(F.lit(" "), "IP_Address")).alias("IP_Address"),
        F.coalesce("MerchantID", F.lit("")).alias("MerchantID"),
        F.when(tid % 7 == 0, "   ").otherwise(F.col("TransactionAmount").cast("string")).alias("TransactionAmount"))
    return sc.type_requests(form, empty_is_null=True)


COERCED = (["TransactionAmount", "TransactionDate", "CustomerAge", "amount_limit"], ["Channel", "device_class"])


@register("coerced_requests", CURATED_WITH + """SELECT TransactionID, TransactionAmount,
       epoch_us(TransactionDate) / 1000000.0::DOUBLE AS TransactionDate, CAST(CustomerAge AS DOUBLE) AS CustomerAge,
       CAST(NULL AS DOUBLE) AS amount_limit, trim(Channel) AS Channel, CAST(NULL AS VARCHAR) AS device_class FROM curated""")
def q_coerced_requests(spark, sf_dir):
    """P23 + P24: typed requests in the fitted input columns: dates as epoch seconds, absent columns as NULL."""
    req = io.parse_requests(cat.request_json(cat.curated(spark, sf_dir).select(*cat.REQUEST_COLS)))
    # whole values again where the request fixture spoils them
    whole = cat.curated(spark, sf_dir).select("TransactionID", F.col("TransactionAmount").alias("_a"), F.col("TransactionDate").alias("_d"))
    typed = sc.type_requests(req).join(whole, "TransactionID")
    typed = typed.withColumn("TransactionAmount", F.coalesce("TransactionAmount", "_a")).withColumn(
        "TransactionDate", F.coalesce("TransactionDate", "_d"))
    return sc.coerce_inputs(typed, *COERCED)


@register("sanitized_vectors", RAW_WITH + """SELECT TransactionID,
       CASE WHEN id % 5 = 0 THEN 0.0 ELSE TransactionAmount END AS v0,
       CASE WHEN id % 7 = 0 THEN 1.7976931348623157e308 / 2 WHEN id % 11 = 0 THEN -1.7976931348623157e308 / 2 ELSE TransactionAmount END AS v1
FROM (SELECT *, CAST(TransactionID AS BIGINT) AS id FROM raw)""")
def q_sanitized_vectors(spark, sf_dir):
    """P25: NaN and infinities in feature vectors become finite."""
    tid, x = F.col("TransactionID").cast("long"), F.col("TransactionAmount")
    inf = F.lit(float("inf"))
    bad = F.array(F.when(tid % 5 == 0, F.lit(float("nan"))).otherwise(x),
                  F.when(tid % 7 == 0, inf).when(tid % 11 == 0, -inf).otherwise(x))
    v = vector_to_array(sc.sanitize(array_to_vector(bad)))
    return cat.raw(spark, sf_dir).select("TransactionID", v[0].alias("v0"), v[1].alias("v1"))


@register("kpi", METRICS_WITH + """SELECT name, printf('%.3f', round(f1, 3)) AS f1, '-' AS missing FROM records""")
def q_kpi(spark, sf_dir):
    """Metrics with three decimals, '-' for a missing one."""
    rec = cat.records(spark, sf_dir)
    return rec.select("name", C.kpi(F.round("f1", 3)).alias("f1"), C.kpi(F.lit(None).cast("double")).alias("missing"))


# ---------------------------------------------------------------- columns and transformers


def _long_counts(df, group, cols):
    """(group value, column, non-null values) of some columns."""
    counts = df.agg(*[F.count(c).alias(c) for c in cols])
    return counts.select(F.lit(group).alias("variant"), F.explode(F.create_map(
        *[x for c in cols for x in (F.lit(c), F.col(c))])).alias("column_name", "n"))


def _union_counts(variants, src):
    return " UNION ALL ".join(f"SELECT '{v}' AS variant, '{c}' AS column_name, count({c}) AS n FROM {src}"
                              for v, cols in variants.items() for c in cols)


MODEL_COLS = ["AccountBalance", "AccountID", "Channel", "CustomerAge", "CustomerOccupation", "DeviceID", "IP_Address", "Location",
              "LoginAttempts", "MerchantID", "TransactionAmount", "TransactionDuration", "TransactionType", "amt_to_bal",
              "is_weekend", "label_source", "logins_log1p", "minutes_since_prev", "secs_since_prev", "txn_hour"]


@register("ablation_frame", cat.FEATURES_WITH + _union_counts(
    {"baseline": MODEL_COLS, "ablated": [c for c in MODEL_COLS if c not in ID_LIKE_COLUMNS]}, "features"))
def q_ablation_frame(spark, sf_dir):
    """P20: the model's input columns with and without those that are like ids, and their values."""
    f = cat.features(spark, sf_dir)
    out = None
    for variant, drop in (("baseline", []), ("ablated", ID_LIKE_COLUMNS)):
        num, text = feat.model_frame_columns(f, extra_drop=drop)
        one = _long_counts(f, variant, num + text)
        out = one if out is None else out.unionByName(one)
    return out


@register("common_numerics", with_ctes(cat.CARD_CTE) + _union_counts({"ulb": ["TransactionAmount"]}, "card"))
def q_common_numerics(spark, sf_dir):
    """Numeric columns that both data sets have, and their values in the second."""
    card = cat.card(spark, sf_dir)
    return _long_counts(card, "ulb", [c for c in feat.common_numeric_columns(cat.curated(spark, sf_dir), card) if c != "is_fraud"])


@register("feature_names", SPLIT_WITH.rstrip() + ",\n" + "parts AS (" + " UNION ALL ".join(
    f"SELECT 'cat__{c}_' || {cat._cat_sql(c)} AS name, split, 1.0::DOUBLE AS x FROM splits" for c in cat.ONEHOT_COLS) + """),
known AS (SELECT DISTINCT name FROM parts WHERE split = 'train'),
totals AS (SELECT name, round(sum(x), 6) AS total FROM parts SEMI JOIN known USING (name) GROUP BY name),
scaled AS (SELECT (CAST(TransactionAmount AS DOUBLE) - (SELECT avg(TransactionAmount) FROM splits WHERE split = 'train'))
                  / (SELECT stddev_pop(TransactionAmount) FROM splits WHERE split = 'train') AS x FROM splits)
SELECT * FROM totals UNION ALL SELECT 'num__TransactionAmount', round(sum(x), 6) FROM scaled""")
def q_feature_names(spark, sf_dir):
    """The names of the assembled vector's entries, in order of position, and the sum of each entry."""
    df = cat.split_features(spark, sf_dir)
    model = tf.tabular_pipeline(["TransactionAmount"], cat.ONEHOT_COLS).fit(df.filter(F.col("split") == "train"))
    names = tf.feature_names(model, spark).withColumnRenamed("position", "i")
    entries = model.transform(df).select(F.posexplode(vector_to_array("features")).alias("i", "x"))
    sums = entries.groupBy("i").agg(F.round(F.sum("x"), 6).alias("total"))
    return sums.join(names, "i").select("name", (F.col("total") + F.lit(0.0)).alias("total"))


@register("pipeline_reload", cat.ORACLE_SQL["standardize"])
def q_pipeline_reload(spark, sf_dir):
    """The fitted scaler saved, loaded and applied."""
    from pyspark.ml import Pipeline
    df = cat.split_features(spark, sf_dir)
    names = [f"num__{c}" for c in cat.SCALE_COLS]
    model = Pipeline(stages=[tf.PopulationScaler(inputCols=cat.SCALE_COLS, outputCols=names)]).fit(df.filter(F.col("split") == "train"))
    path = scratch_path(spark, "pipeline_reload")
    tf.save_pipeline(model, path)
    out = tf.load_pipeline(path).transform(df)
    return out.select("TransactionID", *[r6(n).alias(n) for n in names])


TFIDF_CTES = cat.ORACLE_SQL["tfidf_idf"].split("\nSELECT CAST(idx AS INTEGER)")[0]


@register("tfidf_vectors", TFIDF_CTES + """,
every AS (
  SELECT TransactionID, regexp_extract_all(lower(coalesce(nlp_text, '')), '\\b\\w\\w+\\b') AS t FROM splits),
all_grams AS (
  SELECT TransactionID, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term
  FROM every),
weights AS (
  SELECT TransactionID, idx, count(*) * (ln((1 + n) / (1 + df)) + 1) AS w FROM all_grams JOIN top USING (term), nd
  GROUP BY TransactionID, idx, n, df)
SELECT TransactionID, CAST(idx AS INTEGER) AS idx, round(w / sqrt(sum(w * w) OVER (PARTITION BY TransactionID)), 6) AS weight FROM weights""")
def q_tfidf_vectors(spark, sf_dir):
    """T5: the non-zero entries of every row's normalised TF-IDF vector."""
    df = cat.split_features(spark, sf_dir)
    model, _ = tf.fit_tfidf(df.filter(F.col("split") == "train"), "nlp_text")
    v = F.unwrap_udt("tfidf")
    entries = model.transform(df).select("TransactionID", F.explode(F.arrays_zip(
        v["indices"].alias("idx"), v["values"].alias("weight"))).alias("e"))
    return entries.select("TransactionID", "e.idx", r6("e.weight").alias("weight"))


# ---------------------------------------------------------------- recalibration and model flows


@register("isotonic_scores", METRICS_WITH.rstrip() + """,
points AS (SELECT model, score, sum(label) AS s, count(*) AS n FROM pred GROUP BY model, score),
running AS (SELECT model, score, sum(s) OVER w AS cs, sum(n) OVER w AS cn, s, n FROM points
            WINDOW w AS (PARTITION BY model ORDER BY score)),
spans AS (SELECT a.model, a.score AS lo, b.score AS hi, (b.cs - a.cs + a.s) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS mean
          FROM running a JOIN running b ON a.model = b.model AND a.score <= b.score),
least AS (SELECT p.model, p.score, lo, min(mean) AS m FROM points p JOIN spans x ON x.model = p.model AND lo <= p.score AND hi >= p.score
          GROUP BY p.model, p.score, lo)
SELECT model, score, round(max(m), 6) AS p_iso FROM least GROUP BY model, score""")
def q_isotonic_scores(spark, sf_dir):
    """Isotonic recalibration of every distinct score (the max-min formula states the same)."""
    pred = cat.predictions(spark, sf_dir)
    out = None
    for model in sorted(r[0] for r in pred.select("model").distinct().collect()):
        own = pred.filter(F.col("model") == model)
        one = cal.isotonic(own, own.select("model", "score").distinct()).select("model", "score", r6("p_iso").alias("p_iso"))
        out = one if out is None else out.unionByName(one)
    return out


@register("platt_scores", "WITH RECURSIVE" + METRICS_WITH.rstrip()[len("WITH"):] + """,
points AS (SELECT model, score AS x, CAST(sum(label) AS DOUBLE) AS s, CAST(count(*) AS DOUBLE) AS n FROM pred GROUP BY model, score),
newton AS (
  SELECT model, 0 AS step, 0.0::DOUBLE AS a, 0.0::DOUBLE AS b FROM points GROUP BY model
  UNION ALL
  SELECT model, step + 1, a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab), b - (haa * gb - hab * ga) / (haa * hbb - hab * hab)
  FROM (SELECT model, step, a, b, sum(d * x) + a AS ga, sum(d) AS gb, sum(h * x * x) + 1 AS haa, sum(h * x) AS hab, sum(h) AS hbb
        FROM (SELECT w.*, p.x, p.n / (1 + exp(-(w.a * p.x + w.b))) - p.s AS d,
                     p.n * (1 / (1 + exp(-(w.a * p.x + w.b)))) * (1 - 1 / (1 + exp(-(w.a * p.x + w.b)))) AS h
              FROM newton w JOIN points p USING (model)) GROUP BY model, step, a, b)
  WHERE step < 25)
SELECT p.model, p.x AS score, round(1 / (1 + exp(-(w.a * p.x + w.b))), 6) AS p_platt
FROM points p JOIN newton w ON w.model = p.model AND w.step = 25""")
def q_platt_scores(spark, sf_dir):
    """Platt recalibration of every distinct score, at the optimum (25 Newton steps state the same)."""
    pred = cat.predictions(spark, sf_dir)
    out = None
    for model in sorted(r[0] for r in pred.select("model").distinct().collect()):
        own = pred.filter(F.col("model") == model)
        one = cal.platt(own, own.select("model", "score").distinct()).select("model", "score", r6("p_platt").alias("p_platt"))
        out = one if out is None else out.unionByName(one)
    return out


#: Boosting rounds of ``cross_domain``, below the library's 200: README has the times of the whole size.
FLOW_ROUNDS = 20


@register("ablation")
def q_ablation(spark, sf_dir):
    """M4: the flow with and without id-like columns; every metric of both evaluated splits."""
    return tr.ablation(cat.curated(spark, sf_dir)).select("variant", "split", "metric", r6("value").alias("value"))


@register("cross_domain")
def q_cross_domain(spark, sf_dir):
    """M5: trained on one data set, evaluated on its held-out fifth and on the other set, both ways; the metric records."""
    rec = tr.cross_domain(cat.curated(spark, sf_dir), cat.card(spark, sf_dir), light=True, maxIter=FLOW_ROUNDS)
    metrics = [r6(m).alias(m) for m in ("roc_auc", "pr_auc", "f1", "precision", "recall", "accuracy")]
    return rec.select("direction", "split", *metrics, "n", "support")


@register("gbt_tuning")
def q_gbt_tuning(spark, sf_dir):
    """M3: one fit for each of the 24 grid points on the balanced training rows, with early stopping; its validation metrics, and the best."""
    prep = cat.prepared(spark, sf_dir)
    trials = materialize(mdl.tune_gbt(materialize(tr.balanced(prep.train, "always"), "tuning_train"), prep.val), "trials")
    best = mt.best_trial(trials).select("trial", F.lit(True).alias("best"))
    return trials.join(best, "trial", "left").withColumn("best", F.coalesce("best", F.lit(False)))
