"""Class balancing: weights, k-nearest neighbours, SMOTE (J4, SP6, SP7, A10, A11, U2).

Nearest neighbours are exact (``neighbours.py``: a metric index over bounded blocks).

Vectors stay sparse: (size, indices of non-zeros, values), from dense arrays or
from ML vectors alike.

SMOTE draws, for synthetic row j, a base row, one of its k neighbours and a
step u in [0, 1) from md5(seed:j), so the output does not depend on
partitioning or retries; synthetic = x + u * (neighbour - x).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RANDOM_SEED
from ..session import materialize, scratch_path
from .neighbours import BLOCK, nearest_pairs
from .ordered import hash_bits, hash_bucket, row_number_within

# ------------------------------------------------------------------ A10, A11, SP7


def class_counts(df: DataFrame, label: str = "is_fraud") -> tuple[int, int]:
    """(negatives, positives) in one aggregate."""
    r = df.agg(F.count(F.when(F.col(label) == 0, 1)).alias("neg"),
               F.count(F.when(F.col(label) == 1, 1)).alias("pos")).first()
    return int(r["neg"]), int(r["pos"])


def scale_pos_weight(neg: int, pos: int) -> float | None:
    """A10: negatives for each positive, None where that is at most 3 or there are no positives."""
    return neg / pos if pos and neg > 3 * pos else None


def with_pos_weight(df: DataFrame, label: str = "is_fraud", out: str = "weight") -> tuple[DataFrame, float | None]:
    """A10 as a weight column: positives weigh scale_pos_weight, others 1."""
    spw = scale_pos_weight(*class_counts(df, label))
    w = F.when(F.col(label) == 1, F.lit(spw if spw is not None else 1.0)).otherwise(F.lit(1.0))
    return df.withColumn(out, w), spw


def with_balanced_weight(df: DataFrame, label: str = "is_fraud", out: str = "weight") -> DataFrame:
    """N / (n_classes * n_c) per row (the 'balanced' class weight)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    # one row per class: the window is bounded by the class count
    every = Window.partitionBy()
    w = counts.select(label, (F.sum("_nc").over(every) / (F.count(F.lit(1)).over(every) * F.col("_nc"))).alias(out))
    return df.join(w, label, "left")


def use_smote(policy: str, dataset: str = "primary") -> bool:
    """SP7: 'always'; or 'auto' and not the card data set.  Never decided by a row count."""
    p = (policy or "auto").lower()
    return p == "always" or (p == "auto" and dataset != "ulb")


# ------------------------------------------------------------------ J4

_PAIR = "struct<size:int,indices:array<int>,values:array<double>>"


def sparse(vec: Column, kind: T.DataType) -> Column:
    """struct(size, indices, values) of the non-zeros of an array or ML vector column; such a struct stays as it is."""
    if isinstance(kind, T.StructType):
        return vec.cast(_PAIR)
    if isinstance(kind, VectorUDT):
        u = F.unwrap_udt(vec)
        values = u["values"]
        size = F.coalesce(u["size"], F.size(values))
        indices = F.coalesce(u["indices"], F.sequence(F.lit(0), F.size(values) - 1))
    else:
        values = vec.cast("array<double>")
        size = F.size(values)
        indices = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    entries = F.filter(F.zip_with(indices, values, lambda i, x: F.struct(i.alias("i"), x.alias("x"))), lambda e: e["x"] != 0)
    return F.struct(size.alias("size"), entries["i"].alias("indices"), entries["x"].alias("values")).cast(_PAIR)


def _dense(v: Column) -> Column:
    """The array of all entries of a sparse struct."""
    at = F.map_from_arrays(v["indices"], v["values"])
    return F.transform(F.sequence(F.lit(0), v["size"] - 1), lambda i: F.coalesce(F.element_at(at, i), F.lit(0.0)))


def knn(points: DataFrame, k: int = 5, id_col: str = "id", vec_col: str = "vec",
        block: int = BLOCK) -> DataFrame:
    """The k nearest other points of every point (Euclidean), exactly.

    Returns (id, nn_id, nn_rank 1..k, dist); ties broken by neighbour id.

    Identical vectors are collapsed first (by 128 bits of hash), so a vector
    shared by a third of the points costs one row.  Neighbours are found among distinct
    vectors (``neighbours.nearest_pairs``), each keyed by its smallest id.  A point's answer is
    the top k of its own vector's other ids (distance 0) and the k smallest ids
    of each of its vector's k nearest other vectors; a point outside those has k
    points ranked before it by (distance, id).
    """
    v = sparse(F.col(vec_col), points.schema[vec_col].dataType)
    pts = points.select(F.col(id_col).alias("id"), v.alias("v"))
    h1 = F.xxhash64("v.size", "v.indices", "v.values")
    pts = materialize(pts.withColumns({"h1": h1, "h2": F.xxhash64(F.lit("second"), "v.values", "v.indices")}), "knn_points")
    same = Window.partitionBy("h1", "h2").orderBy("id")
    firsts = materialize(pts.select("id", "h1", "h2").withColumn("_dr", F.row_number().over(same)).filter(F.col("_dr") <= k + 1),
                         "knn_firsts")
    rep_of = firsts.filter("_dr = 1").select("h1", "h2", F.col("id").alias("rep"))
    reps = materialize(pts.join(rep_of, ["h1", "h2"]).filter("id = rep").select("id", "v"), "knn_vectors")
    near = nearest_pairs(reps, k, block).select(F.col("id").alias("rep"), F.col("nn_id").alias("nn_rep"), "dist")
    # kept ids with their vector's representative (at most k + 1 rows a vector)
    fr = firsts.join(rep_of, ["h1", "h2"]).select("id", "rep", "_dr")
    own = fr.select("rep", F.col("id").alias("nn_id"), F.lit(0.0).alias("dist"))
    ext = near.join(fr.filter(F.col("_dr") <= k).select(F.col("rep").alias("nn_rep"), F.col("id").alias("nn_id")),
                    "nn_rep").select("rep", "nn_id", "dist")
    # per distinct vector: the k + 1 best candidates (one of them may be the point itself)
    best = Window.partitionBy("rep").orderBy("dist", "nn_id")
    cand = own.unionByName(ext).withColumn("_c", F.row_number().over(best)).filter(F.col("_c") <= k + 1).drop("_c")
    # every point joins its vector's candidates (a hot vector is a skewed key
    # against a tiny side, which AQE's skew join splits)
    mine = Window.partitionBy("id").orderBy("dist", "nn_id")
    return (pts.select("id", "h1", "h2").join(rep_of, ["h1", "h2"]).select("id", "rep").join(cand, "rep")
            .filter(F.col("nn_id") != F.col("id"))
            .withColumn("nn_rank", F.row_number().over(mine)).filter(F.col("nn_rank") <= k)
            .select("id", "nn_id", "nn_rank", "dist"))


# ------------------------------------------------------------------ SP6, U2

def _u32(h: Column, start: int) -> Column:
    """8 hex digits of an md5 string as an unsigned 32-bit number."""
    return F.conv(F.substring(h, start, 8), 16, 10).cast("long")


def _between(x: Column, y: Column, u: Column) -> Column:
    """x + u * (y - x) of sparse structs; without entries (null) where x or y is null."""
    def one(v: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
        ptr, to = (v.field(c).offsets.to_numpy().astype(np.int64) for c in ("indices", "values"))
        idx, val = v.field("indices").values.to_numpy()[ptr[0]:ptr[-1]], v.field("values").values.to_numpy()[to[0]:to[-1]]
        return (np.repeat(np.arange(n), np.diff(ptr)) << 32) + idx, val

    def between(xs: pa.Array, ys: pa.Array, us: pa.Array) -> pa.Array:
        n = len(us)
        if not n:
            return xs
        (kx, vx), (ky, vy) = one(xs, n), one(ys, n)
        key, at = np.unique(np.r_[kx, ky], return_inverse=True)  # (row, index) in order
        a, b = np.zeros(len(key)), np.zeros(len(key))
        a[at[:len(kx)]], b[at[len(kx):]] = vx, vy
        null = np.zeros(n, dtype=bool)
        for v in (xs, ys):
            null |= v.is_null().to_numpy(zero_copy_only=False) | v.field("indices").is_null().to_numpy(zero_copy_only=False)
        keep = ~null[key >> 32]
        key, a, b = key[keep], a[keep], b[keep]
        row = key >> 32
        value = a + us.to_numpy(zero_copy_only=False)[row] * (b - a)
        ptr = pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32())
        cells = [pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(value)]
        return pa.StructArray.from_arrays([xs.field("size"), *(pa.ListArray.from_arrays(ptr, c, mask=pa.array(null)) for c in cells)], ["size", "indices", "values"])
    return F.arrow_udf(between, _PAIR)(x, y, u)


def synthetic(minority: DataFrame, need: int, k: int = 5, seed: int = RANDOM_SEED) -> DataFrame:
    """SP6: ``need`` synthetic rows from minority rows (id, v): id, base_id, nn_id, u, v.

    Row j takes the base row numbered 1 + md5(seed:j)[0:8] mod m in order of
    md5(id:seed), its neighbour of rank 1 + md5(seed:j)[8:16] mod k, and u from the
    next 8 digits.  Ids are resolved first, vectors are fetched last.
    """
    m = minority.count()
    if m <= k:
        raise ValueError(f"SMOTE with k = {k} needs at least {k + 1} minority rows, got {m}")
    nn = knn(minority, k, "id", "v")
    numbered = minority.select("id").withColumn("_h", F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}"))))
    numbered = row_number_within(numbered.withColumn("_g", F.lit(0)), ["_g"], hash_bucket("_h", hash_bits(m)), ["_h", "id"],
                                 name="pos", count_name=None).select("pos", F.col("id").alias("base_id"))
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col("j").cast("string")))
    draws = minority.sparkSession.range(need).withColumnRenamed("id", "j").select(
        "j", (F.pmod(_u32(h, 1), F.lit(m)) + 1).alias("pos"), (F.pmod(_u32(h, 9), F.lit(k)) + 1).alias("nn_rank"),
        (_u32(h, 17) / F.lit(4294967296.0)).alias("u"))
    ids = (draws.join(numbered, "pos").join(nn.select(F.col("id").alias("base_id"), "nn_rank", "nn_id"), ["base_id", "nn_rank"])
           .select("j", "base_id", "nn_id", "u"))
    return (ids.join(minority.select(F.col("id").alias("base_id"), F.col("v").alias("x")), "base_id")
            .join(minority.select(F.col("id").alias("nn_id"), F.col("v").alias("y")), "nn_id")
            .select(F.concat(F.lit("syn_"), F.col("j").cast("string")).alias("id"), "base_id", "nn_id", "u",
                    _between(F.col("x"), F.col("y"), F.col("u")).alias("v")))


def smote(df: DataFrame, label: str = "label", vec_col: str = "vec", id_col: str = "id", k: int = 5,
          seed: int = RANDOM_SEED) -> DataFrame:
    """SP6 + U2: raise the minority class to the majority count with
    synthetic rows, returned together with the originals.  Fewer than k + 1
    minority rows raise an error.

    Output columns: id (synthetic ids 'syn_<j>'), label, vec (arrays for arrays,
    sparse ML vectors for ML vectors), synthetic (bool).
    """
    kind = df.schema[vec_col].dataType
    # The vectors are read by many passes below: write them once.
    base = materialize(df.select(F.col(id_col).cast("string").alias("id"), F.col(label).alias("label"),
                                 sparse(F.col(vec_col), kind).alias("v")), "smote_input")
    counts = base.groupBy("label").agg(F.count(F.lit(1)).alias("c")).orderBy("c", "label").collect()
    rows = base.withColumn("synthetic", F.lit(False))
    need = int(counts[-1]["c"]) - int(counts[0]["c"]) if len(counts) > 1 else 0
    if need > 0:
        minority = counts[0]["label"]
        made = synthetic(base.filter(F.col("label") == minority).select("id", "v"), need, k, seed)
        rows = rows.unionByName(made.select("id", F.lit(minority).alias("label"), "v", F.lit(True).alias("synthetic")))
    if isinstance(kind, VectorUDT):
        return _as_vectors(rows)
    return rows.select("id", "label", _dense(F.col("v")).alias("vec"), "synthetic")


def _as_vectors(rows: DataFrame) -> DataFrame:
    """Sparse structs written as the storage form of ML vectors and read back as such."""
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "smote_vectors")
    stored = F.struct(F.lit(0).cast("byte").alias("type"), F.col("v.size").alias("size"), F.col("v.indices").alias("indices"),
                      F.col("v.values").alias("values"))
    out = rows.select("id", "label", stored.alias("vec"), "synthetic")
    out.write.parquet(path)
    schema = T.StructType([T.StructField(f.name, VectorUDT() if f.name == "vec" else f.dataType) for f in out.schema.fields])
    return spark.read.schema(schema).parquet(path)
