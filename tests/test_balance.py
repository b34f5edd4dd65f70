"""kNN against brute force and its bound on pairs; SMOTE properties."""

import random

import numpy as np
from pyspark.sql import functions as F

from ledgerlens.operators import balance as bal
from ledgerlens.operators import neighbours as nb
from ledgerlens.operators.balance import knn, scale_pos_weight, smote, use_smote
from ledgerlens.operators.neighbours import Block, nearest
from ledgerlens.session import materialize


def _points(n=120, d=6, seed=5):
    rnd = random.Random(seed)
    pts = [(i, [round(rnd.gauss(0, 1), 2) for _ in range(d)]) for i in range(n)]
    pts.append((n, list(pts[0][1])))  # an exact duplicate
    return pts


def test_knn_exact(spark):
    pts = _points()
    df = spark.createDataFrame(pts, "id long, vec array<double>").repartition(4)
    got = {}
    for r in knn(df, 5).collect():
        got.setdefault(r["id"], []).append((r["nn_rank"], r["nn_id"]))
    X = np.array([v for _, v in pts])
    for i, _ in pts:
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        order = sorted((d[j], j) for j in range(len(pts)) if j != i)[:5]
        assert [j for _, j in sorted(got[i])] == [j for _, j in order], i


def test_knn_tiny_class(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0]), (3, [3.0])], "id long, vec array<double>")
    got = sorted((r["id"], r["nn_rank"], r["nn_id"]) for r in knn(df, 5).collect())
    assert got == [(1, 1, 2), (1, 2, 3), (2, 1, 1), (2, 2, 3), (3, 1, 2), (3, 2, 1)]


def test_smote_properties(spark):
    rnd = random.Random(2)
    rows = [(str(i), int(i < 30), [rnd.random(), rnd.random()]) for i in range(200)]
    df = spark.createDataFrame(rows, "id string, label int, vec array<double>")
    out = smote(df, k=5)
    counts = {r["label"]: r["c"] for r in out.groupBy("label").agg(F.count("*").alias("c")).collect()}
    assert counts == {0: 170, 1: 170}
    mino = np.array([v for _, y, v in rows if y == 1])
    lo, hi = mino.min(axis=0), mino.max(axis=0)
    for r in out.filter("synthetic").collect():
        assert np.all(np.array(r["vec"]) >= lo - 1e-12) and np.all(np.array(r["vec"]) <= hi + 1e-12)
    again = {r["id"]: r["vec"] for r in smote(df.repartition(3), k=5).filter("synthetic").collect()}
    assert again == {r["id"]: r["vec"] for r in out.filter("synthetic").collect()}


def test_weights_and_policy():
    assert scale_pos_weight(90, 10) == 9.0 and scale_pos_weight(30, 10) is None
    assert use_smote("auto", "primary") and not use_smote("auto", "ulb") and use_smote("always", "ulb")


def test_knn_exact_sparse_vectors(spark):
    rnd = random.Random(9)
    pts = []
    for i in range(90):
        v = [0.0] * 40
        for j in rnd.sample(range(40), 3):
            v[j] = float(rnd.randint(1, 4))
        pts.append((i, v))
    df = spark.createDataFrame(pts, "id long, vec array<double>")
    got = {}
    for r in knn(df, 4).collect():
        got.setdefault(r["id"], []).append((r["nn_rank"], r["nn_id"], r["dist"]))
    X = np.array([v for _, v in pts])
    for i, _ in pts:
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        order = sorted((round(d[j], 9), j) for j in range(len(pts)) if j != i)[:4]
        mine = sorted(got[i])
        assert [(round(dd, 9), j) for _, j, dd in mine] == order, i


def test_knn_exact_dense_cluster_and_ties(spark):
    # A third of the points share one first coordinate and sit in a tiny
    # cluster; the rest are spread out.  Rank buckets keep the cluster out of
    # a single join key, and the result must still equal brute force.
    rnd = random.Random(11)
    pts = [(i, [0.5, round(rnd.uniform(0, 1e-3), 6), round(rnd.uniform(0, 1e-3), 6)]) for i in range(40)]
    pts += [(40 + i, [round(rnd.uniform(-50, 50), 2), round(rnd.uniform(-50, 50), 2), round(rnd.uniform(-50, 50), 2)])
            for i in range(80)]
    df = spark.createDataFrame(pts, "id long, vec array<double>").repartition(5)
    got = {}
    for r in knn(df, 3).collect():
        got.setdefault(r["id"], []).append((r["nn_rank"], r["nn_id"]))
    X = np.array([v for _, v in pts])
    for i, _ in pts:
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        order = sorted((d[j], j) for j in range(len(pts)) if j != i)[:3]
        assert [j for _, j in sorted(got[i])] == [j for _, j in order], i


def test_knn_exact_large_duplicate_group(spark):
    # A third of the points are one identical vector: they are collapsed to one
    # row, and every point still gets the brute-force answer (ties by id).
    rnd = random.Random(4)
    pts = [(i, [1.0, 2.0, 3.0]) for i in range(0, 90, 3)]
    pts += [(i, [round(rnd.gauss(0, 2), 1) for _ in range(3)]) for i in range(90) if i % 3]
    pts += [(200 + i, [1.0, 2.5, 3.0]) for i in range(2)]  # a small group at a tied distance
    df = spark.createDataFrame(pts, "id long, vec array<double>").repartition(4)
    got = {}
    for r in knn(df, 4).collect():
        got.setdefault(r["id"], []).append((r["nn_rank"], r["nn_id"]))
    X = np.array([v for _, v in pts])
    ids = [i for i, _ in pts]
    for a, (i, _) in enumerate(pts):
        d = np.sqrt(((X - X[a]) ** 2).sum(axis=1))
        order = sorted((d[b], ids[b]) for b in range(len(pts)) if b != a)[:4]
        assert [j for _, j in sorted(got[i])] == [j for _, j in order], i


def test_knn_single_distinct_vector(spark):
    df = spark.createDataFrame([(i, [0.5, 0.5]) for i in range(5)], "id long, vec array<double>")
    got = sorted((r["id"], r["nn_rank"], r["nn_id"]) for r in knn(df, 2).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 0), (2, 2, 1),
                   (3, 1, 0), (3, 2, 1), (4, 1, 0), (4, 2, 1)]


def test_knn_duplicate_path_plan(spark):
    # The duplicate-collapsing path has no all-pairs operator.
    pts = [(i, [1.0, 2.0]) for i in range(0, 60, 3)] + [(i, [float(i % 7), float(i % 5)]) for i in range(60) if i % 3]
    out = knn(spark.createDataFrame(pts, "id long, vec array<double>"), 3)
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    for bad in ("NestedLoop", "Cartesian", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, bad
    assert "WindowGroupLimit" in plan


def _brute(points, k):
    x = np.array([v for _, v in points])
    out = {}
    for a, (i, _) in enumerate(points):
        d = np.sqrt(np.cumsum((x - x[a]) ** 2, axis=1)[:, -1])
        out[i] = sorted((d[b], points[b][0]) for b in range(len(points)) if b != a)[:k]
    return out


def _rows(got):
    out = {}
    for r in sorted(got, key=lambda r: r["nn_rank"]):
        out.setdefault(r["id"], []).append((r["dist"], r["nn_id"]))
    return out


def test_knn_is_exact_over_many_blocks(spark):
    """Clustered points, a third in one tiny cluster, and one-hot rows with many ties, in blocks of 64."""
    rnd = random.Random(3)
    centres = [[rnd.gauss(0, 5) for _ in range(16)] for _ in range(30)]
    dense = [(i, [c + rnd.gauss(0, 0.5) for c in centres[0 if i % 3 == 0 else rnd.randrange(30)]]) for i in range(900)]
    hot = []
    for i in range(900):
        v = [0.0] * 60
        for j in (rnd.randrange(20), 20 + rnd.randrange(20), 40 + rnd.randrange(20)):
            v[j] = 1.0
        hot.append((f"id{i}", v))
    for points, kind in ((dense, "long"), (hot, "string")):
        df = spark.createDataFrame(points, f"id {kind}, vec array<double>").repartition(5)
        assert _rows(knn(df, 5, block=64).collect()) == _brute(points, 5)


def test_nearest_of_blocks():
    """Sparse blocks of any scale, with ties and a radius, against brute force; wide columns too."""
    rng = np.random.default_rng(0)

    def block(a):
        r, c = np.nonzero(a)
        ptr = np.concatenate([[0], np.cumsum(np.bincount(r, minlength=len(a)))])
        return Block(ptr.astype(np.int64), c.astype(np.int32), a[r, c])
    for t in range(60):
        d = int(rng.integers(1, 30))
        a = rng.integers(-2, 3, (rng.integers(1, 50), d)) * rng.choice([1, 0.37])
        b = rng.integers(-2, 3, (rng.integers(1, 60), d)) * rng.choice([1, 0.37, 1e6])
        if t % 5 == 0:  # far more columns than entries
            a, b = (np.hstack([x, np.zeros((len(x), 300))])[:, rng.permutation(d + 300)] for x in (a, b))
        k, radius = int(rng.integers(1, 6)), rng.choice([np.inf, 3.0], len(a))
        got = {}
        for i, j, dist in zip(*nearest(block(a), block(b), k, radius)):
            got.setdefault(int(i), []).append((dist, int(j)))
        for i in range(len(a)):
            every = [(float(np.sqrt(np.cumsum((a[i] - y) ** 2)[-1])), j) for j, y in enumerate(b)]
            assert got.get(i, []) == sorted(x for x in every if x[0] <= radius[i])[:k]


def test_smote_keeps_sparse_vectors(spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import SparseVector, Vectors
    rnd = random.Random(5)
    rows = []
    for i in range(60):
        at = sorted(rnd.sample(range(1000), 3))
        rows.append((str(i), int(i < 12), Vectors.sparse(1000, at, [1.0, 2.0, rnd.random()])))
    df = spark.createDataFrame(rows, ["id", "label", "vec"])
    out = smote(df, k=5)
    got = out.collect()
    assert len(got) == 96 and all(isinstance(r["vec"], SparseVector) and r["vec"].size == 1000 for r in got)
    assert all(len(r["vec"].indices) <= 6 for r in got)
    dense = {r["id"]: r["vec"] for r in smote(df.withColumn("vec", vector_to_array("vec")), k=5).collect()}
    assert all(list(r["vec"].toArray()) == dense[r["id"]] for r in got)


def test_between_sparse_rows_in_batches(spark):
    rnd = random.Random(4)

    def vector(i):
        at = sorted(rnd.sample(range(50), i % 7))
        return (50, at, [rnd.choice([0.0, -1.5, rnd.random()]) for _ in at])
    rows = [(i, vector(i), vector(i // 7), rnd.random()) for i in range(300)] + [(300, (50, [], []), (50, [], []), 0.5)]
    rows += [(301, None, (50, [1], [2.0]), 0.5), (302, (50, [1], [2.0]), None, 0.5)]
    df = spark.createDataFrame(rows, f"i int, x {bal._PAIR}, y {bal._PAIR}, u double").repartition(3)
    out = df.select("i", bal._between(F.col("x"), F.col("y"), F.col("u")).alias("v"))
    # interpreted maps took most of SMOTE's time
    assert "map_from_arrays" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["i"]: (r["v"]["size"], r["v"]["indices"], r["v"]["values"]) for r in out.collect()}
    assert len(got) == len(rows)  # a null vector gives no entries
    assert got.pop(301)[1:] == got.pop(302)[1:] == (None, None)
    for i, x, y, u in rows[:-2]:
        a, b = dict(zip(*x[1:])), dict(zip(*y[1:]))
        at = sorted({*a, *b})
        assert got[i] == (50, at, [a.get(k, 0.0) + u * (b.get(k, 0.0) - a.get(k, 0.0)) for k in at])
    assert out.filter("i < 0").collect() == []


def test_points_are_sent_once_a_group(spark, monkeypatch):
    """Points near everything: each goes to each group of blocks at most once, however many blocks it is compared with."""
    rnd = np.random.default_rng(4)
    pts = [(i, [float(x) for x in rnd.normal(size=12)]) for i in range(600)]
    df = spark.createDataFrame(pts, "id long, vec array<double>")
    df = df.select("id", bal.sparse(F.col("vec"), df.schema["vec"].dataType).alias("v"))
    monkeypatch.setattr(nb, "GROUP", 4)
    kept, plain = {}, nb.materialize

    def materialize(x, name="table", **k):
        kept[name] = plain(x, name, **k)
        return kept[name]
    monkeypatch.setattr(nb, "materialize", materialize)
    got = {}
    for r in nb.nearest_pairs(df, 5, block=20).collect():
        got.setdefault(r["id"], []).append((r["dist"], r["nn_id"]))
    n = kept["knn_blocks"].count()
    sent = kept["knn_own"].where("target is not null").agg(F.sum(F.size("id"))).first()[0]
    assert n >= 30 and sent <= 600 * -(-n // min(4, n // 8))
    X = np.array([v for _, v in pts])
    for i in range(len(pts)):
        d = np.sqrt(((X - X[i]) ** 2).sum(axis=1))
        assert [j for _, j in sorted(got[i])] == sorted((j for j in range(len(pts)) if j != i), key=lambda j: (d[j], j))[:5]


def test_wide_rows_make_small_row_groups(spark):
    import glob

    import pyarrow.parquet as pq

    rows = spark.range(60).coalesce(1).select(F.expr("transform(sequence(1, 100000), i -> xxhash64(i, id))").alias("x"))  # 0.8 MB
    path = materialize(rows, "wide", wide=True).inputFiles()[0].removeprefix("file:")
    groups = [pq.ParquetFile(f).metadata for f in glob.glob(path)]
    assert sum(m.num_rows for m in groups) == 60
    assert all(m.row_group(i).total_byte_size < 40 << 20 for m in groups for i in range(m.num_row_groups))  # not 48 MB in one
