"""Exact quantiles without collecting a column anywhere.

``percentile``/``percentile_disc`` keep every value of a group in one
aggregation buffer, which for a global statistic is one task holding the whole
column.  Here exact quantiles of any number of columns take the same four distributed
steps at every size:

1. one aggregate: non-null counts and, for each column, a ``percentile_approx`` sketch read at
   RANGES - 1 even probabilities.  Its values are only cut points, so its error costs balance, never exactness;
2. one aggregate: how many values fall between two cut points (a JVM-side binary search; at most RANGES
   rows a column reach the driver).  The counts tell in which range each wanted rank lies;
3. the values of those ranges alone, about one in RANGES for each wanted rank, are grouped by value, so that a
   value held by a third of the rows is one row, and range-partitioned by value;
4. running counts over them (``ordered.running_sums``: partition-local windows and a table of partition totals)
   find the value at each rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import running_sums, with_key_ranges

RANGES = 1024


@dataclass(frozen=True)
class Stat:
    """The quantile of column ``col`` at probability ``p``.

    ``kind="disc"``: the smallest value whose cumulative count reaches
    ceil(p*n) (the warehouse's APPROX_QUANTILES offset; DuckDB quantile_disc).
    ``kind="cont"``: linear interpolation at position (n-1)*p (pandas
    quantile/median, DuckDB quantile_cont).
    """
    col: str
    p: float
    kind: str = "disc"


def number(c: str) -> Column:
    """A column as double, NaN counting as missing."""
    x = F.col(c).cast("double")
    return F.when(~F.isnan(x), x)


def _ranks(s: Stat, n: int) -> list[int]:
    if s.kind == "disc":
        return [max(1, min(n, math.ceil(s.p * n)))]
    h = (n - 1) * s.p
    lo = int(math.floor(h)) + 1
    return [lo, min(n, lo + 1)]


def quantiles(df: DataFrame, stats: Sequence[Stat], extra: dict | None = None, ranges: int = RANGES) -> list[float | None]:
    """Exact quantiles for ``stats``; ``None`` where a column has no values.

    ``extra`` ({name: aggregate Column over ``df``'s columns}) rides along in
    the first pass; its values are written back into the same dict.
    """
    stats = list(stats)
    cols = sorted({s.col for s in stats})
    idx = {c: i for i, c in enumerate(cols)}
    extra = extra if extra is not None else {}
    value = [number(c).alias(f"_q{i}") for i, c in enumerate(cols)]
    vals = df.select(*value)
    src = df.select("*", *value) if extra else vals
    probs = [k / ranges for k in range(1, ranges)]
    row = src.agg(*[F.count(f"_q{i}").alias(f"n{i}") for i in range(len(cols))],
                  *[F.percentile_approx(f"_q{i}", probs, 4 * ranges).alias(f"a{i}") for i in range(len(cols))],
                  *[a.alias(f"_x_{k}") for k, a in extra.items()]).first().asDict()
    for k in list(extra):
        extra[k] = row[f"_x_{k}"]
    cuts = {i: sorted({float(v) for v in row[f"a{i}"] if math.isfinite(v)}) or [0.0]
            for i in range(len(cols)) if row[f"n{i}"]}
    wanted = sorted({(idx[s.col], r) for s in stats if row[f"n{idx[s.col]}"] for r in _ranks(s, row[f"n{idx[s.col]}"])})
    return _finish(stats, idx, row, _select(vals, cuts, wanted))


def _finish(stats, idx, row, got) -> list[float | None]:
    out: list[float | None] = []
    for s in stats:
        i = idx[s.col]
        n = row[f"n{i}"]
        if n == 0:
            out.append(None)
            continue
        rs = _ranks(s, n)
        if s.kind == "disc":
            out.append(got[(i, rs[0])])
        else:
            h = (n - 1) * s.p
            lo, hi = got[(i, rs[0])], got[(i, rs[1])]
            out.append(lo + (hi - lo) * (h - math.floor(h)))
    return out


def _bucketed(vals: DataFrame, th: dict[int, list[float]]) -> DataFrame:
    """(i, b, v): per non-null value of column i, b = number of thresholds <= v
    (a JVM-side binary search: ML Bucketizer over all columns at once)."""
    from pyspark.ml.feature import Bucketizer
    cols = sorted(th)
    x = vals.select(*[F.coalesce(F.col(f"_q{i}"), F.lit(float("nan"))).alias(f"_q{i}") for i in cols])
    bz = Bucketizer(splitsArray=[[-math.inf] + th[i] + [math.inf] for i in cols],
                    inputCols=[f"_q{i}" for i in cols], outputCols=[f"_b{i}" for i in cols],
                    handleInvalid="keep")
    x = bz.transform(x)
    arr = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"_b{i}").cast("int").alias("b"),
                             F.col(f"_q{i}").alias("v")) for i in cols])
    return (x.select(F.explode(arr).alias("t")).select("t.i", "t.b", "t.v")
            .filter(~F.isnan("v")))


def _select(vals: DataFrame, cuts: dict[int, list[float]], wanted: list[tuple[int, int]]) -> dict:
    """The value at each (column, rank)."""
    if not wanted:
        return {}
    spark = vals.sparkSession
    placed = _bucketed(vals, cuts)
    counts = {(r["i"], r["b"]): r["c"] for r in placed.groupBy("i", "b").agg(F.count(F.lit(1)).alias("c")).collect()}
    before: dict[tuple[int, int], int] = {}  # values below each range
    total = dict.fromkeys(cuts, 0)
    for i, b in sorted(counts):
        before[i, b] = total[i]
        total[i] += counts[i, b]
    spec, hit = [], {}
    for j, (i, rank) in enumerate(wanted):
        b = max(b for (c, b), below in before.items() if c == i and below < rank)
        spec.append((j, i, b, rank - before[i, b]))
        hit[i, b] = counts[i, b]
    keys = spark.createDataFrame(sorted(hit), "i int, b int")  # one row for each wanted rank at most
    inside = placed.join(F.broadcast(keys), ["i", "b"]).groupBy("i", "b", "v").agg(F.count(F.lit(1)).alias("c"))
    cut = with_key_ranges(inside, ["i", "b"], ["v"], n=sum(hit.values()))
    walked = running_sums(cut, ["i", "b"], F.col("_ll_range"), ["v"], {"cum": F.col("c")}, totals=False)
    need = spark.createDataFrame(spec, "j int, i int, b int, need long")
    picked = (walked.join(F.broadcast(need), ["i", "b"])
              .filter((F.col("cum") >= F.col("need")) & (F.col("cum") - F.col("c") < F.col("need"))).select("j", "v").collect())
    return {wanted[r["j"]]: r["v"] for r in picked}


def median(df: DataFrame, col: str) -> float | None:
    """Exact interpolated median (pandas ``Series.median``)."""
    return quantiles(df, [Stat(col, 0.5, "cont")])[0]
