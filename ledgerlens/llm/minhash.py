"""Near-duplicate detection with b-bit MinHash.

Each text gets HASHES minima of its shingle set.  Bands of ROWS full minima
generate candidates; BITS low bits of every minimum are kept, packed into
bit planes, and the similarity of a candidate pair is estimated from bit counts,
corrected for the 2**-BITS chance that different minima share their low bits.
Surviving pairs are confirmed on the full sets, and the confirmed links are
closed into components.

How groups of copies stay cheap and no link is lost:

* Texts with equal shingle sets are one class (a map-side combined minimum over a
  128-bit set fingerprint); only class representatives go further.
* In each band bucket every member is paired with one centre, chosen by a hash of
  (id, bucket).  A bucket of m members gives m - 1 pairs, not m*m/2, and the bands give up
  to BANDS different centres for a group of near copies.  The bit estimate drops
  implausible pairs.
* A bucket whose members these pairs leave in several components is split by overlapping size
  class.  Each class gets a centre of its own; then the members outside its largest component are
  compared, on sizes and estimates, with all members of the class, in bounded blocks.  So every
  pair that shares a bucket has been tested or lies in one component already, whatever the centres were.
* Representatives that plausible pairs connect form a cluster.  A cluster that fits in one block
  (BLOCK_ROWS texts, BLOCK_BYTES of text) is compared whole, on the full sets, in one task.
* In a larger cluster about HUBS members, chosen by hash, are compared with all; members that link
  to a hub take its label.  The members outside the largest label are then compared with all
  members, block by block; each block pair is a task of its own and only links between labels
  leave it.  So every pair of a cluster has been compared or lies in one component already: no link
  is lost, a group of m close copies takes about m comparisons with hubs, and no list of the
  pairs within a group is ever made.

A pair at similarity 0.8 shares no band with probability 1.4e-7, one at 0.85 with 2.4e-10;
the estimate of a pair at the bound falls five standard deviations, below the floor, with
probability 3e-7.  No other step loses a link.  Members of a bucket that stay apart cost the
square of their number in bit counts, which a passage common to many unlike texts can make large.

Defined results: a null text counts as empty; texts without words have no
shingles, link with nothing and are kept; a text with fewer than ``shingle`` words
has its whole word sequence as its one shingle; rows that repeat a doc_id are
judged by their own text and are one node when linking; a row with a null doc_id
links with nothing and is kept; empty tables give empty results; extra columns
are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .components import components
from .textops import LOWER, MULT, arrow_map, as_bytes, chain, column_bytes, mix, word_hashes

BANDS, ROWS, BITS = 30, 4, 2
HASHES = BANDS * ROWS
_DEVIATIONS = 5.0  # an estimate that far below the bound is taken as no link
_U = np.uint64
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=_U)) | _U(1)
_CHUNK = 512
BLOCK_ROWS, BLOCK_BYTES, HUBS = 256, 1_500_000, 16
SIDE = 4096  # rows of signatures on each side of one comparison within a bucket
PLANES = [f"p{k}" for k in range(2 * BITS)]  # two words of 60 bits for each retained bit


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text, A-Z lower-cased."""
    w = word_hashes(LOWER[as_bytes(text)])
    if not len(w):
        return w
    return np.unique(chain(w, min(size, len(w))))


def minima(s: np.ndarray) -> np.ndarray:
    """The minimum of each hash function over a non-empty set."""
    out = np.full(HASHES, np.iinfo(_U).max, dtype=_U)
    for k in range(0, len(s), _CHUNK):
        np.minimum(out, (s[None, k:k + _CHUNK] * _FACTORS[:, None]).min(axis=1), out=out)
    return out


def band_keys(m: np.ndarray) -> np.ndarray:
    """For each row of minima, one 64-bit key a band: its number and its full minima."""
    rows = m.reshape(len(m), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=_U), (len(m), BANDS))
    for k in range(ROWS):
        key = mix(key * MULT + rows[:, :, k])
    return key.view(np.int64)


def pack(m: np.ndarray) -> list[np.ndarray]:
    """The low BITS bits of the (mixed) minima, as bit planes of two words of HASHES / 2 bits."""
    low = mix(m)
    half = HASHES // 2
    weights = _U(1) << np.arange(half, dtype=_U)
    out = []
    for bit in range(BITS):
        plane = (low >> _U(bit)) & _U(1)
        out += [(plane[:, :half] * weights).sum(axis=1, dtype=_U), (plane[:, half:] * weights).sum(axis=1, dtype=_U)]
    return [x.view(np.int64) for x in out]


def signatures(documents: DataFrame, shingle: int) -> DataFrame:
    """doc_id, n_shingles, f1, f2 (set fingerprint), the packed planes and the band keys of every row.

    Rows without shingles have zero fingerprints and planes, and no band keys.
    """
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = np.zeros(batch.num_rows, dtype=np.int64)
        f = np.zeros((2, batch.num_rows), dtype=_U)
        m = np.zeros((batch.num_rows, HASHES), dtype=_U)
        for i, text in enumerate(column_bytes(batch.column("text"))):
            s = shingle_set(text, shingle)
            n[i] = len(s)
            if len(s):
                m[i] = minima(s)
                f[0, i] = mix(s + _U(0x1234567)).sum(dtype=_U)
                f[1, i] = mix(s ^ _U(0xABCDEF9876543210)).sum(dtype=_U)
        some = n > 0
        offsets = np.concatenate([[0], np.cumsum(some * BANDS)]).astype(np.int32)
        bands = pa.ListArray.from_arrays(offsets, band_keys(m[some]).ravel())
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n), pa.array(f[0].view(np.int64)), pa.array(f[1].view(np.int64)),
             *map(pa.array, pack(m)), bands], ["doc_id", "n_shingles", "f1", "f2", *PLANES, "bands"])
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return arrow_map(rows, run, "doc_id long, n_shingles long, f1 long, f2 long, "
                     + "".join(f"{p} long, " for p in PLANES) + "bands array<long>")


def _matches(a: str, b: str):
    """Positions whose retained bits all agree, by bit counts of the planes."""
    total = F.lit(HASHES)
    for half in range(2):
        differ = None
        for bit in range(BITS):
            x = F.col(f"{a}.p{2 * bit + half}").bitwiseXOR(F.col(f"{b}.p{2 * bit + half}"))
            differ = x if differ is None else differ.bitwiseOR(x)
        total = total - F.bit_count(differ)
    return total


def estimate(a: str, b: str):
    """Similarity of the rows of aliases a and b, corrected for chance agreement of the retained bits."""
    chance = 2.0 ** -BITS
    return (_matches(a, b) / F.lit(float(HASHES)) - chance) / (1 - chance)


def floor(percent: int) -> float:
    """The least estimate at which a pair may still have the similarity."""
    chance = 2.0 ** -BITS
    p = percent / 100 + (1 - percent / 100) * chance
    return percent / 100 - _DEVIATIONS * (p * (1 - p) / HASHES) ** 0.5 / (1 - chance)


def _plausible(a: str, b: str, percent: int):
    """The sizes allow the similarity, and the estimate is not below the floor."""
    na, nb = F.col(f"{a}.n_shingles"), F.col(f"{b}.n_shingles")
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (estimate(a, b) >= floor(percent))


def _similar(common, na, nb, percent: int):
    return 100 * common >= percent * (na + nb - common)


def _paired(rows: DataFrame, keys: list[str]) -> DataFrame:
    """keys, id, centre of the members (keys, id) of each bucket that has more than one."""
    centres = (rows.groupBy(*keys)
               .agg(F.min(F.struct(F.xxhash64("id", *keys).alias("h"), F.col("id").alias("id"))).alias("c"),
                    F.count(F.lit(1)).alias("n"))
               .where("n > 1").select(*keys, F.col("c.id").alias("centre"), "n"))
    return rows.join(centres, keys)


def _tested(starred: DataFrame, sigs: DataFrame, percent: int) -> DataFrame:
    """a, b, plausible of every member with its centre."""
    pairs = starred.where("id != centre").select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    return (pairs.join(sigs.alias("x"), F.col("a") == F.col("x.doc_id"))
            .join(sigs.alias("y"), F.col("b") == F.col("y.doc_id"))
            .groupBy("a", "b").agg(F.max(_plausible("x", "y", percent)).alias("plausible")))


def _labelled(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
    """The rows with the component of ``column``, itself where no pair names it."""
    held = labels.select(F.col("node").alias(column), F.col("component").alias("__component"))
    return rows.join(held, column, "left").withColumn(name, F.coalesce("__component", column)).drop("__component")


def _size_class(percent: int):
    """Sizes that allow the similarity lie in one class or in two next to each other."""
    return F.floor(F.log("n_shingles") / (math.log(100 / max(percent, 1)) * 1.001 + 1e-6))


def _exhausted(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs of labels (a, b) with a plausible pair of members in one bucket and size class.

    Members outside the largest label of a bucket meet all members, SIDE by SIDE a task key.
    """
    keys = ["key", "class"]
    parts = rows.groupBy(*keys, "label").agg(F.count(F.lit(1)).alias("n"))
    shape = (parts.groupBy(*keys).agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("n"),
                                      F.count(F.lit(1)).alias("parts")).where("parts > 1")
             .select(*keys, F.col("top.label").alias("top"), F.ceil(F.col("n") / SIDE).alias("all_blocks"),
                     F.ceil((F.col("n") - F.col("top.n")) / SIDE).alias("out_blocks")))
    placed, h = rows.join(shape, keys), F.xxhash64(F.lit("side"), "id")
    members = placed.withColumn("mb", F.pmod(h, F.col("all_blocks"))).withColumn(
        "ob", F.explode(F.sequence(F.lit(0).cast("long"), F.col("out_blocks") - 1)))
    outside = placed.where("label != top").withColumn("ob", F.pmod(h, F.col("out_blocks"))).withColumn(
        "mb", F.explode(F.sequence(F.lit(0).cast("long"), F.col("all_blocks") - 1)))
    x, y = outside.alias("x"), members.hint("merge").alias("y")
    same = [F.col(f"x.{k}") == F.col(f"y.{k}") for k in (*keys, "ob", "mb")]
    once = (F.col("y.label") == F.col("y.top")) | (F.col("x.id") < F.col("y.id"))
    return (x.join(y, same).where((F.col("x.label") != F.col("y.label")) & once & _plausible("x", "y", percent))
            .select(F.least("x.label", "y.label").alias("a"), F.greatest("x.label", "y.label").alias("b")).distinct())


def candidates(sigs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose components are those of all plausible pairs that share a band bucket."""
    short = sigs.select("doc_id", "n_shingles", *PLANES)
    starred = materialize(_paired(sigs.select(F.explode("bands").alias("key"), F.col("doc_id").alias("id")), ["key"]),
                          "minhash-buckets")
    tested = materialize(_tested(starred, short, percent), "minhash-stars")
    found = tested.where("plausible").select("a", "b")
    # Buckets with a member that no plausible pair joins with the centre; one of two members is done.
    labels = components(found)
    links = labels.where("node != component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    apart = _labelled(_labelled(tested.where("not plausible"), labels, "a", "la"), labels, "b", "lb").where("la != lb")
    split = (starred.where("n > 2 and id != centre").withColumn("a", F.least("id", "centre"))
             .withColumn("b", F.greatest("id", "centre")).join(apart.select("a", "b"), ["a", "b"]).select("key").distinct())
    rows = _labelled(starred.select("key", "id").join(split, "key"), labels, "id", "label")
    rows = rows.join(short.withColumnRenamed("doc_id", "id"), "id")
    rows = materialize(rows.withColumn("class", F.explode(F.array(_size_class(percent), _size_class(percent) + 1))),
                       "minhash-split")
    if rows.isEmpty():
        return links
    # A centre for each size class first: it joins large groups at one pair a member.  From here on links join labels.
    again = _labelled(_paired(rows.select("key", "class", "id", "label"), ["key", "class"]), labels, "centre", "other")
    again = _tested(again.where("label != other"), short, percent).where("plausible")
    again = materialize(_labelled(_labelled(again, labels, "a", "la"), labels, "b", "lb")
                        .select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).distinct(), "minhash-stars")
    rows = materialize(_labelled(rows.withColumnRenamed("label", "old"), components(again), "old", "label"), "minhash-split")
    return links.unionByName(again).unionByName(materialize(_exhausted(rows, percent), "minhash-exhausted"))


def common_counts(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of every set of x with every set of y, by products of 0/1 matrices over column chunks."""
    values = np.concatenate([*x, *y])
    row = np.repeat(np.arange(len(x) + len(y)), [len(s) for s in (*x, *y)])
    order = np.argsort(values, kind="stable")
    values, row = values[order], row[order]
    column = np.cumsum(np.concatenate([[0], values[1:] != values[:-1]]))
    shared = np.bincount(column)[column] > 1  # a value of one set alone adds nothing
    column, row = np.unique(column[shared], return_inverse=True)[1], row[shared]
    out = np.zeros((len(x), len(y)), dtype=np.float32)
    width = 4096
    edges = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + width, width))
    for k in range(len(edges) - 1):
        part = slice(edges[k], edges[k + 1])
        m = np.zeros((len(x) + len(y), width), dtype=np.float32)
        m[row[part], column[part] - k * width] = 1.0
        out += m[: len(x)] @ m[len(x):].T
    return np.rint(out).astype(np.int64)


def _sets(texts: pa.ChunkedArray, shingle: int) -> list[np.ndarray]:
    return [shingle_set(t, shingle) for t in texts.cast(pa.binary()).to_pylist()]


def _links(x: list[np.ndarray], y: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets of x link with which of y, on the full sets."""
    nx, ny = np.array([len(s) for s in x])[:, None], np.array([len(s) for s in y])[None, :]
    return _similar(common_counts(x, y), nx, ny, percent)


def _lowest(ids: np.ndarray, link: np.ndarray) -> np.ndarray:
    """The smallest id that each of the linked ids reaches."""
    low = ids.copy()
    while True:
        new = np.where(link, low[None, :], low[:, None]).min(axis=1)
        if (new == low).all():
            return low
        low = new


def _whole_cluster(rows: pa.Table, shingle: int, percent: int) -> pa.Table:
    """node, component of one small cluster."""
    ids, sets = np.array(rows.column("doc_id").to_pylist(), dtype=np.int64), _sets(rows.column("text"), shingle)
    link = _links(sets, sets, percent) | (ids[:, None] == ids[None, :])
    return pa.table({"node": pa.array(ids), "component": pa.array(_lowest(ids, link))})


def _with_hubs(rows: pa.Table, shingle: int, percent: int) -> pa.Table:
    """The rows of one block, not its hubs, labelled with the smallest hub that they reach through hubs, else with themselves."""
    hub = np.array(rows.column("hub").to_pylist(), dtype=bool)
    hubs, own = rows.filter(pa.array(hub)), rows.filter(pa.array(~hub))
    ids = np.array(own.column("doc_id").to_pylist(), dtype=np.int64)
    if hubs.num_rows and own.num_rows:
        hub_ids, hub_sets = np.array(hubs.column("doc_id").to_pylist(), dtype=np.int64), _sets(hubs.column("text"), shingle)
        low = _lowest(hub_ids, _links(hub_sets, hub_sets, percent) | (hub_ids[:, None] == hub_ids[None, :]))
        link = _links(_sets(own.column("text"), shingle), hub_sets, percent) | (ids[:, None] == hub_ids[None, :])
        labels = np.where(link.any(axis=1), np.where(link, low[None, :], np.iinfo(np.int64).max).min(axis=1), ids)
    else:
        labels = ids
    return own.select(["cluster", "doc_id", "text"]).append_column("label", pa.array(labels))


def _across(rows: pa.Table, shingle: int, percent: int) -> pa.Table:
    """Pairs of labels (a, b) that link one block of outside members with one block of members."""
    side = np.array(rows.column("outside").to_pylist(), dtype=bool)
    x, y = rows.filter(pa.array(side)), rows.filter(pa.array(~side))
    a, b = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if x.num_rows and y.num_rows:
        lx, ly = (np.array(t.column("label").to_pylist(), dtype=np.int64) for t in (x, y))
        i, j = np.nonzero(_links(_sets(x.column("text"), shingle), _sets(y.column("text"), shingle), percent)
                          & (lx[:, None] != ly[None, :]))
        names, ends = np.unique(np.concatenate([lx[i], ly[j]]), return_inverse=True)
        low, ends = np.arange(len(names)), ends.reshape(2, -1)
        while True:  # a label's lowest reachable one: a forest instead of all pairs
            new = low.copy()
            np.minimum.at(new, ends[0], low[ends[1]])
            np.minimum.at(new, ends[1], low[ends[0]])
            new = new[new]
            if (new == low).all():
                break
            low = new
        tied = low != np.arange(len(names))
        a, b = names[tied], names[low[tied]]
    return pa.table({"a": pa.array(a), "b": pa.array(b)})


def _blocks(n, size):
    return F.greatest(F.ceil(n / BLOCK_ROWS), F.ceil(size / BLOCK_BYTES)).cast("int")


def _large_clusters(texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """node, component of clusters of several blocks; ``texts`` has cluster, doc_id, text, n, blocks."""
    h = F.xxhash64(F.lit("block"), "doc_id")
    own = texts.select("cluster", "doc_id", "text", F.lit(False).alias("hub"), F.pmod(h, F.col("blocks")).cast("int").alias("block"))
    hubs = texts.where(F.pmod(F.xxhash64("doc_id"), F.col("n")) < HUBS).select(
        "cluster", "doc_id", "text", F.lit(True).alias("hub"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def label(table: pa.Table) -> pa.Table:
        return _with_hubs(table, shingle, percent)
    labelled = materialize(own.unionByName(hubs).groupBy("cluster", "block").applyInArrow(
        label, "cluster long, doc_id long, text string, label long"), "minhash-labels")

    size = F.octet_length("text")
    parts = labelled.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("s"))
    shape = (parts.groupBy("cluster")
             .agg(F.max(F.struct("n", "label", "s")).alias("top"), F.sum("n").alias("n"), F.sum("s").alias("s"),
                  F.count(F.lit(1)).alias("parts")).where("parts > 1")
             .select("cluster", F.col("top.label").alias("top"), _blocks(F.col("n"), F.col("s")).alias("all_blocks"),
                     _blocks(F.col("n") - F.col("top.n"), F.col("s") - F.col("top.s")).alias("out_blocks")))
    rows = labelled.join(shape, "cluster")
    members = rows.select(
        "cluster", "label", "text", F.lit(False).alias("outside"), F.pmod(h, F.col("all_blocks")).cast("int").alias("mb"),
        F.explode(F.sequence(F.lit(0), F.col("out_blocks") - 1)).alias("ob"))
    outside = rows.where("label != top").select(
        "cluster", "label", "text", F.lit(True).alias("outside"),
        F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("mb"),
        F.pmod(h, F.col("out_blocks")).cast("int").alias("ob"))

    def compare(table: pa.Table) -> pa.Table:
        return _across(table, shingle, percent)
    across = (members.select("cluster", "label", "text", "outside", "mb", "ob").unionByName(outside)
              .groupBy("cluster", "mb", "ob").applyInArrow(compare, "a long, b long"))
    merged = components(across)
    # A label is a hub's id: also that hub's component may be a smaller member.
    named = labelled.select(F.col("doc_id").alias("node"), "label").join(
        merged.withColumnRenamed("node", "label"), "label", "left").withColumn("part", F.coalesce("component", "label"))
    least = named.groupBy("part").agg(F.min("node").alias("component"))
    return named.select("node", "part").join(least, "part").select("node", "component")


def near_duplicates(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row; links have 100 * intersection >= percent * union."""
    sigs = materialize(signatures(documents, shingle), "minhash-signatures")
    keys = ["f1", "f2", "n_shingles"]
    reps = materialize(sigs.where("n_shingles > 0 and doc_id is not null").groupBy(*keys)
                       .agg(F.min("doc_id").alias("doc_id"), *(F.first(p).alias(p) for p in PLANES), F.first("bands").alias("bands")),
                       "minhash-classes")
    clusters = components(materialize(candidates(reps, percent), "minhash-candidates"))
    texts = materialize(documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
                        .join(clusters.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
                              .hint("merge"), "doc_id"), "minhash-texts")  # no bound on the nodes: never broadcast
    shape = texts.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), _blocks(
        F.count(F.lit(1)), F.sum(F.octet_length("text"))).alias("blocks"))
    large = materialize(shape.where("blocks > 1"), "minhash-large")
    some = not large.isEmpty()

    def solve(table: pa.Table) -> pa.Table:
        return _whole_cluster(table, shingle, percent)
    small = texts.join(large, "cluster", "left_anti") if some else texts
    found = small.groupBy("cluster").applyInArrow(solve, "node long, component long")
    if some:
        found = found.unionByName(_large_clusters(texts.join(large, "cluster"), shingle, percent))
    # A doc_id of several different texts may be found more than once.
    found = found.groupBy(F.col("node").alias("doc_id")).agg(F.min("component").alias("component"))
    classes = reps.select(*keys, F.col("doc_id").alias("doc_id")).join(found, "doc_id", "left").select(
        *keys, F.coalesce("component", "doc_id").alias("component"))
    members = (sigs.where("doc_id is not null").select("doc_id", *keys).join(classes, keys, "left")
               .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
    nameless = sigs.where("doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return members.unionByName(nameless).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def unique_documents(documents: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``documents``, all columns, without those that a document of smaller id stands for."""
    kept = near_duplicates(documents, shingle, percent).where("kept and doc_id is not null").select(
        F.col("doc_id").alias("__kept")).distinct().hint("merge")
    named = documents.where(F.col("doc_id").isNotNull())
    return (named.join(kept, named["doc_id"].cast("long") == kept["__kept"], "left_semi")
            .unionByName(documents.where(F.col("doc_id").isNull())))
