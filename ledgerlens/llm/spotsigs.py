"""Document fingerprints with SpotSigs.

A spot is a common word (an anchor) with the CHAIN content words that follow it, every
STEP-th one; a text's fingerprint is the set of its spots, as 32-bit hashes.  Sets are partitioned by length, a
partition spanning a factor of 1 / bound, and two fingerprints are compared by their Jaccard similarity only where their
partitions are equal or adjacent; the comparison ends as soon as the spots that are left cannot bring it to
the bound.  Likenesses below the bound (BOUND for ``neighbours``) are 0.

``neighbours`` fingerprints each text, the next one, and the text with its second half
taken from the next, without moving any text more than once: rows are dealt by ranges of
doc_id, and the first row of each range is sent along to the range before.  ``near_pairs``
links all texts of a table: sets are partitioned by length, so that only equal or adjacent
partitions can reach the bound, and only sets that share one of their rarest spots meet.

Defined results: a null text counts as empty; a text without spots falls back to a chain at every
word, then to its whole word sequence, then to its bytes, so only the empty text has
the empty fingerprint; two empty fingerprints are alike (1), an empty and a
non-empty one are not (0); the next document is the next row by doc_id (nulls first), rows
with equal doc_id by their text; the next of a single row is itself; very long texts are
fingerprinted whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .textops import LOWER, MULT, as_bytes, column_bytes, mix, small_batches, span_hashes

CHAIN, STEP = 2, 1
BOUND = 0.05
_SLICE = 256  # spots compared between two looks at what is left
#: Common words of English, French, German and Spanish.
ANCHORS = ("a an the of to is was that there said and with "
           "le la les de des un une est et que dans "
           "der die das und ist ein eine von mit "
           "el los las y es por con una").split()
_U = np.uint64
_APART = np.zeros(256, dtype=bool)  # bytes between words: ASCII but letters and digits
_APART[:128] = True
_APART[list(range(48, 58)) + list(range(65, 91)) + list(range(97, 123))] = False


def _word_hashes(b: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(b) + 2, dtype=np.int8)
    inside[1:-1] = ~_APART[b]
    step = np.diff(inside)
    return span_hashes(LOWER[b], np.flatnonzero(step == 1), np.flatnonzero(step == -1))


_ANCHOR_HASHES = np.unique(np.concatenate([_word_hashes(as_bytes(a.encode())) for a in ANCHORS]))


def _is_anchor(w: np.ndarray) -> np.ndarray:
    at = np.searchsorted(_ANCHOR_HASHES, w)
    at[at == len(_ANCHOR_HASHES)] = 0
    return _ANCHOR_HASHES[at] == w


def _chains(heads: np.ndarray, first: np.ndarray, content: np.ndarray) -> np.ndarray:
    """Hash of each head with the CHAIN content words from index ``first`` on, where there are enough."""
    enough = first + (CHAIN - 1) * STEP < len(content)
    h, k = heads[enough], first[enough]
    for c in range(CHAIN):
        h = mix(h * MULT + content[k + c * STEP])
    return h


def spots(text: bytes | None) -> np.ndarray:
    """Sorted distinct 32-bit spot hashes of one text."""
    b = as_bytes(text)
    if not len(b):
        return np.zeros(0, dtype=np.uint32)
    w = _word_hashes(b)
    anchor = _is_anchor(w) if len(w) else np.zeros(0, dtype=bool)
    content = w[~anchor]
    before = np.cumsum(~anchor)  # content words up to and including each word
    h = _chains(w[anchor], before[anchor], content)
    if not len(h) and len(w) > CHAIN:
        h = _chains(w, np.arange(1, len(w) + 1), w)
    if not len(h):
        whole = w if len(w) else span_hashes(b, np.array([0]), np.array([len(b)]))
        one = np.full(1, len(whole), dtype=_U)
        for x in whole:
            one = mix(one * MULT + x)
        h = one
    return np.unique((h >> _U(32)).astype(np.uint32))


def encode(s: np.ndarray) -> str:
    """A fingerprint as text: base64 of the sorted little-endian hashes."""
    return base64.b64encode(s.astype("<u4").tobytes()).decode()


def decode(s: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(s), dtype="<u4")


def partition(n: int, bound: float) -> int:
    """The length partition of a set of n spots: sets that reach the bound are in equal or adjacent ones."""
    return math.floor(math.log(n) / -math.log(bound) + 1e-9)


def likeness(a: np.ndarray, b: np.ndarray, bound: float = BOUND) -> float:
    """Jaccard similarity of two sorted sets, 0 where it is below ``bound``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if abs(partition(len(a), bound) - partition(len(b), bound)) > 1 or min(len(a), len(b)) < bound * max(len(a), len(b)):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    need = bound / (1 + bound) * (len(a) + len(b))  # common spots that reach the bound
    common = 0
    for k in range(0, len(a), _SLICE):
        if common + len(a) - k < need:
            return 0.0
        part = a[k:k + _SLICE]
        at = np.searchsorted(b, part)
        at[at == len(b)] = 0
        common += int(np.count_nonzero(b[at] == part))
    j = common / (len(a) + len(b) - common)
    return j if j >= bound else 0.0


_OUT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _record(doc_id, text: str, own: np.ndarray, nxt: str, other: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = (text[:len(text) - half] + nxt[:half]).encode()
    changed = spots(edited)
    return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), encode(own), encode(changed),
            likeness(own, changed), likeness(own, other))


def neighbours(documents: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row."""
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    number = F.coalesce(F.col("doc_id").cast("double"), F.lit(-math.inf))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranges = [k / parts for k in range(1, parts)]
    cuts = docs.select(F.percentile_approx(F.col("doc_id").cast("double"), ranges, 20 * parts)).first()[0] if ranges else []
    splits = [-math.inf, *sorted(set(cuts or [])), math.inf]
    dealt = docs.withColumn("__n", number)
    if len(splits) > 2:
        dealt = Bucketizer(splits=splits, inputCol="__n", outputCol="__range").transform(dealt)
        dealt = dealt.withColumn("__range", F.col("__range").cast("int"))
    else:
        dealt = dealt.withColumn("__range", F.lit(0))
    # One row for each range: its first doc_id (null if it has one).  At most ``parts`` rows.
    firsts = sorted((r["__range"], None if r["nulls"] else r["least"]) for r in dealt.groupBy("__range").agg(
        F.min("doc_id").alias("least"), F.sum(F.col("doc_id").isNull().cast("int")).alias("nulls")).collect())
    dealt = dealt.select("__range", F.lit(0).alias("__copy"), "doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    if firsts:
        to = [(k, first, firsts[i - 1][0]) for i, (k, first) in enumerate(firsts)]
        plan = F.broadcast(spark.createDataFrame(to, f"__own int, __first {kind}, __to int"))
        copies = (dealt.join(plan, (F.col("__range") == F.col("__own")) & F.col("doc_id").eqNullSafe(F.col("__first")))
                  .select(F.col("__to").alias("__range"), F.lit(1).alias("__copy"), "doc_id", "text"))
        dealt = dealt.unionByName(copies)
    ordered = dealt.repartition(parts, "__range").sortWithinPartitions(
        "__range", "__copy", F.asc_nulls_first("doc_id"), "text")
    names = ["doc_id", *(x.split()[0] for x in _OUT.split(", "))]
    small_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for its next one: range, doc_id, text, spots
        for batch in batches:
            types = batch.schema.field("doc_id").type
            out = []
            for part, copy, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("__range", "__copy", "doc_id", "text"))):
                if copy and (held is None or held[0] != part):
                    continue  # a second copy, or one for a range without rows here
                own = spots(text.encode())
                if held is not None and held[0] == part:
                    out.append(_record(held[1], held[2], held[3], text, own))
                held = None if copy else (part, doc_id, text, own)
            columns = list(zip(*out)) if out else [[]] * len(names)
            kinds = [types, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
    return ordered.mapInArrow(run, f"doc_id {kind}, {_OUT}")


def near_pairs(documents: DataFrame, bound: float = 0.8) -> DataFrame:
    """doc_id, rep of every row, and links between representatives, as two frames (members, links a, b, likeness).

    Rows with equal fingerprints are one class, represented by the smallest doc_id.  Links are all
    pairs of class representatives whose likeness reaches ``bound``.
    """
    spark = documents.sparkSession
    small_batches(spark)
    rows = documents.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [spots(t) for t in column_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([hashlib.md5(s.tobytes()).hexdigest() for s in sets]),
                 pa.array([s.astype(np.int64) for s in sets], pa.list_(pa.int64()))], ["doc_id", "key", "spots"])
    signed = materialize(rows.mapInArrow(sign, "doc_id long, key string, spots array<long>"), "spotsigs")
    classes = signed.groupBy("key").agg(F.min("doc_id").alias("rep"))
    members = signed.select("doc_id", "key").join(classes, "key").select("doc_id", "rep")
    reps = materialize(signed.join(classes, "key").where("doc_id = rep and size(spots) > 0")
                       .select("doc_id", F.size("spots").alias("n"), "spots").dropDuplicates(["doc_id"]), "spotsigs-classes")
    # Sets that reach the bound differ in length by a factor of 1 / bound at most: adjacent partitions.
    part = F.floor(F.log("n") / F.lit(-math.log(bound)) + F.lit(1e-9)).cast("int")
    each = reps.select("doc_id", "n", part.alias("part"), F.explode("spots").alias("spot"))
    rarity = each.groupBy("spot").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = (each.join(rarity, "spot").groupBy("doc_id", "n", "part")
              .agg(F.sort_array(F.collect_list(F.struct("df", "spot"))).alias("s")))
    # Of n spots, the n - ceil(bound * n) + 1 rarest must hit; those that no other set has come first and can't.
    prefix = F.col("n") - F.ceil(F.lit(bound) * F.col("n")) + 1 - (F.col("n") - F.size("s"))
    heads = (shared.where(prefix > 0).withColumn("take", prefix.cast("int"))
             .select("doc_id", "n", "part", F.explode(F.slice("s", 1, F.col("take"))).alias("h"))
             .select("doc_id", "n", "part", F.col("h.spot").alias("spot")))
    x = heads.alias("x")
    y = heads.withColumn("to", F.explode(F.array("part", F.col("part") + 1))).alias("y")
    pairs = (x.join(y, (F.col("x.spot") == F.col("y.spot")) & (F.col("x.part") == F.col("y.to"))
                    & (F.col("y.n") >= F.lit(bound) * F.col("x.n")) & (F.col("x.n") >= F.lit(bound) * F.col("y.n"))
                    & ((F.col("x.part") != F.col("y.part")) | (F.col("x.doc_id") < F.col("y.doc_id"))))
             .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct())
    both = (pairs.join(reps.select(F.col("doc_id").alias("a"), F.col("spots").alias("sa")), "a")
            .join(reps.select(F.col("doc_id").alias("b"), F.col("spots").alias("sb")), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    links = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                        (common / (F.size("sa") + F.size("sb") - common)).alias("likeness")).where(F.col("likeness") >= bound)
    return members, links
