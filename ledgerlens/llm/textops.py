"""Array kernels over the UTF-8 bytes of one document.

Every kernel works on a whole document at a time inside an Arrow batch, so a
task holds the arrays of one document, never those of its partition.  Words are
maximal runs of bytes other than space, tab, \\n, \\v, \\f and \\r; no byte of a
multi-byte character is one of those, so byte runs equal character runs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BATCH_ROWS, BATCH_BYTES = 256, 16 << 20

_U = np.uint64
MULT = _U(0x9E3779B97F4A7C15)
_P = 0x5851F42D4C957F2D  # odd, hence invertible modulo 2**64
_PINV = pow(_P, -1, 1 << 64)

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_pow = np.ones(1, dtype=_U)
_inv = np.ones(1, dtype=_U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash multiplier and of its inverse, up to exponent n."""
    global _pow, _inv
    if len(_pow) < n:
        size = max(n, 2 * len(_pow), 1 << 14)
        _pow = np.full(size, _P, dtype=_U)
        _inv = np.full(size, _PINV, dtype=_U)
        _pow[0] = _inv[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(_pow, out=_pow)
            np.multiply.accumulate(_inv, out=_inv)
    return _pow, _inv


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h = h * _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


def as_bytes(text: bytes | None) -> np.ndarray:
    return np.frombuffer(text or b"", dtype=np.uint8)


def word_bounds(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) byte offsets of the words."""
    word = np.zeros(len(b) + 2, dtype=np.int8)
    word[1:-1] = ~SPACE[b]
    step = np.diff(word)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def span_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, all from one running polynomial sum."""
    if not len(starts):
        return np.zeros(0, dtype=_U)
    powers, inverse = _powers(len(b) + 1)
    total = np.zeros(len(b) + 1, dtype=_U)
    np.cumsum((b.astype(_U) + _U(1)) * powers[: len(b)], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def word_hashes(b: np.ndarray) -> np.ndarray:
    return span_hashes(b, *word_bounds(b))


def chain(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of n consecutive values (empty when there are fewer)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=_U)
    out = np.full(m, n, dtype=_U)
    for k in range(n):
        out = mix(out * MULT + h[k:k + m])
    return out


def column_bytes(column: pa.Array) -> list[bytes | None]:
    """The values of an Arrow string column as UTF-8 bytes."""
    return column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()


def arrow_map(df: DataFrame, one_batch, schema: str) -> DataFrame:
    """``mapInArrow`` of a function from one RecordBatch to one RecordBatch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield one_batch(batch)
    small_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


def hashed_sample(rows: DataFrame, key: str, size: int) -> DataFrame:
    """The ``size`` rows of smallest hash of ``key`` (ties by key); all rows if there are fewer.

    A hash bound that about twice as many rows pass comes first, so what the partitions send to be
    ordered is bounded by the size, not by size times partitions.
    """
    span = 1 << 30
    total = rows.count()
    bound = span if total <= 2 * size else -(-2 * size * span // total) + 1
    h = F.pmod(F.xxhash64(key), F.lit(span))
    return rows.where(h < bound).orderBy(h, key).limit(size)


def small_batches(spark) -> None:
    """Arrow batches of a few hundred texts and a few MB: what a task buffers is bounded by both; a longer text goes alone."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(spark.conf.get(key).rstrip("b")) <= most:
            spark.conf.set(key, str(most))
