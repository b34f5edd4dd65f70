"""Token ids in Parquet files that can be read in part.

A store is a folder of Parquet files in ascending order of doc_id, one row for each document:

    doc_id | part (number of the file) | at (ids before it in its file) | n_tokens | ids list<int>

* ids are dictionary-encoded by default (a vocabulary fits in one dictionary page, so an id takes 16 bits or less), or
  delta-encoded; the columns that only grow within a file (doc_id, at) and n_tokens are delta-encoded.
* Row groups are of ROW_GROUP bytes and pages of PAGE_ROWS rows at most, with a page index. A reader of a doc_id
  interval fetches the pages that hold it; a reader of the metadata never touches the ids.
* Spark's own writer commits the files, so they may lie in any file system that Spark knows, a lost
  executor's rows are written again and a failed job leaves no half of a file.

Texts are dealt by ranges of (doc_id, hash of the text, row number) into files of FILE_BYTES of text at most (and at least
as many as the session has shuffle partitions); the keys after
doc_id cut a doc_id that a third of the rows share. They are encoded after the shuffle, in order, in Arrow batches;
the running count within a file needs no window. The count of ids before a file is a running sum over one
row for each file, read from the metadata.

Encoding: the tokenizer drops white space and no pre-token spans it, so a text's ids are those of its
pieces between white space characters one after the other. Each worker keeps the ids of the short pieces it used last (two
generations of up to CACHE) and has the library encode the others, all of a batch in one call.

Defined results: a null or empty text has the end id alone; special tokens that stand in a text are encoded as the
library does by default; a null doc_id comes first; rows equal in doc_id are in order of a hash of their text;
repeated rows are written row by row; an empty table gives an empty store and an empty result; extra columns are ignored;
a very long text is encoded whole and lies in one row.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .textops import column_bytes, small_batches

FILE_BYTES = 256 << 20
ROW_GROUP, PAGE, PAGE_ROWS = 16 << 20, 256 << 10, 2000
CACHE, _LONGEST, _GROUP = 1 << 20, 64, 32
_MARK = b"\x01"
_COLUMNS = "part int, at bigint, n_tokens int, ids array<int>"


class Encoder:
    """The tokenizer of one process, with the ids of pieces it has seen lately."""

    def __init__(self, definition: str, end_id: int | None):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(definition)
        self.end = b"" if end_id is None else np.array([end_id], dtype="<i4").tobytes()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.mark = self.tokenizer.encode(_MARK.decode(), add_special_tokens=False).ids

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype="<i4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Packed ids of pieces, some of them in one text with a mark between.

        The mark, between spaces, has one id; where a text has just as many of it as marks, no piece has made one,
        and it is cut there. Other pieces are encoded one by one.
        """
        alone = [p for p in pieces if _MARK in p] if len(self.mark) == 1 else pieces
        rest = [p for p in pieces if _MARK not in p] if alone else pieces
        rest = rest if len(self.mark) == 1 else []
        groups = [rest[k:k + _GROUP] for k in range(0, len(rest), _GROUP)]
        between = b" " + _MARK + b" "
        out = {}
        for group, ids in zip(groups, self._ids([between.join(g).decode() for g in groups])):
            at = np.flatnonzero(ids == self.mark[0]).tolist()
            if len(at) != len(group) - 1:
                alone = alone + group
                continue
            packed = ids.tobytes()
            begin = 0
            for piece, end in zip(group, [*at, len(ids)]):
                out[piece] = packed[4 * begin:4 * end]
                begin = end + 1
        out.update(zip(alone, (x.tobytes() for x in self._ids([p.decode() for p in alone]))))
        return out

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """The ids of each text and the end id, as little-endian 32-bit numbers."""
        cut = [t.split() if t else [] for t in texts]  # the six white space characters of ASCII
        found = [list(map(self.young.get, pieces)) for pieces in cut]
        gaps = [[i for i, x in enumerate(ids) if x is None] if None in ids else [] for ids in found]
        missing = {pieces[i] for pieces, gap in zip(cut, gaps) for i in gap}
        made = {p: self.old[p] for p in missing if p in self.old}
        fresh = [p for p in missing if p not in made]
        if fresh:
            made.update(self._learn(fresh))
        for pieces, ids, gap in zip(cut, found, gaps):
            for i in gap:
                ids[i] = made[pieces[i]]
        if len(self.young) + len(made) > CACHE:  # what was not used for a whole generation goes
            self.old, self.young = self.young, {}
        self.young.update(made)
        for p in [p for p in made if len(p) > _LONGEST]:
            del self.young[p]
        return [b"".join(ids) + self.end for ids in found]


_encoders: dict[tuple, Encoder] = {}


def _encoder(held, end_id: int | None) -> Encoder:
    key = (zlib.crc32(held.value), len(held.value), end_id)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(held.value.decode(), end_id)
    return _encoders[key]


def _ids_array(coded: list[bytes]) -> pa.ListArray:
    offsets = np.zeros(len(coded) + 1, dtype=np.int64)
    np.cumsum([len(x) // 4 for x in coded], out=offsets[1:])
    values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(coded))])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), pa.int32()), values)


def encode(rows: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """doc_id, part, at, n_tokens, ids of rows (doc_id, text), in their order within each partition."""
    with open(tokenizer, "rb") as f:  # a fixed vocabulary of a few MB
        held = rows.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            coded = _encoder(held, end_id).encode(column_bytes(batch.column("text")))
            n = np.fromiter((len(x) // 4 for x in coded), dtype=np.int64, count=len(coded))
            starts = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.full(len(n), part, dtype=np.int32)), pa.array(starts),
                 pa.array(n.astype(np.int32)), _ids_array(coded)], ["doc_id", "part", "at", "n_tokens", "ids"])
    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_COLUMNS}")


def write(documents: DataFrame, path: str, tokenizer: str, end_id: int | None = None, ids_encoding: str = "dictionary",
          file_bytes: int = FILE_BYTES, row_group: int = ROW_GROUP, page_rows: int = PAGE_ROWS) -> None:
    """Encode (doc_id, text) and write a store at ``path``; ``ids_encoding`` is "dictionary" or "delta"."""
    if ids_encoding not in ("dictionary", "delta"):
        raise ValueError(f"unknown encoding {ids_encoding!r}")
    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    files = max(-(-size // file_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = (rows.select("doc_id", "text", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"))
             .repartitionByRange(files, "doc_id", "h", "row").sortWithinPartitions("doc_id", "h", "row").select("doc_id", "text"))
    dictionary = {"ids.list.element": ids_encoding == "dictionary", "doc_id": False, "at": False, "n_tokens": False}
    writer = encode(dealt, tokenizer, end_id).write.mode("errorifexists").options(**{
        "compression": "snappy", "parquet.writer.version": "PARQUET_2_0", "parquet.block.size": row_group,
        "parquet.page.size": PAGE, "parquet.page.row.count.limit": page_rows, "parquet.enable.dictionary": True})
    for column, use in dictionary.items():
        writer = writer.option(f"parquet.enable.dictionary#{column}", use)
    writer.parquet(path)


def _stored(spark: SparkSession, path: str, doc_id: T.DataType = T.LongType()) -> DataFrame:
    schema = T.StructType([T.StructField("doc_id", doc_id), *T.StructType.fromDDL(_COLUMNS).fields])
    return spark.read.schema(schema).parquet(path)


def with_starts(rows: DataFrame, spark: SparkSession, path: str) -> DataFrame:
    """Rows of a store with ``start``: the number of ids of all documents before."""
    sums = _stored(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each file: a few hundred thousand at 100 TB
    base = sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("at")).drop("base")


def read_index(spark: SparkSession, path: str, doc_id: T.DataType = T.LongType()) -> DataFrame:
    """doc_id, start, n_tokens of every document, from the metadata columns alone."""
    rows = _stored(spark, path, doc_id).select("doc_id", "part", "at", F.col("n_tokens").cast("long").alias("n_tokens"))
    return with_starts(rows, spark, path).select("doc_id", "start", "n_tokens")


def read_documents(spark: SparkSession, path: str, first, last, doc_id: T.DataType = T.LongType()) -> DataFrame:
    """doc_id, ids of the documents from ``first`` to ``last``: the page index leaves the other pages unread."""
    return _stored(spark, path, doc_id).where(F.col("doc_id").between(first, last)).select("doc_id", "ids")


def read_window(spark: SparkSession, path: str, start: int, count: int) -> DataFrame:
    """doc_id, offset, ids: the ids numbered start to start + count - 1 of the whole store, cut from the documents that hold them.

    ``offset`` is the number of the first id of the piece. The files are found from the metadata; in them, only
    pages with documents that start before the end of the window and in reach of its begin are read.
    """
    bases = (_stored(spark, path).groupBy("part").agg(F.sum("n_tokens").alias("n"), F.max("n_tokens").alias("longest"))
             .withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)),
                                            F.lit(0))))
    end = start + count
    hit = bases.where((F.col("base") < end) & (F.col("base") + F.col("n") > start)).collect()  # the files of the window
    out = None
    for r in hit:
        low, high = start - r["base"], end - r["base"]
        rows = _stored(spark, path).where((F.col("part") == r["part"]) & (F.col("at") < high)
                                          & (F.col("at") > low - r["longest"]) & (F.col("at") + F.col("n_tokens") > low))
        skip = F.greatest(F.lit(low) - F.col("at"), F.lit(0))
        take = F.least(F.col("n_tokens").cast("long"), F.lit(high) - F.col("at")) - skip
        piece = rows.select("doc_id", (F.col("at") + r["base"] + skip).alias("offset"),
                            F.slice("ids", (skip + 1).cast("int"), take.cast("int")).alias("ids"))
        out = piece if out is None else out.unionByName(piece)
    empty = _stored(spark, path).where("false").select("doc_id", F.col("at").alias("offset"), "ids")
    return empty if out is None else out


def read_checksums(spark: SparkSession, path: str, doc_id: T.DataType = T.LongType()) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit numbers) of every document."""
    rows = _stored(spark, path, doc_id).select("doc_id", "part", "at", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = batch.column("ids")
            offsets = ids.offsets.to_numpy()
            data = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)).cast("B")
            sums = [zlib.crc32(data[4 * a:4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("part"), batch.column("at"), pa.array(np.diff(offsets).astype(np.int64)),
                 pa.array(sums, pa.int64())], ["doc_id", "part", "at", "n_tokens", "ids_crc32"])
    small_batches(spark)
    kind = rows.schema["doc_id"].dataType.simpleString()
    read = rows.mapInArrow(run, f"doc_id {kind}, part int, at bigint, n_tokens bigint, ids_crc32 bigint")
    return with_starts(read, spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def round_trip(documents: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """Write a store in the shared folder and read the checksums of its documents back."""
    spark = documents.sparkSession
    path = scratch_path(spark, "token-store")
    write(documents, path, tokenizer, end_id)
    return read_checksums(spark, path, documents.schema["doc_id"].dataType)
