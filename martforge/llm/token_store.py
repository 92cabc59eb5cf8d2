"""Token ids of a corpus as entropy-coded binary files, written and read in parallel.

A store is a folder:

* ``frequencies``: the frequency table all blocks share, one row per id that occurs;
* ``blocks``: rows (shard, block, first, n_ids, n_documents, first_document, documents,
  ids).  ``ids`` is one block of ``rans``: independent of all others, with lanes,
  checkpoints and checksums of its own.  ``documents`` is the block's index: for every
  document with ids in it the ``doc_id`` (with a null mark), the ids that lie in this
  block and whether the document goes on in the next one; a CRC-32 guards it.

The container is Parquet, so that Spark's commit protocol publishes whole tasks only
and any store that Spark reaches will do; entropy-coded bytes are not compressed again.

Documents are in ascending order of ``doc_id`` over shards, blocks and places; rows
without one come last, rows of equal ``doc_id`` by the checksum of their ids and then
in input order.  Shards are ranges of a sample of that order with unique keys, so neither one
``doc_id`` nor one text can fill a shard.  A block holds at most ``block_ids`` ids; a
longer document goes on in the next blocks, and its checksum is put together from
those of its parts.

Null and empty texts have the end id only.  Every input row is a document, repeated
rows too.  Special strings inside a text are what the library makes of them.  An empty
table gives a store without blocks, which reads back as no rows.  Extra columns are
ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martforge.llm import crc, rans, tally
from martforge.llm.common import shuffle_partitions, small_batches, text_bytes, written
from martforge.llm.word_tokens import tokenizer
from martforge.session import checkpoint_root

BLOCK_IDS = 1 << 20
_TOKENS = "doc_id long, task int, nth long, crc long, ids binary, tally binary"
_BLOCKS = "shard int, block int, first long, n_ids long, n_documents int, first_document long, documents binary, ids binary"
_INDEX = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("more", "u1"), ("n", "<u8")])


def tokens(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """One row per document with its ids (the end id last), and one row of counts per task (``tally``)."""
    small_batches(docs.sparkSession, 3000)
    schema = pa.schema([("doc_id", pa.int64()), ("task", pa.int32()), ("nth", pa.int64()), ("crc", pa.int64()),
                        ("ids", pa.binary()), ("tally", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, task, nth = tokenizer(tokenizer_path), TaskContext.get().partitionId(), 0
        size = max(library.size, end_id + 1)
        kind, counts = _kind(size), np.zeros(size, dtype="<i8")
        end = np.array([end_id], dtype=kind).tobytes()
        for b in batches:
            ids, first = library.batch_ids(b.column(1).to_pylist())
            counts += np.bincount(ids, minlength=size)
            counts[end_id] += b.num_rows
            raw, width = memoryview(ids.astype(kind).tobytes()), kind.itemsize
            rows = [bytes(raw[width * lo:width * hi]) + end for lo, hi in zip(first[:-1].tolist(), first[1:].tolist())]
            arrays = [b.column(0), np.full(b.num_rows, task), np.arange(nth, nth + b.num_rows),
                      [zlib.crc32(r) for r in rows], rows, [None] * b.num_rows]
            nth += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(a, type=f.type) for a, f in zip(arrays, schema)], schema=schema)
        last = [[None], [task], [None], [None], [None], [counts.tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(a, type=f.type) for a, f in zip(last, schema)], schema=schema)

    return text_bytes(docs).mapInArrow(run, _TOKENS)


def _kind(size: int) -> np.dtype:
    """Ids between passes: two bytes where the vocabulary allows."""
    return np.dtype("<u2" if size <= 1 << 16 else "<u4")


class _Blocks:
    """Collects the documents of a shard and hands out full blocks."""

    def __init__(self, table: rans.Table, block_ids: int, shard: int):
        self.table, self.block_ids, self.shard = table, block_ids, shard
        self.block = self.first = self.first_document = self.held = 0
        self.parts: list[np.ndarray] = []
        self.index: list[tuple[int, int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while True:
            take = min(len(ids) - at, self.block_ids - self.held)
            more = at + take < len(ids)
            self.parts.append(ids[at:at + take])
            self.index.append((doc_id or 0, doc_id is None, more, take))
            self.held += take
            at += take
            if self.held == self.block_ids:
                yield self.row(more)
            if not more:
                return

    def row(self, goes_on: bool = False) -> tuple:
        index = np.array(self.index, dtype=_INDEX).tobytes()
        out = (self.shard, self.block, self.first, self.held, len(self.index), self.first_document,
               index + zlib.crc32(index).to_bytes(4, "little"), rans.encode(np.concatenate(self.parts), self.table))
        self.block, self.first = self.block + 1, self.first + self.held
        self.first_document += len(self.index) - goes_on  # a document that goes on keeps its number
        self.held, self.parts, self.index = 0, [], []
        return out


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, block_ids: int = BLOCK_IDS) -> None:
    """Writes the store of ``docs`` to ``path``."""
    spark = docs.sparkSession
    table = written(tokens(docs, tokenizer_path, end_id), "token-ids")
    size = max(tokenizer(tokenizer_path).size, end_id + 1)
    freq = rans.Table.of_counts(tally.total(table, size)).freq
    seen = np.flatnonzero(freq)
    rows = list(zip(seen.tolist(), freq[seen].tolist()))  # as many as the vocabulary has
    spark.createDataFrame(rows, "id int, freq long").coalesce(1).write.parquet(f"{path}/frequencies")
    kind = _kind(size)
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                        ("n_documents", pa.int32()), ("first_document", pa.int64()), ("documents", pa.binary()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = _Blocks(rans.Table(freq), block_ids, TaskContext.get().partitionId())

        def out(row: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip(row, schema)], schema=schema)

        for b in batches:
            for doc_id, raw in zip(b.column(0).to_pylist(), b.column(1)):
                for row in blocks.add(doc_id, np.frombuffer(raw.as_buffer(), dtype=kind)):
                    yield out(row)
        if blocks.index:
            yield out(blocks.row())

    keys = [F.col("doc_id").asc_nulls_last(), F.col("crc"), F.col("task"), F.col("nth")]  # unique
    documents = table.where(F.col("tally").isNull()).repartitionByRange(shuffle_partitions(spark), *keys)
    documents.sortWithinPartitions(*keys).select("doc_id", "ids").mapInArrow(encode, _BLOCKS).write.option(
        "compression", "uncompressed").parquet(f"{path}/blocks")


def _frequencies(spark: SparkSession, path: str) -> np.ndarray:
    rows = spark.read.schema("id int, freq long").parquet(f"{path}/frequencies").collect()
    freq = np.zeros(max((r["id"] for r in rows), default=-1) + 1, dtype=np.uint64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    return freq


def _index(raw: bytes) -> np.ndarray:
    if zlib.crc32(raw[:-4]) != int.from_bytes(raw[-4:], "little"):
        raise ValueError("damaged index of a block: its checksum differs")
    return np.frombuffer(raw[:-4], dtype=_INDEX)


def read_parts(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """``(shard, document, doc_id, first, n, crc, ids)``: a document's ids, in one row per block they lie in.

    ``first`` counts the shard's ids before the part; ``ids`` (little-endian unsigned 32-bit)
    is left out where ``with_ids`` is false.  A damaged block or index raises.
    """
    freq = _frequencies(spark, path)
    names = [("shard", pa.int32()), ("document", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n", pa.int64()),
             ("crc", pa.int64()), *([("ids", pa.binary())] if with_ids else [])]
    schema = pa.schema(names)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = rans.Table(freq)
        for b in batches:
            for shard, first, first_document, documents, raw in zip(*(b.column(n) for n in ("shard", "first", "first_document", "documents", "ids"))):
                index = _index(documents.as_py())
                ids = memoryview(rans.Block(raw.as_py(), table).decode().astype("<u4").tobytes())
                ends = np.cumsum(index["n"].astype(np.int64))
                parts = [ids[4 * (e - n):4 * e] for e, n in zip(ends.tolist(), index["n"].tolist())]
                arrays = [np.full(len(index), shard.as_py()), first_document.as_py() + np.arange(len(index)),
                          pa.array(index["doc_id"], mask=index["null"].astype(bool)), first.as_py() + ends - index["n"].astype(np.int64),
                          index["n"].astype(np.int64), [zlib.crc32(p) for p in parts], *([[bytes(p) for p in parts]] if with_ids else [])]
                yield pa.RecordBatch.from_arrays([pa.array(a, type=f.type) for a, f in zip(arrays, schema)], schema=schema)

    kinds = {"int32": "int", "int64": "long", "binary": "binary"}
    small_batches(spark, 16)
    return _blocks(spark, path).mapInArrow(decode, ", ".join(f"{n} {kinds[str(t)]}" for n, t in names))


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCKS).parquet(f"{path}/blocks")


def report(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files alone."""
    @F.pandas_udf("long")
    def whole(parts: pd.Series) -> pd.Series:
        def fold(rows):
            if rows is None:
                return None
            out = np.zeros(1, dtype=np.uint32)
            for r in rows:
                out = crc.joined(out, np.array([r["crc"]], dtype=np.uint32), np.array([4 * r["n"]]))
            return int(out[0])
        return parts.map(fold).astype("Int64")

    shards = _blocks(spark, path).groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # one row per shard
    shards = shards.select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    parts = read_parts(spark, path, with_ids=False)
    documents = parts.groupBy("shard", "document").agg(
        F.first("doc_id").alias("doc_id"), F.min("first").alias("first"), F.sum("n").alias("n_tokens"), F.count("*").alias("n_parts"),
        F.max("crc").alias("crc"), F.array_sort(F.collect_list(F.struct("first", "crc", "n"))).alias("parts"))
    checksum = F.coalesce(whole(F.when(F.col("n_parts") > 1, F.col("parts"))), F.col("crc"))
    return documents.join(shards, "shard").select("doc_id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", checksum.alias("ids_crc32"))


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Writes a store (to a new folder of the shared one, if ``path`` is not given) and reports what it reads back."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_root(spark)}/llm-token-store-{uuid.uuid4().hex}"
    write(docs, path, tokenizer_path, end_id)
    return report(spark, path)
