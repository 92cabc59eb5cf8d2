"""Shared helpers of the training-data operators: input columns, Arrow passes over texts, written steps."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.session import checkpoint_root

# word separators of every contract: space and the ASCII control characters tab .. carriage return;
# exactly what bytes.split() without an argument splits on
SEPARATORS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of few rows: a batch of very long texts stays small (Spark also bounds a batch's bytes)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def text_bytes(docs: DataFrame, null_as_empty: bool = True) -> DataFrame:
    """``(doc_id, text)`` with the text as UTF-8 bytes; other columns are left behind."""
    text = docs["text"].cast("string")
    if null_as_empty:
        text = F.coalesce(text, F.lit(""))
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text.cast("binary").alias("text"))


def map_texts(docs: DataFrame, fn: Callable[[list, list], dict], schema: str, null_as_empty: bool = True) -> DataFrame:
    """``fn(doc_ids, texts) -> {column: values}`` over every Arrow batch of ``(doc_id, text bytes)``.

    ``fn`` may return more or fewer rows than it got.
    """
    small_batches(docs.sparkSession)
    names = [part.split()[0] for part in schema.split(",")]
    types = [_arrow_type(part.split()[1]) for part in schema.split(",")]
    out = pa.schema(list(zip(names, types)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = fn(b.column(0).to_pylist(), b.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(got[n], type=t) for n, t in zip(names, types)], schema=out)

    return text_bytes(docs, null_as_empty).mapInArrow(run, schema)


def map_batches(docs: DataFrame, fn: Callable[[pa.Array, pa.Array], list], schema: str, rows: int = 2000) -> DataFrame:
    """As ``map_texts``, column-wise: ``fn(doc_ids, texts) -> arrays``; texts are Arrow strings, null as empty.

    Bytes that are no UTF-8 are read as replacement characters.
    """
    small_batches(docs.sparkSession, rows)
    out = pa.schema([(part.split()[0], _arrow_type(part.split()[1])) for part in schema.split(",")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arrays = [pa.array(a, type=f.type) for a, f in zip(fn(b.column(0), as_text(b.column(1))), out)]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return text_bytes(docs).mapInArrow(run, schema)


def as_text(raw: pa.Array) -> pa.Array:
    try:
        return raw.cast(pa.large_string())
    except pa.ArrowInvalid:
        return pa.array([t.decode("utf-8", "replace") for t in raw.to_pylist()], type=pa.large_string())


def coded_chunks(texts: pa.Array, mark: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut at every ``mark``: (distinct chunks, code of each chunk, first chunk of each text and the end)."""
    lists = pc.split_pattern(texts, mark)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    coded = lists.flatten().dictionary_encode()
    return coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(zero_copy_only=False), lists.offsets.to_numpy() - lists.offsets[0].as_py()


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring offsets ."""
    total = np.concatenate(([0], np.cumsum(values)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _arrow_type(name: str) -> pa.DataType:
    return {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(),
            "boolean": pa.bool_(), "double": pa.float64()}[name.lower()]


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: a lineage cut that survives lost executors.

    The known schema is passed on, so no inference job runs.  The write's shuffle files
    are of no further use once the table exists, so Spark removes them when it ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm-{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def own_names(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: clashing extra columns of the input cannot reach the operator's joins."""
    return df.select(*[df[n] for n in names])


def keyed(docs: DataFrame) -> DataFrame:
    """Columns that place a document among the others: ``__doc`` (``doc_id``, nulls last) and ``__version``.

    The version is 0 while every ``doc_id`` is there once, else a hash of the text: rows
    that agree in ``doc_id`` and text are the same document, others are told apart.
    """
    doc = F.coalesce(docs["doc_id"].cast("long"), F.lit(2**63 - 1))
    unique = docs.groupBy(doc.alias("d")).count().where("count > 1").isEmpty()
    version = F.lit(0).cast("long") if unique else F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    return docs.withColumns({"__doc": doc, "__version": version})


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
