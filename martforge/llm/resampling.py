"""Importance resampling towards a target distribution over hashed word n-grams.

1. *Features.*  The texts of a batch are joined with a sentinel byte between them and
   lower-cased (A-Z); one regular-expression pass over the joined bytes finds all words
   and sentinels.  The sentinels are the documents' offsets among the words; a binary
   search in these offsets gives every word its document, and n-grams whose first and
   last word lie in different documents are masked out before the buckets are counted.
   A bucket is the CRC-32 of the n-gram modulo ``buckets``; the checksum of an n-gram
   is put together from those of its words.
2. *Gains.*  The corpus and the target are counted per bucket over all rows; a bucket's
   gain is the scaled, floored logarithm of the ratio of its smoothed shares.
3. *Draw.*  A document's weight is the floored mean gain of its features; a Gumbel
   variable from a hash of ``doc_id`` is added, and the highest scores are drawn.  The
   ranks come from range partitions with offsets, so no task sees all rows.

Null texts have no words; null and empty texts have weight 0 and are not drawn.  Every
input row gives one row, repeated rows too (their equal scores take neighbouring
ranks).  A null ``doc_id`` is hashed as an empty one and comes last in ties.  An empty
table gives an empty result; an empty target gives every bucket its smoothed share.
Texts of any length are taken whole.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm import crc, tally
from martforge.llm.common import small_batches, text_bytes, written
from martforge.operators.ranking import global_row_number

_SENTINEL = b"\x00"  # a separator in the definition of words, so a text's own are spaces to it
_FOLD = bytes(0x20 if c == 0 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+|\x00")
_BATCH_BYTES = 4 << 20  # texts are joined up to about this size


def batch_features(texts: list[bytes], buckets: int, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, grouped by document; features of each document; its words)."""
    joined = b"".join(part for t in texts for part in (t.translate(_FOLD), _SENTINEL))
    words = _WORDS.findall(joined)
    length = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    check = np.fromiter(map(zlib.crc32, words), dtype=np.uint32, count=len(words))
    ends = np.flatnonzero((length == 1) & (check == zlib.crc32(_SENTINEL)))  # one checksum per byte: no word has it
    n_words = np.diff(np.concatenate(([-1], ends))) - 1
    place = np.arange(len(words))
    document = np.searchsorted(ends, place, side="left")
    is_word = np.ones(len(words), dtype=bool)
    is_word[ends] = False
    space = np.full(1, zlib.crc32(b" "), dtype=np.uint32)
    features, owners = [(check[is_word] % np.uint64(buckets)).astype(np.uint32)], [document[is_word]]
    gram = check
    for n in range(2, order + 1):
        # a run of n words starts at i and lies within one document
        stop = max(0, len(words) - n + 1)
        whole = (document[:stop] == document[n - 1:n - 1 + stop]) & is_word[n - 1:n - 1 + stop]
        head = crc.joined(gram[:stop], np.broadcast_to(space, stop), np.ones(stop, dtype=np.int64))
        gram = crc.joined(head, check[n - 1:n - 1 + stop], length[n - 1:n - 1 + stop])
        features.append((gram[whole] % np.uint64(buckets)).astype(np.uint32))
        owners.append(document[:stop][whole])
    owner = np.concatenate(owners)
    by_document = np.argsort(owner, kind="stable")
    return np.concatenate(features)[by_document], np.bincount(owner, minlength=len(texts)), n_words


def _groups(ids: list, texts: list[bytes]) -> Iterator[tuple[list, list[bytes]]]:
    """A batch cut into runs of about ``_BATCH_BYTES``; a longer text is a run of its own."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > _BATCH_BYTES:
            yield ids[start:i], texts[start:i]
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield ids[start:], texts[start:]


FEATURES = "doc_id long, task int, nth long, n_words long, n_features long, features binary, tally binary"


def features(docs: DataFrame, buckets: int = 10000, order: int = 2) -> DataFrame:
    """One row per document with the buckets of its features, and one row of counts per task (``tally``).

    ``task`` and ``nth`` tell rows of equal ``doc_id`` apart; a recomputed task numbers alike.
    """
    if not 1 <= buckets <= 1 << 32 or order < 1:
        raise ValueError("buckets must be in 1 .. 2**32 and order at least 1")
    small_batches(docs.sparkSession, 2000)
    kind = "<u2" if buckets <= 1 << 16 else "<u4"
    schema = pa.schema([("doc_id", pa.int64()), ("task", pa.int32()), ("nth", pa.int64()), ("n_words", pa.int64()),
                        ("n_features", pa.int64()), ("features", pa.binary()), ("tally", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth, counts = TaskContext.get().partitionId(), 0, np.zeros(buckets, dtype="<i8")
        for b in batches:
            for ids, texts in _groups(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found, n, n_words = batch_features(texts, buckets, order)
                counts += np.bincount(found, minlength=buckets)
                raw = found.astype(kind)
                ends = np.cumsum(n)
                rows = [raw[e - k:e].tobytes() for e, k in zip(ends.tolist(), n.tolist())]
                numbers = np.arange(nth, nth + len(ids))
                nth += len(ids)
                arrays = [ids, np.full(len(ids), task), numbers, n_words, n, rows, [None] * len(ids)]
                yield pa.RecordBatch.from_arrays([pa.array(a, type=f.type) for a, f in zip(arrays, schema)], schema=schema)
        last = [[None], [task], [None], [None], [None], [None], [counts.tobytes()]]
        yield pa.RecordBatch.from_arrays([pa.array(a, type=f.type) for a, f in zip(last, schema)], schema=schema)

    return text_bytes(docs).mapInArrow(run, FEATURES)


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled, floored log ratio of the smoothed share of every bucket in the target and in the source."""
    n = len(source)
    s_all, t_all = float(source.sum()) + n, float(target.sum()) + n
    return np.array([math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], dtype=np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """Scaled, floored Gumbel variable of a document, from a hash of the seed and its id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighted(table: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """``features`` rows with ``weight`` and ``score``; ``gain`` has one entry per bucket."""
    kind = "<u2" if len(gain) <= 1 << 16 else "<u4"
    names = ["doc_id", "task", "nth", "n_words", "n_features"]
    schema = pa.schema([("doc_id", pa.int64()), ("task", pa.int32()), ("nth", pa.int64()), ("n_words", pa.int64()),
                        ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total = [int(gain[np.frombuffer(raw.as_buffer(), dtype=kind)].sum()) for raw in b.column(5)]
            weight = [t // n if n else 0 for t, n in zip(total, b.column(4).to_pylist())]
            score = [w + gumbel(d, seed) for w, d in zip(weight, b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(weight, type=pa.int64()), pa.array(score, type=pa.int64())], schema=schema)

    rows = table.where(F.col("tally").isNull()).select(*names, "features")
    return rows.mapInArrow(run, "doc_id long, task int, nth long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, buckets: int = 10000,
             order: int = 2, seed: int = 7) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` per row of ``docs``; ``rank`` is null where a row is not drawn.

    ``percent`` of the documents with at least ``min_words`` words are drawn.  ``target``
    needs a column ``text`` only.
    """
    table = written(features(docs, buckets, order), "features")
    wanted = features(target.select(F.lit(None).cast("long").alias("doc_id"), target["text"]), buckets, order)
    gain = gains(tally.total(table, buckets), tally.total(wanted.select("tally"), buckets))
    scored = written(weighted(table, gain, seed), "scores")
    able = scored.where(F.col("n_words") >= min_words).select(
        "doc_id", "n_features", "weight", "score", (-F.col("score")).alias("down"),
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("place"), "task", "nth")
    numbered, n = global_row_number(able, ["down", "place", "task", "nth"], out="number")
    drawn = percent * n // 100
    rank = F.when(F.col("number") <= drawn, F.col("number"))
    rest = scored.where(F.col("n_words") < min_words)
    columns = ["doc_id", "n_features", "weight", "score"]
    return numbered.select(*columns, rank.cast("long").alias("rank")).unionByName(
        rest.select(*columns, F.lit(None).cast("long").alias("rank")))
