"""Word sets of lines, column-wise: hashes, corpus-wide rarity, prefixes in order of rarity.

A line is the set of its words; a word is known by a 64-bit hash of its bytes.  Words of
a whole batch of texts are cut, hashed, sorted and made distinct side by side in numpy,
a few megabytes at a time; one text is never cut, so a task's memory grows with its
longest text only.

Rarity is the magnitude (half octaves) of a word's occurrences in all lines of the
corpus, counted in ``CELLS`` hash cells: a fixed number, whatever the vocabulary.  Any
total order keeps the filters exact; cells only make it selective.  A cell that was met
once belongs to a word of a single line, which no other line can share.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.anchors import mixed
from martforge.llm.common import small_batches

CELLS = 1 << 20          # hash cells of the word counts; their levels travel to every task, a byte each
PARTS = 64               # the cells are summed in so many parts
SPREAD = 64              # tasks whose counts are summed at first
LEVEL_BITS = 6
BLOCK = 1 << 14          # words hashed at a time
GROUP = 1 << 20          # bytes of text worked on at a time

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)    # of the first n of eight bytes
_SIZE = np.uint64(0x9E3779B97F4A7C15)


def _hashes(joined: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at ``start``, eight bytes at a time; eight more bytes follow the last word."""
    eight = np.ndarray(shape=(len(joined) - 7,), dtype="<u8", buffer=joined, strides=(1,))
    out = np.empty(len(start), dtype=np.uint64)
    for a in range(0, len(start), BLOCK):       # arrays that stay in the processor's cache
        at, left = start[a:a + BLOCK], size[a:a + BLOCK]
        h = mixed((eight[at] & _MASKS[np.minimum(left, 8)]) + left.astype(np.uint64) * _SIZE)
        more = np.flatnonzero(left > 8)
        at, left = at[more] + 8, left[more] - 8
        while len(more):
            h[more] = mixed(h[more] * _SIZE + (eight[at] & _MASKS[np.minimum(left, 8)]))
            on = left > 8
            more, at, left = more[on], at[on] + 8, left[on] - 8
        out[a:a + BLOCK] = h
    return out


class Words(NamedTuple):
    """Words of a group of texts in order: their line and hash; every line's text and its number there."""

    line: np.ndarray
    hash: np.ndarray
    text_of: np.ndarray
    number: np.ndarray


def words(texts: list[bytes]) -> Words:
    joined = b"\n".join(texts) + b"\n" + bytes(8)
    raw = np.frombuffer(joined, dtype=np.uint8)[:-8]
    white = _WHITE[raw]
    edges = np.flatnonzero(white[1:] != white[:-1]) + 1
    if not white[0]:
        edges = np.append(0, edges)
    start, stop = edges[0::2], edges[1::2]      # the last byte is white, so every word ends
    line_ends = np.flatnonzero(raw == 0x0A)
    per_line = np.diff(np.searchsorted(start, line_ends), prepend=0)
    line = np.repeat(np.arange(len(line_ends)), per_line)
    first_line = np.searchsorted(line_ends, np.cumsum([0, *(len(t) + 1 for t in texts[:-1])]))
    per_text = np.diff(np.append(first_line, len(line_ends)))
    text_of = np.repeat(np.arange(len(texts)), per_text)
    return Words(line, _hashes(joined, start, stop - start), text_of, np.arange(len(line_ends)) - first_line[text_of])


class Sets(NamedTuple):
    """Distinct words of every line, rarest first."""

    line: np.ndarray     # of each word
    hash: np.ndarray
    single: np.ndarray   # whether it is the only occurrence in the corpus
    size: np.ndarray     # words of each line


def sets(w: Words, levels: np.ndarray) -> Sets:
    level = levels[(w.hash & np.uint64(CELLS - 1)).astype(np.int64)].astype(np.uint64)
    bits = max(len(w.number), 1).bit_length()
    # line, level and the upper bits of the hash in one number; a tie of different words is rare and sorted in full
    packed = ((w.line.astype(np.uint64) << np.uint64(64 - bits)) | (level << np.uint64(64 - bits - LEVEL_BITS))
              | (w.hash >> np.uint64(bits + LEVEL_BITS)))
    order = np.argsort(packed)
    packed, hashes = packed[order], w.hash[order]
    if ((packed[1:] == packed[:-1]) & (hashes[1:] != hashes[:-1])).any():
        order = np.lexsort((w.hash, level, w.line))
        hashes = w.hash[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (w.line[1:] != w.line[:-1])     # the sort leaves lines where they are
    line = w.line[new]
    return Sets(line, hashes[new], (level[order] == 0)[new], np.bincount(line, minlength=len(w.number)))


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of runs of rows of about ``GROUP`` bytes."""
    texts = batch.column("text").to_pylist()
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= GROUP or i + 1 == len(texts):
            yield first, texts[first:i + 1]
            first, size = i + 1, 0


def level_parts(docs: DataFrame) -> DataFrame:
    """``(part, level)``: the bytes of ``levels`` in ``PARTS`` pieces."""
    small_batches(docs.sparkSession)
    width = CELLS // PARTS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(CELLS, dtype=np.int64)
        for b in batches:
            for _, texts in _groups(b):
                cell = (words(texts).hash & np.uint64(CELLS - 1)).astype(np.int64)
                counts += np.bincount(cell, minlength=CELLS)
        if counts.any():
            yield _parts(counts.reshape(PARTS, width), TaskContext.get().partitionId() % SPREAD)

    def _parts(counts: np.ndarray, share: int) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([share] * PARTS, pa.int32()),
                                           pa.array([c.astype("<i8").tobytes() for c in counts], pa.binary())], names=["part", "share", "counts"])

    def total(table: pa.Table) -> np.ndarray:
        out = np.zeros(width, dtype=np.int64)
        for raw in table.column("counts"):
            out += np.frombuffer(raw.as_buffer(), dtype="<i8")
        return out

    def add(table: pa.Table) -> pa.Table:
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "counts": pa.array([total(table).tobytes()], pa.binary())})

    def magnitude(table: pa.Table) -> pa.Table:
        level = np.minimum(2 * np.log2(np.maximum(total(table), 1)), (1 << LEVEL_BITS) - 1).astype(np.uint8)
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "level": pa.array([level.tobytes()], pa.binary())})

    # one Python operator a stage: with two, every core of an executor holds two workers for the rest of the application
    counted = docs.select("text").mapInArrow(count, "part int, share int, counts binary")
    added = counted.groupBy("part", "share").applyInArrow(add, "part int, counts binary")
    return added.groupBy("part").applyInArrow(magnitude, "part int, level binary")


def levels(docs: DataFrame) -> np.ndarray:
    """Magnitude of the occurrences in every cell (0: one occurrence at most), over all texts of ``docs(text binary)``."""
    out = np.zeros((PARTS, CELLS // PARTS), dtype=np.uint8)
    for r in level_parts(docs).collect():     # a byte per cell
        out[r["part"]] = np.frombuffer(bytes(r["level"]), dtype=np.uint8)
    return out.reshape(-1)


PREFIXES = "doc long, version long, line_no int, h1 long, h2 long, s1 long, s2 long, n int, skip int, prefix array<long>"


def prefixes(docs: DataFrame, levels: np.ndarray, p: int, q: int) -> DataFrame:
    """Every line with a word of ``docs(doc, version, text binary)``, prepared for a join at similarity ``p / q``.

    ``h1, h2`` tell its set of words; ``s1, s2`` are 128 bits set by them; ``n`` is the set's size; ``prefix`` has its
    ``n - ceil(n p / q) + 1`` rarest words without the ``skip`` first ones, which occur nowhere else.
    """
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc", pa.int64()), ("version", pa.int64()), ("line_no", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()),
                        ("s1", pa.int64()), ("s2", pa.int64()), ("n", pa.int32()), ("skip", pa.int32()), ("prefix", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, version = b.column("doc").to_numpy(), b.column("version").to_numpy()
            for first, texts in _groups(b):
                w = words(texts)
                if not len(w.line):
                    continue
                s = sets(w, levels)
                some = np.flatnonzero(s.size)
                n = s.size[some]
                begin = np.cumsum(n) - n
                own = np.repeat(np.arange(len(some)), n)
                length = n - (n * p + q - 1) // q + 1
                inside = np.arange(len(own)) - begin[own] < length[own]
                skip = np.bincount(own[inside & s.single], minlength=len(some))
                shared = inside & ~s.single
                offsets = np.append(0, np.cumsum(length - skip)).astype(np.int32)
                row = w.text_of[some] + first
                bit = np.uint64(1) << ((s.hash >> np.uint64(32)) & np.uint64(63))
                upper = (s.hash >> np.uint64(38)) & np.uint64(1) == 1
                signature = [np.bitwise_or.reduceat(np.where(of, bit, np.uint64(0)), begin).view(np.int64) for of in (~upper, upper)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(doc[row]), pa.array(version[row]), pa.array(w.number[some].astype(np.int32)),
                    pa.array(np.add.reduceat(mixed(s.hash), begin).view(np.int64)),
                    pa.array(np.add.reduceat(mixed(~s.hash), begin).view(np.int64)),
                    *map(pa.array, signature), pa.array(n.astype(np.int32)), pa.array(skip.astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(s.hash[shared].view(np.int64)))], schema=schema)

    return docs.select("doc", "version", "text").mapInArrow(run, PREFIXES)
