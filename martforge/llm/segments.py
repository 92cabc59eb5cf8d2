"""The corpus pass over anchored segments: which windows are certainly repeated, and which need a closer look.

``decided`` gives rows ``(kind, doc, version, start, n, anchor)`` for segments of ``n`` windows:

* ``REMOVED``: every window also starts earlier, in an equal segment;
* ``OPEN``: the first of its class, while other contents share its anchor: an operator's own
  method must compare its windows with theirs;
* ``OPEN_HOT``: the same, for an anchor with more open segments than one task should hold.

Segments whose anchor occurs in one content only need nothing more.  A task first settles
what it can from its own rows, so of a passage that a third of all documents share each
task sends one segment per content.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martforge.llm.anchors import segments
from martforge.llm.common import shuffle_partitions, small_batches, written

REMOVED, OPEN, OPEN_HOT = 0, 1, 2
HOT = 4096          # open segments of one anchor that are still dealt as a whole
SPAN_BITS = 10      # a span is packed as start << SPAN_BITS | windows

_SENT = pa.schema([("bucket", pa.int32()), ("anchor", pa.list_(pa.int64())), ("content", pa.list_(pa.int64())), ("doc", pa.list_(pa.int64())),
                   ("version", pa.list_(pa.int64())), ("start", pa.list_(pa.int64())), ("n", pa.list_(pa.int16()))])
_SENT_SQL = "bucket int, anchor array<long>, content array<long>, doc array<long>, version array<long>, start array<long>, n array<short>"
_OUT = pa.schema([("kind", pa.int8()), ("doc", pa.int64()), ("version", pa.int64()), ("start", pa.int64()), ("n", pa.int32()), ("anchor", pa.int64())])
_OUT_SQL = "kind byte, doc long, version long, start long, n int, anchor long"


def _settle(anchor, content, doc, version, start, within: bool):
    """(order by class and place, anchor begins, first row of each row's class, rows that an equal earlier segment settles)."""
    order = np.lexsort((start, version, doc, content, anchor))
    a, c, d = anchor[order], content[order], doc[order]
    new_anchor = np.append(True, a[1:] != a[:-1])[:len(a)]
    new_class = new_anchor | np.append(True, c[1:] != c[:-1])[:len(a)]
    first = np.flatnonzero(new_class)[np.cumsum(new_class) - 1]
    if within:  # equal rows of the input are the same place
        v, s = version[order], start[order]
        later = (d != d[first]) | (v != v[first]) | (s != s[first])
    else:
        later = d > d[first]
    return order, new_anchor, new_class, later


def _lists(columns: list[np.ndarray], bounds: np.ndarray, buckets: np.ndarray) -> pa.RecordBatch:
    offsets = pa.array(bounds, type=pa.int32())
    lists = [pa.ListArray.from_arrays(offsets, pa.array(c, type=f.type.value_type)) for c, f in zip(columns, list(_SENT)[1:])]
    return pa.RecordBatch.from_arrays([pa.array(buckets, type=pa.int32()), *lists], schema=_SENT)


def decided(docs: DataFrame, units: Callable[[bytes], np.ndarray], length: int, gram: int, within: bool) -> DataFrame:
    """``docs``: ``(doc, version, text)`` with text as bytes; ``units`` turns a text into 64-bit values.

    ``within``: whether a repetition inside one document counts, too.
    """
    if not 0 < gram <= length or length - gram + 1 >= 1 << SPAN_BITS:
        raise ValueError("gram must be in 1..length, and windows per segment are bounded")
    spark = docs.sparkSession
    small_batches(spark, 2000)
    parts = shuffle_partitions(spark)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            number, start, n, anchor, content = segments([units(t) for t in b.column("text").to_pylist()], length, gram)
            if not len(number):
                continue
            doc, version = b.column("doc").to_numpy()[number], b.column("version").to_numpy()[number]
            order, _, _, later = _settle(anchor, content, doc, version, start, within)
            settled = np.zeros(len(order), dtype=bool)
            settled[order[later]] = True
            bucket = (anchor.view(np.uint64) % np.uint64(parts)).astype(np.int32)
            for rows, known in ((np.flatnonzero(~settled), False), (np.flatnonzero(settled), True)):
                if len(rows):
                    rows = rows[np.argsort(bucket[rows], kind="stable")]
                    own = bucket[rows]
                    bounds = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
                    columns = [anchor[rows], content[rows], doc[rows], version[rows], start[rows], n[rows]]
                    if known:  # told by a negative length; the hashes are of no more use
                        columns[0], columns[1], columns[5] = np.zeros_like(columns[0]), np.zeros_like(columns[1]), -columns[5]
                    yield _lists(columns, np.append(bounds, len(rows)), own[bounds])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got: list[list[np.ndarray]] = [[] for _ in range(6)]
        for b in batches:
            for held, name in zip(got, ("anchor", "content", "doc", "version", "start", "n")):
                held.append(b.column(name).flatten().to_numpy())
        if not got[0]:
            return
        anchor, content, doc, version, start, n = (np.concatenate(g) for g in got)
        known = n < 0
        if known.any():
            yield from _rows(np.full(known.sum(), REMOVED), doc[known], version[known], start[known], -n[known], anchor[known])
            anchor, content, doc, version, start, n = (x[~known] for x in (anchor, content, doc, version, start, n))
        if not len(anchor):
            return
        order, new_anchor, new_class, later = _settle(anchor, content, doc, version, start, within)
        group = np.cumsum(new_anchor) - 1
        begins = np.flatnonzero(new_anchor)
        contents = np.add.reduceat(new_class.astype(np.int64), begins)
        is_open = ~later & (contents > 1)[group]
        hot = (np.add.reduceat(is_open.astype(np.int64), begins) > HOT)[group]
        kind = np.where(later, REMOVED, np.where(hot, OPEN_HOT, OPEN))
        take = later | is_open
        rows = order[take]
        yield from _rows(kind[take], doc[rows], version[rows], start[rows], n[rows], anchor[rows])

    def _rows(kind, doc, version, start, n, anchor) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(kind), 100_000):
            cut = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(x[cut], type=f.type) for x, f in zip((kind, doc, version, start, n, anchor), _OUT)], schema=_OUT)

    sent = docs.mapInArrow(send, _SENT_SQL)
    return written(sent.repartitionById(parts, F.col("bucket")).mapInArrow(settle, _OUT_SQL), "segments")


def packed(spans: DataFrame) -> DataFrame:
    """``(doc, version, spans)``: the packed spans of every document, in order."""
    one = F.shiftleft(F.col("start"), SPAN_BITS).bitwiseOR(F.col("n").cast("long"))
    return spans.groupBy("doc", "version").agg(F.sort_array(F.collect_set(one)).alias("spans"))


def covered(spans: np.ndarray | None, length: int, size: int) -> list[tuple[int, int]]:
    """The maximal runs of units that the packed, ordered spans of windows cover."""
    if spans is None or not len(spans):
        return []
    spans = np.asarray(spans, dtype=np.int64)
    start = spans >> SPAN_BITS
    stop = np.maximum.accumulate(start + (spans & ((1 << SPAN_BITS) - 1)) + length - 1)
    new = np.append(True, start[1:] > stop[:-1])[:len(start)]
    first = np.flatnonzero(new)
    return list(zip(start[first].tolist(), np.minimum(stop[np.append(first[1:] - 1, len(stop) - 1)], size).tolist()))
