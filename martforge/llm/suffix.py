"""Suffix-array dedup of byte windows by merging shard Burrows-Wheeler transforms.

A byte is removed when a window of ``length`` bytes that covers it also starts in a
document with a smaller ``doc_id``; windows are judged on the input.

Anchored segments (see ``segments``) settle equal contents and leave the open ones: short
byte strings that share an anchor with a different content.  Equal windows share their
anchor, so the strings are dealt by it into buckets of a bounded size.  The strings of an
anchor with very many contents are cut into their windows.  Of every distinct window only
its smallest and its greatest document go on, found with partial results per task, and are
dealt by the window's own hash: however often a window occurs, a bucket holds it twice.
The other occurrences of the windows that the merge finds repeated are joined back by the
window.  In every bucket the strings form shards.  Each shard is suffix-sorted by itself and
gives its Burrows-Wheeler transform.  The merge never sorts suffixes again: the interleave of
the shards is refined once per byte of depth, through the symbols before the suffixes of
those blocks that parted in the pass before; all others rest.  Where two neighbours first
part at depth h, their longest common prefix is h - 1; after ``length`` passes, the
stretches without such a place are the repeated intervals.  In each, all windows but those of its smallest document are removed.

Null texts are empty.  Rows with a null ``doc_id`` come after all others and are not
smaller than each other.  Rows that agree in ``doc_id`` and text get the same result.  Extra
columns are kept by ``remove_repeats`` and ignored by ``report``.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.anchors import Hashes, byte_values
from martforge.llm.common import keyed, small_batches, written
from martforge.llm.segments import OPEN_HOT, REMOVED, covered, decided, packed

BUCKET_BYTES = 300_000
SHARDS = 4


def _ordered(key: np.ndarray, bits: int, place: np.ndarray, place_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(``place`` by ``key`` of ``bits`` bits, equal keys by place; the keys in that order)."""
    if bits + place_bits <= 64:  # one sort of plain numbers, which is much quicker than a sort of places
        both = np.sort((key << np.uint64(place_bits)) | place.astype(np.uint64))
        return (both & np.uint64((1 << place_bits) - 1)).astype(np.int64), both >> np.uint64(place_bits)
    order = np.lexsort((place, key))
    return place[order], key[order]


def suffix_order(symbols: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
    """Sorted suffixes of the strings in ``symbols``, each closed by a 0 at ``ends``; equal suffixes by place.

    Prefix doubling: a suffix ranks by the place where those that agree with it so far begin.
    A suffix that agrees with no other rests, and so do suffixes that are equal to their closing 0.
    """
    n = len(symbols)
    place = np.arange(n)
    to_end = np.repeat(ends, np.diff(np.append(-1, ends))) - place  # symbols before the closing 0
    place_bits, bits = n.bit_length(), int(symbols.max()).bit_length() or 1
    depth = max(1, min(8, (64 - place_bits) // bits))
    padded = np.append(symbols, np.zeros(depth, dtype=symbols.dtype)).astype(np.uint64)
    key = np.zeros(n, dtype=np.uint64)
    for j in range(depth):  # what follows the closing 0 is no part of the suffix
        key = (key << np.uint64(bits)) | np.where(to_end >= j, padded[j:j + n], 0)
    order, key = _ordered(key, depth * bits, place, place_bits)
    rank = np.empty(n, dtype=np.int64)
    at = place  # places in the order that are not settled yet
    while True:
        new = np.append(True, key[1:] != key[:-1])[:len(key)]
        rank[order[at]] = at[np.flatnonzero(new)][np.cumsum(new) - 1]
        alone = new & np.append(new[1:], True)
        at = at[~alone & (to_end[order[at]] >= depth)]
        if not len(at) or depth > longest:
            return order
        waiting = order[at]
        key = (rank[waiting].astype(np.uint64) << np.uint64(place_bits)) | rank[waiting + depth].astype(np.uint64)
        order[at], key = _ordered(key, 2 * place_bits, waiting, place_bits)
        depth *= 2


class Shard:
    """Burrows-Wheeler transform of some strings, with the places of its sorted suffixes."""

    def __init__(self, strings: list[bytes], at: int):
        wide = any(b"\xff" in s for s in strings)
        joined = np.frombuffer(b"\x00".join(strings) + b"\x00", dtype=np.uint8).astype(np.uint16 if wide else np.uint8)
        sizes = np.array([len(s) for s in strings])
        ends = np.cumsum(sizes + 1) - 1
        symbols = joined + joined.dtype.type(1)
        symbols[ends] = 0
        order = suffix_order(symbols, ends, int(sizes.max()) + 1)
        self.bwt = symbols[order - 1]  # before a string's start stands the 0 of the string before it
        self.place = order + at
        self.strings, self.size = len(strings), len(symbols)


def merge(shards: list[Shard], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of all suffixes, in the order of their first ``depth`` symbols; longest common prefix with the one before).

    Common prefixes of ``depth`` or more are given as ``depth``.

    A suffix is named by its number in the shards laid end to end, and ``block`` holds, for
    every suffix, the place where the suffixes that agree with it so far begin; inside a block
    they stand in the order of their numbers.  A block of depth h is one symbol before a block
    of depth h - 1, so it can part only where that one has just parted: a pass looks at the
    suffixes before those of parted blocks and at no others, and the merge ends with the last of them.
    """
    n, strings = sum(s.size for s in shards), sum(s.strings for s in shards)
    bwt = np.concatenate([s.bwt for s in shards])
    before = np.full(n, -1)   # as wide as an index, so that no pass converts it: the suffix one symbol longer; none before a string's own start
    closing = np.empty(strings, dtype=np.int64)
    at = strings_at = 0
    for s in shards:
        before[at + np.argsort(s.bwt, kind="stable")[s.strings:]] = at + np.arange(s.strings, s.size)
        closing[strings_at:strings_at + s.strings] = at + np.arange(s.strings)
        at, strings_at = at + s.size, strings_at + s.strings
    # depth 1: the closing 0s stand in front, each by itself; the other suffixes by their first symbol
    counts = np.bincount(bwt, minlength=2)
    starts = np.cumsum(counts) - counts
    block = np.empty(n, dtype=np.int32)
    longer = np.argsort(bwt, kind="stable")[strings:]
    block[before[longer]] = starts[bwt[longer]]
    block[closing] = np.arange(strings)
    common = np.full(n, depth, dtype=np.int16)
    common[:strings] = 0
    common[starts[counts > 0]] = 0
    parted = np.concatenate([closing, before[longer]])   # always in the order of the blocks
    for h in range(1, depth):
        symbol = bwt[parted]
        late = parted[np.argsort(symbol, kind="stable")[np.count_nonzero(symbol == 0):]]
        if not len(late):
            break
        parted = before[late]
        old, by = block[parted], block[late]
        new_block = np.append(True, old[1:] != old[:-1])
        part = np.flatnonzero(new_block | np.append(True, by[1:] != by[:-1]))
        first = new_block[part]
        number = np.cumsum(first) - 1
        inside = part - part[first][number]
        start = old[part] + inside
        size = np.diff(np.append(part, len(parted)))
        block[parted] = np.repeat(start, size)
        common[start[inside > 0]] = h
        parted = parted[np.repeat((np.bincount(number) > 1)[number], size)]
    places = np.concatenate([s.place for s in shards])
    return places[np.argsort(block, kind="stable")], common


def repeated_windows(strings: list[bytes], doc: np.ndarray, length: int, n_shards: int = SHARDS) -> list[tuple[int, int]]:
    """``(string, offset)`` of the windows that also start in a string of a document with a smaller number."""
    if len(strings) < 2:
        return []
    cuts = np.linspace(0, len(strings), min(n_shards, len(strings)) + 1).astype(int)
    begins = np.cumsum([0, *[len(s) + 1 for s in strings]])
    shards = [Shard(strings[a:b], int(begins[a])) for a, b in zip(cuts, cuts[1:])]
    places, common = merge(shards, length)
    same = common >= length
    same[0] = False
    interval = np.cumsum(~same) - 1
    first = np.flatnonzero(~same)
    string = np.repeat(np.arange(len(strings), dtype=np.int32), np.diff(begins))[places]
    owner = doc[string]
    smallest = np.minimum.reduceat(owner, first)
    late = np.flatnonzero(owner > smallest[interval])
    return list(zip(string[late].tolist(), (places[late] - begins[string[late]]).tolist()))


_CUT = pa.schema([("hot", pa.bool_()), ("key", pa.int64()), ("doc", pa.int64()), ("version", pa.int64()), ("start", pa.int64()), ("text", pa.binary())])
_REPEATED = pa.schema([("key", pa.int64()), ("text", pa.binary()), ("least", pa.int64())])
_FOUND = pa.schema([("doc", pa.int64()), ("version", pa.int64()), ("start", pa.int64()), ("n", pa.int32())])


def _cut(length: int):
    """The open segments' bytes; those of a hot anchor as single windows under their own hash."""
    def run(batches):
        values = byte_values()
        for b in batches:
            out: list[list] = [[] for _ in _CUT]
            for doc, version, text, segs in zip(*(b.column(c).to_pylist() for c in ("doc", "version", "text", "segs"))):
                for s in segs:
                    start, n = s["start"], s["n"]
                    piece = text[start:start + n + length - 1]
                    hot = s["kind"] == OPEN_HOT
                    if not hot:
                        rows = [(s["anchor"], start, piece)]
                    else:
                        at = np.arange(n)
                        keys = Hashes(values[np.frombuffer(piece, dtype=np.uint8)]).of(at, at + length).view(np.int64).tolist()
                        rows = [(key, start + i, piece[i:i + length]) for i, key in enumerate(keys)]
                    for key, at, part in rows:
                        for column, value in zip(out, (hot, key, doc, version, at, part)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, _CUT)], schema=_CUT)
    return run


def _merged(length: int):
    def run(t: pa.Table) -> pa.Table:
        doc, version, start = (t.column(c).to_numpy() for c in ("doc", "version", "start"))
        found = repeated_windows(t.column("text").to_pylist(), doc, length)
        string, offset = (np.array(x, dtype=np.int64) for x in (zip(*found) if found else ((), ())))
        order = np.lexsort((offset, string))
        string, offset = string[order], offset[order]
        # neighbouring windows of a string as one span
        new = np.append(True, (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1))[:len(string)]
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(string)))
        at = string[first]
        return pa.Table.from_arrays([pa.array(doc[at]), pa.array(version[at]), pa.array(start[at] + offset[first]), pa.array(n, type=pa.int32())], schema=_FOUND)
    return run


def _merged_windows(length: int):
    """``(key, text, least)`` of the windows that the merge finds in a greater document, too."""
    def run(t: pa.Table) -> pa.Table:
        found = repeated_windows(t.column("text").to_pylist(), t.column("doc").to_numpy(), length)
        return t.select(_REPEATED.names).take(pa.array([string for string, _ in found], type=pa.int64())).cast(_REPEATED)
    return run


def _buckets(size: int) -> int:
    return max(1, -(-int(size) // BUCKET_BYTES))


def hot_spans(windows: DataFrame, length: int) -> DataFrame:
    """``(doc, version, start, n)`` of the windows ``(key, doc, version, start, text)`` that also start in a smaller document."""
    # partial results per task: a window that a third of all documents hold is a few rows of the exchange
    owners = windows.groupBy("key", "text").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    owners = written(owners, "suffix-owners")
    buckets = _buckets(owners.count() * 2 * (length + 1))
    two = owners.select("key", "text", "least", F.explode(F.array("least", "most")).alias("doc"))
    repeated = two.withColumn("bucket", F.pmod("key", F.lit(buckets))).groupBy("bucket").applyInArrow(
        lambda t: _merged_windows(length)(t), "key long, text binary, least long")
    # one row of a window on the one side; a frequent window on the other is streamed, and a skewed part is split
    later = windows.join(written(repeated, "suffix-repeated"), ["key", "text"]).where("doc > least")
    return written(later.select("doc", "version", "start", F.lit(1).alias("n")), "suffix-hot-spans")


def _bytes() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")


def repeated_spans(docs: DataFrame, length: int = 50, gram: int = 24) -> DataFrame:
    """``(doc, version, spans)`` of every document with repeated windows; ``docs`` as given by ``keyed``."""
    texts = docs.select(F.col("__doc").alias("doc"), F.col("__version").alias("version"), _bytes().alias("text"))
    values = byte_values()
    segs = decided(texts, lambda t: values[np.frombuffer(t, dtype=np.uint8)], length, gram, within=False)
    todo = segs.where(f"kind <> {REMOVED}")
    size = F.col("n") + F.lit(length - 1)
    cold, hot = todo.agg(F.sum(F.when(F.col("kind") != OPEN_HOT, size)), F.sum(F.when(F.col("kind") == OPEN_HOT, size))).first()
    lists = todo.groupBy("doc", "version").agg(F.collect_set(F.struct("start", "n", "anchor", "kind")).alias("segs"))
    cut = texts.join(lists, ["doc", "version"]).select("doc", "version", "text", "segs").mapInArrow(
        _cut(length), "hot boolean, key long, doc long, version long, start long, text binary")
    if hot:  # read more than once
        cut = written(cut, "suffix-cut")
    found = cut.where("NOT hot").withColumn("bucket", F.pmod("key", F.lit(_buckets(cold or 0)))).groupBy("bucket").applyInArrow(
        lambda t: _merged(length)(t), "doc long, version long, start long, n int")
    found = written(found, "suffix-spans")
    if hot:
        found = found.union(hot_spans(cut.where("hot").drop("hot"), length))
    return written(packed(segs.where(f"kind = {REMOVED}").select("doc", "version", "start", "n").union(found)), "spans")


def _with_spans(docs: DataFrame, length: int, gram: int) -> DataFrame:
    base = keyed(docs)
    spans = repeated_spans(base, length, gram).select(F.col("doc").alias("__d"), F.col("version").alias("__v"), F.col("spans").alias("__spans"))
    small_batches(docs.sparkSession, 1000)
    return base.join(spans, (F.col("__doc") == F.col("__d")) & (F.col("__version") == F.col("__v")), "left")


def _kept(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    stops = [0, *[b for _, b in runs]]
    return b"".join(text[a:b] for a, b in zip(stops, [*[a for a, _ in runs], len(text)]))


def report(docs: DataFrame, length: int = 50, gram: int = 24) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row of ``docs``."""
    @F.pandas_udf("n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    def digest(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s in zip(text, spans):
            t = bytes(t)
            runs = covered(s, length, len(t))
            rows.append((len(t), sum(b - a for a, b in runs), len(runs), hashlib.sha256(_kept(t, runs)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    out = _with_spans(docs.select("doc_id", "text"), length, gram)
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), digest(_bytes(), F.col("__spans")).alias("d")).select("doc_id", "d.*")


def remove_repeats(docs: DataFrame, length: int = 50, gram: int = 24) -> DataFrame:
    """``docs`` without the removed bytes; null texts stay null, ``n_chars`` (if there) is brought up to date.

    Where a removed run begins or ends inside a character, what is left of that character goes, too.
    """
    @F.pandas_udf("string")
    def kept(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_kept(bytes(t), covered(s, length, len(t))).decode("utf-8", "ignore") for t, s in zip(text, spans)], dtype=object)

    out = _with_spans(docs, length, gram)
    out = out.withColumn("__new", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(kept(_bytes(), F.col("__spans"))))
    return out.select(*[F.col("__new").alias(c) if c == "text" else F.char_length("__new").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
                        else F.col(f"`{c}`") for c in docs.columns])
