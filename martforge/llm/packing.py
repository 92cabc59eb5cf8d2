"""Best-fit packing of token sequences: vector best-fit over tokens, documents and attention cost.

1. *Pieces.*  One pass tokenizes every document (ids of the tokenizer file, then an
   end id) and cuts only documents longer than a sequence; the first piece is the
   one that may be shorter.  Ids themselves never leave the task.
2. *Plan.*  Pieces of equal length are interchangeable, so the corpus enters as a
   histogram of lengths: at most ``max_tokens`` rows at any size, with exact counts
   of all pieces.  Lengths go from long to short.  A length is placed into the open
   bins that fit under every capacity (residual tokens, residual documents, residual
   attention cost = sum of squared lengths) and that have the best score: the
   smallest weighted norm of what would stay free (``rule="norm"``) or the largest
   weighted dot-product of the length's demand and the residual (``rule="dot"``).
   Bins in the same state are one class with a multiplicity.  A step ends a length
   (at most ``max_tokens`` times) or moves a whole class one state further, and a
   state holds at most as many pieces as fit a bin, so the plan's size depends on
   the capacities, not on the corpus.
3. *Assignment.*  A piece's number among the pieces of its length is its place in its
   task plus the counts of the tasks before it; the plan's runs turn (length, number)
   into (sequence, offset).  No group is ever gathered: a length that a third of all
   documents share is numbered by all tasks at once.

Null texts are empty: their only token is the end id.  Repeated rows are documents
of their own, null ``doc_id`` rows too.  An empty table packs into nothing.  Extra
columns are ignored.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from martforge.llm.common import as_text, small_batches, text_bytes, written
from martforge.llm.word_tokens import Merges

_CACHE = 150_000  # remembered chunks of a generation; a worker process holds two
_STEP = 1 << 20  # chunks whose ids are joined at a time
_RUNS = regex.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = regex.compile(r"[^\S \n]|[\x00\x1c-\x1f\x85]")
# quick signs of it in UTF-8: ASCII controls, and the lead bytes of Unicode's white space
_CONTROLS = b"\x00\t\x0b\x0c\r\x1c\x1d\x1e\x1f"
_LEADS = (b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80")
_CONTROL = np.zeros(256, dtype=bool)
_CONTROL[list(_CONTROLS)] = True
# chunks of letters after at most one space are merged here, up to this many bytes
_LONGEST = 32
_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def _merges(path: str) -> Merges | None:
    """The merges of a byte-level file without other steps; a file of another layout is left to the library."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, cut = spec["model"], spec["pre_tokenizer"] or {}
    plain = not any(model.get(k) for k in ("dropout", "ignore_merges", "end_of_word_suffix", "continuing_subword_prefix"))
    known = (model["type"] == "BPE" and plain and not spec["normalizer"] and cut.get("type") == "ByteLevel"
             and not cut.get("add_prefix_space") and cut.get("use_regex", True))
    return Merges({**model, "end_of_word_suffix": ""}) if known else None


def _bytes_and_offsets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of strings, and where each one begins; one offset more for the end."""
    raw = texts.cast(pa.large_binary())
    if not len(raw):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    offsets = np.frombuffer(raw.buffers()[1], dtype=np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", dtype=np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def _odd_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts are empty, hold two neighbours of space and line end, begin or end with one, or show signs of other white space."""
    odd = np.diff(offsets) == 0
    if not len(data):
        return odd
    blank = (data == 0x20) | (data == 0x0A)
    bad = _CONTROL[data]
    bad[:-1] |= blank[:-1] & blank[1:]  # a pair across two texts ends the first one, which is odd for that
    for lead in _LEADS:
        at = np.flatnonzero(data == lead[0])
        for k, byte in enumerate(lead[1:], 1):
            at = at[data[np.minimum(at + k, len(data) - 1)] == byte]
        bad[at] = True
    odd[np.searchsorted(offsets, np.flatnonzero(bad), side="right") - 1] = True
    some = np.flatnonzero(np.diff(offsets))
    odd[some] |= blank[offsets[some]] | blank[offsets[some + 1] - 1]
    return odd


def _letters_only(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which chunks are letters (ASCII, and the Latin-1 letters written with the byte C3) after at most one space."""
    letter = _ASCII_LETTER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # the second half of Latin-1 is letters but for two signs
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    letter[lead] = letter[lead + 1] = True
    size = np.diff(offsets)
    letters = np.diff(np.concatenate(([0], np.cumsum(letter)))[offsets])
    spaced = np.zeros(len(size), dtype=np.int64)
    some = size > 0
    spaced[some] = data[offsets[:-1][some]] == 0x20
    return (letters > 0) & (letters == size - spaced) & (size <= _LONGEST)


class ChunkTokenizer:
    """Ids of whole texts, from the ids of their distinct chunks.

    For a byte-level pre-tokenizer without a prefix space, a text may be cut where a
    run of spaces and line ends begins after another character: tokens never cross
    that place.  Chunks of letters are one pre-token each; the distinct ones of a batch
    are merged side by side.  The library itself tokenizes every other chunk that is not
    remembered, many per call, and whole texts that hold other white space.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.merges = _merges(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def chunks(text: str) -> list[str]:
        if not text:
            return []
        raw = text.encode("utf-8", "surrogatepass")
        if len(raw.translate(None, _CONTROLS)) < len(raw) or any(lead in raw for lead in _LEADS):
            if _OTHER_SPACE.search(text):
                return [text]
        if not ("  " in text or "\n " in text or " \n" in text or text[0] in " \n" or text[-1] in " \n"):
            return text.replace(" ", "\x00 ").split("\x00")  # single inner spaces only
        return _RUNS.findall(text)

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """For every text its ids as little-endian unsigned 32-bit integers."""
        # every chunk once, in order of first appearance
        cut = [self.chunks(t) for t in texts]
        offsets = np.concatenate(([0], np.cumsum([len(c) for c in cut]))).astype(np.int64)
        coded = pa.array([c for chunks in cut for c in chunks], type=pa.large_string()).dictionary_encode()
        return self._joined(coded.dictionary, coded.indices, offsets)

    def batch_ids(self, texts: pa.Array) -> list[np.ndarray]:
        """As ``ids`` for an Arrow column; texts with single inner spaces only are cut and coded column-wise."""
        odd = _odd_texts(*_bytes_and_offsets(texts))
        out: list = [None] * len(texts)
        usual = np.flatnonzero(~odd)
        if len(usual):
            spaced = pc.replace_substring(texts.take(pa.array(usual)), " ", "\x00 ")
            # a line end between other characters is a token of its own, and so is one mark between a letter and white space
            spaced = pc.replace_substring_regex(spaced, r"([A-Za-z])([,.])(\x00|\n|$)", "\\1\x00\\2\\3")
            spaced = pc.replace_substring(spaced, "\n", "\x00\n\x00")
            lists = pc.split_pattern(spaced, "\x00")
            coded = lists.flatten().dictionary_encode()
            for i, got in zip(usual, self._joined(coded.dictionary, coded.indices, lists.offsets.to_numpy())):
                out[i] = got
        rest = np.flatnonzero(odd)
        for i, got in zip(rest, self.ids([texts[i].as_py() for i in rest]) if len(rest) else []):
            out[i] = got
        return out

    def _remember(self, chunk: str, ids: bytes) -> None:
        """Chunks that are in use move on to the younger generation; the older one goes as a whole."""
        if len(self.known) >= _CACHE:
            self.older, self.known = self.known, {}
        self.known[chunk] = ids

    def _distinct(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first id of every chunk, number of its ids)."""
        n = len(distinct)
        own = np.empty(0, dtype=np.int64)
        own_ids, own_first = np.empty(0, dtype="<u4"), np.zeros(1, dtype=np.int64)
        if self.merges is not None and n:
            data, offsets = _bytes_and_offsets(distinct)
            own = np.flatnonzero(_letters_only(data, offsets))
            size = np.diff(offsets)[own]
            packed = data[np.repeat(offsets[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
            own_ids, own_first = self.merges.ids(packed, np.concatenate(([0], np.cumsum(size))))
        left = np.ones(n, dtype=bool)
        left[own] = False
        other = np.flatnonzero(left)
        found = self._by_library(distinct.take(pa.array(other)).to_pylist())
        many = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        start, length = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        start[own], length[own] = own_first[:-1], np.diff(own_first)
        start[other], length[other] = len(own_ids) + np.cumsum(many) - many, many
        return np.concatenate([own_ids, np.frombuffer(b"".join(found), dtype="<u4")]), start, length

    def _by_library(self, words: list[str]) -> list[bytes]:
        found = list(map(self.known.get, words))
        missing = []
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = again = self.older.get(words[i])
                if again is None:
                    missing.append(i)
                else:
                    self._remember(words[i], again)
        for at in range(0, len(missing), 10_000):
            part = missing[at:at + 10_000]
            for i, got in zip(part, self.library.encode_batch_fast([words[i] for i in part], add_special_tokens=False)):
                found[i] = array("I", got.ids).tobytes()
                if len(words[i]) <= 64:
                    self._remember(words[i], found[i])
        return found

    def _joined(self, distinct: pa.Array, codes: pa.Array, offsets: np.ndarray) -> list[np.ndarray]:
        """Ids of the texts whose chunks are ``distinct[codes]`` between neighbouring offsets."""
        ids, start, length = self._distinct(distinct)
        codes = codes.to_numpy(zero_copy_only=False)
        ends = np.concatenate(([0], np.cumsum(length[codes])))
        at = ends[offsets]  # first id of each text
        flat = np.empty(int(ends[-1]), dtype="<u4")
        for a in range(0, len(codes), _STEP):  # the index is built a piece at a time
            c = codes[a:a + _STEP]
            lo, hi = ends[a], ends[min(a + _STEP, len(codes))]
            flat[lo:hi] = ids[np.repeat(start[c] - (ends[a:a + len(c)] - lo), length[c]) + np.arange(hi - lo)]
        return [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


@lru_cache(maxsize=4)
def tokenizer(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def cut_points(n: int, max_tokens: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole if it fits, else full pieces after a first one that may be shorter."""
    if n <= max_tokens:
        return [(0, n)]
    first = n % max_tokens or max_tokens
    return [(0, first), *[(at, max_tokens) for at in range(first, n, max_tokens)]]


PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, nth long"


def pieces(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece; ``nth`` numbers the pieces of one length within their ``task``.

    A task's rows and their order are fixed by the input files, so a recomputed task numbers alike.
    """
    small_batches(docs.sparkSession, 2000)
    end = array("I", [end_id]).tobytes()
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
                        ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library, task = tokenizer(tokenizer_path), TaskContext.get().partitionId()
        seen = [0] * (max_tokens + 1)
        for b in batches:
            out: list[list] = [[] for _ in schema]
            for doc_id, ids in zip(b.column(0).to_pylist(), library.batch_ids(as_text(b.column(1)))):
                raw = ids.tobytes() + end
                for k, (start, length) in enumerate(cut_points(len(raw) // 4, max_tokens)):
                    row = (doc_id, k, start, length, zlib.crc32(raw[4 * start:4 * (start + length)]), task, seen[length])
                    seen[length] += 1
                    for column, value in zip(out, row):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, schema)], schema=schema)

    return text_bytes(docs).mapInArrow(run, PIECES)


class Plan:
    """Runs of equal-length pieces placed into consecutive bins, sorted by (length, first number)."""

    def __init__(self, histogram: dict[int, int], max_tokens: int, max_documents: int, max_attention: int,
                 weights: tuple[float, float, float] = (1.0, 0.05, 0.05), rule: str = "norm"):
        if rule not in ("norm", "dot"):
            raise ValueError("rule is 'norm' or 'dot'")
        cap = np.array([max_tokens, max_documents, max_attention], dtype=np.float64)
        w = np.array(weights)
        free = np.empty((0, 3), dtype=np.int64)      # residuals of every class of bins in the same state
        first = np.empty(0, dtype=np.int64)          # its first bin
        many = np.empty(0, dtype=np.int64)           # its bins
        runs: list[tuple[int, int, int, int]] = []   # length, first number, first bin, offset
        self.bins = 0

        def opened(res: list[list[int]], at: list[int], n: list[int]) -> None:
            nonlocal free, first, many
            free = np.vstack([free, np.array(res, dtype=np.int64).reshape(-1, 3)])
            first, many = np.append(first, at), np.append(many, n)

        for length in sorted(histogram, reverse=True):
            left, number = histogram[length], 0
            demand = np.array([length, 1, length * length], dtype=np.int64)
            if (demand > cap).any():
                raise ValueError(f"a piece of {length} tokens fits no bin")
            while left:
                fits = np.flatnonzero((free >= demand).all(axis=1))
                if not len(fits):
                    break
                rest = (free[fits] - demand) / cap
                score = -(w * rest * rest).sum(axis=1) if rule == "norm" else (w * (demand / cap) * (free[fits] / cap)).sum(axis=1)
                best = fits[int(np.argmax(score))]
                k = int(min(left, many[best]))
                runs.append((length, number, int(first[best]), max_tokens - int(free[best, 0])))
                number, left = number + k, left - k
                state = free[best] - demand
                if k == many[best]:
                    free[best] = state
                else:
                    at = int(first[best])
                    first[best] += k
                    many[best] -= k
                    opened([state.tolist()], [at], [k])
            if left:  # new bins, each filled with this length as far as it goes
                per_bin = int(min(c // d for c, d in zip(cap.astype(np.int64).tolist(), demand.tolist())))
                full, odd = divmod(left, per_bin)
                for bins, each in ((full, per_bin), (1 if odd else 0, odd)):
                    if bins:
                        for j in range(each):
                            runs.append((length, number, self.bins, j * length))
                            number += bins
                        opened([(cap.astype(np.int64) - each * demand).tolist()], [self.bins], [bins])
                        self.bins += bins
            # states without room for the shortest length left need no further look
            keep = free[:, 0] > 0
            if not keep.all():
                free, first, many = free[keep], first[keep], many[keep]
        table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
        self.length, self.number, self.bin, self.offset = table.T.copy()

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the pieces with these lengths and numbers among their length."""
        stride = int(max(self.number.max(initial=0), number.max(initial=0))) + 1
        at = np.searchsorted(self.length * stride + self.number, length * stride + number, side="right") - 1
        return self.bin[at] + (number - self.number[at]), self.offset[at]


def pack(docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, max_documents: int | None = None,
         max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.05, 0.05),
         rule: str = "norm", end_id: int = 0) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``: one row per piece.

    ``max_documents`` and ``max_attention`` default to what ``max_tokens`` one-token
    documents and one full piece need, so that only tokens bind.
    """
    cut = written(pieces(docs, tokenizer_path, max_tokens, end_id), "pieces")
    tallies = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    tallies = written(tallies.withColumn("before", F.coalesce(before, F.lit(0))), "tallies")
    # one row per length, max_tokens rows at most
    histogram = {r["length"]: r["n"] for r in tallies.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = Plan(histogram, max_tokens, max_documents or max_tokens, max_attention or max_tokens * max_tokens, weights, rule)
    numbered = cut.join(tallies.drop("n"), ["length", "task"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("before") + F.col("nth")).alias("number"))
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                        ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seq, offset = plan.place(b.column("length").to_numpy(), b.column("number").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(seq), pa.array(offset)], schema=schema)

    return numbered.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
