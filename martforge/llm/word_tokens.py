"""Ids of whole texts for a word-level byte-pair tokenizer file, a batch at a time.

The tokenizer's patterns drop white space and never join a letter, a digit or a mark
with a character of another of these kinds, so texts may be cut there.  No cut is made
beside the characters that take part in longer patterns: apostrophes (contractions),
the brackets and bars of special strings, control characters, and whatever is neither
ASCII nor a plain Latin-1 letter (compositions, other scripts).

A chunk without such characters is one pre-token.  The distinct chunks of a batch are
merged side by side, as rows of a matrix: every round merges each row's first pair of
lowest rank, until no row has a pair left.  The library itself tokenizes all other
chunks, many per call; two bounded generations of those are remembered per worker.
A file with other patterns is left to the library as a whole.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

_GENERATION = 200_000   # remembered chunks of a generation
_LONGEST = 64           # bytes of a remembered chunk
_STEP = 1 << 20         # chunks whose ids are joined at a time
_WIDTHS = (1, 2, 4, 6, 8, 10, 12, 16, 24, 32)   # chunks of at most so many bytes are merged together
_NONE = np.iinfo(np.int64).max

_SPACE, _LETTER, _DIGIT, _MARK, _GLUE = range(5)


def _kinds() -> np.ndarray:
    kind = np.full(256, _GLUE, dtype=np.uint8)
    kind[[0x20, *range(0x09, 0x0E)]] = _SPACE
    kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
    kind[0x30:0x3A] = _DIGIT
    kind[[c for c in range(0x21, 0x7F) if kind[c] == _GLUE and chr(c) not in "'<|>"]] = _MARK
    return kind


_KIND = _kinds()
# whether a cut lies between two neighbouring bytes of these kinds; beside white space there always is one
_CUT = np.array([[a != b if _SPACE in (a, b) else _GLUE not in (a, b) and (a != b or a == _DIGIT) for b in range(5)] for a in range(5)])
# the layout this module knows; fixed values of the tokenizer file
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]


def _byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if it is printable, else the next one from 256 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """Byte-pair merging of many chunks at a time."""

    def __init__(self, model: dict):
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.inner = np.array([vocab[c] for c in _byte_symbols()], dtype=np.int64)
        self.last = np.array([vocab[c + end] for c in _byte_symbols()], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        # the end of a word is marked in the second symbol only
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.rank = np.argsort(key, kind="stable")
        self.key = key[self.rank]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, or ``_NONE``; symbols below 0 stand for nothing."""
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key) & (a >= 0) & (b >= 0), self.rank[at], _NONE)

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first id of every chunk and the end); chunks have 1 to ``_WIDTHS[-1]`` bytes."""
        size = np.diff(offsets)
        count = np.zeros(len(size), dtype=np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        for low, width in zip((0, *_WIDTHS), _WIDTHS):
            row = np.flatnonzero((size > low) & (size <= width))
            place = np.arange(width)
            inside = place < size[row][:, None]
            raw = data[np.where(inside, offsets[row][:, None] + place, 0)]
            table = np.where(inside, self.inner[raw], -1)
            table[np.arange(len(row)), size[row] - 1] = self.last[raw[np.arange(len(row)), size[row] - 1]]
            table = np.hstack([table, np.full((len(row), 1), -1)])
            rank = self.ranks(table[:, :-1], table[:, 1:])       # the last column is always _NONE
            while len(row):
                at = rank.argmin(axis=1)
                best = rank[np.arange(len(row)), at]
                over = best == _NONE
                if over.any():
                    count[row[over]] = (table[over] >= 0).sum(axis=1)
                    done.append((row[over], table[over]))
                    row, table, rank, at, best = row[~over], table[~over], rank[~over], at[~over], best[~over]
                    if not len(row):
                        break
                each, shift = np.arange(len(row)), place + (place > at[:, None])
                rank = np.take_along_axis(np.hstack([rank, np.full((len(row), 1), _NONE)]), shift, axis=1)
                table[:, :-1] = np.take_along_axis(table, shift, axis=1)
                table[each, at] = self.merged[best]
                rank[each, at] = self.ranks(table[each, at], table[each, at + 1])
                left = np.flatnonzero(at > 0)
                rank[left, at[left] - 1] = self.ranks(table[left, at[left] - 1], table[left, at[left]])
        first = np.concatenate(([0], np.cumsum(count)))
        out = np.empty(int(first[-1]), dtype=np.uint32)
        for row, table in done:
            held = table >= 0
            out[(first[row][:, None] + np.arange(table.shape[1]))[held]] = table[held]
        return out, first


def _merges(path: str) -> Merges | None:
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    cuts = [p.get("pattern", {}).get("Regex") for p in (spec["pre_tokenizer"] or {}).get("pretokenizers", [])]
    known = model["type"] == "BPE" and model["end_of_word_suffix"] and not model["dropout"] and steps == _NORMALIZERS and cuts == [_SPLIT, None]
    return Merges(model) if known else None


class WordTokenizer:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        self.merges = _merges(path)
        self.known: dict[bytes, np.ndarray] = {}
        self.older: dict[bytes, np.ndarray] = {}

    def batch_ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, first id of every text and the end)."""
        if self.merges is None:
            got = [np.array(e.ids, dtype=np.uint32) for e in self.library.encode_batch_fast([t.decode("utf-8", "replace") for t in texts], add_special_tokens=False)]
            return np.concatenate([np.empty(0, dtype=np.uint32), *got]), np.concatenate(([0], np.cumsum([len(g) for g in got]))).astype(np.int64)
        joined = b"\n".join(texts)  # a line end is white space to every text
        raw = np.frombuffer(joined, dtype=np.uint8)
        if not len(raw):
            return np.empty(0, dtype=np.uint32), np.zeros(len(texts) + 1, dtype=np.int64)
        begins = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), dtype=np.int64, count=len(texts)) + 1)))[:-1]
        kind = _KIND[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)  # Latin-1 letters: all of its second half but the two signs
        lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        if b"<|" not in joined:
            # the normalizer lower-cases; before any other character a letter may have to be composed first
            plain = np.append(kind[1:] != _GLUE, True) | np.append(raw[1:] < 0x80, True)
            raw = raw.copy()
            upper = np.flatnonzero((raw >= 0x41) & (raw <= 0x5A) & plain)
            raw[upper] += 32
            second = lead + 1
            second = second[(raw[second] >= 0x80) & (raw[second] <= 0x9E) & plain[second]]
            raw[second] += 32
        else:
            upper = (raw >= 0x41) & (raw <= 0x5A)
            upper[lead + 1] |= raw[lead + 1] <= 0x9E
            kind[upper] = _GLUE  # left to the library as they are
            kind[lead] = kind[lead + 1]
        edge = np.concatenate(([0], np.flatnonzero(_CUT.reshape(-1)[kind[:-1] * 5 + kind[1:]]) + 1, [len(raw)]))
        start, stop = edge[:-1], edge[1:]
        ink = kind[start] != _SPACE
        start, stop = start[ink], stop[ink]
        offsets = np.concatenate(([0], np.cumsum(stop - start)))
        packed = raw[kind != _SPACE]
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(packed)]).dictionary_encode()
        ids, begin = self._chunks(coded.dictionary)
        codes, length = coded.indices.to_numpy(), np.diff(begin)
        ends = np.concatenate(([0], np.cumsum(length[codes]))) if len(codes) else np.zeros(1, dtype=np.int64)
        flat = np.empty(int(ends[-1]), dtype=np.uint32)
        for a in range(0, len(codes), _STEP):
            c = codes[a:a + _STEP]
            lo, hi = ends[a], ends[min(a + _STEP, len(codes))]
            flat[lo:hi] = ids[np.repeat(begin[c] - (ends[a:a + len(c)] - lo), length[c]) + np.arange(hi - lo)]
        return flat, ends[np.append(np.searchsorted(start, begins), len(start))]

    def _chunks(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first id of every chunk and the end)."""
        n = len(distinct)
        if not n:
            return np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)
        offsets = np.frombuffer(distinct.buffers()[1], dtype=np.int64)[:n + 1]
        data = np.frombuffer(distinct.buffers()[2], dtype=np.uint8)
        # a text's upper-case letters that are still there, and every byte of no plain kind, go to the library
        kind = _KIND[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        lead = lead[(data[lead + 1] >= 0x9F) & (data[lead + 1] != 0xB7)]
        kind[lead] = kind[lead + 1] = _LETTER
        odd = np.concatenate(([0], np.cumsum((kind == _GLUE) | ((data >= 0x41) & (data <= 0x5A)))))
        simple = (odd[offsets[1:]] == odd[offsets[:-1]]) & (np.diff(offsets) <= _WIDTHS[-1])
        own = np.flatnonzero(simple)
        size = np.diff(offsets)[own]
        own_data = data[np.repeat(offsets[own] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        ids, first = self.merges.ids(own_data, np.concatenate(([0], np.cumsum(size)))) if len(own) else (np.empty(0, dtype=np.uint32), np.zeros(1, dtype=np.int64))
        other = np.flatnonzero(~simple)
        got = self._by_library(distinct.take(pa.array(other)).to_pylist())
        length = np.zeros(n, dtype=np.int64)
        length[own] = np.diff(first)
        length[other] = np.fromiter(map(len, got), dtype=np.int64, count=len(got))
        begin = np.concatenate(([0], np.cumsum(length)))
        out = np.empty(int(begin[-1]), dtype=np.uint32)
        take = length[own]
        out[np.repeat(begin[own] - (np.cumsum(take) - take), take) + np.arange(take.sum())] = ids
        if got:
            take = length[other]
            out[np.repeat(begin[other] - (np.cumsum(take) - take), take) + np.arange(take.sum())] = np.concatenate(got)
        return out, begin

    def _remember(self, chunk: bytes, ids: np.ndarray) -> None:
        if len(chunk) > _LONGEST:
            return
        if len(self.known) >= _GENERATION:
            self.older, self.known = self.known, {}
        self.known[chunk] = ids

    def _by_library(self, distinct: list[bytes]) -> list[np.ndarray]:
        found = list(map(self.known.get, distinct))
        missing = []
        for i, ids in enumerate(found):
            if ids is None:
                found[i] = again = self.older.get(distinct[i])
                if again is None:
                    missing.append(i)
                else:
                    self._remember(distinct[i], again)
        for at in range(0, len(missing), 20_000):
            part = missing[at:at + 20_000]
            texts = [distinct[i].decode("utf-8", "replace") for i in part]
            for i, got in zip(part, self.library.encode_batch_fast(texts, add_special_tokens=False)):
                found[i] = np.array(got.ids, dtype=np.uint32)
                self._remember(distinct[i], found[i])
        return found


@lru_cache(maxsize=4)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)
