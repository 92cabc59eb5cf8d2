"""Weighted acyclic automata over words: counts of word n-grams, built, united and composed as arrays.

An automaton has one level of states per word of an n-gram.  An arc carries a word and
the weight (the count) of the n-gram that ends with it; weight 0 marks a mere prefix.
N-grams come in sorted order.  Once all n-grams of a stretch are there, its states are
registered level by level, last words first: states with the same arcs become one
state, so common endings are stored once and the automaton is acyclic but no tree.

Words are numbered in byte order, so the order of packed numbers is the order of the
n-grams as lists of words.
"""

from __future__ import annotations

import io
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BITS = 21                      # of a word's number in a packed n-gram of up to three words
MAX_ORDER = 63 // BITS
MAX_WORDS = (1 << BITS) - 2    # 0 is "no word"

_ARC = np.dtype([("word", "<i4"), ("state", "<i4"), ("weight", "<i8")])


class Grams:
    """Sorted distinct n-grams with weights; ``key`` packs the numbers of their words in ``words``."""

    def __init__(self, words: pa.Array, key: np.ndarray, weight: np.ndarray, order: int):
        self.words, self.key, self.weight, self.order = words, key, weight, order

    def __len__(self) -> int:
        return len(self.key)

    def numbers(self) -> np.ndarray:
        """Column j holds the number (from 1) of word j of every n-gram, 0 where it is shorter."""
        shift = BITS * np.arange(self.order - 1, -1, -1)
        return (self.key[:, None] >> shift) & ((1 << BITS) - 1)

    def sizes(self) -> np.ndarray:
        return (self.numbers() > 0).sum(axis=1)

    def slice(self, lo: int, hi: int) -> Grams:
        """A stretch with the words that occur in it only."""
        part = Grams(self.words, self.key[lo:hi], self.weight[lo:hi], self.order)
        numbers = part.numbers()
        used = np.unique(numbers)
        used = used[used > 0]
        new = np.zeros(len(self.words) + 1, dtype=np.int64)
        new[used] = np.arange(1, len(used) + 1)
        return Grams(self.words.take(pa.array(used - 1)), pack(new[numbers]), part.weight, self.order)

    def phrases(self, at: np.ndarray) -> list[bytes]:
        """The words of the n-grams at these places, joined by one space."""
        words = [w + b" " for w in self.words.to_pylist()]
        lists = self.numbers()[at].tolist()
        return [b"".join([words[n - 1] for n in row if n])[:-1] for row in lists]


def pack(numbers: np.ndarray) -> np.ndarray:
    out = np.zeros(len(numbers), dtype=np.int64)
    for j in range(numbers.shape[1]):
        out = (out << BITS) | numbers[:, j]
    return out


def sorted_words(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(distinct words in byte order, the number from 1 of every input word); words are large binary."""
    coded = words.dictionary_encode()
    distinct = coded.dictionary
    order = pc.sort_indices(distinct).to_numpy()
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    return distinct.take(pa.array(order)), rank[coded.indices.to_numpy()] if len(words) else np.empty(0, dtype=np.int64)


def counted(words: pa.Array, piece: np.ndarray, order: int, skip: int = 0) -> Grams:
    """N-grams of 1 to ``order`` consecutive words of one piece with their counts; those that end within the first ``skip`` words do not count."""
    if not 1 <= order <= MAX_ORDER or len(words) > MAX_WORDS:
        raise ValueError(f"at most {MAX_ORDER} words a phrase and {MAX_WORDS} words at a time")
    distinct, number = sorted_words(words)
    keys = []
    for size in range(1, order + 1):
        start, stop = max(0, skip - size + 1), len(number) - size + 1
        if stop <= start:
            continue
        key = np.zeros(stop - start, dtype=np.int64)
        for j in range(size):
            key = (key << BITS) | number[start + j:stop + j]
        keys.append(key[piece[start:stop] == piece[start + size - 1:stop + size - 1]] << (BITS * (order - size)))
    key, weight = np.unique(np.concatenate(keys) if keys else np.empty(0, dtype=np.int64), return_counts=True)
    return Grams(distinct, key, weight.astype(np.int64), order)


def cut(grams: Grams, bounds: list[list[bytes]]) -> np.ndarray:
    """For every bound (ascending lists of words) the place of the first n-gram that is not below it."""
    vocabulary = grams.words.to_pylist()
    keys = np.zeros(len(bounds), dtype=np.int64)
    for i, bound in enumerate(bounds):
        key = 0
        for j in range(grams.order):
            at = bisect_left(vocabulary, bound[j]) if j < len(bound) else -1
            key = (key << BITS) | (at + 1)
            if at >= 0 and (at == len(vocabulary) or vocabulary[at] != bound[j]):
                key <<= BITS * (grams.order - 1 - j)   # the first word above the bound's, whatever follows
                break
        keys[i] = key
    return np.searchsorted(grams.key, keys)


def unions(parts: list[Grams], order: int) -> list[Grams]:
    """The n-grams of all parts with their weights summed: one stretch, or several where one would hold too many words."""
    parts = [p for p in parts if len(p)]
    if not parts:
        return []
    words, number = sorted_words(pa.concat_arrays([p.words for p in parts]))
    if len(words) > MAX_WORDS:
        largest = max(parts, key=len)
        middle = largest.phrases(np.array([len(largest) // 2]))[0].split(b" ")
        ends = [int(cut(p, [middle])[0]) for p in parts]
        return (unions([p.slice(0, e) for p, e in zip(parts, ends)], order)
                + unions([p.slice(e, len(p)) for p, e in zip(parts, ends)], order))
    keys, at = [], 0
    for p in parts:
        new = np.concatenate(([0], number[at:at + len(p.words)]))
        keys.append(pack(new[p.numbers()]))
        at += len(p.words)
    key, weight = np.concatenate(keys), np.concatenate([p.weight for p in parts])
    by_key = np.argsort(key, kind="stable")
    key, weight = key[by_key], weight[by_key]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return [Grams(words, key[first], np.add.reduceat(weight, first), order)]


class Transducer:
    """The minimal states of a stretch of n-grams: per level the arcs of all states and where each state begins."""

    def __init__(self, words: pa.Array, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.words, self.levels = words, levels   # level j: (arcs, offsets of its states); level 0 has one state

    @classmethod
    def build(cls, grams: Grams) -> Transducer:
        numbers, order = grams.numbers(), grams.order
        levels: list[tuple[np.ndarray, np.ndarray]] = []
        state_of = np.empty(0, dtype=np.int64)  # states of the level below, by the prefix that leads to them
        prefix_below = np.empty(0, dtype=np.int64)
        for j in range(order - 1, -1, -1):
            shift = BITS * (order - 1 - j)
            prefix = np.unique((grams.key >> shift)[numbers[:, j] > 0])   # every prefix of j + 1 words
            arcs = np.zeros(len(prefix), dtype=_ARC)
            arcs["word"] = prefix & ((1 << BITS) - 1)
            own = (numbers[:, j] > 0) & ((numbers[:, j + 1] == 0) if j + 1 < order else True)
            arcs["weight"][np.searchsorted(prefix, grams.key[own] >> shift)] = grams.weight[own]
            if len(prefix_below):
                arcs["state"][np.searchsorted(prefix, prefix_below)] = state_of + 1   # 0: no way on
            parent = prefix >> BITS
            first = np.flatnonzero(np.concatenate(([True], parent[1:] != parent[:-1]))) if len(parent) else np.empty(0, dtype=np.int64)
            offsets = np.append(first, len(prefix))
            # the register: states with equal arcs are one state
            raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(first), [
                None, pa.py_buffer((offsets * _ARC.itemsize).astype(np.int64)), pa.py_buffer(arcs.tobytes())]).dictionary_encode()
            state_of, prefix_below = raw.indices.to_numpy().astype(np.int64), parent[first]
            distinct = raw.dictionary
            buffers = distinct.buffers()
            ends = np.frombuffer(buffers[1], dtype=np.int64)[:len(distinct) + 1]
            kept = np.frombuffer(buffers[2] or b"", dtype=np.uint8)[ends[0]:ends[-1]].tobytes() if len(distinct) else b""
            levels.append((np.frombuffer(kept, dtype=_ARC), (ends - ends[0]) // _ARC.itemsize if len(distinct) else np.zeros(1, dtype=np.int64)))
        return cls(grams.words, levels[::-1])

    def grams(self) -> Grams:
        """All n-grams with a weight, in order."""
        order = len(self.levels)
        if not len(self.levels[0][0]):
            return Grams(self.words, np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), order)
        keys, weights = [], []
        prefix, state = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
        for j, (arcs, offsets) in enumerate(self.levels):
            lo, hi = offsets[state], offsets[state + 1]
            n = hi - lo
            at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())
            prefix = (np.repeat(prefix, n) << BITS) | arcs["word"][at]
            own = arcs["weight"][at] > 0
            keys.append(prefix[own] << (BITS * (order - 1 - j)))
            weights.append(arcs["weight"][at][own])
            on = arcs["state"][at] > 0
            prefix, state = prefix[on], arcs["state"][at][on].astype(np.int64) - 1
        key = np.concatenate(keys)
        by_key = np.argsort(key, kind="stable")
        return Grams(self.words, key[by_key], np.concatenate(weights)[by_key], order)

    def compose(self, wanted: list[list[bytes]]) -> np.ndarray:
        """Weight of each wanted n-gram (0 if absent): the paths that the wanted n-grams and this automaton share."""
        vocabulary = self.words.to_pylist()
        number = dict(zip(vocabulary, range(1, len(vocabulary) + 1)))
        out = np.zeros(len(wanted), dtype=np.int64)
        sizes = np.fromiter(map(len, wanted), dtype=np.int64, count=len(wanted))
        alive = np.flatnonzero((sizes > 0) & (sizes <= len(self.levels)))
        state = np.zeros(len(alive), dtype=np.int64)
        for j, (arcs, offsets) in enumerate(self.levels):
            if not len(alive) or not len(arcs):
                break
            word = np.fromiter((number.get(wanted[i][j], 0) for i in alive), dtype=np.int64, count=len(alive))
            # arcs are sorted by (state, word), so one search finds them all
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            have = (owner << BITS) | arcs["word"]
            at = np.minimum(np.searchsorted(have, (state << BITS) | word), len(have) - 1)
            hit = have[at] == ((state << BITS) | word)
            last = hit & (sizes[alive] == j + 1)
            out[alive[last]] = arcs["weight"][at[last]]
            on = hit & (sizes[alive] > j + 1) & (arcs["state"][at] > 0)
            alive, state = alive[on], arcs["state"][at[on]].astype(np.int64) - 1
        return out

    def dump(self) -> bytes:
        """Columns of an Arrow stream, compressed; small numbers are stored in few bytes by the codec."""
        sink = io.BytesIO()
        for arcs, offsets in self.levels:
            for column in (arcs["word"], arcs["state"], arcs["weight"], np.diff(offsets)):
                _put(sink, _narrow(np.ascontiguousarray(column)))
        _put(sink, pa.array([len(self.words)]).to_numpy())
        ends = np.frombuffer(self.words.buffers()[1], dtype=np.int64)[self.words.offset:self.words.offset + len(self.words) + 1] if len(self.words) else np.zeros(1, dtype=np.int64)
        _put(sink, _narrow(np.diff(ends)))
        data = self.words.buffers()[2]
        _put(sink, np.frombuffer(data, dtype=np.uint8)[ends[0]:ends[-1]] if data is not None else np.empty(0, dtype=np.uint8))
        raw = sink.getvalue()
        return len(raw).to_bytes(8, "little") + _CODEC.compress(raw, asbytes=True)

    @classmethod
    def load(cls, raw: bytes, order: int) -> Transducer:
        data = _CODEC.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), asbytes=True)
        source = io.BytesIO(data)
        levels = []
        for _ in range(order):
            word, state, weight, degree = (_get(source) for _ in range(4))
            arcs = np.empty(len(word), dtype=_ARC)
            arcs["word"], arcs["state"], arcs["weight"] = word, state, weight
            levels.append((arcs, np.concatenate(([0], np.cumsum(degree, dtype=np.int64)))))
        n = int(_get(source)[0])
        ends = np.concatenate(([0], np.cumsum(_get(source), dtype=np.int64)))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(_get(source).astype(np.uint8).tobytes())])
        return cls(words, levels)


_CODEC = pa.Codec("zstd", compression_level=1)


def _narrow(values: np.ndarray) -> np.ndarray:
    top = int(values.max(initial=0))
    kind = next(k for k in ("<u1", "<u2", "<u4", "<u8") if top <= np.iinfo(k).max)
    return values.astype(kind)


def _put(sink: io.BytesIO, values: np.ndarray) -> None:
    """Kind, length and the bytes of the values, all first bytes before all second ones: high bytes are mostly zero."""
    width = values.dtype.itemsize
    sink.write(width.to_bytes(1, "little") + len(values).to_bytes(8, "little"))
    sink.write(np.ascontiguousarray(values).view(np.uint8).reshape(-1, width).T.tobytes())


def _get(source: io.BytesIO) -> np.ndarray:
    width, n = source.read(1)[0], int.from_bytes(source.read(8), "little")
    raw = np.frombuffer(source.read(width * n), dtype=np.uint8).reshape(width, n)
    return np.ascontiguousarray(raw.T).view(f"<u{width}").reshape(-1).astype(np.int64)
