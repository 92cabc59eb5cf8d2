"""Static range asymmetric numeral system over numpy lanes: blocks of symbols to bytes and back.

All blocks share one frequency table.  A block deals its symbols to interleaved lanes
(symbol i to lane i mod lanes); the lanes' states advance together, one step per row of
symbols, and share one stream of 32-bit words.  Checkpoints hold every lane's state and
the position in the stream at evenly spaced steps: all of a block's stretches between
checkpoints decode side by side, and a reader may start at any of them.  A block ends
with the CRC-32 of its bytes and names the CRC-32 of the table it was written with.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

_LOW = 31                        # states stay in [2**31, 2**63)
_HEADER = struct.Struct("<4sIQIIIQ")   # magic, table checksum, symbols, lanes, steps between checkpoints, checkpoints, words
_MAGIC = b"RTB1"
_STEPS = 512                     # a lane holds about so many symbols
_LANES = 2048
_CHECKPOINTS = 4


class Table:
    """Frequencies that sum to a power of two (or to nothing, for an empty corpus)."""

    def __init__(self, freq: np.ndarray):
        self.freq = np.asarray(freq, dtype=np.uint64)
        total = int(self.freq.sum())
        if total & (total - 1):
            raise ValueError("frequencies do not sum to a power of two")
        self.bits = max(total, 1).bit_length() - 1
        self.start = np.cumsum(self.freq, dtype=np.uint64) - self.freq
        self.symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        self.checksum = zlib.crc32(np.trim_zeros(self.freq, "b").astype("<u8").tobytes())

    @classmethod
    def of_counts(cls, counts: np.ndarray) -> Table:
        """Counts scaled to a power of two; every symbol that occurs keeps at least one slot."""
        counts = np.asarray(counts, dtype=np.int64)
        freq = np.zeros(len(counts), dtype=np.int64)
        seen = np.flatnonzero(counts)
        if len(seen):
            slots = 1 << max(16, len(seen).bit_length() + 3)
            freq[seen] = np.maximum(1, np.floor(counts[seen] / counts[seen].sum() * slots)).astype(np.int64)
            spare = slots - int(freq.sum())
            if spare >= 0:
                freq[np.argmax(freq)] += spare
            while spare < 0:  # the rare symbols' single slots come from the most frequent one
                top = int(np.argmax(freq))
                take = min(-spare, int(freq[top]) // 2)
                freq[top] -= take
                spare += take
        return cls(freq)


def encode(symbols: np.ndarray, table: Table) -> bytes:
    """One block."""
    n = len(symbols)
    lanes = min(_LANES, max(1, n // _STEPS))
    steps = -(-n // lanes)
    every = max(1, -(-steps // _CHECKPOINTS))
    if n and (int(symbols.max()) >= len(table.freq) or not table.freq[symbols].all()):
        raise ValueError("a symbol is missing from the frequency table")
    state = np.full(lanes, 1 << _LOW, dtype=np.uint64)
    freq, start = table.freq[symbols], table.start[symbols]
    room = freq << np.uint64(63 - table.bits)
    words: list[np.ndarray] = []
    saved: list[tuple[int, np.ndarray]] = []
    for step in range(steps - 1, -1, -1):
        at = slice(step * lanes, min(n, (step + 1) * lanes))
        x, f = state[:at.stop - at.start], freq[at]
        over = x >= room[at]
        words.append(x[over].astype("<u4"))  # the low 32 bits
        x = np.where(over, x >> np.uint64(32), x)
        q = x // f
        state[:at.stop - at.start] = (q << np.uint64(table.bits)) + (x - q * f) + start[at]
        if step % every == 0:
            saved.append((len(words), state.copy()))
    size = [len(w) for w in words]
    total = sum(size)
    # a decoder reads the words in the opposite order of the steps
    before = np.concatenate((np.cumsum(size[::-1])[::-1], [0])).astype(np.int64) if words else np.zeros(1, dtype=np.int64)
    saved.reverse()
    body = [struct.pack("<Q", int(before[made])) + s.astype("<u8").tobytes() for made, s in saved]
    stream = np.concatenate(words[::-1]).astype("<u4").tobytes() if words else b""
    raw = _HEADER.pack(_MAGIC, table.checksum, n, lanes, every, len(saved), total) + b"".join(body) + stream
    return raw + struct.pack("<I", zlib.crc32(raw))


class Block:
    """A checked block, ready to decode as a whole or from one of its checkpoints."""

    def __init__(self, raw: bytes, table: Table):
        if len(raw) < _HEADER.size + 4 or zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
            raise ValueError("damaged block: its checksum differs")
        magic, checksum, self.n, self.lanes, self.every, marks, n_words = _HEADER.unpack_from(raw)
        if magic != _MAGIC or checksum != table.checksum:
            raise ValueError("the block was written with another format or frequency table")
        self.table, at = table, _HEADER.size
        self.state = np.empty((marks, self.lanes), dtype=np.uint64)
        self.position = np.empty(marks, dtype=np.int64)
        for k in range(marks):
            self.position[k] = struct.unpack_from("<Q", raw, at)[0]
            self.state[k] = np.frombuffer(raw, dtype="<u8", count=self.lanes, offset=at + 8)
            at += 8 + 8 * self.lanes
        # reading past the stream's end is masked out below; one spare word keeps the index valid
        self.words = np.concatenate((np.frombuffer(raw, dtype="<u4", count=n_words, offset=at), [0])).astype(np.uint64)

    def stretch(self, k: int) -> tuple[int, int]:
        """First symbol of checkpoint ``k``'s stretch and the one after its last."""
        size = self.every * self.lanes
        return k * size, min(self.n, (k + 1) * size)

    def decode(self, first: int = 0, last: int | None = None) -> np.ndarray:
        """Symbols of the stretches of checkpoints ``first`` up to but without ``last``."""
        last = len(self.state) if last is None else last
        if first >= last:
            return np.empty(0, dtype=np.uint32)
        t, lanes = self.table, self.lanes
        state, position = self.state[first:last].copy(), self.position[first:last].copy()
        out = np.zeros((last - first, self.every, lanes), dtype=np.uint32)
        mask, bits, low = np.uint64((1 << t.bits) - 1), np.uint64(t.bits), np.uint64(1 << _LOW)
        ends = [self.stretch(k)[1] - self.stretch(k)[0] for k in range(first, last)]
        for step in range(self.every):
            rows = sum(e > step * lanes for e in ends)  # only the last stretch may be shorter
            if not rows:
                break
            width = np.full(rows, lanes)
            width[rows - 1] = min(lanes, ends[rows - 1] - step * lanes)
            x = state[:rows]
            slot = x & mask
            symbol = t.symbol[slot.astype(np.int64)]
            x = t.freq[symbol] * (x >> bits) + slot - t.start[symbol]
            live = np.arange(lanes) < width[:, None]
            need = (x < low) & live
            taken = np.cumsum(need, axis=1)
            word = self.words[np.minimum(position[:rows, None] + taken - 1, len(self.words) - 1) * need]
            state[:rows] = np.where(live, np.where(need, (x << np.uint64(32)) | word, x), state[:rows])
            position[:rows] += taken[:, -1]
            out[:rows, step] = symbol
        return np.concatenate([out[i].reshape(-1)[:e] for i, e in enumerate(ends)])
