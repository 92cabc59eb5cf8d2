"""Anchored segments: how repeated windows of a corpus are found without moving every window.

A window is ``length`` consecutive units (bytes or words) of one document.  Its anchor
is the gram of ``gram`` units with the smallest hash in it, the leftmost of equals: a
function of the window's content alone.  Consecutive windows with the same anchor
occurrence form a segment.  So equal windows lie in segments with equal anchor hashes,
and only segments whose anchor occurs elsewhere can hold a repeated window.  Segments of
equal content are one class: all windows of a later member also start in the first member.

Long texts are read in blocks, so memory is bounded; hashes are 64 bits wide, and a class
is told by two of them (anchor and content).
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_POSITION_BITS = 22
BLOCK = 1 << 16      # units hashed at a time
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(of: int, n: int) -> np.ndarray:
    out = np.full(n, of, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    # the longest run ever hashed at once: a block, the windows' overlap into the next, and an end
    return _powers(_BASE, 1 << 18), _powers(_INVERSE, 1 << 18)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    """A pseudo-random 64-bit value for every byte."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        x = np.minimum(x[:-span], x[span:])
        span *= 2
    if span < width:
        x = np.minimum(x[:len(x) - (width - span)], x[width - span:])
    return x


class Hashes:
    """Content hashes of all ranges of a block of units."""

    def __init__(self, units: np.ndarray):
        up, self.down = _tables()
        self.sums = np.zeros(len(units) + 1, dtype=np.uint64)
        np.cumsum(units * up[:len(units)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.down[start] + (stop - start).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n] + np.uint64(size))


def _block_segments(units: np.ndarray, doc: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(start, windows, anchor, content) of the segments of a block; ``doc`` numbers the document of every unit."""
    n_windows = len(units) - length + 1
    hashes = Hashes(units)
    grams = hashes.grams(gram)
    place = np.uint64((1 << _POSITION_BITS) - 1)
    packed = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_min(packed, length - gram + 1) & place).astype(np.int64)
    whole = doc[:n_windows] == doc[length - 1:]          # windows that cross no document's end
    new = np.empty(n_windows, dtype=bool)
    new[0] = True
    new[1:] = (at[1:] != at[:-1]) | (whole[1:] != whole[:-1])
    start = np.flatnonzero(new)
    windows = np.diff(np.append(start, n_windows))
    keep = whole[start]
    start, windows = start[keep], windows[keep]
    return start, windows, grams[at[start]], hashes.of(start, start + windows + (length - 1))


def segments(values: list[np.ndarray], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(document number, start, windows, anchor, content) of all segments of the documents ``values``.

    Anchors and contents are returned as signed 64-bit integers.
    """
    out: list[tuple] = []
    held: list[tuple[int, int, np.ndarray]] = []  # (document, offset in it, units) waiting for a full block
    size = 0

    def flush() -> None:
        nonlocal size
        if held:
            units = np.concatenate([u for _, _, u in held])
            lengths = [len(u) for _, _, u in held]
            part = np.repeat(np.arange(len(held)), lengths)
            begins = np.cumsum([0, *lengths[:-1]])
            start, windows, anchor, content = _block_segments(units, part, length, gram)
            which = part[start]
            docs, offsets = np.array([d for d, _, _ in held]), np.array([o for _, o, _ in held])
            out.append((docs[which], offsets[which] + start - begins[which], windows, anchor.view(np.int64), content.view(np.int64)))
            held.clear()
            size = 0

    for number, units in enumerate(values):
        for at in range(0, max(len(units) - length + 1, 0), BLOCK):
            part = units[at:at + BLOCK + length - 1]
            held.append((number, at, part))
            size += len(part)
            if size >= BLOCK:
                flush()
    flush()
    if not out:
        return tuple(np.empty(0, dtype=np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*out))
