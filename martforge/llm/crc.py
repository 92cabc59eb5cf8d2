"""CRC-32 of concatenations, computed from the CRC-32 of the parts.

Appending n bytes multiplies a checksum by a fixed linear map, so the checksum of
``a + b`` is ``map(len(b))(crc(a)) ^ crc(b)``.  A map is held as four tables of 256
entries, one per byte of the checksum; all functions take numpy arrays.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_SHORT = 64  # lengths with a ready map


@lru_cache(maxsize=1)
def byte_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1)
    return c


def _apply(maps: np.ndarray, crc: np.ndarray) -> np.ndarray:
    out = maps[0][crc & 255]
    for k in (1, 2, 3):
        out = out ^ maps[k][(crc >> np.uint32(8 * k)) & 255]
    return out


@lru_cache(maxsize=1)
def _short_maps() -> np.ndarray:
    """``[length][byte of the checksum][its value]`` for lengths below ``_SHORT``."""
    maps = np.empty((_SHORT, 4, 256), dtype=np.uint32)
    maps[0] = np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32) * 8)[:, None]
    for n in range(1, _SHORT):
        maps[n] = byte_table()[maps[n - 1] & 255] ^ (maps[n - 1] >> 8)
    return maps


@lru_cache(maxsize=4096)
def _map(length: int) -> np.ndarray:
    """The map of any length, by halving it."""
    if length < _SHORT:
        return _short_maps()[length]
    half = _map(length // 2)
    both = _apply(half, half)
    return _apply(_map(1), both) if length % 2 else both


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums as they count in a concatenation that goes on for ``length`` bytes."""
    crc, length = np.asarray(crc, dtype=np.uint32), np.asarray(length, dtype=np.int64)
    maps = _short_maps().reshape(-1)
    row = np.minimum(length, _SHORT - 1) * 1024
    out = maps[row + (crc & 255)]
    for k in (1, 2, 3):
        out ^= maps[row + (256 * k) + ((crc >> np.uint32(8 * k)) & 255)]
    for n in np.unique(length[length >= _SHORT]):
        at = np.flatnonzero(length == n)
        out[at] = _apply(_map(int(n)), crc[at])
    return out


def joined(first: np.ndarray, second: np.ndarray, second_length: np.ndarray) -> np.ndarray:
    """Checksum of ``a + b`` from those of ``a`` and ``b`` and the bytes of ``b``."""
    return shifted(first, second_length) ^ np.asarray(second, dtype=np.uint32)
