"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are produced.

The characters of a chunk form a linked list; a heap holds every adjacent pair
whose concatenation is a piece, by rank and then position.  The lowest is popped
and merged until none is left.  The count is the initial symbols minus the merges:
a character that is a piece counts one symbol, any other one per UTF-8 byte (byte
fallback).  A chunk of n characters takes O(n log n), also without any space in it.

Null and empty texts have 0 bytes and 0 tokens.  Strings such as ``<s>`` inside a
text are ordinary text.  Every input row gives one row, repeated and null
``doc_id`` alike; extra columns are ignored.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from martforge.llm.common import coded_chunks, map_batches, sums
from martforge.llm.pieces import Remembered, Vocabulary, chunks, marked, plain, vocabulary


def merged_count(part: str, vocab: Vocabulary) -> int:
    """Tokens of one chunk."""
    rank = vocab.rank
    n = len(part)
    size = [1 if c in rank else len(c.encode("utf-8", "surrogatepass")) for c in part]
    count = sum(size)
    if n == 1:
        return count
    start, stop = list(range(n)), list(range(1, n + 1))     # a live symbol i covers part[start[i]:stop[i]]
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    alive = [True] * n
    heap = [(rank[part[i:i + 2]], i, i + 1, 2) for i in range(n - 1) if part[i:i + 2] in rank]
    heapq.heapify(heap)
    while heap:
        _, left, right, length = heapq.heappop(heap)
        if not (alive[left] and alive[right] and after[left] == right and stop[right] - start[left] == length):
            continue  # one of the two was merged meanwhile
        count -= size[left] + size[right] - 1
        size[left], stop[left], alive[right] = 1, stop[right], False
        nxt = after[left] = after[right]
        if nxt < n:
            before[nxt] = left
            grown = part[start[left]:stop[nxt]]
            if grown in rank:
                heapq.heappush(heap, (rank[grown], left, nxt, len(grown)))
        prev = before[left]
        if prev >= 0:
            grown = part[start[prev]:stop[left]]
            if grown in rank:
                heapq.heappush(heap, (rank[grown], prev, left, len(grown)))
    return count


@lru_cache(maxsize=4)
def counter(path: str) -> Remembered:
    vocab = vocabulary(path)
    parts = Remembered(lambda p: merged_count(p, vocab) if p else 0)

    def chunk_count(chunk: str) -> int:
        return sum(map(parts.__getitem__, vocab.parts(chunk)))

    return Remembered(chunk_count)


def count_tokens(text: str, path: str) -> int:
    return sum(map(counter(path).__getitem__, chunks(text, vocabulary(path))))


def count_batch(texts: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text; equal chunks of a batch are looked up once."""
    vocab, known = vocabulary(path), counter(path)
    simple = plain(texts, vocab).to_numpy(zero_copy_only=False) & (pc.binary_length(texts).to_numpy() > 0)
    out = np.zeros(len(texts), dtype=np.int64)
    distinct, codes, offsets = coded_chunks(marked(texts.filter(pa.array(simple)), vocab), " ")
    each = np.fromiter(map(known.__getitem__, distinct), dtype=np.int64, count=len(distinct))
    out[simple] = sums(each[codes], offsets)
    for i in np.flatnonzero(~simple):
        out[i] = count_tokens(texts[i].as_py(), path)
    return out


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per row of ``docs``."""
    def run(ids: pa.Array, texts: pa.Array) -> list:
        n = count_batch(texts, model_path)
        return [ids, pc.binary_length(texts), n, n > limit]

    return map_batches(docs, run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
