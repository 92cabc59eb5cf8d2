"""SimHash fingerprints and near-duplicate classes by multi-index hashing.

*Fingerprint.*  Words of the lower-cased text (A-Z only), shingles of ``shingle``
words joined by one space, each hashed with XXH64 (seed 42); a bit is set when it
is set in over half of the shingle hashes.

*Links.*  The 64 bits are cut into segments.  Around each distinct fingerprint the
small Hamming balls within every segment are enumerated: at most ``(d + 1) // 2``
bits are flipped, spread over the segments in every way.  The index holds a
fingerprint under each of these keys; two fingerprints within distance ``d`` always
meet under a common key (each moves half of the differing bits).  A key keeps the
bits of *all* segments, so a bucket holds no more distinct fingerprints than the
ball has members (65 for d = 2): a third of all documents may agree in one segment
and still no bucket grows with the data and no group is paired with itself.
Fetched neighbours are verified by their complete distance.

Null texts and texts without a word have fingerprint zero and are linked like any
other.  Rows without a ``doc_id`` keep their row; they join a class but never name
it (a class with no ``doc_id`` at all has a null ``component_id``).  Repeated rows
give one row each.  An empty table gives an empty result.  Columns other than
``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from itertools import combinations, product

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.llm.common import map_texts, own_names, written
from martforge.llm.components import connected_components

BITS = 64
_CHUNK = 1 << 16  # shingles hashed at a time, so that a very long text needs little memory


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of one text, unsigned."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n]
    stops = ends[min(shingle, len(words)) - 1:]
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        h = np.array([digest(joined[a:b], 42) for a, b in zip(starts[at:at + _CHUNK].tolist(), stops[at:at + _CHUNK].tolist())],
                     dtype="<u8")
        ones += _bit_counts(h)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > n)))


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _bit_counts(h: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)`` per row of ``docs``; ``fp`` is the fingerprint as a signed long."""
    def run(ids: list, texts: list) -> dict:
        fp = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
        return {"doc_id": ids, "fp": fp}

    return map_texts(docs, run, "doc_id long, fp long")


def ball_masks(radius: int, segments: int) -> list[int]:
    """XOR masks of weight <= ``radius``: the product of the segments' own small balls, as signed longs."""
    width = BITS // segments
    cuts = [(i * width, BITS if i == segments - 1 else (i + 1) * width) for i in range(segments)]
    masks = []
    for weights in product(range(radius + 1), repeat=segments):
        if sum(weights) <= radius:
            balls = [[sum(1 << b for b in flip) for flip in combinations(range(lo, hi), w)] for (lo, hi), w in zip(cuts, weights)]
            masks += [sum(parts) for parts in product(*balls)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


def links(fps: DataFrame, max_distance: int = 2, segments: int = 2) -> DataFrame:
    """Verified links ``(a, b)`` between distinct fingerprints of ``fps(fp)``, enough to connect every linked pair.

    With an even ``max_distance`` all members of a bucket are within the distance
    of each other, so neighbours in the bucket's order are linked; with an odd one
    every pair of the (bounded) bucket is verified.
    """
    if not 0 <= max_distance <= 4:
        raise ValueError("max_distance must be 0 to 4: the balls grow with the power of half the distance")
    distinct = own_names(fps, "fp").distinct()
    masks = ball_masks((max_distance + 1) // 2, segments)
    index = distinct.select("fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")).select(
        F.col("fp").bitwiseXOR(F.col("mask")).alias("key"), "fp")
    if max_distance % 2 == 0:
        # a bucket's members in order, each with the one before it
        pairs = index.withColumn("a", F.lag("fp").over(Window.partitionBy("key").orderBy("fp"))).select(
            "a", F.col("fp").alias("b")).where("a IS NOT NULL")
    else:
        left, right = index.withColumnRenamed("fp", "a"), index.withColumnRenamed("fp", "b")
        pairs = left.join(right, "key").where("a < b").select("a", "b")
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, max_distance: int = 2, segments: int = 2) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable over links.
    """
    fps = written(fingerprints(docs, shingle), "fingerprints")
    nodes = connected_components(links(fps, max_distance, segments))
    # classes of equal fingerprints collapse before the join with the component roots
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    classes = first.join(nodes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id")
    named = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    label = classes.join(named, "root").select("fp", "component_id")
    return fps.join(label, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each_group(docs: DataFrame, shingle: int = 3, max_distance: int = 2) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` names its near-duplicate class; other members are dropped.

    Rows without a ``doc_id`` cannot be told apart from their copies and are kept.
    Of several rows with the naming ``doc_id`` the smallest by content stays.
    """
    kept = near_duplicates(docs, shingle, max_distance).where("doc_id = component_id").select(
        F.col("doc_id").alias("__kept")).distinct()
    stay = docs.join(kept, docs["doc_id"] == kept["__kept"], "left_semi")
    order = [F.col(f"`{f.name}`") for f in docs.schema.fields if isinstance(f.dataType, T.AtomicType)]
    stay = (stay.withColumn("__n", F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)))
            .where("__n = 1").drop("__n"))
    return stay.unionByName(docs.where("doc_id IS NULL"))
