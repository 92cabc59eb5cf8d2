"""Phrase collocations from weighted acyclic automata of word n-grams.

1. *Shards.*  Every task cuts its texts into pieces and words and counts the n-grams of
   a language a buffer at a time; the sorted n-grams are cut at the bounds of prefix
   ranges, and each stretch becomes a count transducer (``transducers``).
2. *Union.*  The transducers of a range and language are united and their weights
   summed.  Every phrase of interest and all its parts occur at least as often as the
   phrase itself, so what is rarer than ``min_count`` in the whole corpus is left out.
3. *Composition.*  The distinct parts of all candidates are dealt to their ranges and
   composed with the ranges' transducers; the weights found are joined back to the cuts
   (a skewed join is split).  Scores are exact decimals.

The bounds are quantiles of a hash sample of n-grams of about ``SAMPLE_DOCS`` documents.
They only balance the ranges, as in any range partitioning; all counts cover all rows.
A frequent first word is no hot key, because bounds are whole n-grams, and a task sends
an n-gram at most once per buffer.

Null texts hold no words; a null language is ``und``.  Repeated rows count each.  Ties in
score and count are ranked by phrase in byte order.  An empty table, or one without
frequent phrases, gives no rows.  Long texts are counted in stretches that carry the
last words over, so no phrase is lost.  Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import shuffle_partitions, small_batches, written
from martforge.llm.transducers import MAX_WORDS, Grams, Transducer, counted, cut, unions

SAMPLE_DOCS = 4000        # documents whose n-grams may set the ranges' bounds
_SAMPLE_PER_RANGE = 20    # sampled n-grams per range
_RANGES_PER_PARTITION = 4
_BUFFER = 8 << 20        # bytes of a language counted at a time
_HELD = 16 << 20          # bytes held for all languages of a task
_PENDING = 1_500_000      # n-grams loaded before they are united

_WORD, _BLANK, _BREAK = range(3)
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_KIND = np.full(256, _WORD, dtype=np.uint8)
_KIND[[0x20, 0x09]] = _BLANK
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = _BREAK

Bounds = list[tuple[str, list[bytes]]]


def word_stretches(raw: bytes, order: int) -> Iterator[tuple[pa.Array, np.ndarray, int]]:
    """(words, piece of each word, leading words already counted) of lower-cased bytes, a stretch at a time."""
    data = np.frombuffer(raw.translate(_FOLD), dtype=np.uint8)
    kind = _KIND[data]
    lo = carried = 0
    while lo < len(data):
        hi = min(len(data), lo + _BUFFER)
        while hi < len(data):  # a stretch ends before a separator
            gap = np.flatnonzero(kind[hi:hi + 65536] != _WORD)
            if len(gap):
                hi += int(gap[0])
                break
            hi = min(len(data), hi + 65536)
        ink = np.concatenate(([False], kind[lo:hi] == _WORD, [False]))
        edge = np.flatnonzero(ink[1:] != ink[:-1])
        start, stop = edge[::2], edge[1::2]
        piece = np.searchsorted(np.flatnonzero(kind[lo:hi] == _BREAK), start)
        offsets = np.concatenate(([0], np.cumsum(stop - start)))
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [
            None, pa.py_buffer(offsets), pa.py_buffer(data[lo:hi][ink[1:-1]])])
        at = 0
        while at < len(words):
            end = min(len(words), at + MAX_WORDS)
            yield words.slice(at, end - at), piece[at:end], carried
            if end == len(words):
                break
            carried = order - 1
            at = end - carried
        if hi >= len(data):
            return
        carried = min(order - 1, len(start))
        lo = lo + int(start[len(start) - carried]) if carried else hi


def shard_grams(raw: bytes, order: int) -> Iterator[Grams]:
    for words, piece, skip in word_stretches(raw, order):
        grams = counted(words, piece, order, skip)
        if len(grams):
            yield grams


def _language_and_text(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(docs["text"].cast("string"), F.lit("")).cast("binary").alias("text"))


def bounds(docs: DataFrame, order: int, ranges: int) -> Bounds:
    """At most ``ranges - 1`` ascending (language, n-gram) bounds."""
    n = docs.count()
    part = docs if n <= SAMPLE_DOCS else docs.sample(SAMPLE_DOCS / n, seed=1)
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary())])

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for g in shard_grams(text, order):
                    found = g.phrases(np.arange(len(g)))
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), type=pa.string()), pa.array(found, type=pa.binary())], schema=schema)

    small_batches(docs.sparkSession, 1000)
    found = _language_and_text(part).mapInArrow(grams, "lang string, phrase binary").distinct()
    sample = found.orderBy(F.xxhash64("lang", "phrase"), "lang", "phrase").limit(_SAMPLE_PER_RANGE * ranges).collect()
    keys = sorted((r["lang"].encode(), bytes(r["phrase"]).split(b" ")) for r in sample)
    at = sorted({len(keys) * i // ranges for i in range(1, ranges)} - {0})
    return [(keys[i][0].decode(), keys[i][1]) for i in at]


class Ranges:
    """Prefix ranges between ascending bounds; range i holds what is not below bound i - 1 but below bound i."""

    def __init__(self, bounds: Bounds):
        self.keys = [(lang.encode(), words) for lang, words in bounds]

    def of(self, lang: str, words: list[bytes]) -> int:
        return bisect_right(self.keys, (lang.encode(), words))

    def stretches(self, lang: str, grams: Grams) -> Iterator[tuple[int, Grams]]:
        own = lang.encode()
        first = bisect_left(self.keys, (own, []))
        last = bisect_left(self.keys, (own + b"\x00", []))
        ends = cut(grams, [words for _, words in self.keys[first:last]]).tolist()
        for k, (lo, hi) in enumerate(zip([0, *ends], [*ends, len(grams)])):
            if hi > lo:
                yield first + k, grams.slice(lo, hi)


def shards(docs: DataFrame, ranges: Ranges, order: int) -> DataFrame:
    """``(range, lang, automaton)``: the count transducers of every task's buffers, cut at the ranges' bounds."""
    schema = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("automaton", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            del size[lang]
            for grams in shard_grams(b"\n".join(held.pop(lang)), order):  # a line end separates pieces, so texts, too
                rows = [(at, Transducer.build(part).dump()) for at, part in ranges.stretches(lang, grams)]
                yield pa.RecordBatch.from_arrays([pa.array([r for r, _ in rows], type=pa.int32()), pa.array([lang] * len(rows), type=pa.string()),
                                                  pa.array([a for _, a in rows], type=pa.binary())], schema=schema)

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                held.setdefault(lang, []).append(text)
                size[lang] = size.get(lang, 0) + len(text) + 1
                if size[lang] >= _BUFFER:
                    yield from flush(lang)
                while sum(size.values()) >= _HELD:
                    yield from flush(max(size, key=size.get))
        for lang in list(held):
            yield from flush(lang)

    small_batches(docs.sparkSession, 1000)
    return _language_and_text(docs).mapInArrow(run, "range int, lang string, automaton binary")


def united(shard_rows: DataFrame, order: int, min_count: int) -> DataFrame:
    """``(range, lang, n_words, automaton)``: per range and language the n-grams with at least ``min_count``; ``n_words`` counts all words."""
    schema = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("n_words", pa.int64()), ("automaton", pa.binary())])

    def unite(t: pa.Table) -> pa.Table:
        pending: list[Grams] = []
        held = 0
        for raw in t.column("automaton"):
            pending.append(Transducer.load(raw.as_py(), order).grams())
            held += len(pending[-1])
            if held > _PENDING:
                pending = unions(pending, order)
                held = sum(map(len, pending)) // 2  # what is left distinct must not be united again at once
        rows = []
        for g in unions(pending, order):
            often = np.flatnonzero(g.weight >= min_count)
            kept = Grams(g.words, g.key[often], g.weight[often], order)
            rows.append((int(g.weight[g.sizes() == 1].sum()), Transducer.build(kept.slice(0, len(kept))).dump()))
        arrays = [[t.column("range")[0].as_py()] * len(rows), [t.column("lang")[0].as_py()] * len(rows), [n for n, _ in rows], [a for _, a in rows]]
        return pa.table([pa.array(a, type=f.type) for a, f in zip(arrays, schema)], schema=schema)

    return shard_rows.groupBy("range", "lang").applyInArrow(unite, "range int, lang string, n_words long, automaton binary")


def cuts(ranges: DataFrame, order: int) -> DataFrame:
    """``(lang, phrase, size, a, k, first, rest)``: every candidate cut after its first k words."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("size", pa.int32()), ("a", pa.int64()), ("k", pa.int32()),
                        ("first", pa.binary()), ("rest", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lang, raw in zip(b.column(0).to_pylist(), b.column(1)):
                grams = Transducer.load(raw.as_py(), order).grams()
                sizes = grams.sizes()
                at = np.flatnonzero(sizes > 1)
                rows = []
                for phrase, size, a in zip(grams.phrases(at), sizes[at].tolist(), grams.weight[at].tolist()):
                    words = phrase.split(b" ")
                    rows += [(lang, phrase, size, a, k, b" ".join(words[:k]), b" ".join(words[k:])) for k in range(1, size)]
                columns = list(zip(*rows)) if rows else [[] for _ in schema]
                yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)

    return ranges.select("lang", "automaton").mapInArrow(run, "lang string, phrase binary, size int, a long, k int, first binary, rest binary")


def lookups(parts: DataFrame, ranges: DataFrame, at: Ranges, order: int) -> DataFrame:
    """``(lang, part, f)`` of distinct ``(lang, part)`` rows, by composing them with the ranges' transducers."""
    schema = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("part", pa.binary())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            place = [at.of(lang, part.split(b" ")) for lang, part in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(place, type=pa.int32()), b.column(0), b.column(1)], schema=schema)

    def compose(wanted: pa.Table, held: pa.Table) -> pa.Table:
        part = wanted.column("part").to_pylist()
        f = np.zeros(len(part), dtype=np.int64)
        for raw in held.column("automaton"):
            f += Transducer.load(raw.as_py(), order).compose([p.split(b" ") for p in part])
        return pa.table({"lang": wanted.column("lang"), "part": wanted.column("part"), "f": pa.array(f)})

    dealt = parts.mapInArrow(deal, "range int, lang string, part binary")
    keys = ["range", "lang"]
    return dealt.groupBy(*keys).cogroup(ranges.select(*keys, "automaton").groupBy(*keys)).applyInArrow(compose, "lang string, part binary, f long")


def _inner(candidates: DataFrame) -> DataFrame:
    """``(lang, phrase, longer)``: every shorter candidate inside a longer one, with the longer one's count."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("longer", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for lang, phrase, a in zip(*(c.to_pylist() for c in b.columns)):
                words = phrase.split(b" ")
                rows += [(lang, b" ".join(words[i:i + n]), a) for n in range(2, len(words)) for i in range(len(words) - n + 1)]
            columns = list(zip(*rows)) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema)

    return candidates.where("size > 2 AND k = 1").select("lang", "phrase", "a").mapInArrow(run, "lang string, phrase binary, longer long")


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, top: int = 2000, inside_percent: int = 50) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases of 2 to ``max_words`` words.

    A phrase inside a longer candidate that has at least ``inside_percent`` of its count is left out.
    """
    partitions = _RANGES_PER_PARTITION * shuffle_partitions(docs.sparkSession)
    at = Ranges(bounds(docs, max_words, partitions))
    ranges = written(united(shards(docs, at, max_words), max_words, min_count), "phrase-ranges")
    small_batches(docs.sparkSession, 1000)
    candidates = written(cuts(ranges, max_words), "phrase-cuts")
    wanted = candidates.select("lang", F.explode(F.array("first", "rest")).alias("part")).distinct()
    weights = written(lookups(wanted, ranges, at, max_words), "phrase-parts")
    left = weights.select("lang", F.col("part").alias("first"), F.col("f").alias("l"))
    right = weights.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"))
    # products pass 64 bits: counts of 15 digits keep 1000000 * a * a within 38
    exact = "cast((cast(1000000 as decimal(7, 0)) * cast(a as decimal(15, 0)) * cast(a as decimal(15, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0))) as long)"
    scored = candidates.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).withColumn("score", F.expr(exact))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("c")).select("lang", "phrase", "c.*")
    longer = _inner(candidates).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = best.join(longer, ["lang", "phrase"], "left").where(f"longer IS NULL OR 100 * longer < {int(inside_percent)} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")  # each task keeps its own top rows only
    ranked = free.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = ranges.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), F.col("phrase").cast("string").alias("phrase"),
                                              "a", "l", "r", "n", "score")
