"""Substring dedup of word windows by De Bruijn compaction.

A word is removed when a window of ``length`` words that covers it also starts earlier: in
a document with a smaller ``doc_id``, or earlier in the same document.  Windows are judged
on the input.

Token k-mers (k = ``length`` words) are the edges of the graph.  As in minimizer-bucketed
graph construction, neighbouring edges travel together: a segment is a run of edges that
share an anchor (see ``segments``).  Equal segments are one path and settle at once; the
open ones share their anchor with other contents, so the graph branches there:

1. their edges are told by anchor and content, 128 bits in all; edges that occur once are
   dropped;
2. an edge and its successor compact if every occurrence of the one is followed by the
   other, and every occurrence of the other preceded by the one.  A join of the edges
   with their only successors finds the others: the heads of the nonbranching paths;
3. every occurrence of a path is whole, so a path's occurrences are told by their heads, and
   its source coordinates verify the span: same number of edges, and the first one stays.

Texts are split at spaces and ASCII control white space; words are compared as bytes.  Null
texts have no words.  Rows with a null ``doc_id`` come after all others.  Rows that share a
``doc_id`` are one document in the order of their texts' hashes, equal rows the same one.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.anchors import Hashes
from martforge.llm.common import keyed, small_batches, written
from martforge.llm.segments import REMOVED, covered, decided, packed

_EDGES = pa.schema([("anchor", pa.int64()), ("edge", pa.int64()), ("before", pa.int64()), ("after", pa.int64()), ("doc", pa.int64()),
                    ("version", pa.int64()), ("segment", pa.int64()), ("at", pa.int64())])
_EDGES_SQL = "anchor long, edge long, before long, after long, doc long, version long, segment long, at long"


def word_values(text: bytes) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in text.split()], dtype=np.uint64)


def _edges(length: int):
    """The k-mers of the open segments, each with the one before and after it in its segment."""
    def run(batches):
        for b in batches:
            out: list[list] = [[] for _ in _EDGES]
            for doc, version, text, segs in zip(*(b.column(c).to_pylist() for c in ("doc", "version", "text", "segs"))):
                words = text.split()
                for s in segs:
                    start, n, anchor = s["start"], s["n"], s["anchor"]
                    at = np.arange(n)
                    values = np.array([xxhash.xxh64_intdigest(w) for w in words[start:start + n + length - 1]], dtype=np.uint64)
                    edge = Hashes(values).of(at, at + length).view(np.int64).tolist()
                    for column, values in zip(out, ([anchor] * n, edge, [None, *edge[:-1]], [*edge[1:], None], [doc] * n, [version] * n,
                                                    [start] * n, range(start, start + n))):
                        column.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(out, _EDGES)], schema=_EDGES)
    return run


def path_spans(edges: DataFrame) -> DataFrame:
    """``(doc, version, start, n)``: the occurrences of repeated paths that are not their first."""
    key = ["anchor", "edge"]
    graph = edges.groupBy(*key).agg(
        F.count("*").alias("times"), F.count("before").alias("n_before"), F.min("before").alias("b0"), F.max("before").alias("b1"),
        F.count("after").alias("n_after"), F.min("after").alias("a0"), F.max("after").alias("a1")).where("times > 1")
    graph = written(graph.select(
        *key, F.expr("IF(n_before = times AND b0 = b1, b0, NULL)").alias("only_before"),
        F.expr("IF(n_after = times AND a0 = a1, a0, NULL)").alias("only_after")), "edges")
    # x -> y compacts if y is the only successor of x and x the only predecessor of y
    inner = graph.where("only_after IS NOT NULL").select("anchor", F.col("only_after").alias("edge"), F.col("edge").alias("x"))
    heads = graph.join(inner, key, "left").select(*key, (F.col("x").isNull() | F.col("only_before").isNull() | (F.col("x") != F.col("only_before"))).alias("head"))
    heads = heads.groupBy(*key).agg(F.min("head").alias("head"))  # several edges may name the same successor
    # an occurrence of a path: its head and the edges up to the next head in the same segment
    order = Window.partitionBy("doc", "version", "segment", "anchor").orderBy("at")
    runs = edges.join(heads, key).withColumn("start", F.last(F.when(F.col("head"), F.col("at")), ignorenulls=True).over(order))
    runs = runs.groupBy("doc", "version", "segment", "anchor", "start").agg(
        F.count("*").cast("int").alias("n"), F.max(F.when(F.col("head"), F.col("edge"))).alias("path"))
    runs = written(runs, "path-runs")
    place = F.struct("doc", "version", "start")
    first = runs.groupBy("anchor", "path").agg(F.min(place).alias("first"), F.max("n").alias("edges"))
    return runs.join(first, ["anchor", "path"]).where((place > F.col("first")) & (F.col("n") == F.col("edges"))).select("doc", "version", "start", "n")


def _bytes() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")


def repeated_spans(docs: DataFrame, length: int = 20, gram: int = 8) -> DataFrame:
    """``(doc, version, spans)`` of every document with repeated windows; ``docs`` as given by ``keyed``."""
    texts = docs.select(F.col("__doc").alias("doc"), F.col("__version").alias("version"), _bytes().alias("text"))
    segs = decided(texts, word_values, length, gram, within=True)
    todo = segs.where(f"kind <> {REMOVED}").groupBy("doc", "version").agg(F.collect_set(F.struct("start", "n", "anchor")).alias("segs"))
    # equal rows are one document; its segments are there once
    some = texts.join(todo, ["doc", "version"]).dropDuplicates(["doc", "version"]).select("doc", "version", "text", "segs")
    edges = written(some.mapInArrow(_edges(length), _EDGES_SQL), "kmers")
    found = path_spans(edges)
    return written(packed(segs.where(f"kind = {REMOVED}").select("doc", "version", "start", "n").union(found)), "spans")


def _kept(words: list[bytes], runs: list[tuple[int, int]]) -> list[bytes]:
    stops = [0, *[b for _, b in runs]]
    return [w for a, b in zip(stops, [*[a for a, _ in runs], len(words)]) for w in words[a:b]]


def report(docs: DataFrame, length: int = 20, gram: int = 8) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` per row of ``docs``."""
    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string")
    def digest(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s in zip(text, spans):
            words = bytes(t).split()
            kept = _kept(words, covered(s, length, len(words)))
            rows.append((len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        return pd.DataFrame(rows, columns=["n_words", "n_removed", "kept_sha256"])

    base = keyed(docs.select("doc_id", "text"))
    spans = repeated_spans(base, length, gram).select(F.col("doc").alias("__d"), F.col("version").alias("__v"), "spans")
    small_batches(docs.sparkSession, 1000)
    out = base.join(spans, (F.col("__doc") == F.col("__d")) & (F.col("__version") == F.col("__v")), "left")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), digest(_bytes(), F.col("spans")).alias("d")).select("doc_id", "d.*")
