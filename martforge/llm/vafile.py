"""Exact top-k inner-product search with vector-approximation files.

Components are quantised to integers, ``floor(256 * x)``.  Every dimension's range over
all rows is divided into ``2 ** bits`` cells; a vector's approximation is its cell
numbers.  Rows and queries are dealt into blocks, and each pair of a query block and
a data block is one group of work:

1. scan the approximations: the cells bound every inner product from below and above;
2. the k-th best lower bound of a query rules out every vector whose upper bound is less;
3. the exact vectors of the others are read in the order of their upper bounds, in
   steps, until the k-th exact score beats (not just equals) the next upper bound;
4. the k best of every pair of blocks are merged per query.

Equal vectors score alike, so of each group of equal vectors only the ``k + 1`` smallest
ids can be among a query's k best (its own row is one of them); the others are left
out before anything is dealt.  That is exact, and a group of copies of any size
costs ``k + 1`` rows.

Vectors that are null or hold a null or non-finite component take no part, neither
as query nor as candidate; rows with a null id likewise.  A query is compared with
the vectors of as many components as it has.  Rows that repeat an id are candidates
of their own, but never for the query of the same id; a repeated query id that holds
different vectors asks once for each (``query_id`` then repeats).  Ties go to the smaller
``vec_id``.  An empty table gives an empty result.  Extra columns are ignored.

Inner products are exact: 64-bit floating point where no partial sum can reach 2^53,
Python integers otherwise.  Scores beyond the range of a long are cut to it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.llm.common import written

DATA_BLOCK, QUERY_BLOCK = 4096, 1024
_STEP = 32  # exact vectors read at a time
_EXACT = 2.0**53


def quantised(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id") -> DataFrame:
    """``(vec_id, q)`` of the rows that take part: ``q`` holds ``floor(256 * x)`` as doubles (exact: a power of two)."""
    x = F.transform(vectors[vector], lambda v: v.cast("double"))
    finite = F.forall(vectors[vector], lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float("inf")))
    return vectors.where(vectors[vec_id].isNotNull() & vectors[vector].isNotNull() & finite).select(
        vectors[vec_id].cast("long").alias("vec_id"), F.transform(x, lambda v: _floor(v * 256.0)).alias("q"))


def _floor(v: Column) -> Column:
    """Floor as a double; doubles from 2^52 on are whole already."""
    return F.when(F.abs(v) < 2.0**52, F.floor(v).cast("double")).otherwise(v)


def _dealt(df: DataFrame, block: str, size: int, rows: int) -> DataFrame:
    """``block``: rows dealt evenly by a hash of their content into blocks of about ``size``, however many rows there are."""
    return df.withColumn(block, F.pmod(F.xxhash64("vec_id", "q"), F.lit(max(1, -(-rows // size)))).cast("int"))


def ranges(vectors: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per number of components: smallest and largest value of every dimension (as many rows as dimensions)."""
    cells = vectors.select(F.size("q").alias("d"), F.posexplode("q").alias("i", "v")).groupBy("d", "i").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    out: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for r in cells:
        lo, hi = out.setdefault(r["d"], (np.zeros(r["d"]), np.zeros(r["d"])))
        lo[r["i"]], hi[r["i"]] = r["lo"], r["hi"]
    return out


def approximate(q: np.ndarray, lo: np.ndarray, hi: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell numbers, cell width of each dimension) of the vectors ``q``."""
    cells = 1 << bits
    width = np.maximum(np.ceil((hi - lo + 1) / cells), 1)
    # rounding of very large values may leave the last cell: it is closed by hi anyway
    return np.clip(np.floor((q - lo) / width), 0, cells - 1).astype(np.uint16), width


def bounds(queries: np.ndarray, codes: np.ndarray, lo: np.ndarray, hi: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the inner products, queries by vectors, from the cells alone."""
    low = lo + codes * width
    high = np.minimum(low + width - 1, hi)
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _scores(q: np.ndarray, vectors: np.ndarray, exact: bool) -> list:
    if exact:
        return (vectors @ q).astype(np.int64).tolist()
    whole = [int(x) for x in q]
    top, low = 2**63 - 1, -(2**63)
    return [min(max(sum(a * int(b) for a, b in zip(whole, v)), low), top) for v in vectors.tolist()]


def search_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int,
                 lo: np.ndarray, hi: np.ndarray, bits: int) -> list[tuple[int, int, int]]:
    """``(row of the query, vec_id, score)``: the k best of this data block for every query of this query block."""
    codes, width = approximate(vectors, lo, hi, bits)
    largest = np.abs(np.concatenate([queries, vectors])).max(initial=0)
    exact = largest * largest * max(queries.shape[1], 1) < _EXACT
    if exact:
        lower, upper = bounds(queries, codes, lo, hi, width)
    else:  # no safe bound in floating point: every vector is read
        lower = np.full((len(queries), len(vectors)), -np.inf)
        upper = np.full((len(queries), len(vectors)), np.inf)
    out = []
    for r, (query_id, q) in enumerate(zip(query_ids.tolist(), queries)):
        others = np.flatnonzero(ids != query_id)
        if not len(others):
            continue
        at_least = np.partition(lower[r, others], -k)[-k] if len(others) >= k else -np.inf
        left = others[upper[r, others] >= at_least]
        left = left[np.argsort(-upper[r, left], kind="stable")]
        best: list[tuple[int, int]] = []  # (-score, vec_id), best first
        for a in range(0, len(left), _STEP):
            if len(best) == k and upper[r, left[a]] < -best[-1][0]:
                break
            step = left[a:a + _STEP]
            best = sorted(best + [(-s, i) for s, i in zip(_scores(q, vectors[step], exact), ids[step].tolist())])[:k]
        out += [(r, i, -s) for s, i in best]
    return out


def top_k(vectors: DataFrame, k: int = 5, query_every: int = 50, bits: int = 6, vector: str = "embedding",
          vec_id: str = "vec_id") -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows for every row whose id is divisible by ``query_every``."""
    parts = written(quantised(vectors, vector, vec_id), "quantised")
    spans = ranges(parts)
    # of equal vectors the k + 1 smallest ids; a query's own repetitions are not among its candidates
    order = Window.partitionBy("q").orderBy("vec_id")
    data = parts.withColumn("n", F.dense_rank().over(order)).where(f"n <= {k + 1}").drop("n")
    same = Window.partitionBy("q", "vec_id").orderBy("vec_id")
    data = written(data.withColumn("n", F.row_number().over(same)).where(f"n <= {k}").drop("n"), "candidates")
    queries = parts.where(F.pmod("vec_id", F.lit(query_every)) == 0).distinct()
    queries = written(parts.where(F.pmod("vec_id", F.lit(query_every)) == 0).distinct(), "search-queries")
    rows, asked = data.count(), queries.count()
    # every query block meets every data block: the stated query set against all rows
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(max(1, -(-rows // DATA_BLOCK)) - 1))).alias("data_block")
    asking = _dealt(queries, "query_block", QUERY_BLOCK, asked).select(
        "query_block", everywhere, "vec_id", "q", F.size("q").alias("d"), F.xxhash64("q").alias("version"))
    for_all = F.explode(F.sequence(F.lit(0), F.lit(max(1, -(-asked // QUERY_BLOCK)) - 1))).alias("query_block")
    held = _dealt(data, "data_block", DATA_BLOCK, rows).select(for_all, "data_block", "vec_id", "q", F.size("q").alias("d"))
    schema = pa.schema([("query_id", pa.int64()), ("version", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def matrix(t: pa.Table, d: int) -> np.ndarray:
        return t.column("q").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, d)

    def work(q: pa.Table, v: pa.Table) -> pa.Table:
        if not q.num_rows or not v.num_rows:
            return schema.empty_table()
        d = q.column("d")[0].as_py()
        query_ids = q.column("vec_id").to_numpy()
        found = search_block(query_ids, matrix(q, d), v.column("vec_id").to_numpy(), matrix(v, d), k, *spans.get(d, (np.zeros(0),) * 2), bits)
        row, vec_ids, score = (np.array(c, dtype=np.int64) for c in (zip(*found) if found else ((), (), ())))
        return pa.Table.from_arrays([pa.array(query_ids[row]), pa.array(q.column("version").to_numpy()[row]), pa.array(vec_ids),
                                     pa.array(score)], schema=schema)

    keys = ["query_block", "data_block", "d"]
    near = asking.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInArrow(work, "query_id long, version long, vec_id long, score long")
    best = Window.partitionBy("query_id", "version").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best).cast("int")).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")
