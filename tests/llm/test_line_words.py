"""Word sets of lines against plain Python, and a line that a third of all documents share."""

import random

import numpy as np
from pyspark.sql import functions as F

from martforge.llm import line_dedup, line_words
from tests.llm.helpers import awkward_texts, frame


def by_line(texts):
    return [(i, k, line.split()) for i, t in enumerate(texts) for k, line in enumerate(t.split(b"\n"))]


def test_words_are_those_of_every_line():
    texts = [(t or "").encode() for t in awkward_texts(3)] + [b"\n\n", b"x" * 5000 + b" " + b"x" * 5001, b"ab\x1ccd \x0b ab\x1ccd"]
    w = line_words.words(texts)
    want = by_line(texts)
    assert list(zip(w.text_of.tolist(), w.number.tolist())) == [(i, k) for i, k, _ in want]
    flat = [word for _, _, ws in want for word in ws]
    assert w.line.tolist() == [n for n, (_, _, ws) in enumerate(want) for _ in ws]
    # equal words have equal hashes, others differ, wherever they stand
    assert len(set(zip(flat, w.hash.tolist()))) == len(set(flat)) == len(set(w.hash.tolist()))


def test_words_of_equal_beginnings_differ():
    base = [b"a" * n for n in range(1, 40)] + [b"a" * n + b"b" for n in range(40)]
    assert len(set(line_words.words([b" ".join(base)]).hash.tolist())) == len(set(base))


def test_sets_are_distinct_and_rarest_first():
    r = random.Random(5)
    texts = [b" ".join(r.choice([b"a", b"b", b"cc", b"word%d" % r.randint(0, 50)]) for _ in range(r.randint(0, 30))) for _ in range(60)]
    w = line_words.words(texts)
    cell = (w.hash & np.uint64(line_words.CELLS - 1)).astype(np.int64)
    counts = np.bincount(cell, minlength=line_words.CELLS)
    levels = np.minimum(2 * np.log2(np.maximum(counts, 1)), 63).astype(np.uint8)
    s = line_words.sets(w, levels)
    assert s.size.tolist() == [len(set(ws)) for _, _, ws in by_line(texts)]
    rarity = levels[(s.hash & np.uint64(line_words.CELLS - 1)).astype(np.int64)].astype(int)
    for line in set(s.line.tolist()):
        own = s.line == line
        order = list(zip(rarity[own].tolist(), s.hash[own].tolist()))
        assert order == sorted(order) and len(set(order)) == len(order)


def test_ties_in_the_packed_order_are_sorted_in_full():
    high = np.uint64(0x123456789ABCDE) << np.uint64(8)
    words = line_words.Words(np.array([0, 0, 0]), np.array([high | np.uint64(2), high | np.uint64(1), high | np.uint64(2)]), np.array([0]), np.array([0]))
    s = line_words.sets(words, np.zeros(line_words.CELLS, dtype=np.uint8))
    assert s.size.tolist() == [2] and s.hash.tolist() == [int(high) | 1, int(high) | 2]


def test_line_that_a_third_of_all_documents_share(spark):
    texts = [f"own{i} line{i} of{i} this{i} text{i}" + ("\nthe very same line everywhere" if i % 3 == 0 else "") for i in range(600)]
    got = {r.doc_id: (r.n_lines, list(r.removed_lines)) for r in line_dedup.report(frame(spark, texts)).collect()}
    assert got == {i: (2, [1] if i else []) if i % 3 == 0 else (1, []) for i in range(600)}


def test_no_stage_of_the_levels_runs_two_python_operators(spark):
    texts = frame(spark, awkward_texts(4)).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    plan = line_words.level_parts(texts)._jdf.queryExecution().executedPlan().toString()
    stages = [stage.count("InArrow") for stage in plan.split("Exchange ")]
    assert sum(stages) == 3 and max(stages) == 1, plan
