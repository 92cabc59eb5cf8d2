"""Line dedup on a large group of near copies: whole results, pairs in proportion to the lines, no Python on the executors."""

import random
import re
from fractions import Fraction

from martforge.llm import line_dedup
from tests.llm.helpers import frame
from tests.llm.test_dedup_operators import brute_lines


def near_copies(n):
    """``n`` copies of a line with two new words each, then lines that match a single copy only, and lines that match none."""
    r = random.Random(8)
    base = [f"word{i}" for i in range(40)]

    def changed(words, k, name):
        out = list(words)
        for at in r.sample(range(40), k):
            out[at] = f"{name}x{at}"
        return out

    copies = [changed(base, 2, f"c{i}") for i in range(n)]
    late = [changed(c, 3, f"l{i}") for i, c in enumerate(copies[5:25])]
    none = [changed(base, 12, f"n{i}") for i in range(20)]
    return [" ".join(words) for words in copies + late + none]


def recorded(monkeypatch):
    steps, plain = [], line_dedup.written

    def written(df, label):
        out = plain(df, label)
        steps.append((label, df._jdf.queryExecution().executedPlan().toString(), out.count()))
        return out

    monkeypatch.setattr(line_dedup, "written", written)
    return steps


def test_near_copies_meet_few_lines_and_keep_their_result(spark, monkeypatch):
    steps = recorded(monkeypatch)
    texts = near_copies(400)
    ids = list(range(len(texts)))
    out = line_dedup.report(frame(spark, texts, ids))
    got = sorted(((r.doc_id, r.n_lines, r.n_removed, list(r.removed_lines)) for r in out.collect()), key=repr)
    assert got == brute_lines(texts, ids, Fraction(4, 5))
    # all 79,800 pairs of copies are similar
    pairs = {label: n for label, _, n in steps if "pairs" in label}
    assert max(pairs.values()) < 40 * len(texts), pairs
    plans = [plan for _, plan, _ in steps] + [out._jdf.queryExecution().executedPlan().toString()]
    assert not [found for plan in plans for found in re.findall("Python|Pandas|InArrow", plan)]


def test_small_groups_go_to_the_prefix_join_alone(spark, monkeypatch):
    steps = recorded(monkeypatch)
    texts = near_copies(line_dedup.LARGE // 4)[:line_dedup.LARGE // 4]
    ids = list(range(len(texts)))
    got = line_dedup.report(frame(spark, texts, ids)).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, list(r.removed_lines)) for r in got), key=repr) == brute_lines(texts, ids, Fraction(4, 5))
    assert "line-settled" not in [label for label, _, _ in steps]
