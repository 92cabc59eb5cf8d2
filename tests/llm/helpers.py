"""Small document tables with the awkward cases, and brute-force answers."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, version int, kind string, spans int"


def frame(spark, texts, ids=None):
    """A documents table with extra columns whose names clash with the operators' own."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t) if t is not None else None, "x", 7, "y", 1) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def awkward_texts(seed=0, n=30, vocabulary=12):
    """Copies, near copies, shared passages, periodic and empty texts, odd white space, several scripts."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["né", "日本", "Ab", "x#y"]
    passage = " ".join(r.choice(words) for _ in range(40))
    out = ["", None, " \t\n", "one", "a b", "a a a a " * 30, passage, passage, "start " + passage + " end", "\n\n" + passage]
    for _ in range(n):
        t = " ".join(r.choice(words) for _ in range(r.randint(1, 60)))
        if r.random() < 0.3:
            t = t + "\n" + passage[r.randint(0, 40):]
        if r.random() < 0.2:
            t = t.replace(" ", r.choice(["  ", "\t", " \n", "\x0b"]), 5)
        out += [t] * r.choice([1, 1, 1, 2, 3])
    out.append(" ".join(r.choice(words) for _ in range(3000)))  # a long text
    return out


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
