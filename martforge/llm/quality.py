"""Quality rules as a short-circuit cascade, DataFrame functions only.

Every rule is a rejecting condition over a few text features.  Costs (seconds per
row, measured) and selectivities (share rejected) come from a bounded sample of
rows; the rules are then ordered by rejection per cost, and a row that one rule
rejects never reaches the features of the next.  A document is kept when no rule
rejects it, so the order changes the time taken and never the verdict.

Null texts count as empty and are rejected (no words).  Every input row has one
verdict, repeated rows and null ``doc_id`` alike.  Extra columns pass through
``keep_good`` and are ignored by ``report``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import written

# fixed values of the thresholds
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20       # words inside repeated 5-word windows, of all words
MEAN_WORD_CHARS = (2, 20)     # mean code points per word
MAX_SYMBOL_PERCENT = 25       # symbols per 100 words
MAX_DUP_LINE_PERCENT = 50     # lines equal to an earlier line, of all lines with a word
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
WINDOW = 5


def _text(df: DataFrame) -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def add_words(df: DataFrame) -> DataFrame:
    """``__words``, ``n_words`` and ``word_chars``."""
    only_spaces = F.translate(_text(df), WHITE[1:], " " * (len(WHITE) - 1))
    df = df.withColumn("__words", F.array_remove(F.split(only_spaces, " "), ""))
    return df.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.char_length(F.translate(_text(df), WHITE, "")).cast("long"),
    })


def add_symbols(df: DataFrame) -> DataFrame:
    return df.withColumn("n_symbols", (F.char_length(_text(df)) - F.char_length(F.translate(_text(df), SYMBOLS, ""))).cast("long"))


def add_lines(df: DataFrame) -> DataFrame:
    """``n_lines`` (lines with a word) and ``n_dup_lines`` (those equal to an earlier one)."""
    df = df.withColumn("__lines", F.filter(F.split(_text(df), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    return df.withColumns({
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
    }).drop("__lines")


def add_repeats(df: DataFrame) -> DataFrame:
    """``n_repeat_words``: words inside 5-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hashes of 64-bit word hashes.  Most texts repeat
    no window, which a hash set settles; only the others sort their windows.  Every
    step takes time in proportion to the text (times the logarithm for the sort).
    Each array is a column of its own that the next step reads more than once, so
    that the optimizer does not move its computation into the loops over it.
    """
    last = F.greatest(F.size("__wh") - (WINDOW - 1), F.lit(0))
    df = df.withColumn("__wh", F.transform("__words", lambda w: F.xxhash64(w)))
    df = df.withColumn("__win", F.transform(
        F.slice("__wh", F.lit(1), last),
        lambda h, i: F.xxhash64(h, *[F.get(F.col("__wh"), i + k) for k in range(1, WINDOW)])))
    df = df.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__win")) < F.size("__win"),
        F.array_sort(F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    at = F.array_sort(F.transform(F.filter(
        F.col("__sorted"),
        lambda e, j: (F.get(F.col("__sorted"), j - 1)["h"] == e["h"]) | (F.get(F.col("__sorted"), j + 1)["h"] == e["h"])),
        lambda e: e["i"]))
    # union length of the intervals [i, i + 5)
    covered = F.aggregate(
        at, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda acc, i: F.struct((acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n"), (i + WINDOW).alias("end")),
        lambda acc: acc["n"])
    # a value that reads the row number stays in its projection: no filter on it moves the loops into a condition
    counted = F.when(F.monotonically_increasing_id() >= 0, F.coalesce(covered, F.lit(0)).cast("long"))
    return df.withColumn("n_repeat_words", counted).drop("__wh", "__win", "__sorted")


@dataclass(frozen=True)
class Rule:
    """``rejects`` is a condition over the columns that ``features`` (in order) add."""

    name: str
    features: tuple[Callable[[DataFrame], DataFrame], ...]
    rejects: str


RULES = [
    Rule("few_words", (add_words,), f"n_words < {MIN_WORDS}"),
    Rule("repeated_windows", (add_words, add_repeats), f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule("word_length", (add_words,),
         f"word_chars < {MEAN_WORD_CHARS[0]} * n_words OR word_chars > {MEAN_WORD_CHARS[1]} * n_words"),
    Rule("symbols", (add_words, add_symbols), f"100 * n_symbols > {MAX_SYMBOL_PERCENT} * n_words"),
    Rule("duplicate_lines", (add_lines,), f"100 * n_dup_lines > {MAX_DUP_LINE_PERCENT} * n_lines"),
]


def _with(df: DataFrame, features: tuple, done: list) -> DataFrame:
    for f in features:
        if f not in done:
            df = f(df)
            done.append(f)
    return df


def order_rules(docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = 2000, seed: int = 42) -> list[Rule]:
    """The rules by rejection per cost on a sample of about ``sample_rows`` rows, ties by name.

    A rule's cost is the time to compute its features and condition over the sample,
    the better of two runs, less the time to read the sample.
    """
    rows = docs.count()
    if rows == 0:
        return list(rules)
    sample = written(docs.select(_text(docs).alias("text")).sample(min(1.0, sample_rows / rows), seed).limit(2 * sample_rows), "sample")

    def timed(df: DataFrame, condition: str) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            began = time.perf_counter()
            share = df.agg(F.avg(F.expr(condition).cast("int").cast("double"))).first()[0] or 0.0
            best = min(best, time.perf_counter() - began)
        return best, share

    base, _ = timed(sample, "text IS NULL")
    measured = []
    for rule in rules:
        cost, share = timed(_with(sample, rule.features, []), rule.rejects)
        measured.append((-share / max(cost - base, 1e-3), rule.name, rule))
    return [rule for *_, rule in sorted(measured, key=lambda m: m[:2])]


def keep_good(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """The rows that no rule rejects, with their own columns; each rule sees what the ones before it left.

    A filter on a row number is not moved below the projection that numbers the rows,
    so the features are computed once, in their own projections, and not inside the condition.
    """
    done: list = []
    # the input's columns wait under other names: a feature's name may be one of theirs
    held = {c: c if c == "text" else f"__in_{i}" for i, c in enumerate(docs.columns)}
    df = docs.select([docs[c].alias(name) for c, name in held.items()])
    for rule in rules if rules is not None else order_rules(docs):
        df = _with(df, rule.features, done).withColumn("__row", F.monotonically_increasing_id())
        df = df.where(f"NOT ({rule.rejects}) AND __row >= 0")
    return df.select([F.col(name).alias(c) for c, name in held.items()])


def report(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """Per row of ``docs``: its features, ``base_failed`` and the cascade's verdict ``kept``."""
    df = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    ordered = rules if rules is not None else order_rules(docs)
    df = add_repeats(add_lines(add_symbols(add_words(df))))
    cascade = F.when(F.lit(False), F.lit(False))
    for rule in ordered:
        cascade = cascade.when(F.expr(rule.rejects), F.lit(False))
    base_failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", base_failed).withColumn("kept", ~F.col("base_failed") & cascade.otherwise(F.lit(True))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
