"""Line dedup by an exact set-similarity join.

A line is the set of its words.  A line is removed when an earlier line (smaller
``doc_id``, or the same document and an earlier line) has a Jaccard similarity of at
least ``similarity`` with it; lines are judged on the input.  Lines without a word
are never removed.

1. Words of a line are cut, hashed, made distinct and sorted by array functions; lines of
   equal word sets collapse to one class by a grouped minimum of their places, and all
   but the first are removed at once.  A line that a third of all documents share costs one
   row per task there.
2. Words of a line are ordered by rarity: by the magnitude of the number of occurrences,
   counted over the whole corpus in a fixed number of hash cells, then by hash.
   Any total order makes the filters exact; rarity makes them selective.
3. Large groups of near copies settle first: lines that agree in their least or greatest
   word hashes (a band) meet the earliest line of the band, and lines that are verified as
   similar to it are removed.  A round has one pair per line, not all pairs of the group.
4. Prefix filter: similar lines share one of their first ``n - ceil(s n) + 1`` words.
   Words that occur nowhere else leave the prefix.  The length filter, the positional
   filter and a bound on the differing words from 128-bit signatures prune the equi-join
   of all lines with those that are not settled.
5. Surviving pairs are verified by the exact Jaccard similarity of their words as text;
   only lines that are in a pair are fetched: a line meets its earliest candidate first,
   all others if that one fails.

All steps are DataFrame code; no Python runs on the executors.

An empty table has no lines.  A very long text is cut whole in one task, a line is never
shortened.
Rows that agree in ``doc_id`` and text are one document and get the same result; null
texts have no line; rows with a null ``doc_id`` come after all others.  Extra columns
are kept by ``remove_matches`` and ignored by ``report``.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.llm.common import written

CELLS = 1 << 20         # hash cells of the word counts
RANK_BITS = 58          # of a word's hash, below the level of its cell: its place in the order of rarity
MAX_LEVEL = 31
BAND = 4                # word hashes in a band
LARGE = 32              # lines of a band that meet its first lines before the prefix join
ROUNDS = 2

WHITE = "\t\x0b\x0c\r"
ID = ["doc", "version", "line_no"]  # a line's place: the total order that "earlier" means
PAIR = [f"{s}_{c}" for s in "ab" for c in ID]


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _doc() -> Column:
    """``doc_id`` with nulls last."""
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1))


def _split(line: Column) -> Column:
    """Words of a line, and empty strings between neighbouring spaces."""
    # most lines hold no white space but spaces; a plain search is much cheaper than a translation
    other = F.contains(line, F.lit(WHITE[0]))
    for c in WHITE[1:]:
        other = other | F.contains(line, F.lit(c))
    spaced = F.when(other, F.translate(line, WHITE, " " * len(WHITE))).otherwise(line)
    return F.split(spaced, " ")


def _words(line: Column) -> Column:
    return F.array_remove(_split(line), "")


def _placed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``__doc`` and ``__version``, and the distinct ``(doc, version, text)`` of it.

    The version is 0 while every ``doc_id`` is there once, else a hash of the text.
    """
    unique = docs.groupBy(_doc().alias("d")).count().where("count > 1").isEmpty()
    version = F.lit(0).cast("long") if unique else F.xxhash64(_text())
    texts = docs.select(_doc().alias("doc"), version.alias("version"), _text().alias("text"))
    return docs.withColumns({"__doc": _doc(), "__version": version}), texts if unique else texts.dropDuplicates(["doc", "version"])


def _lines(texts: DataFrame) -> DataFrame:
    # there is always a line; the outer form saves the planner's own test for one, which would cut the text once more
    return texts.select("doc", "version", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))


def _levels(lines: DataFrame) -> Column:
    """Array of the magnitudes (half octaves) of the words' occurrences in every hash cell; 0: one occurrence at most."""
    words = lines.select(F.explode_outer(_split(F.col("line"))).alias("word")).where("word != ''")
    counts = words.groupBy(F.xxhash64("word").bitwiseAND(CELLS - 1).cast("int").alias("cell")).count()
    level = F.least(F.lit(MAX_LEVEL), F.floor(2 * F.log2("count"))).cast("int")
    found = written(counts.where("count > 1").select("cell", level.alias("level")), "line-levels").toArrow()   # CELLS rows at most
    out = np.zeros(CELLS, dtype=np.int8)
    out[found.column("cell").to_numpy()] = found.column("level").to_numpy()
    return F.split(F.lit(",".join(map(str, out.tolist()))), ",").cast("array<bigint>")     # folded into one constant


def _sets(lines: DataFrame, levels: Column, similarity: Fraction) -> DataFrame:
    """Every line as a set of words: ``h1, h2`` tell the set, ``n`` is its size, ``bits0, bits1`` are set by its words, ``bands`` are
    hashes of its ``BAND`` least and greatest word hashes, ``prefix`` has its ``n - ceil(s n) + 1`` rarest words without the
    ``skip`` first ones, which occur nowhere else."""
    p, q = similarity.numerator, similarity.denominator
    hashes = F.array_remove(F.transform(_split(F.col("line")), lambda w: F.xxhash64(w)), F.xxhash64(F.lit("")))
    hashed = lines.select(*ID, F.sort_array(F.array_distinct(hashes)).alias("words"))
    ranked = lambda h: F.shiftleft(levels[h.bitwiseAND(CELLS - 1)], RANK_BITS).bitwiseOR(F.shiftrightunsigned(h, 64 - RANK_BITS))

    def bits(of: Callable[[Column], Column]) -> Column:
        """A word sets one of 128 bits; bit 57 of its hash tells whether here or in the other half."""
        bit = lambda h: F.call_function("shiftleft", of(h).bitwiseAND(1), F.shiftrightunsigned(h, 58).cast("int"))
        return F.aggregate("words", F.lit(0).cast("long"), lambda s, h: s.bitwiseOR(bit(h)))

    sets = hashed.select(
        *ID, F.size("words").alias("n"), F.xxhash64("words").alias("h1"), F.xxhash64(F.lit(1), "words").alias("h2"),
        bits(lambda h: F.shiftrightunsigned(h, 57)).alias("bits0"), bits(lambda h: F.shiftrightunsigned(F.bitwise_not(h), 57)).alias("bits1"),
        F.array(F.xxhash64(F.slice("words", 1, BAND)),
                F.xxhash64(F.slice("words", F.greatest(F.size("words") - (BAND - 1), F.lit(1)), BAND))).alias("bands"),
        F.sort_array(F.transform("words", ranked)).alias("ranked"))
    length = F.expr(f"n - CAST((n * {p}L + {q - 1}L) DIV {q}L AS INT) + 1")
    sets = sets.withColumn("ranked", F.slice("ranked", 1, length))
    # equal words have equal tokens; two words of one token only make a candidate more
    token = lambda r: r.bitwiseAND(2**32 - 1)
    shared = F.transform(F.filter("ranked", lambda r: r >= 1 << RANK_BITS), token)
    return sets.withColumn("prefix", shared).withColumn("skip", F.size("ranked") - F.size("prefix")).drop("ranked")


def _classes(sets: DataFrame) -> DataFrame:
    """One row per set of words, at the place of its first line; ``lines``: how many have it."""
    equal = [F.first(c).alias(c) for c in ("n", "bits0", "bits1", "bands", "prefix", "skip")]
    grouped = sets.where("n > 0").groupBy("h1", "h2").agg(F.min(F.struct(*ID)).alias("place"), F.count("*").alias("lines"), *equal)
    return grouped.select("place.*", "h1", "h2", "lines", "n", "bits0", "bits1", "bands", "prefix", "skip")


def _settled(texts: DataFrame, firsts: DataFrame, similarity: Fraction) -> DataFrame | None:
    """Places of class representatives that match an earlier line of a large band; ``None`` without large bands.

    The lines of a band meet its earliest line, those that fail the next one, ``ROUNDS`` times; a round's pairs are as many as
    its lines.  What is left meets all earlier lines in the prefix join.
    """
    bands = firsts.select(*ID, F.explode(F.array_distinct("bands")).alias("band"))
    large = bands.groupBy("band").count().where(F.col("count") >= LARGE).select("band")
    live = written(bands.join(large, "band"), "line-bands")
    if live.isEmpty():
        return None
    lines = _fetched(texts, live.select(*ID))
    found = []
    for _ in range(ROUNDS):
        leader = live.groupBy("band").agg(F.min(F.struct(*ID)).alias("leader"))
        later = written(live.join(leader, "band").where(F.struct(*ID) > F.col("leader")), "line-band-pairs")
        pairs = later.select(*[F.col(f"leader.{c}").alias(f"a_{c}") for c in ID], *[F.col(c).alias(f"b_{c}") for c in ID]).distinct()
        found.append(written(similar_pairs(pairs, lines, similarity).select(*[F.col(f"b_{c}").alias(c) for c in ID]).distinct(), "line-settled"))
        live = later.select(*ID, "band").join(found[-1], ID, "left_anti")
    return functools.reduce(DataFrame.union, found)


def candidate_pairs(firsts: DataFrame, similarity: Fraction, settled: DataFrame | None = None) -> DataFrame:
    """Places ``(a_*, b_*)``, a before b, of the class representatives that pass every filter; no b is ``settled``."""
    p, q = similarity.numerator, similarity.denominator

    def side(of: DataFrame, s: str) -> DataFrame:
        rows = of.select(*ID, "n", "bits0", "bits1", "skip", F.posexplode("prefix").alias("at", "token")).withColumn("at", F.col("at") + F.col("skip"))
        return rows.select("token", *[F.col(c).alias(f"{s}_{c}") for c in (*ID, "n", "bits0", "bits1", "at")])

    opened = firsts if settled is None else firsts.join(settled, ID, "left_anti")
    joined = side(opened, "a").join(side(opened, "b"), "token")
    if settled is not None:     # lines that are settled can still be the earlier one
        joined = joined.union(side(firsts.join(settled, ID, "left_semi"), "a").join(side(opened, "b"), "token"))
    candidates = joined.where(
        "(a_doc < b_doc OR (a_doc = b_doc AND (a_version < b_version OR (a_version = b_version AND a_line_no < b_line_no))))"
        # length filter, and the positional filter: the overlap that is still possible reaches the needed one
        f" AND a_n * {q}L >= b_n * {p}L AND b_n * {q}L >= a_n * {p}L"
        f" AND least(a_n - a_at, b_n - b_at) * {p + q}L >= (a_n + b_n) * {p}L"
        # every bit that only one side sets stands for a word that only one side has
        f" AND (bit_count(a_bits0 ^ b_bits0) + bit_count(a_bits1 ^ b_bits1)) * {p + q}L <= (a_n + b_n) * {q - p}L")
    return written(candidates.select(*PAIR).distinct(), "line-pairs")


def _fetched(texts: DataFrame, places: DataFrame) -> DataFrame:
    """``places`` and text of the lines there."""
    wanted = places.groupBy("doc", "version").agg(F.collect_set("line_no").alias("__wanted"))
    cut = texts.join(wanted, ["doc", "version"]).withColumn("__lines", F.split("text", "\n"))
    lines = cut.select("doc", "version", "__lines", F.explode("__wanted").alias("line_no"))
    return written(lines.select(*ID, F.get("__lines", "line_no").alias("line")), "line-texts")


def similar_pairs(candidates: DataFrame, firsts: DataFrame, similarity: Fraction) -> DataFrame:
    """The candidates whose Jaccard similarity reaches ``similarity``; lines travel as text, words are cut where they are compared."""
    p, q = similarity.numerator, similarity.denominator
    for s in "ab":
        lines = firsts.select(*[F.col(c).alias(f"{s}_{c}") for c in ID], F.col("line").alias(f"{s}_line"))
        candidates = candidates.join(lines, [f"{s}_{c}" for c in ID])
    a, b = (F.array_distinct(_words(F.col(f"{s}_line"))) for s in "ab")
    common = F.size(F.array_intersect("a_words", "b_words"))
    total = F.size("a_words") + F.size("b_words")
    compared = candidates.select(*PAIR, a.alias("a_words"), b.alias("b_words")).select(
        *PAIR, (common * (p + q) >= total * p).alias("similar"), F.monotonically_increasing_id().alias("pair"))
    # reading the row number keeps the comparison in its projection: the words are cut once
    return compared.where("similar AND pair >= 0").select(*PAIR)


def removed_lines(texts: DataFrame, similarity: Fraction = Fraction(4, 5)) -> DataFrame:
    """``(doc, version, line_no)`` of every line of the distinct ``texts(doc, version, text)`` that matches an earlier one."""
    lines = _lines(texts)
    sets = written(_sets(lines, _levels(lines), similarity), "lines")
    firsts = written(_classes(sets), "line-classes")
    shared = firsts.where("lines > 1").select("h1", "h2", F.struct(*ID).alias("place"))
    repeated = sets.select("h1", "h2", *ID).join(shared, ["h1", "h2"]).where(F.struct(*ID) != F.col("place")).select(*ID)
    settled = _settled(texts, firsts, similarity)
    pairs = candidate_pairs(firsts, similarity, settled)
    places = [pairs.select(*[F.col(f"{s}_{c}").alias(c) for c in ID]) for s in "ab"]
    fetched = _fetched(texts, places[0].union(places[1]))
    # one match is enough: each line meets its earliest candidate first, and the others only if that one fails
    b = PAIR[len(ID):]
    earliest = pairs.groupBy(*b).agg(F.min(F.struct(*PAIR[:len(ID)])).alias("a")).select("a.*", *b)
    hit = written(similar_pairs(earliest, fetched, similarity).select(*b), "line-matches")
    others = written(pairs.join(hit, b, "left_anti").select(*PAIR), "line-pairs-left")
    late = hit.union(similar_pairs(others, fetched, similarity).select(*b)).distinct()
    return repeated.union(late) if settled is None else repeated.union(late).union(settled)


def _per_document(texts: DataFrame, similarity: Fraction) -> DataFrame:
    removed = removed_lines(texts, similarity)
    return removed.groupBy("doc", "version").agg(F.sort_array(F.collect_set("line_no")).alias("__removed"))


def _joined(base: DataFrame, texts: DataFrame, similarity: Fraction) -> DataFrame:
    removed = _per_document(texts, similarity).select(F.col("doc").alias("__d"), F.col("version").alias("__v"), "__removed")
    return base.join(removed, (F.col("__doc") == F.col("__d")) & (F.col("__version") == F.col("__v")), "left")


def report(docs: DataFrame, similarity: Fraction = Fraction(4, 5)) -> DataFrame:
    """``(doc_id, n_lines, n_removed, removed_lines)`` per row; lines with a word count, line numbers start at 0."""
    n = F.size(F.filter(F.split(_text(), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")))
    placed, texts = _placed(docs)
    base = placed.select(F.col("doc_id").cast("long").alias("doc_id"), "__doc", "__version", n.cast("long").alias("n_lines"))
    none = F.array().cast("array<int>")
    return _joined(base, texts, similarity).select(
        "doc_id", "n_lines", F.size(F.coalesce("__removed", none)).cast("long").alias("n_removed"),
        F.coalesce("__removed", none).alias("removed_lines"))


def remove_matches(docs: DataFrame, similarity: Fraction = Fraction(4, 5)) -> DataFrame:
    """``docs`` with removed lines taken out of ``text`` and ``n_chars`` (if there) brought up to date; null texts stay null."""
    base, texts = _placed(docs)
    out = _joined(base, texts, similarity).withColumn("__lines", F.split(F.col("text").cast("string"), "\n"))
    out = out.withColumn("__keep", F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__removed"))
    text = F.when(F.col("__removed").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform("__keep", lambda i: F.get(F.col("__lines"), i)), "\n"))
    # the line array is read by two columns, so it is not computed again for every line
    out = out.withColumn("__new", text).withColumn("__count", F.size("__lines"))
    columns = [F.col("__new").alias(c) if c == "text" else F.char_length("__new").cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
               else F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns)
