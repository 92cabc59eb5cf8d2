"""SimHash, byte-window, word-window and line dedup against brute force, with the awkward cases."""

import hashlib
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
import xxhash

from martforge.llm import debruijn, line_dedup, simhash, suffix
from martforge.llm.anchors import segments
from tests.llm.helpers import awkward_texts, empty, frame

IDS = "distinct", "with nulls and repeats"


def ids_for(case, n):
    if case == IDS[0]:
        return list(range(0, 3 * n, 3))
    return [None if i % 11 == 5 else i - 1 if i % 7 == 3 else i for i in range(n)]


# --- SimHash --------------------------------------------------------------------------------
def brute_fingerprint(text, shingle=3):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [w.lower() for w in words]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, distance):
    parent = list(range(len(fps)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


@pytest.mark.parametrize("case", IDS)
def test_simhash_classes(spark, case):
    texts = awkward_texts(1)
    ids = ids_for(case, len(texts))
    got = simhash.near_duplicates(frame(spark, texts, ids)).collect()
    fps = [brute_fingerprint(t) for t in texts]
    roots = brute_components(fps, 2)
    low = {}
    for i, r in zip(ids, roots):
        if i is not None:
            low[r] = min(low.get(r, i), i)
    want = sorted(((i, f"{f:016x}", low.get(r)) for i, f, r in zip(ids, fps, roots)), key=repr)
    assert sorted(map(tuple, got), key=repr) == want


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_connect_what_brute_force_connects(spark, distance):
    r = random.Random(distance)
    fps = [r.getrandbits(64) for _ in range(20)]
    for _ in range(150):  # chains of small steps, so that components are long paths
        f = r.choice(fps)
        for _ in range(r.randint(0, 4)):
            f ^= 1 << r.randrange(64)
        fps.append(f)
    fps = sorted(set(fps))
    df = spark.createDataFrame([(int(np.uint64(f).astype(np.int64)),) for f in fps], "fp long")
    edges = simhash.links(df, distance)
    pairs = [(a & (2**64 - 1), b & (2**64 - 1)) for a, b in edges.collect()]
    assert all(bin(a ^ b).count("1") <= distance for a, b in pairs)
    parent = {f: f for f in fps}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    brute = brute_components(fps, distance)
    assert all((root(fps[i]) == root(fps[j])) == (brute[i] == brute[j]) for i in range(len(fps)) for j in range(i))
    assert simhash.connected_components(edges).select("root").distinct().count() == len({root(f) for p in pairs for f in p})


def test_simhash_keeps_one_of_each_group(spark):
    texts = awkward_texts(2)
    docs = frame(spark, texts)
    kept = simhash.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    want = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)
    assert simhash.near_duplicates(empty(spark)).count() == 0


# --- byte windows ----------------------------------------------------------------------------
def brute_bytes(texts, ids, length):
    order = [2**63 if i is None else i for i in ids]
    raw = [(t or "").encode() for t in texts]
    first = {}
    for b, d in zip(raw, order):
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            first[w] = min(first.get(w, d), d)
    out = []
    for b, d, i in zip(raw, order, ids):
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p:p + length]] < d:
                gone[p:p + length] = b"\x01" * length
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("case", IDS)
@pytest.mark.parametrize("hot", [False, True])
def test_suffix_dedup(spark, case, hot, monkeypatch):
    from martforge.llm import segments as module
    if hot:  # every anchor with two open contents is dealt by its windows
        monkeypatch.setattr(module, "HOT", 1)
    texts = awkward_texts(3)
    ids = ids_for(case, len(texts))
    got = suffix.report(frame(spark, texts, ids), length=20, gram=8).collect()
    assert sorted(map(tuple, got), key=repr) == brute_bytes(texts, ids, 20)


def test_suffix_dedup_a_frequent_window_does_not_fill_a_bucket(spark, monkeypatch):
    from martforge.llm import segments as module
    monkeypatch.setattr(module, "HOT", 1)

    def checked(merged):
        def of(length):
            def run(t):  # the passage is there 300 times, but a task meets each of its windows at most twice
                assert max(Counter(t.column("text").to_pylist()).values()) <= 2
                return merged(length)(t)
            return run
        return of

    for name in [n for n in dir(suffix) if n.startswith("_merged")]:
        monkeypatch.setattr(suffix, name, checked(getattr(suffix, name)))
    r = random.Random(12)
    passage = "".join(r.choice("abcdefgh") for _ in range(45))
    around = lambda: "".join(r.choice("ijklmnop") for _ in range(12))
    texts = [around() + passage + around() for _ in range(300)]
    ids = [i // 2 if i < 20 else None if i % 50 == 0 else i for i in range(300)]
    got = suffix.report(frame(spark, texts, ids), length=20, gram=8).collect()
    assert sorted(map(tuple, got), key=repr) == brute_bytes(texts, ids, 20)


def test_suffix_dedup_texts_and_empty_table(spark):
    texts = ["é" * 30 + "abc", "é" * 30 + "xyz", None]
    out = {r.doc_id: r for r in suffix.remove_repeats(frame(spark, texts), length=50, gram=24).collect()}
    assert out[0].text == texts[0] and out[1].text == "xyz" and out[1].n_chars == 3 and out[2].text is None
    assert suffix.report(empty(spark)).count() == 0


def test_merge_equals_sorting_all_suffixes():
    r = random.Random(5)
    for _ in range(300):
        alphabet = r.choice([b"ab", b"ab\x00\xff", bytes(range(256))])
        strings = [bytes(r.choice(alphabet) for _ in range(r.randint(1, 20))) for _ in range(r.randint(2, 10))]
        doc, length = np.array([r.randint(0, 4) for _ in strings]), r.randint(1, 7)
        first = {}
        for s, d in zip(strings, doc):
            for p in range(len(s) - length + 1):
                first[s[p:p + length]] = min(first.get(s[p:p + length], 9), d)
        want = sorted((k, p) for k, (s, d) in enumerate(zip(strings, doc)) for p in range(len(s) - length + 1) if first[s[p:p + length]] < d)
        assert sorted(suffix.repeated_windows(strings, doc, length, r.randint(1, 4))) == want
        begins = np.cumsum([0, *[len(s) + 1 for s in strings]])
        cut = len(strings) // 2
        places, common = suffix.merge([suffix.Shard(strings[:cut], 0), suffix.Shard(strings[cut:], int(begins[cut]))], 30)
        suffixes = [s[p:] for s in strings for p in range(len(s) + 1)]
        merged = [suffixes[p] for p in places]
        assert merged == sorted(suffixes)
        for a, b, n in zip(merged, merged[1:], common[1:]):
            shared = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert n == min(shared, 30)


def suffixes_of(strings):
    """(symbols, ends) as ``suffix_order`` takes them, and its answer by sorting."""
    begins = np.cumsum([0, *[len(s) + 1 for s in strings]])
    symbols = np.frombuffer(b"\x00".join(strings) + b"\x00", dtype=np.uint8).astype(np.uint16) + np.uint16(1)
    symbols[begins[1:] - 1] = 0
    places = [(s[p:], int(b) + p) for s, b in zip(strings, begins) for p in range(len(s) + 1)]
    return symbols, begins[1:] - 1, [place for _, place in sorted(places)]


@pytest.mark.parametrize("narrow", [False, True])
def test_suffix_order_equal_suffixes_by_place(narrow, monkeypatch):
    if narrow:  # as with so many suffixes that ranks and places do not fit one number
        ordered = suffix._ordered
        monkeypatch.setattr(suffix, "_ordered", lambda key, bits, place, place_bits: ordered(key, 65, place, place_bits))
    r = random.Random(8)
    for alphabet in (b"a", b"ab", bytes(range(256)), b"\x00\xff"):
        for _ in range(15):
            strings = [bytes(r.choice(alphabet) for _ in range(r.choice([0, 1, 7, 60]))) for _ in range(r.randint(1, 12))]
            strings += r.sample(strings, len(strings) // 2)
            symbols, ends, want = suffixes_of(strings)
            assert suffix.suffix_order(symbols, ends, max(map(len, strings)) + 1).tolist() == want


def test_suffix_order_suffixes_that_agree_with_no_other_rest(monkeypatch):
    sorted_keys, ordered = [], suffix._ordered
    monkeypatch.setattr(suffix, "_ordered", lambda key, *rest: sorted_keys.append(len(key)) or ordered(key, *rest))
    r = random.Random(9)
    strings = [bytes(r.choice(b"abcdefgh") for _ in range(70)) for _ in range(40)]
    strings.append(strings[0])
    symbols, ends, want = suffixes_of(strings)
    assert suffix.suffix_order(symbols, ends, 71).tolist() == want
    # the two equal strings alone are looked at again, and their suffixes rest when they have ended
    assert sorted_keys[0] == len(symbols) and sum(sorted_keys[1:]) < len(symbols) // 4


def test_segments_cover_every_window_once_across_blocks(monkeypatch):
    from martforge.llm import anchors
    monkeypatch.setattr(anchors, "BLOCK", 64)
    r = np.random.default_rng(0)
    docs = [r.integers(0, 3, n).astype(np.uint64) for n in (0, 1, 9, 10, 63, 64, 65, 500)]
    doc, start, n, _, _ = segments(docs, 10, 4)
    seen = sorted((d, s + k) for d, s, m in zip(doc, start, n) for k in range(m))
    assert seen == [(d, p) for d, u in enumerate(docs) for p in range(len(u) - 9)]


# --- word windows ------------------------------------------------------------------------------
def brute_words(texts, ids, length):
    rows = sorted({(2**63 - 1 if i is None else i, t or "") for i, t in zip(ids, texts)},
                  key=lambda x: (x[0], version(x, ids, texts)))
    seen, result = set(), {}
    for key in rows:
        w = key[1].encode().split()
        gone = bytearray(len(w))
        for p in range(len(w) - length + 1):
            k = tuple(w[p:p + length])
            if k in seen:
                gone[p:p + length] = b"\x01" * length
            seen.add(k)
        kept = [x for x, g in zip(w, gone) if not g]
        result[key] = (len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest())
    return sorted(((i, *result[(2**63 - 1 if i is None else i, t or "")]) for i, t in zip(ids, texts)), key=repr)


def version(key, ids, texts):
    """Rows that share a doc_id are ordered by the signed hash of their text."""
    return int(np.uint64(xxhash.xxh64_intdigest(key[1].encode(), seed=42)).astype(np.int64))


@pytest.mark.parametrize("case", IDS)
def test_substring_dedup(spark, case):
    texts = awkward_texts(4)
    ids = ids_for(case, len(texts))
    got = debruijn.report(frame(spark, texts, ids), length=8, gram=3).collect()
    assert sorted(map(tuple, got), key=repr) == brute_words(texts, ids, 8)


def test_substring_dedup_branches_and_periods(spark):
    r = random.Random(9)
    # three letters only: nearly every anchor has many contents, and texts repeat within themselves
    texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 120))) for _ in range(25)] + ["a " * 90, "a b " * 50]
    got = debruijn.report(frame(spark, texts), length=6, gram=2).collect()
    assert sorted(map(tuple, got), key=repr) == brute_words(texts, list(range(len(texts))), 6)
    assert debruijn.report(empty(spark)).count() == 0


# --- lines ---------------------------------------------------------------------------------------
def brute_lines(texts, ids, similarity):
    keys = sorted({(2**63 - 1 if i is None else i, version((i, t or ""), None, None), t or "") for i, t in zip(ids, texts)})
    sets, gone = [], {}
    for key in keys:
        gone[key] = []
        for n, line in enumerate(key[2].split("\n")):
            words = frozenset(re.findall(r"[^\x20\x09-\x0D]+", line))
            if words:
                if any(Fraction(len(words & s), len(words | s)) >= similarity for s in sets):
                    gone[key].append(n)
                sets.append(words)
    out = []
    for i, t in zip(ids, texts):
        key = (2**63 - 1 if i is None else i, version((i, t or ""), None, None), t or "")
        lines = sum(1 for x in key[2].split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
        out.append((i, lines, len(gone[key]), gone[key]))
    return sorted(out, key=repr)


def line_texts(seed):
    r = random.Random(seed)
    words = [f"t{i}" for i in range(15)]
    lines = [[r.choice(words) for _ in range(r.randint(1, 12))] for _ in range(25)]
    for _ in range(60):  # variants: a word dropped, added, repeated or all in another order
        line = list(r.choice(lines))
        r.choice([lambda: line.pop(), lambda: line.append(r.choice(words)), lambda: r.shuffle(line), lambda: line.append(line[0])])()
        if line:
            lines.append(line)
    r.shuffle(lines)
    texts = ["\n".join(" ".join(x) for x in lines[i:i + 4]) for i in range(0, len(lines), 4)]
    return [*texts, texts[0], "", None, "\n \n", "t1\tt2  t3\x0bt4\nt4 t3 t2 t1"]


@pytest.mark.parametrize("case", IDS)
@pytest.mark.parametrize("similarity", [Fraction(4, 5), Fraction(1, 2)])
def test_line_dedup(spark, case, similarity):
    texts = line_texts(6)
    ids = ids_for(case, len(texts))
    got = line_dedup.report(frame(spark, texts, ids), similarity).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, list(r.removed_lines)) for r in got), key=repr) == brute_lines(texts, ids, similarity)


def test_line_dedup_texts(spark):
    docs = frame(spark, ["a b\nc d\n\na b", "c d\nnew line", None, "same"])
    out = line_dedup.remove_matches(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {
        0: ("a b\nc d\n", 8), 1: ("new line", 8), 2: (None, None), 3: ("same", 4)}
    assert line_dedup.report(empty(spark)).count() == 0


def test_line_dedup_keeps_the_lines_of_repeated_rows(spark):
    import corpus_pipeline

    # (7, "a b c") and the null id's text are there twice: the same document, not an earlier one
    texts = ["a b c", "a b c", "d e f\ng h i", "d e f\ng h i", "a b c\nnew line"]
    ids = [7, 7, None, None, 8]
    docs = frame(spark, texts, ids)
    got = line_dedup.report(docs).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, list(r.removed_lines)) for r in got), key=repr) == brute_lines(texts, ids, Fraction(4, 5))
    want = sorted([(7, "a b c")] * 2 + [(None, "d e f\ng h i")] * 2 + [(8, "new line")], key=repr)
    for out in (line_dedup.remove_matches(docs), corpus_pipeline.line_dedup_stage(spark, docs, "")):
        assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == want
