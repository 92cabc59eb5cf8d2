"""Importance resampling, the token store and phrase mining against brute force and the tokenizer library."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from martforge.llm import crc, phrases, rans, resampling, token_store
from martforge.llm.transducers import Transducer, counted, cut, unions
from martforge.llm.word_tokens import WordTokenizer
from tests.llm.helpers import SCHEMA, awkward_texts, empty, frame

WORDS = public_tokenizers.path("word_bpe_49k.json")


def odd_texts(alphabet, n=1500, seed=3):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(n)]


def repeated_and_null_ids(texts):
    ids = list(range(len(texts)))
    ids[1] = ids[2] = None
    ids[4], texts[4] = ids[5], texts[5]
    ids[7] = ids[8]
    return ids


# --- checksums of concatenations -----------------------------------------------------------------------
def test_joined_checksums():
    r = random.Random(1)
    parts = [(r.randbytes(r.randint(0, 40)), r.randbytes(r.choice([0, 1, 5, 63, 64, 65, 1000, 100_001]))) for _ in range(200)]
    got = crc.joined(np.array([zlib.crc32(a) for a, _ in parts], dtype=np.uint32), np.array([zlib.crc32(b) for _, b in parts], dtype=np.uint32),
                     np.array([len(b) for _, b in parts]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in parts]


# --- importance resampling ---------------------------------------------------------------------------------
def brute_features(text, order=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return words, [" ".join(words[i:i + n]) for n in range(1, order + 1) for i in range(len(words) - n + 1)]


def brute_resample(ids, texts, target, buckets, percent, min_words, seed):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    source, wanted = Counter(), Counter()
    for t in texts:
        source.update(map(bucket, brute_features(t)[1]))
    for t in target:
        wanted.update(map(bucket, brute_features(t)[1]))
    s_all, t_all = sum(source.values()) + buckets, sum(wanted.values()) + buckets
    gain = [math.floor(1000 * math.log((wanted[b] + 1) * s_all / ((source[b] + 1) * t_all))) for b in range(buckets)]
    rows = []
    for i, t in zip(ids, texts):
        words, found = brute_features(t)
        weight = sum(gain[bucket(f)] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words)])
    able = sorted((r for r in rows if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def test_resampling_equals_brute_force(spark):
    texts = awkward_texts(n=120) + odd_texts("aAbéZ09 -\x00日.", 200) + ["", None, "\x00\x00", "one"]
    target = ["w1 w2 w3 passage", None, "", "né 日本 ab"]
    ids = repeated_and_null_ids(texts)
    wanted = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    for buckets, percent in ((97, 25), (70_000, 100)):
        got = resampling.resample(frame(spark, texts, ids), wanted, percent=percent, min_words=5, buckets=buckets)
        assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resample(ids, texts, target, buckets, percent, 5, 7)


def test_resampling_of_empty_tables(spark):
    wanted = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(empty(spark), wanted).count() == 0
    texts = ["w " * 30, "x y z " * 10]
    got = resampling.resample(frame(spark, texts), wanted.limit(0), percent=50)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_resample([0, 1], texts, [], 10000, 50, 20, 7)


def test_features_never_cross_documents():
    texts = [b"a b", b"", b"b c", b"\x00d\x00", b"e"]
    found, n, words = resampling.batch_features(texts, 1 << 32, 3)
    at = np.cumsum(n)
    for t, hi, k, w in zip(texts, at, n, words):
        own, grams = brute_features(t.decode(), 3)
        assert Counter(found[hi - k:hi].tolist()) == Counter(zlib.crc32(g.encode()) for g in grams) and w == len(own)


# --- token store -------------------------------------------------------------------------------------------
@pytest.mark.parametrize("alphabet", [" \n\t'aAbJsStTrRe.,;!09é̌̇İΣςK日本\x00\x1c\x85 🙂<|>-_ ", " aAeEéÉßÿÞ×÷'.,!?19-̌sS\n", "abcdefghijklmnopqrstuvwxyzABCÀàü,. 7"])
def test_batch_ids_equal_the_library(alphabet):
    texts = odd_texts(alphabet) + ["<|startoftext|>x", "It's 'same !!'S THEY'LL J̌ é", "a" * 3000, "", " "]
    library, own = Tokenizer.from_file(WORDS), WordTokenizer(WORDS)
    for batch in (texts, [t for t in texts if "<|" not in t]):
        ids, first = own.batch_ids([t.encode() for t in batch])
        for t, lo, hi in zip(batch, first, first[1:]):
            assert ids[lo:hi].tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_token_store_round_trip(spark, tmp_path):
    texts = odd_texts("aAb Ré日.,'<|>\n", 300) + awkward_texts() + ["", None, "word and number 7 " * 3000]
    ids = repeated_and_null_ids(texts)
    library = Tokenizer.from_file(WORDS)
    encoded = [np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4") for t in texts]
    order = sorted(range(len(texts)), key=lambda i: (ids[i] is None, ids[i] or 0, zlib.crc32(encoded[i].astype("<u2").tobytes())))
    at, expected = 0, []
    for i in order:
        expected.append((ids[i], at, len(encoded[i]), zlib.crc32(encoded[i].tobytes())))
        at += len(encoded[i])
    for block_ids in (501, token_store.BLOCK_IDS):  # documents over many blocks, and one block a shard
        path = f"{tmp_path}/store-{block_ids}"
        token_store.write(frame(spark, texts, ids), path, WORDS, block_ids=block_ids)
        got = [tuple(r) for r in token_store.report(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)
        parts = token_store.read_parts(spark, path).orderBy("shard", "first").collect()
        assert b"".join(bytes(p.ids) for p in parts) == b"".join(encoded[i].tobytes() for i in order)
    assert token_store.round_trip(empty(spark), WORDS).count() == 0


def test_rans_blocks_checkpoints_and_damage():
    r = np.random.default_rng(0)
    for n in (0, 1, 5, 511, 513, 5000, 200_000):
        symbols = np.minimum(r.zipf(1.2, n), 49_407).astype(np.uint32)
        table = rans.Table.of_counts(np.bincount(symbols, minlength=49_408) + (np.arange(49_408) % 7 == 0))
        raw = rans.encode(symbols, table)
        block = rans.Block(raw, rans.Table(np.trim_zeros(table.freq, "b")))
        assert (block.decode() == symbols).all()
        for k in range(len(block.state)):
            lo, hi = block.stretch(k)
            assert (block.decode(k, k + 1) == symbols[lo:hi]).all()
        with pytest.raises(ValueError):
            rans.Block(raw[:-9] + bytes([raw[-9] ^ 1]) + raw[-8:], table)
    with pytest.raises(ValueError):
        rans.encode(np.array([3], dtype=np.uint32), rans.Table.of_counts(np.array([1, 1])))
    with pytest.raises(ValueError):
        rans.Block(raw, rans.Table.of_counts(np.array([1, 1])))


# --- phrases -----------------------------------------------------------------------------------------------
def brute_collocations(rows, min_count, top, inside=50, order=3):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f[lang].update(tuple(words[i:i + k]) for k in range(1, order + 1) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        able = {g: a for g, a in counts.items() if len(g) > 1 and a >= min_count}
        found = []
        for g, a in able.items():
            if any(100 * b >= inside * a for h, b in able.items() if len(h) > len(g) and any(h[i:i + len(g)] == g for i in range(len(h)))):
                continue
            score, k = min((math.floor(Fraction(1000000 * a * a, counts[g[:k]] * counts[g[k:]])), k) for k in range(1, len(g)))
            found.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        out += [(lang, rank, p.decode(), -a, x, y, n[lang], -s) for rank, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def test_collocations_equal_brute_force(spark, monkeypatch):
    r = random.Random(5)
    texts = awkward_texts(n=150, vocabulary=6) + odd_texts("abAB \t.,\x01\n", 300) + ["new york city. " * 30 + "york city, New York"] * 5
    langs = [r.choice(["en", "de", None, "en\x00", ""]) for _ in texts]
    rows = [(i, t, lang, "s", 0, "x", 7, "y", 1) for i, (t, lang) in enumerate(zip(texts, langs))]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = brute_collocations(list(zip(langs, texts)), 3, 40)
    assert [tuple(x) for x in phrases.collocations(docs, min_count=3, top=40).orderBy("lang", "rank").collect()] == expected
    # the same with stretches and buffers of a few words
    monkeypatch.setattr(phrases, "SAMPLE_DOCS", 50)
    assert sorted(tuple(x) for x in phrases.collocations(docs, min_count=3, top=40).collect()) == expected
    assert phrases.collocations(empty(spark)).count() == 0


def test_stretches_carry_words_over(monkeypatch):
    raw = " ".join(random.Random(2).choice(["a", "bb", "c.", "dd,", "e\n"]) for _ in range(5000)).encode()
    whole = Counter()
    for g in phrases.shard_grams(raw, 3):
        whole.update(dict(zip(g.phrases(np.arange(len(g))), g.weight.tolist())))
    for buffer, words in ((64, 1 << 20), (1 << 20, 50), (100, 7)):
        monkeypatch.setattr(phrases, "_BUFFER", buffer)
        monkeypatch.setattr(phrases, "MAX_WORDS", words)
        parts = Counter()
        for g in phrases.shard_grams(raw, 3):
            parts.update(dict(zip(g.phrases(np.arange(len(g))), g.weight.tolist())))
        assert parts == whole


def test_transducers_cut_unite_and_compose(monkeypatch):
    r = random.Random(1)
    for n, v in ((0, 1), (1, 1), (60, 3), (500, 40)):
        words, piece = [f"w{r.randrange(v)}".encode() for _ in range(n)], np.sort(np.array([r.randrange(1 + n // 9) for _ in range(n)], dtype=np.int64))
        expected = Counter(tuple(words[i:i + k]) for k in (1, 2, 3) for i in range(n - k + 1) if piece[i] == piece[i + k - 1])
        grams = counted(pa.array(words, type=pa.large_binary()), piece, 3)
        automaton = Transducer.load(Transducer.build(grams).dump(), 3)
        back = automaton.grams()
        assert [tuple(p.split(b" ")) for p in back.phrases(np.arange(len(back)))] == sorted(expected)
        wanted = [list(k) for k in expected] + [[b"zz"], [b"w0", b"zz"], [b"w0"] * 4]
        assert automaton.compose(wanted).tolist() == [expected[tuple(k)] for k in wanted]
        for bound in ([b"w1"], [b"w1", b"w10"], [b"w2x", b"a"], [b"a"], [b"z"]):
            assert cut(grams, [bound])[0] == sum(list(k) < bound for k in expected)
        for limit in (1 << 20, max(v // 2, 3)):  # the second one makes the union split
            monkeypatch.setattr("martforge.llm.transducers.MAX_WORDS", limit)
            if len(grams) < 10 * limit:
                both = unions([back, grams.slice(0, len(grams) // 2)], 3)
                total = Counter()
                for g in both:
                    total.update(dict(zip((tuple(p.split(b" ")) for p in g.phrases(np.arange(len(g)))), g.weight.tolist())))
                half = sorted(expected)[:len(grams) // 2]
                assert total == Counter({k: c + (expected[k] if k in half else 0) for k, c in expected.items()})
        monkeypatch.undo()
    # common endings are one state
    grams = counted(pa.array([b"a", b"x", b"b", b"x", b"c", b"x"], type=pa.large_binary()), np.array([0, 0, 1, 1, 2, 2]), 2)
    assert len(Transducer.build(grams).levels[1][1]) == 2
