"""Top-k search, quality rules, token counts, licences, packing, codec and the pipeline."""

import random
import zlib
from array import array

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from martforge.llm import bpe_count, licenses, packing, quality, sentencepiece_codec, vafile
from martforge.llm.pieces import SPACE, vocabulary
from martforge.llm.sql import ORACLE
from tests.llm.helpers import awkward_texts, empty, frame

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def odd_texts(n=3000, seed=1):
    r = random.Random(seed)
    alphabet = " \n\t" + SPACE + "aeinst<>/s1209.,é日本\x00🙂 "
    out = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))).replace("a", r.choice(["a", "   ", "the "])) for _ in range(n)]
    return out + ["<s> </s><unk>", "<|endoftext|>", "x  \n <|endoftext|> y", "a\r\nb", "a" * 3000, " ", "\n", "", None]


# --- token counts and codec -------------------------------------------------------------------------
def test_token_counts_equal_the_library(spark):
    texts = odd_texts() + awkward_texts()
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = {r.doc_id: r for r in bpe_count.token_counts(frame(spark, texts), MODEL, limit=20).collect()}
    for i, t in enumerate(texts):
        n = len(library.encode(t or ""))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((t or "").encode()), n > 20), repr(t)
    assert bpe_count.token_counts(empty(spark), MODEL).count() == 0


def brute_viterbi(text, vocab):
    """Best total score over all segmentations of a marked text, by dynamic programming over every piece."""
    unknown = -max(vocab.rank.values()) - 10.0
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(1, len(text) + 1):
        for j in range(max(0, i - 20), i):
            if text[j:i] in vocab.rank:
                best[i] = max(best[i], best[j] - vocab.rank[text[j:i]])
        if text[i - 1] not in vocab.rank:
            best[i] = max(best[i], best[i - 1] + unknown)
    return best[-1]


def test_codec_round_trip_and_best_scores(spark):
    texts = odd_texts(1000) + awkward_texts()
    docs = frame(spark, texts)
    encoded = sentencepiece_codec.encode_documents(docs, MODEL)
    decoded = {r.doc_id: r.text for r in sentencepiece_codec.decode_documents(encoded, MODEL).collect()}
    assert decoded == {i: t or "" for i, t in enumerate(texts)}
    assert sentencepiece_codec.codec_report(docs, MODEL).where("NOT round_trip").count() == 0
    codec, vocab = sentencepiece_codec.codec(MODEL), vocabulary(MODEL)
    score = {i: -vocab.rank[p] for p, i in vocab.ids.items()}
    unknown = -max(vocab.rank.values()) - 10.0
    for t in texts[:400]:
        if t and SPACE not in t:
            marked = vocab.dummy_prefix + t.replace(" ", SPACE)
            ids = list(array("I", codec.encode(t)))
            uncovered = sum(c not in vocab.rank for c in marked)
            assert sum(score.get(i, 0.0) for i in ids) + unknown * uncovered == brute_viterbi(marked, vocab), repr(t)


# --- packing ------------------------------------------------------------------------------------------
def test_packing(spark):
    texts = odd_texts(400) + awkward_texts() + ["word " * 5000, "x" * 9000]
    library, size = Tokenizer.from_file(BYTES), 64
    rows = packing.pack(frame(spark, texts), BYTES, max_tokens=size).collect()
    ids = {i: [*library.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    pieces = {(r.doc_id, r.piece): r for r in rows}
    assert len(pieces) == len(rows)
    for i, own in ids.items():
        at = 0
        mine = [pieces[i, k] for k in range(sum(1 for r in rows if r.doc_id == i))]
        assert (len(mine) == 1) == (len(own) <= size)
        for k, r in enumerate(mine):
            assert r.start == at and r.length <= size and (k == 0 or r.length == size)
            assert r.ids_crc32 == zlib.crc32(array("I", own[at:at + r.length]).tobytes())
            at += r.length
        assert at == len(own)
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= size
    assert len(bins) <= 1.02 * sum(r.length for r in rows) / size + 1
    assert packing.pack(empty(spark), BYTES).count() == 0


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_respects_every_capacity(rule):
    r = random.Random(3)
    histogram = {n: r.randint(1, 30) for n in r.sample(range(1, 101), 40)}
    plan = packing.Plan(histogram, 100, 4, 4000 + 100 * 100 - 4000, rule=rule)
    tight = packing.Plan({n: c for n, c in histogram.items() if n <= 60}, 100, 4, 4000, rule=rule)
    for p, h, documents, attention in ((plan, histogram, 4, 10_000), (tight, {n: c for n, c in histogram.items() if n <= 60}, 4, 4000)):
        length = np.repeat(list(h), list(h.values()))
        number = np.concatenate([np.arange(c) for c in h.values()])
        seq, offset = p.place(length, number)
        for b in range(p.bins):
            own = np.flatnonzero(seq == b)
            order = own[np.argsort(offset[own])]
            assert 0 < len(own) <= documents and (length[own] ** 2).sum() <= attention
            assert (offset[order] == np.cumsum(length[order]) - length[order]).all() and length[own].sum() <= 100
        assert set(seq) == set(range(p.bins))
    with pytest.raises(ValueError):
        packing.Plan({101: 1}, 100, 4, 10**6)


# --- quality --------------------------------------------------------------------------------------------
def test_quality_report_equals_sql(spark):
    texts = odd_texts(300) + awkward_texts() + ["# " * 30 + "word " * 10, "l1 a\nl1 a\n" * 20]
    docs = frame(spark, texts, [None if i % 50 == 3 else i // 2 for i in range(len(texts))])
    report = quality.report(docs)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.sql(ORACLE["op5_quality_rules"])
    assert report.columns == want.columns
    import pandas as pd
    clean = lambda rows: sorted((tuple(None if pd.isna(x) else x for x in r) for r in rows), key=repr)
    assert clean(report.collect()) == clean(want.fetchall())


def test_cascade_returns_the_input_columns_as_they_were(spark):
    from pyspark.sql import functions as F
    docs = frame(spark, awkward_texts())
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "__row"]
    marked = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    kept = quality.keep_good(marked, list(quality.RULES))
    assert kept.schema == marked.schema
    expected = {r.doc_id for r in quality.report(docs, list(quality.RULES)).where("kept").collect()}
    rows = kept.collect()
    assert {r.doc_id for r in rows} == expected and rows
    assert all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_cascade_keeps_what_the_report_keeps_in_any_order(spark):
    texts = awkward_texts(7) + ["ok words are here and they go on for long enough to pass", "# " * 40]
    docs = frame(spark, texts)
    want = sorted(r.doc_id for r in quality.report(docs).where("kept").collect())
    for rules in (None, quality.RULES, quality.RULES[::-1]):
        kept = quality.keep_good(docs, rules)
        assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == want
    assert {r.name for r in quality.order_rules(docs)} == {r.name for r in quality.RULES}
    assert quality.report(empty(spark)).count() == 0 and quality.keep_good(empty(spark)).count() == 0


# --- top-k ------------------------------------------------------------------------------------------------
def brute_top_k(rows, k, every):
    whole = {}
    parts = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            parts.append((i, [int(np.floor(256.0 * float(np.float32(x)))) for x in v]))
    out = []
    for i, q in {(i, tuple(q)): (i, q) for i, q in parts if i % every == 0}.values():
        found = sorted((-max(min(sum(a * b for a, b in zip(q, v)), 2**63 - 1), -2**63), j) for j, v in parts if j != i and len(v) == len(q))[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(found, 1)]
    del whole
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e25])
def test_top_k(spark, scale, monkeypatch):
    monkeypatch.setattr(vafile, "DATA_BLOCK", 16)
    monkeypatch.setattr(vafile, "QUERY_BLOCK", 4)
    r = np.random.default_rng(0)
    vectors = [[float(x) * scale for x in v] for v in r.normal(size=(60, 5)).astype(np.float32)]
    rows = list(enumerate(vectors)) + [(100 + i, vectors[3]) for i in range(30)]          # many copies: ties
    rows += [(3, vectors[3]), (5, vectors[8]), (10, vectors[1])]                          # repeated ids
    rows += [(200, None), (210, [1.0, None, 2.0, 1.0, 0.0]), (220, [float("nan")] * 5), (230, [float("inf")] * 5),
             (None, vectors[0]), (240, []), (250, []), (260, [1.0, 2.0]), (270, [2.0, 1.0]), (280, [0.0] * 5), (-10, vectors[2])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<float>, q string, d int")
    got = sorted(map(tuple, vafile.top_k(df, k=5, query_every=10).collect()))
    assert got == brute_top_k(rows, 5, 10)
    assert vafile.top_k(df.where("false")).count() == 0


def test_cell_bounds_hold_every_score():
    r = np.random.default_rng(1)
    q, v = r.integers(-256, 256, (20, 16)).astype(float), r.integers(-256, 256, (200, 16)).astype(float)
    lo, hi = v.min(axis=0), v.max(axis=0)
    for bits in (1, 3, 6):
        codes, width = vafile.approximate(v, lo, hi, bits)
        lower, upper = vafile.bounds(q, codes, lo, hi, width)
        assert (lower <= q @ v.T).all() and (q @ v.T <= upper).all()


# --- licences -----------------------------------------------------------------------------------------------
def test_licence_scan_held_out_accuracy(spark):
    r = random.Random(4)
    words = [f"wort{i}" for i in range(200)] + ["the", "of", "and", "software", "version", "license", "free"]
    prose = [" ".join(r.choice(words) for _ in range(r.randint(5, 25))) for _ in range(400)]
    texts, want = [], []
    for i in range(200):
        lines = r.sample(prose, 4)
        families = set()
        if i % 2:
            family = r.choice(sorted(licenses.TEMPLATES))
            statement = r.choice(licenses.TEMPLATES[family])
            lines.insert(r.randint(0, 4), r.choice(["", "Note: "]) + statement.upper() + r.choice(["", " Copyright 2020 by the authors."]))
            families.add(family)
        texts.append("\n".join(lines))
        want.append(",".join(sorted(families)))
    texts += ["", None, "Licensed under the Apache License, Version 2.0.\nReleased under the MIT License."]
    want += ["", "", "Apache-2.0,MIT"]
    docs = frame(spark, texts)
    got = {x.doc_id: x for x in licenses.report(docs).collect()}
    right = sum(got[i].families == w for i, w in enumerate(want))
    assert right >= 0.97 * len(want), [(texts[i], got[i], w) for i, w in enumerate(want) if got[i].families != w][:3]
    assert all(got[i].families == "" for i, w in enumerate(want) if not w)
    assert got[len(texts) - 1].n_license_paragraphs == 2 and got[len(texts) - 2].n_paragraphs == 0
    assert licenses.report(empty(spark), licenses.train(spark, docs)).count() == 0


def test_licence_scan_finds_wrapped_paragraphs(spark):
    import textwrap

    r = random.Random(5)
    words = [f"wort{i}" for i in range(200)] + ["the", "of", "and", "software", "version", "license", "free"]
    prose = lambda: " ".join(r.choice(words) for _ in range(r.randint(5, 25)))
    texts, want = [], []
    for i in range(200):
        family = r.choice(sorted(licenses.TEMPLATES))
        statement = r.choice([t for t in licenses.TEMPLATES[family] if len(t) > 80] or licenses.TEMPLATES[family])
        lines = textwrap.wrap(statement, r.randint(60, 80))
        if i % 4 == 1:
            lines = [r.choice(["# ", " * ", "// ", "-- "]) + x for x in lines]
        around = [prose(), prose()]
        texts.append("\n".join([around[0], *([""] if i % 2 else []), *lines, *([""] if i % 2 else []), around[1]]))
        want.append(family)
    texts += ["\n".join(prose() for _ in range(8)) for _ in range(100)]
    texts.append("Released under the MIT License.\nPermission is hereby granted, free of charge, to any person obtaining a copy of\n"
                 "this software and associated documentation files, to deal in the Software\nwithout restriction.")
    want += [""] * 100 + ["MIT"]
    docs = frame(spark, texts)
    got = {x.doc_id: x for x in licenses.report(docs).collect()}
    wrong = [(texts[i], got[i], w) for i, w in enumerate(want) if got[i].families != w]
    assert len(wrong) <= 0.03 * len(want), wrong[:3]
    assert all(got[i].families == "" for i, w in enumerate(want) if not w)
    assert all(got[i].n_license_paragraphs == 1 for i, w in enumerate(want) if got[i].families == w != "")


# --- pipeline -------------------------------------------------------------------------------------------------
def test_pipeline_stages_and_rows(spark, tmp_path):
    import corpus_pipeline

    r = random.Random(8)
    words = [f"v{i}" for i in range(300)]
    sentence = lambda: " ".join(r.choice(words) for _ in range(14))
    good = ["\n".join(sentence() for _ in range(5)) for _ in range(30)]
    texts = [*good, good[0], good[1] + " more", "bad", "# " * 50, None, good[2][:200] + "\n" + sentence()]
    docs = frame(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = {x.doc_id for x in rows}
    # the copies 30 and 31 lose all their lines; of the empty texts one stays
    assert set(range(30)) <= kept and not kept & {31, 32, 33, 34}
    stage = docs
    for _, f in corpus_pipeline.STAGES[:-1]:
        stage = f(spark, stage, str(tmp_path))
        assert stage.columns == docs.columns
    assert all(x.n_chars == len(x.text) for x in stage.collect())
