"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a single-pass Viterbi.

The automaton holds all pieces.  Reading a chunk once, left to right, the output
links of the state reached list every piece that ends at the current position;
each relaxes the best score of that position.  Scores are the model's own piece
scores, added up.  A character that no one-character piece covers costs the lowest
score minus ten and is written as its UTF-8 bytes (byte fallback).  Of equal scores
the segmentation whose last piece is longest wins, at every position.

Decoding is the inverse: pieces are concatenated, marks become spaces, the leading
mark goes.  A literal U+2581 in a text is encoded as bytes, so every text comes back
exactly.  Null and empty texts encode to no ids.  Every input row gives one row;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache

from pyspark.sql import DataFrame

from martforge.llm.common import map_texts
from martforge.llm.pieces import SPACE, Remembered, Vocabulary, chunks, vocabulary



class Automaton:
    """Aho-Corasick over the pieces: goto tables, failure links, and output links to shorter matches."""

    def __init__(self, vocab: Vocabulary):
        self.goto: list[dict[str, int]] = [{}]
        self.fail, self.out_link = [0], [0]
        self.piece: list[tuple[int, float, int] | None] = [None]  # (length, score, id) of the piece that ends here
        for p, rank in vocab.rank.items():
            at = 0
            for c in p:
                if c not in self.goto[at]:
                    self.goto[at][c] = len(self.goto)
                    self.goto.append({})
                    self.fail.append(0)
                    self.out_link.append(0)
                    self.piece.append(None)
                at = self.goto[at][c]
            self.piece[at] = (len(p), -rank, vocab.ids[p])
        queue = list(self.goto[0].values())
        for at in queue:
            for c, nxt in self.goto[at].items():
                queue.append(nxt)
                f = self.fail[at]
                while f and c not in self.goto[f]:
                    f = self.fail[f]
                f = self.goto[f].get(c, 0)
                self.fail[nxt] = f
                self.out_link[nxt] = f if self.piece[f] else self.out_link[f]


class Codec:
    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.auto = Automaton(self.vocab)
        self.unknown = -max(self.vocab.rank.values()) - 10.0
        self.parts = Remembered(lambda p: self.best(p).tobytes() if p else b"")
        self.chunk_ids = Remembered(lambda c: b"".join(map(self.parts.__getitem__, self.vocab.parts(c))))
        self.surface = {i: p.replace(SPACE, " ").encode() for p, i in self.vocab.ids.items()}
        self.surface |= {i: bytes([b]) for b, i in enumerate(self.vocab.byte_ids)}

    def best(self, part: str) -> array:
        """Ids of the best segmentation of one chunk."""
        goto, fail, out_link, piece = self.auto.goto, self.auto.fail, self.auto.out_link, self.auto.piece
        score, back, state = [0.0], [None], 0
        for i, c in enumerate(part, 1):
            while state and c not in goto[state]:
                state = fail[state]
            state = goto[state].get(c, 0)
            top, via, covered = float("-inf"), None, False
            at = state if piece[state] else out_link[state]
            while at:  # the pieces that end here, longest first
                length, gain, _ = found = piece[at]
                covered |= length == 1
                if score[i - length] + gain > top:
                    top, via = score[i - length] + gain, found
                at = out_link[at]
            if not covered and score[i - 1] + self.unknown > top:
                top, via = score[i - 1] + self.unknown, None
            score.append(top)
            back.append(via)
        ids: list[int] = []
        i = len(part)
        while i:
            if back[i] is None:
                ids += [self.vocab.byte_ids[b] for b in reversed(part[i - 1].encode())]
                i -= 1
            else:
                ids.append(back[i][2])
                i -= back[i][0]
        return array("I", reversed(ids))

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if SPACE in text:  # literal marks are bytes; the texts between them are encoded on their own
            mark = array("I", [self.vocab.byte_ids[b] for b in SPACE.encode()]).tobytes()
            first, *rest = text.split(SPACE)
            lead = self.encode(first) if first else self.chunk_ids[self.vocab.dummy_prefix]
            return lead + b"".join(mark + self._bare(t) for t in rest)
        return b"".join(map(self.chunk_ids.__getitem__, chunks(text, self.vocab)))

    def _bare(self, text: str) -> bytes:
        """Ids of a text that follows something else, so without the leading mark."""
        marked = text.replace(" ", SPACE)
        runs = [r for r in marked.replace(SPACE, " " + SPACE).split(" ") if r]
        merged: list[str] = []
        for r in runs:  # a run of marks and the characters after it are one chunk
            if merged and merged[-1].strip(SPACE) == "":
                merged[-1] += r
            else:
                merged.append(r)
        return b"".join(map(self.chunk_ids.__getitem__, merged))

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.surface.__getitem__, array("I", ids)))
        return raw[len(self.vocab.dummy_prefix and " "):].decode("utf-8", "replace")


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, ids)``: the ids of every text as little-endian unsigned 32-bit integers."""
    def run(ids: list, texts: list) -> dict:
        c = codec(model_path)
        return {"doc_id": ids, "ids": [c.encode(t.decode("utf-8", "replace")) for t in texts]}

    return map_texts(docs, run, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, text)`` from ``(doc_id, ids)``; null ids decode to the empty text."""
    frame = encoded.select("doc_id", encoded["ids"].alias("text"))

    def run(ids: list, raw: list) -> dict:
        c = codec(model_path)
        return {"doc_id": ids, "text": [c.decode(r) for r in raw]}

    return map_texts(frame, run, "doc_id long, text string")


def codec_report(docs: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, ids_crc32, round_trip)`` per row: encoded, decoded and compared in one pass."""
    def run(ids: list, texts: list) -> dict:
        c = codec(model_path)
        out = {"doc_id": ids, "n_bytes": [len(t) for t in texts], "n_tokens": [], "ids_crc32": [], "round_trip": []}
        for t in texts:
            raw = c.encode(t.decode("utf-8", "replace"))
            out["n_tokens"].append(len(raw) // 4)
            out["ids_crc32"].append(zlib.crc32(raw))
            out["round_trip"].append(c.decode(raw).encode() == t)
        return out

    return map_texts(docs, run, "doc_id long, n_bytes long, n_tokens long, ids_crc32 long, round_trip boolean")
