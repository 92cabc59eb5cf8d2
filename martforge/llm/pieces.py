"""The piece vocabulary of a SentencePiece model, and the cutting of texts into independent chunks.

No piece holds a space mark after another character, so neither byte-pair merging
nor a best segmentation ever crosses the start of a run of spaces: a text is the
concatenation of its chunks, and a chunk's result can be remembered.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
import regex
import sentencepiece

SPACE = "▁"


class Vocabulary:
    """Pieces and ranks of a model with byte fallback, identity normalisation and visible spaces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        model = pb.ModelProto()
        model.ParseFromString(sp.serialized_model_proto())
        spec = model.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models with identity normalisation are supported")
        if model.trainer_spec.treat_whitespace_as_suffix or not model.trainer_spec.byte_fallback:
            raise ValueError("only models with leading space marks and byte fallback are supported")
        kinds = model.SentencePiece
        if any(p.type in (kinds.UNUSED, kinds.USER_DEFINED) for p in model.pieces):
            raise ValueError("models with unused or user-defined pieces are not supported")
        self.dummy_prefix = SPACE if spec.add_dummy_prefix else ""
        self.rank = {p.piece: -p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        byte_at = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.byte_ids = [byte_at[f"<0x{b:02X}>"] for b in range(256)]
        if any(SPACE in p.lstrip(SPACE) for p in self.rank):
            raise ValueError("a piece spans the start of a space run")
        # neighbouring characters that some piece holds; everything else is a sure boundary
        self.joins = {p[i:i + 2] for p in self.rank for i in range(len(p) - 1)}
        self.newline_alone = not any("\n" in p for p in self.rank if len(p) > 1)

    def parts(self, chunk: str) -> list[str]:
        """The chunk cut wherever no piece holds both neighbours."""
        cuts = [0] + [i for i in range(1, len(chunk)) if chunk[i - 1:i + 1] not in self.joins] + [len(chunk)]
        return [chunk[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def plain(texts: pa.Array, vocab: Vocabulary) -> pa.Array:
    """Whether a text has single inner spaces only and no literal mark: cutting at every space is then right."""
    odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")), pc.match_substring(texts, SPACE))
    return pc.invert(odd) if vocab.newline_alone else pc.and_(odd, pc.invert(odd))


def marked(texts: pa.Array, vocab: Vocabulary) -> pa.Array:
    """Plain, non-empty texts with marks, so that a cut at every space gives the chunks of ``chunks()``."""
    out = pc.replace_substring(pc.replace_substring(texts, " ", " " + SPACE), "\n", " \n ")
    return pc.binary_join_element_wise(pa.scalar(vocab.dummy_prefix, pa.large_string()), out, pa.scalar("", pa.large_string()))


_RUNS = regex.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def chunks(text: str, vocab: Vocabulary) -> list[str]:
    """The text, spaces as marks and with the leading mark, cut at the start of every space run."""
    if not text:
        return []
    if vocab.newline_alone and "  " not in text and text[0] != " " and SPACE not in text:
        # the usual text: single spaces only; line ends stand alone
        return (vocab.dummy_prefix + text).replace(" ", " " + SPACE).replace("\n", " \n ").split(" ")
    return _RUNS.findall(vocab.dummy_prefix + text.replace(" ", SPACE))


class Remembered(dict):
    """chunk -> result, computed once per worker process; emptied when it holds ``limit`` chunks."""

    def __init__(self, compute: Callable[[str], object], limit: int = 600_000):
        super().__init__()
        self.compute, self.limit = compute, limit

    def __missing__(self, chunk: str):
        if len(self) >= self.limit:
            self.clear()
        got = self.compute(chunk)
        if len(chunk) <= 64:
            self[chunk] = got
        return got
