"""SentencePiece encoding and decoding by the tokenizers library.

The model's protobuf is read field by field; from it the normaliser, the white-space marker, the pieces
with their scores and byte fallback are rebuilt. A unigram model keeps its scores; for a BPE model the
merges follow from the pieces: every split of a piece into two others, in order of the piece's score.

Where no piece has the marker inside, a text falls apart before each run of markers, so words are
encoded once and kept in a cache of bounded size; the batches go to the library, which is multithreaded.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, small_batches, worker_state

MARK = "▁"
#: Kinds of pieces and of models in the protobuf; fixed values.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
CACHE_BYTES, _JOIN, _STEP = 240 << 20, 400, 1_000_000
#: What Python needs for a word, its ids and their place in the cache, beside their characters.
_ENTRY = 190
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


class Model(NamedTuple):
    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    charsmap: bytes
    dummy_prefix: bool
    trim: bool
    escape: bool


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and raw values of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[at : at + n]
            at += n


def read_model(data: bytes) -> Model:
    """Field numbers are those of the published ``sentencepiece_model.proto``."""
    pieces, trainer, normaliser = [], {}, {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            pieces.append((piece[1].decode(), struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0], piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    return Model(pieces, trainer.get(3, UNIGRAM), bool(trainer.get(35, 0)), normaliser.get(2, b""), bool(normaliser.get(3, 1)), bool(normaliser.get(4, 1)), bool(normaliser.get(5, 1)))


def _merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    known = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    order = sorted((-score, i, p) for i, (p, score, kind) in enumerate(pieces) if kind == NORMAL and len(p) > 1)
    return [(p[:k], p[k:]) for _, _, p in order for k in sorted(range(1, len(p)), key=lambda k: (known.get(p[:k], 0), known.get(p[k:], 0))) if p[:k] in known and p[k:] in known]


class Codec:
    """Encodes and decodes whole texts as the model does."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import AddedToken, Regex, Tokenizer, models, normalizers, pre_tokenizers

        with open(path, "rb") as f:
            self.model = m = read_model(f.read())
        if m.kind not in (UNIGRAM, BPE):
            raise ValueError(f"model kind {m.kind} is neither unigram nor BPE")
        unknown = next(i for i, p in enumerate(m.pieces) if p[2] == UNKNOWN)
        if m.kind == UNIGRAM:
            core = models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=unknown, byte_fallback=m.byte_fallback)
        else:
            core = models.BPE({p: i for i, (p, _, _) in enumerate(m.pieces)}, _merges(m.pieces), unk_token=m.pieces[unknown][0], fuse_unk=True, byte_fallback=m.byte_fallback)
        self.tokenizer = Tokenizer(core)
        if m.kind == BPE:  # such pieces are never merged with what stands beside them
            self.tokenizer.add_tokens([AddedToken(p, normalized=False) for p, _, kind in m.pieces if kind == USER_DEFINED])
        self.tokenizer.pre_tokenizer = pre_tokenizers.Split("\0", "removed")
        steps = ([normalizers.Precompiled(m.charsmap)] if m.charsmap else []) + ([normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()] if m.trim else [])
        self.normaliser = normalizers.Sequence(steps) if steps else None
        self.apart = not any(MARK in p.lstrip(MARK) for p, _, kind in m.pieces if kind in (NORMAL, USER_DEFINED))
        self.bytes = [bytes([int(p[3:5], 16)]) if kind == BYTE else b"" if kind == CONTROL else " ⁇ ".encode() if kind == UNKNOWN else p.replace(MARK, " ").encode() for p, _, kind in m.pieces]
        self.sizes = np.array([1 if kind == BYTE else len(p.encode()) for p, _, kind in m.pieces], dtype=np.int64)
        self.cache: dict[str, bytes] = {}
        self.held, self.most = 0, cache_bytes

    def normalise(self, text: str) -> str:
        """The text as the pieces see it."""
        if self.normaliser:
            text = self.normaliser.normalize_str(text)
        if not text:
            return ""
        text = (" " if self.model.dummy_prefix else "") + text
        return text.replace(" ", MARK) if self.model.escape else text

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        held, chars = [], 0
        for text in texts:
            plain = self.normalise(text)
            held.append(_WORD.findall(plain) if self.apart else [plain] if plain else [])
            chars += len(text)
            if chars >= _STEP:
                yield from self._ids(held)
                held, chars = [], 0
        yield from self._ids(held)

    def _ids(self, held: list[list[str]]) -> Iterator[bytes]:
        missing = [w for w in {w for words in held for w in words} if w not in self.cache]
        joined = [w for w in missing if "\0" not in w and self.model.byte_fallback and len(w) < 100]
        groups = [joined[k : k + _JOIN] for k in range(0, len(joined), _JOIN)]
        for g, e in zip(groups, self.tokenizer.encode_batch_fast(["\0".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            till = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(w.encode()) for w in g])) + 1
            raw, at = ids.tobytes(), 0
            for w, end in zip(g, (4 * till).tolist(), strict=True):
                self.cache[w] = raw[at:end]
                at = end
            self.held += _ENTRY * len(g) + sum(map(len, g)) + len(raw)
        for w in set(missing).difference(joined):
            self.cache[w] = ids = np.array(self._alone(w), dtype="<u4").tobytes()
            self.held += _ENTRY + len(w) + len(ids)
        cache = self.cache
        for words in held:
            yield b"".join([cache[w] for w in words])
        if self.held > self.most:  # short words come back more often
            self.cache = {w: ids for w, ids in cache.items() if len(w) <= 8}
            self.held = sum(_ENTRY + len(w) + len(ids) for w, ids in self.cache.items())
            if self.held > self.most // 2:
                self.cache, self.held = {}, 0

    def _alone(self, word: str) -> list[int]:
        """Of a word that can't share a text with others, as it may hold the character that parts them."""
        from tokenizers import pre_tokenizers

        parting, self.tokenizer.pre_tokenizer = self.tokenizer.pre_tokenizer, pre_tokenizers.Sequence([])
        try:
            return self.tokenizer.encode(word, add_special_tokens=False).ids
        finally:
            self.tokenizer.pre_tokenizer = parting

    def decode(self, ids: bytes) -> str:
        table = self.bytes
        text = b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


def encode(docs: DataFrame, model: str, verify: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, ids`` (little-endian unsigned 32-bit), ``n_tokens, decoded, parity``.

    ``decoded`` is the text that the ids give back; ``parity`` tells whether the ids are those of the
    sentencepiece library (null unless ``verify``). Null and empty texts have no ids and decode to an
    empty text; repeated rows are encoded each; an empty table gives no rows; other columns are not
    read; texts count whole.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("sentence pieces")
        codec = state.get(("codec", model)) or state.setdefault(("codec", model), Codec(model))
        if verify and ("spm", model) not in state:
            import sentencepiece

            state["spm", model] = sentencepiece.SentencePieceProcessor(model_file=model)
        for batch in slices(batches, 256):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found = list(codec.encode(texts))
            same: list[bool | None] = [None] * len(texts)
            if verify:
                same = [a == array("I", b).tobytes() for a, b in zip(found, state["spm", model].encode(texts, num_threads=1), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary()), pa.array([len(x) // 4 for x in found], pa.int64()), pa.array(map(codec.decode, found), pa.string()), pa.array(same, pa.bool_())], names=["doc_id", "ids", "n_tokens", "decoded", "parity"])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, ids binary, n_tokens long, decoded string, parity boolean")
