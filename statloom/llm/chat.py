"""Chat formatting with offset-aligned loss masks.

A conversation is rendered turn by turn as ``<|im_start|>role<|im_sep|>text<|im_end|>``. The three markers
are added to the tokenizer as tokens of their own, so no other token crosses a turn's border, and a conversation that
is encoded in pieces of whole turns has the ids that it has when encoded at once. A control
string inside a role or text is escaped: wherever ``<``, any number of backslashes and ``|`` stand
together, one backslash more is put in, which takes every ``<|`` away and can be undone.

Whole turns are rendered into a piece, the piece is encoded once with offsets, and the sorted spans of
the assistant's texts are intersected with the tokens' spans by binary search. A byte-level token stands for as many
bytes as it has characters, so offsets follow from the ids by a sum.

Turns are dealt by ranges of conversation and turn, so a conversation of very many turns spreads over
tasks; a piece ends with the task's part of a conversation or after ``PIECE`` characters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import shuffle_partitions, small_batches, worker_state

#: The template's markers; fixed values.
START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
PIECE, _TOGETHER = 200_000, 64
_RAW, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEP) + "(.*?)" + re.escape(END), re.DOTALL)

PIECES = "conv_id long, part int, piece long, text string, ids array<int>, loss array<boolean>, loss_spans array<struct<start int, end int>>"
_LOSS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def escape(text: str) -> str:
    return _RAW.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of these turns and the spans of the assistant's texts in it."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(text: str) -> list[tuple[str, str]]:
    """The turns that were rendered."""
    return [(unescape(role), unescape(body)) for role, body in _TURN.findall(text)]


def mask(offsets: np.ndarray, spans: list[tuple[int, int]]) -> np.ndarray:
    """Which tokens begin inside a span; both are sorted."""
    if not spans:
        return np.zeros(len(offsets), dtype=bool)
    starts, ends = np.array(spans).T
    at = np.searchsorted(starts, offsets[:, 0], side="right") - 1
    return (at >= 0) & (offsets[:, 0] < ends[np.maximum(at, 0)]) & (offsets[:, 1] > offsets[:, 0])


def covered(offsets: np.ndarray, chosen: np.ndarray) -> list[tuple[int, int]]:
    """The spans of text under the chosen tokens, joined where they touch."""
    s, e = offsets[chosen].T if chosen.any() else (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))
    new = np.flatnonzero(np.append(True, s[1:] > np.maximum.accumulate(e)[:-1])) if len(s) else np.empty(0, dtype=np.int64)
    return list(zip(s[new].tolist(), np.maximum.reduceat(e, new).tolist() if len(s) else [], strict=True))


class Encoder:
    """Ids and offsets of rendered texts, by a byte-level tokenizer to which the markers are added."""

    def __init__(self, path: str):
        from tokenizers import AddedToken, Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (START, SEP, END)])
        self.sizes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())], dtype=np.int64)

    def encode(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text its ids, and for each token where it starts and ends, in code points."""
        for text, e in zip(texts, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype=np.int32)
            ends = np.cumsum(self.sizes[ids])
            offsets = np.stack([ends - self.sizes[ids], ends], axis=1)
            if not text.isascii():  # a token of a part of a character has the place of that character
                begun = np.concatenate([[0], np.cumsum(np.frombuffer(text.encode(), dtype=np.int8) >= -64)])
                offsets = np.stack([begun[offsets[:, 0] + 1] - 1, begun[offsets[:, 1]]], axis=1)
            yield ids, offsets


def _encoder(path: str) -> Encoder:
    state = worker_state("chat")
    if path not in state:
        state[path] = Encoder(path)
    return state[path]


def format_conversations(turns: DataFrame, tokenizer: str, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Pieces of conversations: ``conv_id, part, piece, text, ids, loss, loss_spans``.

    In order of ``part, piece`` the pieces' texts make the conversation; each has whole turns. ``loss``
    marks the tokens of assistants' texts, ``loss_spans`` is the text under them. Turns follow by
    ``turn`` (null first), equal ones by role and text; repeated rows are turns of their own. Null roles and
    texts are empty; rows without an id are one conversation of a null id; an empty table gives no
    rows; other columns are not read; texts of any length are encoded whole.
    """
    rows = small_batches(turns).select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.spark_partition_id().alias("of"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "of"]
    rows = rows.repartitionByRange(shuffle_partitions(turns.sparkSession), *order).sortWithinPartitions(*order)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        pieces: list[tuple[int | None, list[tuple[str, str]]]] = []
        sizes, done = 0, 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal pieces, sizes, done
            texts, spans = zip(*(render(t) for _, t in pieces), strict=True)
            columns: list[list] = [[], [], []]
            for (ids, offsets), s in zip(encoder.encode(list(texts)), spans, strict=True):
                chosen = mask(offsets, s)
                for column, x in zip(columns, (ids, chosen, [{"start": a, "end": b} for a, b in covered(offsets, chosen)]), strict=True):
                    column.append(x)
            n = len(pieces)
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in pieces], pa.int64()), pa.array([part] * n, pa.int32()), pa.array(range(done, done + n), pa.int64()), pa.array(texts, pa.string()), pa.array(columns[0], pa.list_(pa.int32())), pa.array(columns[1], pa.list_(pa.bool_())), pa.array(columns[2], _LOSS)], names=[c.split()[0] for c in re.sub(r"<.*?>+", "", PIECES).split(", ")])
            pieces, sizes, done = [], 0, done + n

        size = 0
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text")), strict=True):
                if not pieces or pieces[-1][0] != conv or size >= PIECE:
                    if len(pieces) >= _TOGETHER or sizes >= PIECE:
                        yield from flush()
                    pieces.append((conv, []))
                    size = 0
                pieces[-1][1].append((role, text))
                size += len(text)
                sizes += len(text)
        if pieces:
            yield from flush()

    return rows.mapInArrow(run, PIECES)


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation, read back from its pieces: numbers and digests of turns and of the text under the mask.

    A digest is sequential, so one task streams the pieces of a conversation; it holds one at a time.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        at, state = (), None

        def row() -> tuple:
            n, turns, chars, loss, formatted = state
            return (at[0], n, turns.hexdigest(), chars, loss.hexdigest(), formatted)

        for batch in batches:
            rows = []
            for conv, text, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss_spans")), strict=True):
                if at != (conv,):
                    if state:
                        rows.append(row())
                    at, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, body in parse(text):
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode())
                for span in spans:
                    body = unescape(text[span["start"] : span["end"]])
                    state[2] += len(body)
                    state[3].update(body.encode())
                state[4] += len(text)
            yield _batch(rows, names)
        yield _batch([row()] if state else [], names)

    kept = pieces.select("conv_id", "part", "piece", "text", "loss_spans")
    return kept.repartition("conv_id").sortWithinPartitions("conv_id", "part", "piece").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if "sha256" in n else pa.int64()) for c, n in zip(columns, names, strict=True)], names=names)
