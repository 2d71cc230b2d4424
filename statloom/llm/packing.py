"""Cost-balanced packing of tokenised documents into fixed-length training sequences.

The cost of a piece of ``n`` tokens is ``linear * n + quadratic * n * n``: the feed-forward part
of a step grows with the tokens, attention within the piece with their square. Pieces are taken
in descending length and each goes to the open sequence that costs least so far among all with
room for it. Only when no sequence can hold a piece whole is it cut, to fill the cheapest one; a document
of more than a sequence first gives whole sequences of its own. A window opens just as many sequences as its
tokens fill, so all but its last sequence end up full.

Work happens in the tasks that scan the documents: there is no shuffle, a task holds one window
(``window_tokens`` tokens, plus at most one document), and a lost task repeats with the same result.
"""

from __future__ import annotations

import gc
import heapq
import itertools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import slices, small_batches, trim, worker_state

#: The code points that the pre-tokenizer's ``\s`` takes as white space (Unicode White_Space); fixed values.
WHITE = "\t-\r \x85\xa0  -     　"
#: Letters of Latin scripts, of which most texts here consist; a range of letters only.
_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: The pre-tokenizer always splits between these chunks: Latin letters that ASCII or white space
#: follows, with the one space before them; another run without white space, likewise; white space up
#: to the last of its run; that last one.
_CHUNK = re.compile(f" ?[{_LATIN}]+(?![^{WHITE}\x00-\x40\x5b-\x60\x7b-\x7f])| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
_WORD = re.compile(f" ?[{_LATIN}]+")
CACHE_BYTES, _SHORT = 256 << 20, 8
#: What Python needs for a key, its ids and their place in the cache, beside their characters.
_ENTRY = 190
#: Characters of text whose chunks are held at once; words in one text for the tokenizer.
_STEP, _JOIN = 400_000, 400

PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


class ChunkEncoder:
    """Token ids of whole texts by the ``tokenizers`` library, which sees each distinct chunk once.

    Unknown words go to the library many at a time, kept apart by a character that its pre-tokenizer
    removes; which ids belong to which word is told by the bytes of the tokens. The cache holds about
    ``cache_bytes``; when it is full, all but the short chunks are forgotten.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.any_text = self.tokenizer.pre_tokenizer
        # words are pre-tokens already
        self.words = pre_tokenizers.Sequence([pre_tokenizers.Split("\0", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # a byte-level token has one character for each byte
        self.sizes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.tokenizer.get_vocab_size())], dtype=np.int64)
        self.cache: dict[str, bytes] = {}
        self.held, self.most = 0, cache_bytes
        trim()  # loading takes more than what is kept

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        held: list[list[str]] = []
        chars = 0
        for text in texts:
            held.append(_CHUNK.findall(text))
            chars += len(text)
            if chars >= _STEP:
                yield from self._ids(held)
                held, chars = [], 0
        yield from self._ids(held)

    def _ids(self, held: list[list[str]]) -> Iterator[bytes]:
        distinct = set(itertools.chain.from_iterable(held))
        self._learn(distinct.difference(self.cache))
        # most chunks of a step come again in it, and a small table is faster than the cache
        own = dict(zip(distinct, map(self.cache.__getitem__, distinct), strict=True))
        for chunks in held:
            yield b"".join(map(own.__getitem__, chunks))
        if self.held > self.most:  # short chunks come back more often
            self.cache = {c: ids for c, ids in self.cache.items() if len(c) <= _SHORT}
            self.held = sum(map(self._size, self.cache.items()))
            if self.held > self.most // 2:
                self.cache, self.held = {}, 0

    @staticmethod
    def _size(entry: tuple[str, bytes]) -> int:
        return _ENTRY + len(entry[0]) + len(entry[1])

    def _learn(self, missing: set[str]) -> None:
        words, others = [], []
        for c in missing:
            (words if _WORD.fullmatch(c) else others).append(c)
        self.tokenizer.pre_tokenizer = self.any_text
        for c, e in zip(others, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            self.cache[c] = ids = np.array(e.ids, dtype="<u4").tobytes()
            self.held += self._size((c, ids))
        self.tokenizer.pre_tokenizer = self.words
        groups = [words[k : k + _JOIN] for k in range(0, len(words), _JOIN)]
        for g, e in zip(groups, self.tokenizer.encode_batch_fast(["\0".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(e.ids, dtype="<u4")
            till = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(c.encode()) for c in g])) + 1
            raw, at = ids.tobytes(), 0
            for c, end in zip(g, (4 * till).tolist(), strict=True):
                self.cache[c] = raw[at:end]
                at = end
            self.held += _ENTRY * len(g) + sum(map(len, g)) + len(raw)


class _Open:
    """Open sequences by room, with the cheapest (ties: the first) of every range of rooms in a tree over rooms.

    Among sequences of one room the cheapest is on top of a heap; a node of the tree names the cheaper of
    its two halves, so the cheapest with room for a piece is found, and moved, in steps that grow with
    the logarithm of the size.
    """

    def __init__(self, rooms: list[int], size: int):
        self.leaves = 1 << size.bit_length()
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(self.leaves)]
        for sequence, room in enumerate(rooms):
            self.heaps[room].append((0.0, sequence))
        self.best = [_NONE] * (2 * self.leaves)
        for room in set(rooms):
            self._renew(room)

    def _renew(self, room: int) -> None:
        best, node = self.best, room + self.leaves
        best[node] = self.heaps[room][0] if self.heaps[room] else _NONE
        while node > 1:
            one, two = best[node], best[node ^ 1]
            node >>= 1
            best[node] = one if one < two else two

    def take(self, room: int) -> tuple[float, int, int] | None:
        """Cost, number and room of the cheapest sequence with this room or more, which is then no longer open."""
        node, found = room + self.leaves, _NONE
        at = node
        if self.best[node] < found:
            found = self.best[node]
        while node > 1:
            if not node & 1 and self.best[node + 1] < found:
                found, at = self.best[node + 1], node + 1
            node >>= 1
        if found is _NONE:
            return None
        while at < self.leaves:
            at = 2 * at if self.best[2 * at] == found else 2 * at + 1
        own = at - self.leaves
        heapq.heappop(self.heaps[own])
        self._renew(own)
        return *found, own

    def put(self, cost: float, sequence: int, room: int) -> None:
        heapq.heappush(self.heaps[room], (cost, sequence))
        if self.heaps[room][0][1] == sequence:
            self._renew(room)


_NONE = (float("inf"), -1)


def assign(lengths: list[int], size: int, linear: float, quadratic: float) -> Iterator[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` for documents of these token counts.

    A document longer than ``size`` first gives whole sequences of its own; its rest, like shorter
    documents, goes in descending order (ties: the earlier document) to the cheapest sequence with
    room (ties: the first), and is cut only if there is none. The last sequence is only as long as what remains, so the others fill up.
    """
    sequence, rests = 0, []
    for doc, n in enumerate(lengths):
        whole = n // size
        for k in range(whole):
            yield doc, k * size, size, sequence, 0
            sequence += 1
        if n % size:
            rests.append((n % size, doc, whole * size))
    rests.sort(key=lambda x: (-x[0], x[1]))
    total = sum(r[0] for r in rests)
    rooms = [size] * (total // size) + ([total % size] if total % size else [])
    open_ = _Open(rooms, size)
    for rest, doc, start in rests:
        while rest:
            cost, s, room = open_.take(rest) or open_.take(1)
            part = min(rest, room)
            yield doc, start, part, sequence + s, rooms[s] - room
            if room > part:
                open_.put(cost + linear * part + quadratic * part * part, s, room - part)
            rest -= part
            start += part


def pack(docs: DataFrame, tokenizer: str, size: int = 1024, end_id: int = 0, linear: float = 1.0, quadratic: float = 1 / 512, window_tokens: int = 1 << 21, cache_bytes: int = CACHE_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document into sequences of at most ``size`` tokens.

    One row per piece: ``doc_id, start, length, ids`` (little-endian unsigned 32-bit),
    ``doc_tokens, sequence_id, offset``. A document's tokens are its text's ids and ``end_id``.

    Null and empty texts are the end id alone; a null id stays null; repeated rows are documents of
    their own; an empty table gives no rows; other columns are not read. Texts of any length are
    encoded whole. Sequences never cross a window of about ``window_tokens`` tokens, so each window
    adds less than one sequence of padding. Each Python worker keeps ids of chunks of text in ``cache_bytes``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = worker_state("packing")
        encoder = state.get(tokenizer) or state.setdefault(tokenizer, ChunkEncoder(tokenizer, cache_bytes))
        end = np.array([end_id], dtype="<u4").tobytes()
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        held: list[tuple[int | None, bytes]] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, held, tokens
            pieces = assign([len(b) // 4 for _, b in held], size, linear, quadratic)
            while part := list(itertools.islice(pieces, 1024)):
                rows = [(held[d][0], start, length, held[d][1][4 * start : 4 * (start + length)], len(held[d][1]) // 4, base + sequence, offset) for d, start, length, sequence, offset in part]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], names=_NAMES)
            base, held, tokens = base + -(-tokens // size), [], 0

        gc.disable()  # nothing here makes reference cycles, and the cache is long to walk
        try:
            for batch in slices(batches, 256):
                ids = batch.column(0).to_pylist()
                for doc_id, raw in zip(ids, encoder.encode(t or "" for t in batch.column(1).to_pylist()), strict=True):
                    held.append((doc_id, raw + end))
                    tokens += len(raw) // 4 + 1
                    if tokens >= window_tokens:
                        yield from flush()
            yield from flush()
        finally:  # also where a task ends early: the worker lives on
            gc.enable()

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


_NAMES = [c.split()[0] for c in PIECES.split(", ")]
_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
