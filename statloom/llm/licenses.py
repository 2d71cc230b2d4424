"""Licence scans by ordered signature rules.

A text is cut into words, lower-case and one space apart. Each rule is tried only if its keyword occurs;
its matches are intervals of words. Overlapping detections are resolved in order of priority, then
length, then place: what lies inside an interval that was already taken is dropped.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import slices, small_batches, worker_state
from .license_rules import Rule, rules

#: Base phrases and their labels; fixed values.
BASE = {b"mit license": "mit", b"apache license": "apache", b"general public license": "gpl"}
#: A-Z to a-z, digits, a-z and everything beyond ASCII as they are, all else to a space.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
_BASE = [(re.compile(rb"(?<= )" + phrase + rb"(?= )"), phrase, label) for phrase, label in BASE.items()]

DETECTION = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("words", pa.int64()), ("confidence", pa.float64())])
SCANNED = "doc_id long, n_words long, base array<struct<label string, first_word long>>, detections array<struct<label string, first_word long, words long, confidence double>>"


def plain(text: bytes) -> tuple[bytes, int]:
    """The words with a space around each, and their number."""
    words = text.translate(_PLAIN).split()
    return b" " + b" ".join(words) + b" ", len(words)


def _places(line: bytes) -> np.ndarray:
    """Where the space before each word stands, and the last one."""
    return np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)


class _Taken:
    """Intervals taken so far, without those inside another: starts and ends both ascend."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def add(self, start: int, end: int) -> bool:
        """Take an interval; False, if it lies inside of one that was taken."""
        at = bisect.bisect_right(self.starts, start)
        if at and self.ends[at - 1] >= end:
            return False
        first, last = bisect.bisect_left(self.starts, start), bisect.bisect_right(self.ends, end)
        self.starts[first : max(first, last)], self.ends[first : max(first, last)] = [start], [end]
        return True


def detect(line: bytes, signatures: list[Rule], places: np.ndarray | None = None) -> list[tuple[str, int, int, float]]:
    """Resolved detections ``(label, first word, words, confidence)`` in the order of the text."""
    places = _places(line) if places is None else places
    found = []
    for rule in signatures:
        if rule.keyword in line:
            spans = [m.span() for m in rule.pattern.finditer(line)]  # of words, without the spaces around them
            if spans:
                first, after = (np.searchsorted(places, x).tolist() for x in np.array(spans).T)
                found += [(-rule.priority, a - b - 1, a - 1, rule.label, rule.confidence) for a, b in zip(first, after, strict=True)]
    found.sort()
    taken = _Taken()
    kept = [(label, first, -minus, confidence) for _, minus, first, label, confidence in found if taken.add(first, first - minus)]
    return sorted(kept, key=lambda d: d[1:])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words``, ``base`` (places of the base phrases) and ``detections``.

    Null texts are empty and give no detection; repeated rows are scanned each; an empty table gives no
    rows; other columns are not read; texts count whole. Ties between rules of equal priority and
    length at one place go to the label that comes first by name.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("licences")  # drops what another operator has left
        signatures = rules()
        for batch in slices(batches):
            counts, base, found = [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                line, n = plain(text or b"")
                places = _places(line)
                counts.append(n)
                own = [(label, [m.start() for m in p.finditer(line)]) for p, phrase, label in _BASE if phrase in line]
                base.append([{"label": label, "first_word": k} for label, at in own for k in (np.searchsorted(places, at) - 1).tolist()])
                found.append([{"label": a, "first_word": b, "words": c, "confidence": d} for a, b, c, d in detect(line, signatures, places)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(base, pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64())]))), pa.array(found, pa.list_(DETECTION))], names=["doc_id", "n_words", "base", "detections"])

    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCANNED)
