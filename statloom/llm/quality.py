"""Quality classifier: ordinal cumulative-link regression on graded ratings.

All grades share one weight per hashed feature of the text; ordered thresholds cut the latent score
``f``: ``P(grade >= k) = sigmoid(f - threshold_k)``. That gives an expected grade and the probability of
the tail at or above a wanted grade, by which documents are selected.

The features are those a text has or lacks: its lower-case words without the signs around them, and
its shape (shares of upper-case, of repeated words, of runs of signs, ...) in steps of a tenth, all
hashed into one table.
"""

from __future__ import annotations

import itertools
import operator
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import slices, small_batches, worker_state

BITS = 18
BEGINNINGS = (4, 5, 6)
_SIGNS = re.compile(r"[^\w\s.,;:'\"()-]{2,}")
_AROUND = "".join(map(chr, (*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127))))
_CACHE = 100_000


class Model(NamedTuple):
    weights: np.ndarray
    thresholds: np.ndarray
    uid: str


class _Words(dict):
    """Hashed features of a word as it stands in the text: itself and its beginnings; forgets all when full."""

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) > _CACHE:
            self.clear()
        plain = word.strip(_AROUND).lower()
        names = [plain, *(f"{plain[:k]}-" for k in BEGINNINGS if len(plain) > k)]
        self[word] = found = tuple(zlib.crc32(x.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1) for x in names)
        return found


def shape(text: str, words: list[str], distinct: int) -> list[int]:
    n = max(1, len(words))
    shares = {
        "upper": sum(map(str.isupper, words)) / n,
        "again": sum(map(operator.eq, words, words[1:])) / n,
        "signs": len(_SIGNS.findall(text)) / n,
        "bars": words.count("|") / n,
        "distinct": distinct / n,
        "length": min(1.0, (len(text) / n - 1) / 20),
        "size": min(1.0, len(words).bit_length() / 16),
    }
    return [zlib.crc32(f"{k} {min(10, int(10 * v))}".encode(), 1) & ((1 << BITS) - 1) for k, v in shares.items()]


def features(text: str | None, cache: _Words) -> np.ndarray:
    """The features that a text has, each once; a null text is empty."""
    text = text or ""
    words = text.split()
    distinct = set(words)
    found = set(itertools.chain.from_iterable(map(cache.__getitem__, distinct)))
    found.update(shape(text, words, len(distinct)))
    return np.fromiter(found, dtype=np.int64, count=len(found))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _minimum(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, steps: int, memory: int = 12) -> np.ndarray:
    """Limited-memory BFGS with backtracking."""
    value, grad = loss(x)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        step, parts = -grad, []
        for s, y, rho in reversed(pairs):
            parts.append(rho * (s @ step))
            step = step - parts[-1] * y
        if pairs:
            s, y, rho = pairs[-1]
            step = step / (rho * (y @ y))
        for (s, y, rho), part in zip(pairs, reversed(parts), strict=True):
            step = step + (part - rho * (y @ step)) * s
        slope, size = grad @ step, 1.0 if pairs else min(1.0, 1 / (np.abs(grad).sum() + 1e-12))
        if slope >= 0:
            break
        for _ in range(25):
            new, new_grad = loss(x + size * step)
            if new <= value + 1e-4 * size * slope:
                break
            size /= 2
        else:
            break
        s, y = size * step, new_grad - grad
        if s @ y > 1e-12:
            pairs = [*pairs[-memory + 1 :], (s, y, 1 / (s @ y))]
        done = value - new < 1e-9
        x, value, grad = x + s, new, new_grad
        if done:
            break
    return x


def fit_ordinal(rows: list[np.ndarray], grades: np.ndarray, top: int, steps: int = 120, ridge: float = 1e-4, screen: float = 4.5) -> Model:
    """Maximum likelihood with a ridge; grades are 0 to ``top``.

    The gaps between thresholds are exponentials, so they stay in order. Only features whose rows
    differ from all in the share above some threshold by ``screen`` standard errors get a weight, as
    most words tell nothing. Without rows all weights are zero.
    """
    weights = np.zeros(1 << BITS)
    if not len(rows):
        return Model(weights.astype(np.float32), np.arange(top, dtype=np.float64), uuid.uuid4().hex)
    every, sizes = np.concatenate(rows), np.array([len(r) for r in rows])
    counts = np.bincount(every, minlength=1 << BITS)
    telling = np.zeros(1 << BITS, dtype=bool)
    for k in range(1, top + 1):
        p = (grades >= k).mean()
        above = np.bincount(every, weights=np.repeat((grades >= k) - p, sizes), minlength=1 << BITS)
        telling |= np.abs(above) >= screen * np.sqrt(np.maximum(counts, 3) * max(p * (1 - p), 1e-9))
    rows = [np.append(r[telling[r]], 1 << BITS) for r in rows]  # the last one is of all rows, so that none is empty
    used, index = np.unique(np.concatenate(rows), return_inverse=True)
    sizes = np.array([len(r) for r in rows])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    n, m, at = len(rows), len(used), np.arange(len(rows))
    share = np.array([np.clip((grades >= k).mean(), 0.01, 0.99) for k in range(1, top + 1)])
    cuts = -np.log(share / (1 - share))

    def loss(params: np.ndarray) -> tuple[float, np.ndarray]:
        w, gaps = params[:m], np.exp(params[m + 1 :])
        theta = params[m] + np.concatenate([[0.0], np.cumsum(gaps)])
        f = np.add.reduceat(w[index], starts)
        above = np.concatenate([np.ones((n, 1)), _sigmoid(f[:, None] - theta[None, :]), np.zeros((n, 1))], axis=1)
        slope = above * (1 - above)
        p = np.maximum(above[at, grades] - above[at, grades + 1], 1e-12)
        low, high = slope[at, grades] / p / n, slope[at, grades + 1] / p / n
        by_theta = np.array([low[grades == k].sum() - high[grades + 1 == k].sum() for k in range(1, top + 1)])
        tails = np.cumsum(by_theta[::-1])[::-1]
        grad = np.concatenate([ridge * w - np.bincount(index, weights=np.repeat(low - high, sizes), minlength=m), [tails[0]], tails[1:] * gaps])
        return float(-np.log(p).mean() + ridge / 2 * (w @ w)), grad

    params = _minimum(loss, np.concatenate([np.zeros(m), [cuts[0]], np.log(np.maximum(np.diff(cuts), 0.05))]), steps)
    weights[used[:-1]] = params[: m - 1]
    theta = params[m] - params[m - 1] + np.concatenate([[0.0], np.cumsum(np.exp(params[m + 1 :]))])
    return Model(weights.astype(np.float32), theta, uuid.uuid4().hex)


def fit(docs: DataFrame, ratings: DataFrame, grade: Column, top: int, max_docs: int = 10_000, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on about ``max_docs`` rated documents, chosen by a hash of the id (all, if there are no more).

    ``grade`` is an integer column over ``ratings``, 0 to ``top``; rows without one, without an id or
    without a document are left out. A document rated twice counts twice. What reaches the driver is
    bounded by the sample.
    """
    rated = ratings.select(F.col(id_col).cast("long").alias("id"), grade.cast("int").alias("grade")).where(f"id is not null and grade between 0 and {top}")
    total = rated.count()
    if total > max_docs:
        rated = rated.where(F.expr(f"pmod(xxhash64(id), 1000000) < {1_000_000 * max_docs // total}"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("quality fit")
        cache = _Words()
        for batch in slices(batches):
            found = [np.sort(features(t, cache)).astype("<i4").tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("grade"), pa.array(found, pa.binary())], names=["id", "grade", "found"])

    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(F.broadcast(rated), "id").select("id", "grade", "text")
    table = rows.mapInArrow(run, "id long, grade int, found binary").toArrow().sort_by([("id", "ascending"), ("grade", "ascending")])
    return fit_ordinal([np.frombuffer(x, dtype="<i4") for x in table.column("found").to_pylist()], table.column("grade").to_numpy().astype(np.int64), top)


def _above(docs: DataFrame, model: Model) -> Callable[[list[str | None]], np.ndarray]:
    """For texts on an executor: the probabilities of each grade from 1 on, a row per text."""
    small_batches(docs)
    sent, uid = docs.sparkSession.sparkContext.broadcast(tuple(model)), model.uid

    def above(texts: list[str | None]) -> np.ndarray:
        state = worker_state("quality")
        if state.get("model", (None,))[0] != uid:
            state["model"] = (uid, sent.value)
        weights, theta, _ = state["model"][1]
        cache = state.setdefault("words", _Words())
        f = np.array([weights[np.sort(features(t, cache))].sum(dtype=np.float64) for t in texts])
        return _sigmoid(f[:, None] - theta[None, :])

    return above


def score(docs: DataFrame, model: Model, wanted: int, least: float = 0.65, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, expected_grade, tail`` (probability of grade ``wanted`` or more), ``kept``.

    Kept are documents whose tail is ``least`` or more. Null texts are empty texts; rows with a null
    id and repeated rows are scored each; an empty table gives no rows; other columns are not read; texts count whole.
    """
    above = _above(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = above(batch.column(1).to_pylist())
            tail = found[:, wanted - 1]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.sum(axis=1)), pa.array(tail), pa.array(tail >= least)], names=["doc_id", "expected_grade", "tail", "kept"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, expected_grade double, tail double, kept boolean")


def select(docs: DataFrame, model: Model, wanted: int, least: float = 0.65, text_col: str = "text") -> DataFrame:
    """The documents that ``score`` would keep, with all their columns."""
    above = _above(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(above(batch.column(text_col).to_pylist())[:, wanted - 1] >= least))

    return docs.mapInArrow(run, docs.schema)


def grade() -> Column:
    """The driver's ratings as grades: 0 poor, 1 of good quality but toxic, 2 good."""
    return F.when(F.col("quality") == 0, 0).when(F.col("quality") == 1, F.when(F.col("toxic") == 1, 1).otherwise(2))
