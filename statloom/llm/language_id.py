"""Language identification with word-first backoff.

A word known from the training texts is scored by its logarithmic frequency in each language. An
unseen word falls back to its character n-grams (word borders included): to those of four characters
that are known, if none is, to those of three, and so on down to single characters. A document's score
in a language is the sum over its words; the posterior at equal priors is its confidence.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import materialise, slices, small_batches, worker_state

LONGEST = 4
_WORD = re.compile(r"[^\W\d_]+")
_CACHE = 100_000


class Table(NamedTuple):
    """Words or n-grams of one length: sorted 64-bit hashes, and for each the languages it was seen in.

    ``rest`` is the log probability per language of what was not seen there; ``more`` is added for what was.
    Entries of hash ``k`` stand from ``starts[k]`` to ``starts[k + 1]``.
    """

    hashes: np.ndarray
    starts: np.ndarray
    langs: np.ndarray
    more: np.ndarray
    rest: np.ndarray


class Model(NamedTuple):
    langs: list[str]
    tables: list[Table]
    uid: str


def held_out(id_col: str = "doc_id") -> Column:
    """A quarter of the documents, by ``crc32`` of the id as text; null ids count as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def tokens(text: str) -> list[str]:
    """Lower-case runs of letters; runs of other word characters only, such as fractions, don't count."""
    found = _WORD.findall(text.lower())
    return found if any(map(str.isalpha, found)) else [w for w in found if any(map(str.isalpha, w))]


def grams(word: str, n: int) -> list[str]:
    word = f"<{word}>" if n > 1 else word
    return [word[k : k + n] for k in range(len(word) - n + 1)]


def hashed(gram: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(gram.encode("utf-8", "surrogatepass"))


def table(hashes: np.ndarray, langs: np.ndarray, counts: np.ndarray, n_langs: int) -> Table:
    """A table of counts, by hash and language, with half a count added to each."""
    order = np.lexsort((langs, hashes))
    hashes, langs, counts = hashes[order], langs[order], counts[order].astype(np.float64)
    names, starts = np.unique(hashes, return_index=True)
    whole = np.log(np.bincount(langs, weights=counts, minlength=n_langs) + 0.5 * (len(names) + 1))
    return Table(names, np.append(starts, len(hashes)), langs.astype(np.int32), (np.log(counts + 0.5) - np.log(0.5)).astype(np.float32), (np.log(0.5) - whole).astype(np.float32))


def fit(labelled: DataFrame, max_docs: int = 6000, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Counts of words and n-grams per language, as log probabilities.

    The sample has about ``max_docs`` labelled documents (by a hash of the id; all, if there are no
    more); every word and n-gram of it is kept, so the model is bounded by the sample, and its languages are those of the
    sample. Rows with a null text or language teach nothing.
    """
    rows = small_batches(labelled).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(id_col).alias("id"))
    total = rows.count()
    if total > max_docs:
        rows = rows.where(F.expr(f"pmod(xxhash64(id), 1000000) < {1_000_000 * max_docs // total}"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("language fit")
        seen: dict[str, Counter] = {}
        for batch in slices(batches):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(tokens(text))
        for lang, words in seen.items():
            yield _counted(lang, 0, words)
            for kind in range(1, LONGEST + 1):
                counts: Counter = Counter()
                for w, n in words.items():
                    for g in grams(w, kind):
                        counts[g] += n
                yield _counted(lang, kind, counts)

    counted = rows.select("text", "lang").mapInArrow(run, "lang string, kind int, hash long, n long").groupBy("kind", "hash", "lang").agg(F.sum("n").alias("n"))
    counted = materialise(counted, "counts")
    found = counted.toArrow()
    langs = sorted(found.column("lang").unique().to_pylist())
    place = np.searchsorted(np.array(langs, dtype=object), np.array(found.column("lang").to_pylist(), dtype=object)) if langs else np.empty(0, dtype=np.int64)
    kinds, hashes, counts = (found.column(c).to_numpy() for c in ("kind", "hash", "n"))
    tables = [table(hashes[kinds == k].view(np.uint64), place[kinds == k], counts[kinds == k], len(langs)) for k in range(LONGEST + 1)]
    return Model(langs, tables, uuid.uuid4().hex)


def _counted(lang: str, kind: int, counts: Counter) -> pa.RecordBatch:
    hashes = np.fromiter(map(hashed, counts), dtype=np.uint64, count=len(counts)).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array([kind] * len(counts), pa.int32()), pa.array(hashes), pa.array(list(counts.values()), pa.int64())], names=["lang", "kind", "hash", "n"])


class Scorer:
    """Log probabilities of words per language, each worked out once and kept while there is room."""

    def __init__(self, model: Model):
        self.langs, self.tables = model.langs, model.tables
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((_CACHE, len(self.langs)), dtype=np.float32)

    def known(self, kind: int, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Which of these words or n-grams were seen, and the scores of those."""
        t = self.tables[kind]
        asked = np.fromiter(map(hashed, names), dtype=np.uint64, count=len(names))
        at = np.searchsorted(t.hashes, asked)
        seen = np.zeros(len(names), dtype=bool)
        seen[at < len(t.hashes)] = t.hashes[at[at < len(t.hashes)]] == asked[at < len(t.hashes)]
        at = at[seen]
        scores = np.tile(t.rest, (len(at), 1))
        sizes = t.starts[at + 1] - t.starts[at]
        entries = np.repeat(t.starts[at] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        scores[np.repeat(np.arange(len(at)), sizes), t.langs[entries]] += t.more[entries]
        return seen, scores

    def words(self, words: list[str]) -> np.ndarray:
        """A row of scores for each word: its own, or the mean of its longest known n-grams, or zero."""
        out = np.zeros((len(words), len(self.langs)), dtype=np.float32)
        seen, scores = self.known(0, words)
        out[seen] = scores
        left = np.flatnonzero(~seen)
        for n in range(LONGEST, 0, -1):
            if not len(left):
                break
            parts = [grams(words[k], n) for k in left.tolist()]
            of = np.repeat(np.arange(len(left)), [len(p) for p in parts])
            seen, scores = self.known(n, [g for p in parts for g in p])
            hits = np.bincount(of[seen], minlength=len(left))
            sums = np.zeros((len(left), len(self.langs)))
            np.add.at(sums, of[seen], scores)
            out[left[hits > 0]] = sums[hits > 0] / hits[hits > 0, None]
            left = left[hits == 0]
        return out

    def documents(self, texts: list[str | None]) -> list[tuple[str, float]]:
        every = [tokens(t or "") for t in texts]
        if sum(map(len, every)) > _CACHE // 2:  # long texts: one by one, in steps that fit into the cache
            return list(map(self._document, every))
        self._learn(itertools.chain.from_iterable(every))
        return list(map(self._document, every))

    def _learn(self, words: Iterable[str]) -> None:
        new = list(set(words).difference(self.rows))
        if len(self.rows) + len(new) > _CACHE:
            self.clear()
            return
        self.scores[len(self.rows) : len(self.rows) + len(new)] = self.words(new)
        self.rows.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))

    def _document(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.langs:
            return "und", 0.0
        total = np.zeros(len(self.langs))
        for k in range(0, len(words), _CACHE // 2):
            part = words[k : k + _CACHE // 2]
            while not self.rows.keys() >= set(part):
                self._learn(part)
            total += self.scores[np.fromiter(map(self.rows.__getitem__, part), dtype=np.int64, count=len(part))].sum(axis=0, dtype=np.float64)
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(np.minimum(total - total[best], 0)).sum())


def _answers(docs: DataFrame, model: Model) -> Callable[[list[str | None]], list[tuple[str, float]]]:
    """For texts on an executor: language and confidence."""
    small_batches(docs)
    sent, uid = docs.sparkSession.sparkContext.broadcast(tuple(model)), model.uid

    def answers(texts: list[str | None]) -> list[tuple[str, float]]:
        state = worker_state("language")
        if state.get("scorer", (None,))[0] != uid:
            state["scorer"] = (uid, Scorer(Model(*sent.value)))
        return state["scorer"][1].documents(texts)

    return answers


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score``.

    Texts that are null or have no letter are ``und`` with score 0, as is every text when the model has
    learned nothing. Ties go to the first language by name. Rows that repeat an id are answered each;
    an empty table gives no rows; other columns are not read; texts count whole. The model is
    bounded by the sample of ``fit`` and broadcast.
    """
    answers = _answers(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = answers(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def select(docs: DataFrame, model: Model, least: float, text_col: str = "text") -> DataFrame:
    """The documents with a language and a confidence of ``least`` or more, with all their columns."""
    answers = _answers(docs, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array([lang != "und" and score >= least for lang, score in answers(batch.column(text_col).to_pylist())], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
