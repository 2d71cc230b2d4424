"""Near-duplicate documents by min-max hashing of word shingles, with exact confirmation.

A document's set is its distinct five-word shingles. Each permutation of the 64-bit hashes is
evaluated once and yields two signature values, the smallest and the largest image: both agree
between two sets with the probability of their Jaccard similarity, so 100 permutations give 200
values. Bands of five values make the buckets in which documents meet. For independent values a pair at similarity 0.75
misses all 40 bands with a probability of 2e-5, one at 0.9 with 1e-16; smallest and largest of a set of few
shingles depend on each other, which raises the first to 5e-5 at 40 shingles. So a set of at most ``FEW``
shingles has further buckets: any two sets at the threshold share one of their first shingles in the order of the
hashes (as many as either may lack, and one more), so those sets never miss each other.

How the work is bounded:

* documents with equal sets are one node;
* in every bucket only the pairs with its best-connected node (the one that meets most others over
  all its buckets) are confirmed first, on full sets;
* buckets that end up in one component are done; in the others only the nodes outside of the bucket's largest
  component are compared, with each other and with that component, in blocks of bounded rows and bytes. Within a block
  two nodes are compared if they share one of the shingles that are rarest there, of which either may not
  lack all, on halved hashes; those that may reach the threshold are confirmed, too.

Rows moved for the last step grow with a bucket times the number of blocks of its smaller components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import BROADCAST_ROWS, discard, materialise, slices, small, small_batches, worker_state
from .graph import components

PERMUTATIONS, BAND, FEW = 100, 5, 16
BANDS = 2 * PERMUTATIONS // BAND
#: Rows of one key that a join leaves together; a larger key is dealt to several tasks.
HOT = 100_000
_BLOCK, _BLOCK_BYTES, _CHUNK, _CACHE = 512, 2 << 20, 4096, 100_000


class _Hashes(dict):
    """64-bit hashes of words; forgets all when full."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > _CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of MurmurHash3 (fixed values), a bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _odd(seed: int, n: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


def shingle_set(text: bytes | None, cache: _Hashes, words: int = 5) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; fewer words: of the whole sequence; none: empty."""
    split = text.lower().split() if text else []
    if not split:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(cache.__getitem__, split), dtype=np.uint64, count=len(split))
    n = min(words, len(h))
    by = _odd(11, words + 1)
    sums = np.full(len(h) - n + 1, int(by[-1]) * n % 2**64, dtype=np.uint64)
    for k in range(n):
        sums += h[k : len(h) - n + 1 + k] * by[k]
    return np.unique(_mix(sums))


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest and largest image under each permutation ``x -> a * x + b``, side by side."""
    low = high = None
    for k in range(0, len(shingles), _CHUNK):
        images = a[:, None] * shingles[None, k : k + _CHUNK] + b[:, None]
        lo, hi = images.min(axis=1), images.max(axis=1)
        low, high = (lo, hi) if low is None else (np.minimum(low, lo), np.maximum(high, hi))
    return np.stack([low, high], axis=1).ravel()


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    return _odd(21, PERMUTATIONS), _odd(22, PERMUTATIONS)


def band_keys(values: np.ndarray) -> np.ndarray:
    """A signed 64-bit key for each band."""
    rows = values.reshape(BANDS, BAND)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(BAND):
        keys = _mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return keys.view(np.int64)


def first_keys(shingles: np.ndarray, share: int) -> np.ndarray:
    """Keys of the first shingles of a small set: two sets at the threshold have one in common."""
    first = shingles[: len(shingles) - -(-share * len(shingles) // 100) + 1]
    return _mix(first ^ np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _text_column(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def _words() -> _Hashes:
    """This worker's cache of words; what another operator has left is dropped."""
    return worker_state("near duplicates").setdefault("words", _Hashes())


def signatures(docs: DataFrame, share: int = 75) -> DataFrame:
    """``doc_id, tk`` with ``n`` (size of the set), ``set_key`` (128-bit digest) and ``bands``; from ``doc_id, tk, text``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, (a, b) = _words(), _permutations()
        for batch in slices(batches, 1024):
            sizes, keys, bands = [], [], []
            for text in _text_column(batch, "text"):
                s = shingle_set(text, cache)
                sizes.append(len(s))
                if not len(s):
                    keys.append(None), bands.append(None)
                    continue
                keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                own = band_keys(signature(s, a, b))
                bands.append(np.concatenate([own, first_keys(s, share)]) if len(s) <= FEW else own)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tk"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], names=["doc_id", "tk", "n", "set_key", "bands"])

    return docs.select("doc_id", "tk", "text").mapInArrow(run, "doc_id long, tk long, n long, set_key binary, bands array<long>")


def _by_key(rows: DataFrame, keyed: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join written ``rows`` with the written table ``keyed``: one row per ``key`` and ``met``, its number of rows.

    A small ``keyed`` is broadcast. Otherwise the rows of a key with more than ``HOT`` (there are few, as they
    add up to the rows) are dealt to as many tasks as they fill.
    """
    total = keyed.agg(F.count("*").alias("n"), F.sum("met").alias("met")).first()
    if total.n <= BROADCAST_ROWS:
        return rows.join(F.broadcast(keyed), key, how).drop("met")
    parts = F.ceil(F.col("met") / max(HOT, (total.met or 0) // HOT)).cast("int")
    hot = keyed.select(key, parts.alias("parts")).where("parts > 1")  # at most HOT
    dealt = rows.join(F.broadcast(hot), key, "left").withColumn("part", F.pmod(F.monotonically_increasing_id(), F.coalesce("parts", F.lit(1))).cast("int")).drop("parts")
    return dealt.join(keyed.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("met"), [key, "part"], how).drop("part")


def confirmed(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, share: int, held: list[str]) -> DataFrame:
    """Those of ``pairs`` (``a, b`` of nodes) that reach ``share`` percent on full sets.

    The texts meet by ``a``; a node with many partners is dealt to several tasks, each with its text once.
    """
    spread = materialise(pairs.groupBy("a").agg(F.ceil(F.count("*") / 128).cast("int").alias("parts")), "spread", held)
    many = small(materialise(spread.where("parts > 1"), "many", held))
    dealt = pairs.join(many, "a", "left").select(F.col("b").alias("node"), "a", F.expr("int(pmod(xxhash64(b), coalesce(parts, 1)))").alias("part"), F.lit(1).alias("kind"))
    hubs = spread.select(F.col("a").alias("node"), "a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"))
    wanted = small(materialise(dealt.union(hubs).join(nodes.select("node", "doc_id", "tk"), "node"), "wanted", held))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, at, hub = _words(), None, None
        for batch in slices(batches, 1024):
            found: tuple[list[int], list[int]] = ([], [])
            columns = (batch.column(c).to_pylist() for c in ("a", "part", "kind", "node"))
            for a, part, kind, b, text in zip(*columns, _text_column(batch, "text"), strict=True):
                if (a, part) != at:
                    at, hub = (a, part), None
                if not kind:
                    hub = shingle_set(text, cache) if hub is None else hub  # rows may repeat
                    continue
                s = shingle_set(text, cache)
                if hub is None:
                    continue
                near = np.searchsorted(hub, s)
                near[near == len(hub)] = 0
                both = int((hub[near] == s).sum())
                if 100 * both >= share * (len(s) + len(hub) - both):
                    found[0].append(a), found[1].append(b)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], names=["a", "b"])

    rows = docs.join(wanted, ["doc_id", "tk"]).select("a", "part", "kind", "node", "text")
    return rows.repartition("a", "part").sortWithinPartitions("a", "part", "kind").mapInArrow(run, "a long, b long")


def _halved(docs: DataFrame) -> DataFrame:
    """``node, half``: the upper 32 bits of a document's hashes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _words()
        for batch in slices(batches, 1024):
            half = [(shingle_set(t, cache) >> np.uint64(32)).astype("<u4").tobytes() for t in _text_column(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(half, pa.binary())], names=["node", "half"])

    return docs.select("node", "text").mapInArrow(run, "node long, half binary")


class _Node(NamedTuple):
    """A node as it comes to a block: ``side`` tells the two blocks that meet apart."""

    side: int
    band: int
    node: int
    comp: int
    bands: list[int]
    half: bytes


def likely(nodes: list[_Node], two: bool, share: int) -> Iterator[tuple[int, int]]:
    """Places of pairs of one block, or of two that meet, in different components that may reach the threshold.

    Exact up to confirmation: of ``n`` shingles a partner lacks at most ``n - ceil(share * n)``, so the pair
    shares one of as many and one more, whichever these are; the rarest here meet fewest others.
    """
    sizes = np.array([len(x.half) // 4 for x in nodes], dtype=np.int64)
    every = np.frombuffer(b"".join(x.half for x in nodes), dtype="<u4")
    names, token, counts = np.unique(every, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(nodes)), sizes)
    order = np.lexsort((token, counts[token], owner))
    starts = np.cumsum(sizes) - sizes
    rank = np.empty(len(every), dtype=np.int64)
    rank[order] = np.arange(len(every)) - starts[owner]
    early = np.flatnonzero(rank < sizes[owner] - -(-share * sizes[owner] // 100) + 1)
    by_token = early[np.argsort(token[early], kind="stable")]
    ends = np.searchsorted(token[by_token], np.arange(len(names) + 1))
    comps, sides = (np.array([getattr(x, c) for x in nodes], dtype=np.int64) for c in ("comp", "side"))
    band = min(nodes[0].band, BANDS)
    bands = np.array([x.bands[:band] for x in nodes], dtype=np.int64).reshape(len(nodes), band)
    mark = np.zeros(len(names), dtype=bool)
    mine = np.split(early, np.searchsorted(owner[early], np.arange(1, len(nodes))))
    for k in range(len(nodes)):
        if two and sides[k]:
            continue
        met = [owner[by_token[ends[t] : ends[t + 1]]] for t in token[mine[k]].tolist() if ends[t + 1] - ends[t] > 1]
        if not met:
            continue
        others = np.unique(np.concatenate(met))
        others = others[sides[others] == 1] if two else others[others > k]
        others = others[(comps[others] != comps[k]) & (100 * np.minimum(sizes[others], sizes[k]) >= share * np.maximum(sizes[others], sizes[k]))]
        if band:  # a pair comes from the first of its common buckets
            others = others[~(bands[others] == bands[k]).any(axis=1)]
        own = token[starts[k] : starts[k] + sizes[k]]
        mark[own] = True
        for o in others.tolist():
            both = int(mark[token[starts[o] : starts[o] + sizes[o]]].sum())  # no fewer than on full hashes
            if 100 * both >= share * (sizes[o] + sizes[k] - both):
                yield k, o
        mark[own] = False


def _across(members: DataFrame, share: int, held: list[str]) -> DataFrame:
    """Pairs of a bucket in different components that may reach the threshold.

    ``members``: ``key, band, node, comp, minor, bands, half``; ``minor`` marks the nodes outside of the bucket's
    largest component. Minor blocks meet each other and the major ones; a pair comes from the first of its common buckets only.
    """
    blocks = lambda cond: F.greatest(F.ceil(F.count(F.when(cond, 1)) / _BLOCK), F.ceil(F.sum(F.when(cond, F.octet_length("half"))) / _BLOCK_BYTES)).cast("int")
    sizes = members.groupBy("key").agg(F.count("*").alias("met"), blocks(F.col("minor")).alias("minors"), blocks(~F.col("minor")).alias("majors"))
    rows = _by_key(members, materialise(sizes, "sizes", held), "key")
    rows = rows.withColumn("mine", F.expr("int(pmod(xxhash64(node, 5), if(minor, minors, majors)))"))
    to, minors, majors = F.struct, F.sequence(F.lit(0), F.col("minors") - 1), F.sequence(F.lit(0), F.col("majors") - 1)
    among = F.transform(minors, lambda x: to(F.lit(0).alias("kind"), F.least("mine", x).alias("i"), F.greatest("mine", x).alias("j"), (F.col("mine") > x).cast("int").alias("side")))
    down = F.transform(majors, lambda x: to(F.lit(1).alias("kind"), F.col("mine").alias("i"), x.alias("j"), F.lit(0).alias("side")))
    up = F.transform(minors, lambda x: to(F.lit(1).alias("kind"), x.alias("i"), F.col("mine").alias("j"), F.lit(1).alias("side")))
    rows = rows.withColumn("at", F.explode(F.when(F.col("minor"), F.concat(among, down)).otherwise(up)))
    rows = rows.select("key", "at.kind", "at.i", "at.j", "at.side", "band", "node", "comp", "bands", "half")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_state("near duplicates")
        at, held = None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if len(held) < 2:
                return
            two = at[1] == 1 or at[2] != at[3]
            pairs = [sorted((held[k].node, held[o].node)) for k, o in likely(held, two, share)]
            yield pa.RecordBatch.from_arrays([pa.array([p[x] for p in pairs], pa.int64()) for x in (0, 1)], names=["a", "b"])

        for batch in slices(batches, 256):
            for key, kind, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, kind, i, j) != at:
                    yield from flush()
                    at, held = (key, kind, i, j), []
                held.append(_Node(*row))
        yield from flush()

    return rows.repartition("key", "kind", "i", "j").sortWithinPartitions("key", "kind", "i", "j", "node").mapInArrow(run, "a long, b long").distinct()


def _classes(docs: DataFrame, share: int, by_id: bool, kept: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows (``doc_id, tk, n, node``) and classes (``node, met, rep``): the smallest id and text of a node's component.

    A node is a distinct set of shingles. Rows without words or without an id have no node. With ``by_id`` the
    sets of one id are linked, too.
    """
    spark, held = docs.sparkSession, []
    seen = materialise(signatures(docs, share), "signatures", held)
    nodes = seen.where("n > 0 and doc_id is not null").groupBy("set_key").agg(F.min(F.struct("doc_id", "tk")).alias("of"), F.first("bands").alias("bands"), F.count("*").alias("met"))
    nodes = materialise(nodes.select(F.monotonically_increasing_id().alias("node"), "set_key", "of.doc_id", "of.tk", "bands", "met"), "nodes", held)
    # rows without a node have a key of their own, which no digest can be
    own = seen.select("doc_id", "tk", "n", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("set_key")), F.monotonically_increasing_id().cast("string").cast("binary")).alias("set_key"))
    own = materialise(_by_key(own, nodes.select("set_key", "node", "met"), "set_key", "left").select("doc_id", "tk", "n", "node"), "own", kept)

    buckets = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    shared = materialise(buckets.groupBy("key").agg(F.count("*").alias("met")).where("met > 1"), "buckets", held)
    members = materialise(_by_key(buckets, shared.select("key", "met", F.col("met").alias("size")), "key"), "members", held)
    degrees = members.groupBy("node").agg(F.sum("size").alias("degree"))
    leaders = members.join(degrees, "node").groupBy("key").agg(F.max(F.struct("degree", F.negative("node").alias("minus"))).alias("top"), F.count("*").alias("met"))
    leaders = materialise(leaders.select("key", F.negative("top.minus").alias("a"), "met"), "leaders", held)
    first = _by_key(members, leaders, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct()
    first = materialise(first, "pairs", held)
    links = materialise(confirmed(docs, nodes, first, share, held), "links", held)
    if by_id:
        repeated = materialise(own.where("node is not null").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b"), F.count("*").alias("met")).where("a < b").drop("b"), "repeated", held)
        links = links.union(materialise(_by_key(own, repeated, "doc_id").where("node <> a").select("a", F.col("node").alias("b")).distinct(), "links", held))
    found = components(links)

    placed = materialise(members.join(found.withColumnRenamed("id", "node"), "node", "left").select("key", "band", "node", F.coalesce("comp", "node").alias("comp")), "placed", held)
    open_ = placed.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.count("*").alias("comps"), F.sum("n").alias("met"))
    open_ = materialise(open_.where("comps > 1").drop("comps"), "open", held)
    if not open_.isEmpty():
        rest = materialise(_by_key(placed, open_, "key").withColumn("minor", F.expr("comp <> major")).drop("major"), "rest", held)
        ids = materialise(rest.select("node").distinct().join(nodes.select("node", "doc_id", "tk", "bands"), "node"), "ids", held)
        halves = materialise(_halved(docs.join(small(ids.drop("bands")), ["doc_id", "tk"])).dropDuplicates(["node"]), "halves", held)
        rest = materialise(rest.join(ids.select("node", "bands"), "node").join(halves, "node"), "members", held)
        tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        second = materialise(_across(rest, share, held).join(tried, ["a", "b"], "left_anti"), "pairs", held)
        if not second.isEmpty():
            links = links.union(materialise(confirmed(docs, nodes, second, share, held), "links", held))
            found = components(links)

    of = nodes.join(found.withColumnRenamed("id", "node"), "node").select("node", "comp", "met", F.struct("doc_id", "tk").alias("rep"))
    least = of.groupBy("comp").agg(F.min("rep").alias("rep"))
    alone = nodes.join(found.select(F.col("id").alias("node")), "node", "left_anti").select("node", "met", F.struct("doc_id", "tk").alias("rep"))
    classes = materialise(of.drop("rep").join(least, "comp").select("node", "met", "rep").union(alone), "classes", kept)
    discard(spark, held)
    return own, classes


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tk"), F.col(text_col).alias("text"))


def near_duplicates(docs: DataFrame, share: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_shingles, component_id, kept``.

    ``component_id`` is the smallest id reachable over links of ``share`` percent or more, ``kept``
    marks the document of that id. Documents without words (null, empty, blank) have an empty set and
    are linked with nothing. A null id is linked with nothing either: its component is null and it is
    kept. Rows that repeat an id are one document, whatever their texts: all are in one component, and
    each row has the size of its own set. An empty
    table gives no rows; other columns are not read; texts of any length count whole.
    """
    own, classes = _classes(_keyed(docs, id_col, text_col), share, True, [])
    # textless rows of an id that also has texts belong to those
    bare = own.where("node is null")
    by_text = _by_key(own.where("node is not null"), classes, "node").select("doc_id", "n", F.col("rep.doc_id").alias("component_id"))
    known = by_text.join(bare.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    bare = bare.join(known, "doc_id", "left").select("doc_id", "n", F.coalesce("component_id", "doc_id").alias("component_id"))
    return by_text.union(bare).select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def distinct_documents(docs: DataFrame, share: int = 75, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicate texts, with all its columns: that of the smallest id.

    Here it is texts that are linked, so of an id with two different texts either may stay. Of rows of equal id and
    text one stays, the first by its columns as JSON. Rows with a null id all stay, as do documents without words (one row
    of equal ones). An empty table gives no rows; columns of any name are carried along.
    """
    kept: list[str] = []
    own, classes = _classes(_keyed(docs, id_col, text_col), share, False, kept)
    rep = F.struct("doc_id", "tk")
    rows = _by_key(own.where("node is not null"), classes, "node")
    gone = small(materialise(rows.where(rep != F.col("rep")).select(*_KEYS).distinct(), "gone"))
    twice = own.where("doc_id is not null").groupBy(*_KEYS).agg(F.count("*").alias("n")).where("n > 1")
    twice = materialise(twice.select(*_KEYS), "twice")
    discard(docs.sparkSession, kept)
    at = F.struct(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("tk"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), at.alias("at")).select("row", "at.*")
    left = keyed.join(gone, _KEYS, "left_anti")
    if not twice.isEmpty():
        twice = small(twice)
        order = Window.partitionBy(*_KEYS).orderBy(F.to_json("row"))
        ones = left.join(twice, _KEYS, "left_semi").withColumn("copy", F.row_number().over(order)).where("copy = 1").drop("copy")
        left = left.join(twice, _KEYS, "left_anti").union(ones)
    return left.select("row.*")


_KEYS = ["doc_id", "tk"]
