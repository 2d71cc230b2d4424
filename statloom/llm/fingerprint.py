"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is a bag of words with their counts as weights. For each of ``SAMPLES`` samples every
word has, from hashes of itself and the sample, ``r`` and ``c`` from Gamma(2, 1) and ``beta`` uniform;
with ``t = floor(ln(weight) / r + beta)`` the word of the smallest
``ln a = ln c - r * (t - beta + 1)`` is drawn, together with its ``t``. Two documents draw the same in a
sample with a probability of their generalised Jaccard similarity, sum of minima over sum of maxima.

A sample is kept as one long: ``ln a`` in fixed point above 32 bits that name the word and its ``t``;
so a plain ``min`` draws it inside a hash aggregate.

Documents are dealt to groups of neighbouring ids (by histograms of about ``CELLS`` cells, the only
thing the driver sees, finer where ids are dense), the first row of each group also to the group before it. That one shuffle
serves everything: the next document, the counts, the samples and the comparisons.
"""

from __future__ import annotations

import bisect
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import shuffle_partitions

SAMPLES, CELLS, ROWS = 32, 1 << 16, 1500
#: What ends a word: ASCII other than digits and letters; fixed values.
_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(rows: DataFrame, keys: list[str], text: str) -> DataFrame:
    """A row with ``keys`` and ``term`` (long) for each lower-case word.

    A text without words is one term as a whole, so that every document has one.
    """
    split = rows.select(*keys, F.col(text).alias("t"), F.array_remove(F.split(F.lower(text), _BREAK), "").alias("words"))
    each = split.select(*keys, F.explode(F.when(F.size("words") > 0, F.col("words")).otherwise(F.array("t"))).alias("word"))
    return each.select(*keys, F.xxhash64("word").alias("term"))


def sample(term: Column, log_weight: Column, k: int) -> Column:
    """One draw of one term as a long: smaller is better, the low 32 bits name what is drawn."""
    h = F.xxhash64(term, F.lit(k))
    g = F.xxhash64(h)
    unit = lambda x, shift, bits: (F.shiftrightunsigned(x, shift).bitwiseAND(F.lit((1 << bits) - 1)) + F.lit(0.5)) / F.lit(float(1 << bits))
    r = -F.log(unit(h, 0, 21) * unit(h, 21, 21))
    beta = unit(h, 42, 22)
    log_c = F.log(-F.log(unit(g, 0, 32) * unit(g, 32, 32)))
    t = F.floor(log_weight / r + beta)
    log_a = log_c - r * (t - beta + F.lit(1.0))
    high = F.greatest(F.lit(0.0), (log_a + F.lit(64.0)) * F.lit(float(1 << 24))).cast("long")
    name = F.xxhash64(h, t).bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(high, 32).bitwiseOR(name)


def signatures(occurrences: DataFrame, keys: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and ``names`` (array of long) from rows of ``keys`` and ``term``, one per occurrence."""
    weights = occurrences.groupBy(*keys, "term").agg(F.log(F.count("*").cast("double")).alias("w"))
    drawn = weights.groupBy(*keys).agg(*(F.min(sample(F.col("term"), F.col("w"), k)).alias(f"s{k}") for k in range(samples)))
    return drawn.select(*keys, F.array(*(F.col(f"s{k}").bitwiseAND(F.lit(0xFFFFFFFF)) for k in range(samples))).alias("names"))


def as_text(names: Column) -> Column:
    return F.array_join(F.transform(names, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples, an estimate of the generalised Jaccard similarity."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)


def _pick(at: Column, values: dict, kind: str) -> Column:
    """``values[at]`` from a list that becomes one literal; null for what is not there."""
    every = ",".join("" if (v := values.get(k)) is None else str(v) for k in range(max(values, default=0) + 1))
    return F.get(F.split(F.lit(every), ","), at).try_cast(kind)


class _Level(NamedTuple):
    """Cells of one level: a row's cell, where each node's cells begin, and by cell ``(rows, least id, node of the next level)``."""

    cell: Column
    starts: list[int]
    found: dict[int, tuple[int, int | None, int | None]]


def _histogram(docs: DataFrame, fill: int, cells: int) -> list[_Level]:
    """Cells of ids, finer where ids are dense.

    A cell of more than twice ``fill`` rows and more than one id is a node of the next level, where it falls
    apart into cells of its own; so ids far from all others cost a level, not a large cell.
    """
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    levels: list[_Level] = []
    nodes = [(low or 0, high or 0)]
    while nodes:
        starts, shifts, lows, total = [], [], [], 1  # cell 0 is that of null ids
        for low, high in nodes:
            shift = 0
            while (high >> shift) - (low >> shift) >= max(2, cells // len(nodes)):
                shift += 1
            starts.append(total)
            shifts.append(shift)
            lows.append(low >> shift)
            total += (high >> shift) - (low >> shift) + 1
        if levels:
            node = _pick(levels[-1].cell, {c: at for c, (_, _, at) in levels[-1].found.items()}, "int")
            own = dict(enumerate(zip(shifts, lows, starts, strict=True)))
            shift, low, start = (_pick(node, {k: v[i] for k, v in own.items()}, kind) for i, kind in enumerate(("int", "long", "int")))
            cell = (F.call_function("shiftright", "doc_id", shift) - low + start).cast("int")
        else:
            cell = F.coalesce(F.shiftright("doc_id", shifts[0]) - F.lit(lows[0]) + 1, F.lit(0)).cast("int")
        nodes, found = [], {}
        for r in sorted(docs.groupBy(cell.alias("cell")).agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).where("cell is not null").collect()):
            c, n, low, high = r
            split = n > 2 * fill and low is not None and low < high
            found[c] = (n, low, len(nodes) if split else None)
            nodes += [(low, high)] if split else []
        levels.append(_Level(cell, starts, found))
    return levels


def neighbours(docs: DataFrame) -> tuple[DataFrame, int]:
    """Rows of ``doc_id, text`` with ``g, after`` (1: the row that follows group ``g``), and the partitions for them."""
    rows = docs.count()
    parts = max(shuffle_partitions(docs.sparkSession), -(-rows // ROWS))
    fill = max(1, rows // (8 * parts), 8 * rows // CELLS)
    levels = _histogram(docs, fill, min(CELLS, max(256, rows // 100)))
    groups: list[dict[int, int]] = [{} for _ in levels]
    order = [sorted(x.found) for x in levels]
    firsts, held, open_ = [], fill, [(0, c) for c in reversed(order[0])]
    while open_:  # cells in the order of ids
        level, c = open_.pop()
        n, first, node = levels[level].found[c]
        if node is not None:
            level += 1
            first, last = (bisect.bisect_left(order[level], levels[level].starts[k]) if k < len(levels[level].starts) else None for k in (node, node + 1))
            open_ += [(level, k) for k in reversed(order[level][first:last])]
            continue
        if held >= fill:
            firsts.append(first)
            held = 0
        held += n
        groups[level][c] = len(firsts) - 1
    g = F.coalesce(*(_pick(x.cell, of, "int") for x, of in zip(levels[::-1], groups[::-1], strict=True)), F.lit(0))
    at = docs.withColumn("g", g)
    own = F.struct("g", F.lit(0).alias("after"))
    before = F.struct(F.when(F.col("g") == 0, F.lit(max(0, len(firsts) - 1))).otherwise(F.col("g") - 1).alias("g"), F.lit(1).alias("after"))
    first = F.col("doc_id").eqNullSafe(_pick(F.col("g"), dict(enumerate(firsts)), "long"))
    return at.withColumn("to", F.explode(F.when(first, F.array(own, before)).otherwise(F.array(own)))).select("doc_id", "text", "to.g", "to.after"), parts


def fingerprints(docs: DataFrame, samples: int = SAMPLES, with_text: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the fingerprints of its text and of its text edited at the end.

    ``doc_id, n_chars, edited, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``; without
    ``edited`` unless ``with_text``, as that text is moved once more to meet its fingerprint. In the edited
    text the last ``floor(n_chars / 2)`` code points give way to the first as many (or all) of the next
    document's; documents follow by ascending id (null first, then by text), the first comes after the
    last, so a single document follows itself. Null texts are empty; texts without words are one term
    of their own; equal texts have equal fingerprints. Rows that repeat an id are documents of their
    own, in one group. An empty table gives no rows; other columns are not read; texts count whole.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed, parts = neighbours(docs)
    order = Window.partitionBy("g").orderBy("after", F.col("doc_id").asc_nulls_first(), "text")
    rows = placed.repartition(parts, "g").withColumn("pos", F.row_number().over(order)).withColumn("next", F.lead("text").over(order))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next", F.lit("")), F.lit(1), half))
    rows = rows.select("g", "after", "pos", "doc_id", "text", edited.alias("edited"))

    text, other = F.struct(F.lit(0).alias("kind"), F.col("text").alias("t")), F.struct(F.lit(1).alias("kind"), F.col("edited").alias("t"))
    both = rows.select("g", "pos", F.explode(F.when(F.col("after") == 0, F.array(text, other)).otherwise(F.array(text))).alias("of")).select("g", "pos", "of.*")
    found = signatures(terms(both, ["g", "pos", "kind"], "t"), ["g", "pos", "kind"], samples)
    follow = Window.partitionBy("g").orderBy("pos", "kind")
    found = found.withColumn("edited_names", F.lead("names").over(follow)).withColumn("next_names", F.lead("names", 2).over(follow)).where("kind = 0")
    found = found.select("g", "pos", as_text(F.col("names")).alias("fingerprint"), as_text(F.col("edited_names")).alias("edited_fingerprint"), likeness(F.col("names"), F.col("edited_names")).alias("near_edited"), likeness(F.col("names"), F.col("next_names")).alias("near_next"))
    own = rows.where("after = 0").select("g", "pos", "doc_id", n.cast("long").alias("n_chars"), *(["edited"] if with_text else []), F.sha2("edited", 256).alias("edited_sha256"))
    return own.join(found, ["g", "pos"]).drop("g", "pos")
