"""Sharding, classifier, neighbours, near-duplicates, fingerprints and the pipeline on small tables."""

import hashlib
import itertools
import math
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from statloom.llm import common, fingerprint, graph, near_dup, neighbours, quality, queries, sharding
from statloom.llm.common import materialise


def docs(spark, texts, ids=None):
    rows = [(k if ids is None else ids[k], t, "clash", 7) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, set_key string, n int")


# ---- sharding


@given(st.lists(st.integers(1, 1000), max_size=60), st.integers(1, 8))
def test_differencing_places_every_weight(weights, k):
    parts = sharding.difference(weights, k)
    assert len(parts) == len(weights) and all(0 <= p < k for p in parts)
    sums = [sum(w for w, p in zip(weights, parts, strict=True) if p == s) for s in range(k)]
    assert max(sums) - min(sums) <= max(weights, default=0)


def test_differencing_is_tighter_than_greedy():
    rng = random.Random(3)
    weights = [rng.randint(1, 10**6) for _ in range(400)]
    parts = sharding.difference(weights, 2)
    assert abs(sum(w if p else -w for w, p in zip(weights, parts, strict=True))) <= 10


@pytest.mark.parametrize("bucket", [20_000, 40])
def test_shards(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BUCKET", bucket)
    monkeypatch.setattr(sharding, "BINS", 8)
    rng = random.Random(1)
    texts = ["x" * rng.randint(0, 300) + str(rng.randint(0, 60)) for _ in range(300)] + ["copy"] * 150 + [None, "", None]
    found = sharding.shard(docs(spark, texts), 8).toPandas()
    assert len(found) == len(texts)
    sizes = found.groupby("shard")["size"].sum()
    assert sizes.max() - sizes.min() <= 0.05 * sizes.sum() / 8 + 750
    groups = {}
    for r in found.itertuples():
        groups.setdefault(texts[r.doc_id] or "", set()).add(r.shard)
    assert all(len(s) == 1 for s in groups.values())
    for _, own in found.groupby("shard"):
        assert own.sort_values("doc_id").slot.tolist() == list(range(len(own)))
    assert sharding.shard(docs(spark, []), 8).count() == 0


def test_shards_are_as_even_as_differencing_makes_them(spark):
    """On few groups the operator is plain differencing; over several rounds the spread stays below a small group."""
    rng = random.Random(2)
    texts = ["x" * rng.randint(0, 4000) + str(k) for k in range(500)] + ["twin"] * 40
    found = sharding.shard(docs(spark, texts), 8).toPandas()
    sizes = found.groupby("shard")["size"].sum()
    weights = Counter()
    for t in texts:
        weights[t] += len(t) + 1
    parts = sharding.difference(sorted(weights.values(), reverse=True), 8)
    plain = [sum(w for w, p in zip(sorted(weights.values(), reverse=True), parts, strict=True) if p == k) for k in range(8)]
    assert sizes.max() - sizes.min() == max(plain) - min(plain) <= 5


def test_sharding_query_at_the_edges(spark, tmp_path):
    texts = [None, "", "a", "a", None, "é" * 100_000, "b"]
    ids = [3, 3, None, 1, None, 2, 2]
    docs(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op3_sharding(spark, str(tmp_path)).collect()
    wanted = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in zip(ids, texts, strict=True))
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == wanted and all(r.law == "bytes" and r.grown_shard is None for r in found)
    for shard in {r.shard for r in found}:
        own = sorted((r.slot, r.doc_id is not None, r.doc_id or 0) for r in found if r.shard == shard)
        assert [x[0] for x in own] == list(range(len(own))) and [x[1:] for x in own] == sorted(x[1:] for x in own)


def test_rows_of_one_id_are_spread(spark):
    same = spark.range(3000).select(F.lit(5).alias("doc_id"), F.lit("copy").alias("text"))
    found = sharding.shard(same, 3).collect()
    assert sorted(r.slot for r in found) == list(range(3000)) and len({r.shard for r in found}) == 1


# ---- classifier


def rated(spark, n=300):
    rng = random.Random(5)
    good, bad, mean = "plain honest words here".split(), "spam!! BUY $$$ ***".split(), "rotten".split()
    rows = []
    for k in range(n):
        g = k % 3
        words = [rng.choice(good) for _ in range(20)] + [rng.choice((bad, mean, good)[g]) for _ in range(6)]
        rows.append((k, " ".join(words), g))
    df = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    return df, df.select("doc_id", "grade")


def test_classifier_orders_grades(spark):
    df, ratings = rated(spark)
    part = F.col("doc_id") % 4 == 1
    model = quality.fit(df, ratings.where(~part), F.col("grade"), 2)
    assert model.thresholds[0] < model.thresholds[1]
    found = quality.score(df, model, 2).join(ratings, "doc_id").where(part).collect()
    by = {g: np.mean([r.expected_grade for r in found if r.grade == g]) for g in range(3)}
    assert by[0] < by[1] < by[2] and all(r.kept == (r.grade == 2) for r in found)
    odd = quality.score(docs(spark, [None, "", "word " * 50_000, "word", "word"], [0, 1, 2, 3, 3]), model, 2).collect()
    assert len(odd) == 5 and all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in odd)
    assert quality.score(docs(spark, []), model, 2).count() == 0
    assert quality.select(df, model, 2).count() == quality.score(df, model, 2).where("kept").count()
    again = quality.fit(df, ratings.where(~part), F.col("grade"), 2)
    assert np.array_equal(again.weights, model.weights)


def test_probabilities_against_the_formula(spark):
    df, ratings = rated(spark, 90)
    model = quality.fit(df, ratings, F.col("grade"), 2)
    cache = quality._Words()
    for r in quality.score(df, model, 1).join(df, "doc_id").collect():
        f = sum(float(model.weights[k]) for k in quality.features(r.text, cache))
        p = [1 / (1 + math.exp(t - f)) for t in model.thresholds]
        assert math.isclose(r.tail, p[0], abs_tol=1e-9) and math.isclose(r.expected_grade, sum(p), abs_tol=1e-9)


def test_classifier_query(spark, tmp_path):
    df, ratings = rated(spark)
    odd = spark.createDataFrame([(None, "plain honest words here"), (900, None), (901, "")], "doc_id long, text string")
    df.drop("grade").union(odd).withColumn("weights", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    ratings.select("doc_id", (F.col("grade") > 0).cast("int").alias("quality"), (F.col("grade") == 1).cast("int").alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    found = queries.op4_quality(spark, str(tmp_path)).collect()
    wanted = {r.doc_id: r.grade == 2 for r in ratings.collect()}
    assert len(found) == 303 and all(r.kept == wanted[r.doc_id] for r in found if r.doc_id in wanted)


def test_fitting_reaches_the_maximum():
    """No step away from the fitted weights and thresholds makes the ratings likelier."""
    rng = np.random.default_rng(4)
    rows = [np.unique(rng.integers(0, 6, 3)) for _ in range(200)]
    grades = np.array([min(2, int((r < 2).sum() + rng.integers(0, 2))) for r in rows])
    model = quality.fit_ordinal(rows, grades, 2, ridge=1e-4, screen=0.0)

    def loss(weights, theta):
        total = 0.0
        for r, g in zip(rows, grades, strict=True):
            above = [1.0, *(1 / (1 + math.exp(t - weights[r].sum())) for t in theta), 0.0]
            total -= math.log(above[g] - above[g + 1]) / len(rows)
        return total + 1e-4 / 2 * float(weights @ weights)

    best = loss(model.weights.astype(np.float64), model.thresholds)
    for k in range(40):
        step = np.zeros_like(model.weights, dtype=np.float64)
        step[:6] = rng.normal(size=6) * 0.05
        assert loss(model.weights + step, model.thresholds + rng.normal(size=2) * 0.05) > best - 1e-5


def test_classifier_without_ratings(spark):
    df, ratings = rated(spark, 6)
    model = quality.fit(df, ratings.where("false"), F.col("grade"), 2)
    assert quality.score(df, model, 2).count() == 6 and not model.weights.any()
    nulls = ratings.select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("int").alias("grade"))
    assert not quality.fit(df, nulls, F.col("grade"), 2).weights.any()
    assert quality.fit(df, ratings, F.col("grade"), 2, max_docs=2) is not None


# ---- neighbours


def brute_nearest(rows, k, query):
    own = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            own[i] = min(own.get(i, v), v)
    out = []
    for q in filter(query, own):
        score = lambda v: sum(a * b for a, b in zip(own[q], v, strict=True))
        near = sorted((-math.inf if (s := score(v)) != s else -s if s < math.inf else -1e309, s == s, i, s) for i, v in own.items() if i != q and len(v) == len(own[q]))
        near.sort(key=lambda x: (x[1], x[0], x[2]))
        out += [(q, r, i, s) for r, (_, _, i, s) in enumerate(near[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2048, 8192), (3, 7)])
def test_neighbours_against_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", blocks[1])
    rng = np.random.default_rng(2)
    f32 = lambda v: [float(np.float32(x)) for x in v]
    rows = [(k, f32(rng.normal(size=5) * 10.0 ** rng.integers(-3, 3))) for k in range(60)]
    hot = f32(rng.normal(size=5))
    rows += [(100 + k, hot) for k in range(40)] + [(3, rows[3][1])] * 2 + [(4, hot)]
    rows += [(200, None), (201, [0.0] * 5), (202, [1.0, None, 1.0, 1.0, 1.0]), (203, [math.nan] * 5), (204, [math.inf, 1.0, 1.0, 1.0, 1.0]), (None, hot), (205, [1.0, 2.0]), (206, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, i int, copy string")
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, 7).collect()
    assert sorted(tuple(r) for r in found) == brute_nearest(rows, 7, lambda i: i % 20 == 0)
    assert neighbours.nearest(df.where("vec_id = 200"), F.col("vec_id") % 20 == 0).count() == 0
    assert neighbours.nearest(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0
    few = neighbours.nearest(df.where("vec_id in (20, 21)"), F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(20, 1, 21)]


@pytest.mark.parametrize("blocks", [(2048, 8192), (3, 7)])
def test_neighbours_of_any_finite_size(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", blocks[1])
    rng = np.random.default_rng(5)
    rows = [(20, [1e200, 1.0]), (21, [1e200, 2.0]), (22, [1.0, 1.0]), (23, [1e-320, 0.0]), (24, [1e308, -1e308]), (40, [1e308, 1e308]), (41, [5e-324, 5e-324]), (60, [1e-320, 1e-310])]
    rows += [(100 + k, (rng.normal(size=2) * 10.0 ** rng.integers(-320, 300)).tolist()) for k in range(60)]
    rows = [(i, v) for i, v in rows if any(v)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, 6).collect()
    assert [repr(tuple(r)) for r in sorted(found, key=lambda r: r[:2])] == [repr(x) for x in sorted(brute_nearest(rows, 6, lambda i: i % 20 == 0), key=lambda x: x[:2])]


# ---- near-duplicates


def brute_near(texts, ids, share=75):
    """Rows of one id are one document, linked by any of its sets."""
    sets = []
    for t in texts:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").encode().split()
        sets.append({tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    up = {i: i for i in ids}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(range(len(ids)), 2):
        both, union = len(sets[a] & sets[b]), len(sets[a] | sets[b])
        if both and 100 * both >= share * union:
            x, y = sorted((find(ids[a]), find(ids[b])))
            up[y] = x
    return sorted((i, len(s), find(i), find(i) == i) for i, s in zip(ids, sets, strict=True))


def corpus(seed=4):
    rng = random.Random(seed)
    vocab = [f"w{k}é" for k in range(400)]
    word = lambda n: [rng.choice(vocab) for _ in range(n)]
    texts = [" ".join(word(60)) for _ in range(30)]
    base, passage = word(90), word(70)
    for _ in range(40):  # near copies of one text, of which some are too far from each other
        copy = list(base)
        for at in rng.sample(range(len(copy)), rng.choice((1, 2, 2, 3))):
            copy[at] = rng.choice(vocab)
        texts.append(" ".join(copy))
    texts += [" ".join(word(rng.randint(20, 60)) + passage) for _ in range(40)]  # a passage that many share
    texts += [" ".join(base)] * 25 + ["A b C", "a B c", "a b", "", None, " \t\n", "One two three four five", "one two three four FIVE six", " ".join(word(6000))]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [1024, 8])
def test_near_duplicates_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "_BLOCK", block)
    texts = corpus()
    ids = list(range(0, 3 * len(texts), 3))
    found = sorted(tuple(r) for r in near_dup.near_duplicates(docs(spark, texts, ids)).collect())
    assert found == brute_near(texts, ids)


def test_repeated_ids_are_one_document(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "_BLOCK", 8)
    rng = random.Random(6)
    texts = corpus(6)
    ids = [rng.randint(0, 120) for _ in texts]
    found = sorted(tuple(r) for r in near_dup.near_duplicates(docs(spark, texts, ids)).collect())
    assert found == brute_near(texts, ids)
    one, two = "a b c d e f g", "t u v w x y z"
    found = near_dup.near_duplicates(docs(spark, [one, one, two, two, two], [3, 7, 7, 9, 9])).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(3, 3, True), (7, 3, False), (9, 3, False)} and len(found) == 5
    found = near_dup.near_duplicates(docs(spark, [one, one, ""], [3, 7, 7])).collect()
    assert sorted(map(tuple, found)) == [(3, 3, 3, True), (7, 0, 3, False), (7, 3, 3, False)]


def test_one_row_of_each_group_of_texts(spark):
    one, two, three = "a b c d e f g", "t u v w x y z", "lone words here"
    rows = [(3, one), (7, one), (7, two), (9, two), (5, three), (5, three), (5, three), (None, one), (4, ""), (4, ""), (6, None), (None, None)]
    table = spark.createDataFrame([(i, t, 8, "row") for i, t in rows], "doc_id long, text string, node int, tk string")
    left = near_dup.distinct_documents(table)
    assert left.columns == table.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter([(3, one), (7, two), (5, three), (None, one), (4, ""), (6, None), (None, None)])
    assert near_dup.distinct_documents(table.where("false")).count() == 0
    texts = corpus(2)
    ids = list(range(len(texts)))
    assert sorted(r.doc_id for r in near_dup.distinct_documents(docs(spark, texts, ids)).collect()) == [i for i, _, _, kept in brute_near(texts, ids) if kept]


def test_keys_with_many_rows_are_dealt(spark, monkeypatch):
    for name, value in (("HOT", 25), ("BROADCAST_ROWS", -1)):
        monkeypatch.setattr(near_dup, name, value)
    monkeypatch.setattr(common, "BROADCAST_ROWS", -1)
    texts = corpus(7)
    rows = near_dup.near_duplicates(docs(spark, texts, list(range(len(texts))))).collect()
    assert sorted(tuple(r) for r in rows) == brute_near(texts, list(range(len(texts))))


def test_small_sets_never_miss_each_other():
    rng, cache = random.Random(1), near_dup._Hashes()
    for _ in range(300):
        words = [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(5, 20))]
        one, two = (near_dup.shingle_set(" ".join(w).encode(), cache) for w in (words, words[rng.randint(0, 1) : rng.randint(len(words) - 2, len(words))]))
        both = len(np.intersect1d(one, two))
        if 4 * both >= 3 * (len(one) + len(two) - both):
            assert np.intersect1d(near_dup.first_keys(one, 75), near_dup.first_keys(two, 75)).size


@pytest.mark.parametrize("two", [False, True])
def test_blocks_against_all_pairs(two):
    rng = np.random.default_rng(3)
    hot = rng.integers(0, 2**32, 40)
    sets = [np.unique(np.concatenate([rng.choice(hot, rng.integers(10, 40), replace=False), rng.integers(0, 2**32, rng.integers(0, 15))])).astype("<u4") for _ in range(80)]
    nodes = [near_dup._Node(k % 2 if two else 0, 0, k, k % 7, [], x.tobytes()) for k, x in enumerate(sets)]
    wanted = set()
    for a, b in itertools.combinations(nodes, 2):
        both = len(np.intersect1d(sets[a.node], sets[b.node]))
        if a.comp != b.comp and (not two or a.side != b.side) and 4 * both >= 3 * (len(sets[a.node]) + len(sets[b.node]) - both):
            wanted.add((a.node, b.node))
    assert wanted and {tuple(sorted(p)) for p in near_dup.likely(nodes, two, 75)} == wanted


def test_near_duplicates_at_the_edges(spark):
    found = near_dup.near_duplicates(docs(spark, ["a b c d e f"] * 3 + [None, "x"], [5, None, 5, None, 9])).collect()
    assert Counter(map(tuple, found)) == Counter([(5, 2, 5, True), (5, 2, 5, True), (None, 2, None, True), (None, 0, None, True), (9, 1, 9, True)])
    assert near_dup.near_duplicates(docs(spark, [])).count() == 0
    assert near_dup.near_duplicates(docs(spark, [""])).first().kept


def test_signatures_estimate_jaccard():
    rng = np.random.default_rng(0)
    a, b = near_dup._permutations()
    x = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    one, two = np.unique(x[:2000]), np.unique(x[1000:])
    same = near_dup.signature(one, a, b) == near_dup.signature(two, a, b)
    assert abs(same.mean() - 1 / 3) < 0.1 and len(same) == 2 * near_dup.PERMUTATIONS


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 1000))
def test_components(spark_session_for_graph, seed):
    spark = spark_session_for_graph
    rng = random.Random(seed)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(40)] + [(k, k + 1) for k in range(100, 140)] + [(200 + k, 250) for k in range(30)]
    up = {}
    find = lambda x: x if up.setdefault(x, x) == x else find(up[x])
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    linked = {n for a, b in edges if a != b for n in (a, b)}
    found = {r.id: r.comp for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {n: find(n) for n in linked}


@pytest.fixture(scope="module")
def spark_session_for_graph(spark):
    return spark


# ---- fingerprints


def brute_names(text):
    words = [w for w in "".join(c if ord(c) > 127 or c.isdigit() or "a" <= c <= "z" else " " for c in text.lower()).split(" ") if w] or [text]
    h64 = lambda x, seed=42: xxhash.xxh64_intdigest(x, seed)
    num = lambda x: (x & (2**64 - 1)).to_bytes(8, "little")
    out = []
    counts = Counter(words)
    for k in range(fingerprint.SAMPLES):
        best = None
        for word, n in counts.items():
            term = h64(word.encode())
            h = h64(k.to_bytes(4, "little"), h64(num(term)))
            g = h64(num(h))
            unit = lambda x, shift, bits: ((x >> shift & (1 << bits) - 1) + 0.5) / (1 << bits)
            r = -math.log(unit(h, 0, 21) * unit(h, 21, 21))
            beta = unit(h, 42, 22)
            t = math.floor(math.log(n) / r + beta)
            log_a = math.log(-math.log(unit(g, 0, 32) * unit(g, 32, 32))) - r * (t - beta + 1)
            name = h64(num(t), h64(num(h))) & 0xFFFFFFFF
            key = int(max(0.0, (log_a + 64) * (1 << 24))) << 32 | name
            best = key if best is None else min(best, key)
        out.append(best & 0xFFFFFFFF)
    return out


def test_fingerprints_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("alpha beta gamma delta eps zeta é日 X9".split()) for _ in range(rng.randint(0, 40))) for _ in range(60)] + [None, "", "...", "one", "🙂🙂🙂", "same text here", "same text here"]
    ids = rng.sample(range(-1000, 10**12), len(texts) - 2) + [None, 7]
    docs(spark, texts, ids).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in queries.op10_fingerprint(spark, str(tmp_path)).collect()}
    order = sorted(zip(ids, (t or "" for t in texts), strict=True), key=lambda x: (x[0] is not None, x[0] or 0))
    for k, (i, text) in enumerate(order):
        follow = order[(k + 1) % len(order)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        a, b, c = brute_names(text), brute_names(edited), brute_names(follow)
        r = found[i]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == "".join(f"{x:08X}" for x in a) and r.edited_fingerprint == "".join(f"{x:08X}" for x in b)
        assert math.isclose(r.near_edited, np.mean(np.array(a) == b)) and math.isclose(r.near_next, np.mean(np.array(a) == c))


def test_groups_are_even_whatever_the_ids(spark):
    ids = [*range(2000), 2**60, -(2**63), 2**63 - 1, *range(10**15, 10**15 + 500), *range(0, 10**9, 10**6)]
    ids = sorted(set(ids))
    placed, parts = fingerprint.neighbours(spark.createDataFrame([(i, str(i)) for i in ids] + [(None, "")], "doc_id long, text string"))
    rows = placed.collect()
    own = sorted((r.doc_id, r.g) for r in rows if not r.after and r.doc_id is not None)
    assert [i for i, _ in own] == ids and [g for _, g in own] == sorted(g for _, g in own)
    assert max(Counter(g for _, g in own).values()) <= len(ids) // parts
    firsts = {g: min(i for i, x in own if x == g) for g in {g for _, g in own}}
    for r in rows:
        if r.after and r.doc_id is not None:
            assert firsts[r.g + 1] == r.doc_id


def test_collision_rate_is_generalised_jaccard(spark):
    one, two = {"a": 4, "b": 1, "c": 2, "d": 1}, {"a": 2, "b": 3, "c": 2, "e": 2}
    wanted = sum(min(one.get(w, 0), two.get(w, 0)) for w in "abcde") / sum(max(one.get(w, 0), two.get(w, 0)) for w in "abcde")
    rows = [(k, w) for k, bag in enumerate((one, two)) for w, n in bag.items() for _ in range(n)]
    terms = spark.createDataFrame(rows, "k int, w string").select("k", F.xxhash64("w").alias("term"))
    a, b = (r.names for r in fingerprint.signatures(terms, ["k"], 600).orderBy("k").collect())
    assert abs(np.mean(np.array(a) == np.array(b)) - wanted) < 0.08


def test_fingerprints_of_few_rows(spark):
    assert fingerprint.fingerprints(docs(spark, [])).count() == 0
    alone = fingerprint.fingerprints(docs(spark, ["a b c d"])).first()
    assert alone.near_next == 1.0 and alone.edited == "a b a b"
    twins = fingerprint.fingerprints(docs(spark, ["a b", "a b", "c"], [1, 1, 1])).collect()
    assert len(twins) == 3
    plan = fingerprint.fingerprints(docs(spark, ["a"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan.split("LogicalRDD")[0]


# ---- the pipeline


def test_pipeline_stages(spark, tmp_path):
    texts = corpus(9) + ["###!! $$$ ***"] * 5
    ids = list(range(len(texts)))
    tables = spark.createDataFrame([(i, t, "en" if i % 2 else "xx", "s", len(t or "")) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, lang string, source string, n_chars long")
    tables.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 0 if (texts[i] or "").startswith("###") else 1, 0) for i in ids], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "packing"]
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = left
        left = materialise(stage(spark, left, str(tmp_path)), name)
        assert left.columns == tables.columns and left.join(before, "doc_id", "left_anti").count() == 0
        counts.append(left.count())
    kept = [(r.doc_id, r.text) for r in before.orderBy("doc_id").collect()]
    wanted = [i for i, _, _, own in brute_near([t for _, t in kept], [i for i, _ in kept]) if own]
    assert sorted(r.doc_id for r in left.collect()) == wanted
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(wanted)
    assert packed.groupBy("doc_id").agg((F.sum("length") - F.max("doc_tokens")).alias("d")).where("d <> 0").count() == 0


# ---- SQL

@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    data = "/root/testdata/sf0.001"
    db = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        try:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
        except duckdb.IOException:
            pytest.skip("needs the driver's tables")
    found = queries.QUERIES[name](spark, data).toPandas()
    wanted = db.execute(queries.ORACLES[name]).fetchdf()
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    assert sorted(map(tuple, found[columns].astype(str).values)) == sorted(map(tuple, wanted[columns].astype(str).values))
