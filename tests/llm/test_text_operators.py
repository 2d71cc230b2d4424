"""Chat formatting, licence scans, SentencePiece, packing and language identification on small tables."""

import hashlib
import re
import time
import zlib

import numpy as np
import pytest
import public_tokenizers
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from statloom.llm import chat, language_id, license_rules, licenses, packing, queries, sentence_pieces

BPE, SPM = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "a", "  two  spaces \n\n end ", "日本語 🙂 é", "it's 12,345 <|endoftext|>!!", "x" * 5000, "tab\tand\x1cunit\x85sep z", None, "\x00a b", "word " * 3000]


def docs(spark, texts, extra=False):
    rows = [(k, t, "clash", 1) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string, n int")
    return df if extra else df.select("doc_id", "text")


# ---- chat


@given(st.text(alphabet="<|\\im_startendsep>a\n"))
def test_escapes_are_reversible_and_hide_markers(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|im_sep|>"]), st.text(max_size=30)), max_size=5))
def test_rendered_turns_parse_back(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def brute_conversations(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    found = {}
    for conv, turns in out.items():
        own = "".join(t for r, t in turns if r == "assistant")
        size = sum(32 + len(chat.escape(r)) + len(chat.escape(t)) for r, t in turns)
        found[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(own), hashlib.sha256(own.encode()).hexdigest(), size)
    return found


def test_chat_against_brute_force(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "<|im_end|><|im_start|>assistant ok"), (1, 1, "assistant", " \n x "), (2, 0, None, None), (2, None, "assistant", "é日🙂 "), (3, 0, "assistant", ""), (None, 1, "assistant", "lost"), (4, 0, "user", "q")]
    rows += [(5, k, "assistant" if k % 2 else "user", f"turn {k} " * 50) for k in range(900)] + [(6, 0, "assistant", "same")] * 4
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    pieces = chat.format_conversations(df, BPE)
    found = {r.conv_id: tuple(r)[1:] for r in chat.digests(pieces).collect()}
    assert found == brute_conversations(rows)
    first = pieces.where("conv_id = 1").first()
    assert len(first.ids) == len(first.loss) and any(first.loss) and not all(first.loss)
    assert pieces.where("conv_id = 5").count() > 1  # a long conversation is more than one piece
    assert chat.digests(chat.format_conversations(df.where("false"), BPE)).count() == 0


def test_offsets_are_those_of_the_library():
    encoder = chat.Encoder(BPE)
    texts = [chat.render([("user", t or ""), ("assistant", f"é {t} 🙂")])[0] for t in ODD] + [""]
    for (ids, offsets), e, text in zip(encoder.encode(texts), encoder.tokenizer.encode_batch(texts, add_special_tokens=False), texts, strict=True):
        assert ids.tolist() == e.ids
        library = np.array(e.offsets).reshape(-1, 2)
        assert np.array_equal(offsets[:, 1], library[:, 1])  # where the library leaves out spaces before a word, ends still agree
        assert (offsets[:, 0] <= library[:, 0]).all() and all(text[a:b].isspace() or a == b for a, b in zip(offsets[:, 0], library[:, 0]))


def test_pieces_have_the_ids_of_the_whole(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE", 500)
    rows = [(5, k, "assistant" if k % 2 else "user", f" turn {k} é🙂\n " * 9 + "<|im_end|>") for k in range(200)]
    pieces = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), BPE).orderBy("part", "piece").collect()
    text, spans = chat.render([r[2:] for r in rows])
    ids, offsets = next(chat.Encoder(BPE).encode([text]))
    assert len(pieces) > 20 and "".join(r.text for r in pieces) == text
    assert [i for r in pieces for i in r.ids] == ids.tolist() and [x for r in pieces for x in r.loss] == chat.mask(offsets, spans).tolist()


def test_mask_is_the_overlap_of_spans():
    offsets = np.array([(0, 2), (2, 5), (5, 5), (5, 8), (8, 9)])
    assert chat.mask(offsets, [(2, 8)]).tolist() == [False, True, False, True, False]
    assert chat.covered(offsets, np.array([False, True, False, True, False])) == [(2, 8)] and chat.covered(offsets, np.zeros(5, dtype=bool)) == []


# ---- licences


def test_rules_have_keywords_that_their_matches_hold():
    found = license_rules.rules()
    assert len(found) > 300 and len({(r.label, r.pattern.pattern) for r in found}) == len(found)
    for r in found:
        assert len(r.keyword) >= 3, r
        sample = r.pattern.pattern.decode().replace("(?<= )", "").replace("(?= )", "")
        sample = re.sub(r"\(\?:([^()|]*)(?:\|[^()]*)?\)\??", r"\1", sample)
        sample = re.sub(r"\[(.)[^\]]*\]", r"\1", sample).replace("?", "")
        line = licenses.plain(sample.encode())[0]
        assert r.keyword in line and r.pattern.search(line), r


def test_containment_and_priority():
    rules = license_rules.rules()
    labels = lambda t: [d[0] for d in licenses.detect(licenses.plain(t.encode())[0], rules)]
    assert labels("Apache License, Version 2.0") == ["apache-2.0"]
    assert labels("GNU Lesser General Public License v2.1 or the MIT License") == ["lgpl-2.1", "mit"]
    assert labels("SPDX-License-Identifier: GPL-3.0-or-later") == ["gpl-3.0-or-later"]
    assert labels("permit licenses of the omit license") == []
    assert labels("") == []


def brute_detections(text):
    """Every rule on every word, all against all."""
    line = licenses.plain(text.encode())[0]
    found = []
    for r in license_rules.rules():
        for m in r.pattern.finditer(line):
            words = m.group().decode().split()
            found.append((-r.priority, -len(words), len(line[: m.start()].split()), r.label, r.confidence))
    kept = []
    for _, minus, first, label, confidence in sorted(found):
        if not any(a <= first and first - minus <= a + n for _, a, n, _ in kept):
            kept.append((label, first, -minus, confidence))
    return sorted(kept, key=lambda d: d[1:])


PHRASES = "mit license|the mit license|apache license version 2 0|apache license|licensed under the apache license version 2 0|gnu lesser general public license v2 1|gnu general public license|spdx license identifier|gpl 3 0 or later|bsd 3 clause|word|9|, ".split("|")


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(PHRASES), max_size=25))
def test_detections_against_brute_force(phrases):
    text = " ".join(phrases)
    assert licenses.detect(licenses.plain(text.encode())[0], license_rules.rules()) == brute_detections(text)


def test_long_texts_of_licences_take_linear_time():
    rules, took = license_rules.rules(), []
    for n in (4000, 16_000):
        line = licenses.plain(b"the mit license and the apache license version 2 0 " * n)[0]
        began = time.process_time()
        licenses.detect(line, rules)
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0]


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(k, label) for k in range(len(words)) for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")) if words[k : k + len(phrase.split())] == phrase.split()]
    starts = [k for k, _ in at]
    return len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def test_licence_query_against_brute_force(spark, tmp_path):
    texts = ODD + ["The MIT License. mit-license MIT License", "Apache License apache license", "GNU General Public License general public licence", "x MIT", "License\nMIT License", "ÉMIT license mit licenseé mit license9"]
    docs(spark, texts, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op2_licenses(spark, str(tmp_path)).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    assert licenses.scan(docs(spark, [])).count() == 0


# ---- SentencePiece


def test_sentence_pieces_are_those_of_the_library(spark):
    found = sentence_pieces.encode(docs(spark, ODD, extra=True), SPM).orderBy("doc_id").collect()
    assert all(r.parity for r in found) and [r.decoded for r in found] == [t or "" for t in ODD]
    assert sentence_pieces.encode(docs(spark, []), SPM).count() == 0
    assert sentence_pieces.encode(docs(spark, ["a"]), SPM, verify=False).first().parity is None


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \t\n▁aeT.é日🙂\0<s>"), st.characters(exclude_categories=["Cs"])), max_size=40), max_size=5))
def test_any_text_round_trips(texts):
    import sentencepiece

    codec = _codec()
    ids = list(codec.encode(texts))
    library = sentencepiece.SentencePieceProcessor(model_file=SPM)
    assert [np.frombuffer(i, dtype="<u4").tolist() for i in ids] == library.encode(texts)
    assert [codec.decode(i) for i in ids] == [library.decode(np.frombuffer(i, dtype="<u4").tolist()) for i in ids]


_held = {}


def _codec():
    return _held.setdefault("codec", sentence_pieces.Codec(SPM)) if "codec" not in _held else _held["codec"]


def toy_model(path, pieces, kind):
    """A small model with byte fallback, put together field by field."""

    def field(number, data):
        if isinstance(data, int):
            return bytes([number << 3 & 127 | (128 if number > 15 else 0)] + ([number >> 4] if number > 15 else []) + [data])
        head = number << 3 | 2
        return (bytes([head]) if head < 128 else bytes([head & 127 | 128, head >> 7])) + bytes([len(data)]) + data

    def piece(text, score, kind):
        return field(1, field(1, text.encode()) + bytes([2 << 3 | 5]) + np.array(score, dtype="<f4").tobytes() + field(3, kind))

    every = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] + pieces
    path.write_bytes(b"".join(piece(*p) for p in every) + field(2, field(3, kind) + field(35, 1)) + field(3, field(1, b"identity") + field(4, 0)))
    return str(path)


def same_as_the_library(path, texts):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert [np.frombuffer(i, dtype="<u4").tolist() for i in sentence_pieces.Codec(path).encode(texts)] == library.encode(texts)


def test_unigram_models_keep_their_scores(tmp_path):
    pieces = [("▁", -2.0, 1), ("▁ab", -1.0, 1), ("a", -3.0, 1), ("b", -3.1, 1), ("ab", -4.0, 1), ("abc", -4.5, 1), ("c", -3.3, 1)]
    same_as_the_library(toy_model(tmp_path / "unigram.model", pieces, 1), ["abc ab", "cab abcab", "", "é ab", "a  b"])


def test_pieces_defined_by_the_user_are_never_merged(tmp_path):
    pieces = [("<sep>", 0.0, 4), ("ab", 0.0, 4), ("▁a", -1.0, 1), ("bc", -2.0, 1), ("▁abc", -3.0, 1), ("ca", -4.0, 1), ("▁", -5.0, 1), ("a", -6.0, 1), ("b", -7.0, 1), ("c", -8.0, 1)]
    same_as_the_library(toy_model(tmp_path / "bpe.model", pieces, 2), ["abc a<sep>bc abca", "<sep>", "ca<sep> <sep>ab", "<se p> é", "bca bc  abab", ""])


def test_a_small_cache_of_words_gives_the_same_ids():
    texts = [t for t in ODD if t] + [f"word{k} other{k * 7}" for k in range(2000)] * 2
    assert list(sentence_pieces.Codec(SPM, 50_000).encode(texts)) == list(_codec().encode(texts))


def test_sentence_piece_query_round_trips(spark, tmp_path):
    docs(spark, ODD * 2, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    for r in queries.op7_sentencepiece(spark, str(tmp_path)).collect():
        assert r.parity and r.decoded_sha256 == hashlib.sha256(((ODD * 2)[r.doc_id] or "").encode()).hexdigest()


# ---- packing


def test_ids_are_those_of_the_tokenizer():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    plain.encode_special_tokens = True
    texts = [t for t in ODD if t is not None]
    wanted = [np.array(e.ids, dtype="<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert list(packing.ChunkEncoder(BPE).encode(texts)) == wanted


@given(st.lists(st.integers(1, 70), max_size=40), st.integers(2, 16))
def test_assignment_is_exact_and_dense(lengths, size):
    pieces = list(packing.assign(lengths, size, 1.0, 0.1))
    for d, n in enumerate(lengths):
        own = sorted((s, k) for doc, s, k, _, _ in pieces if doc == d)
        assert [s for s, _ in own] == list(np.cumsum([0] + [k for _, k in own])[:-1]) and sum(k for _, k in own) == n
    fill = {}
    for _, _, k, sequence, offset in pieces:
        fill.setdefault(sequence, []).append((offset, k))
    for at in fill.values():
        at.sort()
        assert [o for o, _ in at] == list(np.cumsum([0] + [k for _, k in at])[:-1])
    assert len(fill) == -(-sum(lengths) // size) or not lengths
    assert sum(sum(k for _, k in at) < size for at in fill.values()) <= 1


def cheapest_with_room(lengths, size, linear, quadratic):
    """The rule of the method, looking at every sequence for every piece."""
    rests = sorted(((-(n % size), d) for d, n in enumerate(lengths) if n % size))
    total = -sum(r for r, _ in rests)
    rooms = [size] * (total // size) + [total % size] * (total % size > 0)
    left, cost, out = list(rooms), [0.0] * len(rooms), []
    first = sum(n // size for n in lengths)
    for minus, d in rests:
        rest, start = -minus, lengths[d] // size * size
        while rest:
            fit = [s for s in range(len(left)) if left[s] >= rest] or [s for s in range(len(left)) if left[s]]
            s = min(fit, key=lambda s: (cost[s], s))
            part = min(rest, left[s])
            out.append((d, start, part, first + s, rooms[s] - left[s]))
            cost[s] += linear * part + quadratic * part * part
            left[s] -= part
            rest, start = rest - part, start + part
    return out


@given(st.lists(st.integers(1, 70), max_size=60), st.integers(2, 40))
def test_assignment_follows_the_cost_rule(lengths, size):
    found = [p for p in packing.assign(lengths, size, 1.0, 0.25) if p[2] < size or lengths[p[0]] < size or p[1] >= lengths[p[0]] // size * size]
    assert found == cheapest_with_room(lengths, size, 1.0, 0.25)


def test_assignment_of_usual_lengths_follows_the_cost_rule():
    lengths = (np.random.default_rng(2).lognormal(5, 1, 1200).astype(int) + 1).tolist()
    found = [p for p in packing.assign(lengths, 1024, 1.0, 1 / 512) if p[2] < 1024]
    assert found == [p for p in cheapest_with_room(lengths, 1024, 1.0, 1 / 512) if p[2] < 1024]


def test_a_small_cache_gives_the_same_ids():
    texts = [t for t in ODD if t] * 2 + [f"word{k} other{k * 7}" for k in range(3000)]
    assert list(packing.ChunkEncoder(BPE, 100_000).encode(texts)) == list(packing.ChunkEncoder(BPE).encode(texts))


def test_packed_query(spark, tmp_path):
    docs(spark, ODD * 3, extra=True).withColumn("doc_id", F.expr("nullif(doc_id, 3)")).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op6_packing(spark, str(tmp_path)).collect()
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(BPE)
    plain.encode_special_tokens = True
    for r in rows:
        ids = np.array(plain.encode((ODD * 3)[3 if r.doc_id is None else r.doc_id] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    sums = {}
    for r in rows:
        sums[r.sequence_id] = sums.get(r.sequence_id, 0) + r.length
    assert max(sums.values()) <= 1024
    assert packing.pack(docs(spark, []), BPE).count() == 0


# ---- language identification

WORDS = {"en": "the cat sat on the warm mat and then it slept", "de": "die katze schlief dann auf der warmen matte und", "fr": "le chat dormait alors sur le tapis chaud et"}


def samples(spark, n=60):
    rows = [(k, " ".join(np.random.default_rng(k).choice(WORDS[lang].split(), 12)), lang) for k in range(n) for lang in [sorted(WORDS)[k % 3]]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_languages(spark):
    known = samples(spark)
    model = language_id.fit(known.where(~language_id.held_out()))
    rest = language_id.predict(known, model).join(known, "doc_id").where(language_id.held_out()).collect()
    assert rest and all(r.lang_pred == r.lang for r in rest)
    found = language_id.predict(docs(spark, [None, "", "123 ½ _", "die schlafende katze", "THE CATS", "日本", *["sat " * 60_000]], extra=True), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in found][:5] == ["und", "und", "und", "de", "en"] and found[6].lang_pred == "en"
    assert all(0 <= r.score <= 1 for r in found) and found[0].score == 0
    assert language_id.predict(docs(spark, []), model).count() == 0
    assert [r.doc_id for r in language_id.select(docs(spark, ["die katze", None]), model, 0.3).collect()] == [0]


def test_backoff_against_brute_force(spark):
    known = samples(spark)
    scorer = language_id.Scorer(language_id.fit(known))
    langs, counts = sorted(WORDS), [{} for _ in range(5)]
    for r in known.collect():
        for w in r.text.split():
            for kind in range(5):
                for g in [w] if kind == 0 else language_id.grams(w, kind):
                    counts[kind].setdefault(g, [0, 0, 0])[langs.index(r.lang)] += 1

    def score(kind, gram):
        whole = np.array(list(counts[kind].values())).sum(axis=0)
        return np.log((np.array(counts[kind][gram]) + 0.5) / (whole + 0.5 * (len(counts[kind]) + 1)))

    def brute(word):
        if word in counts[0]:
            return score(0, word)
        for n in (4, 3, 2, 1):
            hits = [score(n, g) for g in language_id.grams(word, n) if g in counts[n]]
            if hits:
                return np.mean(hits, axis=0)
        return np.zeros(3)

    words = ["katze", "katzen", "chatte", "zzz", "a", "日本", "cat"]
    for word, own in zip(words, scorer.words(words), strict=True):
        assert np.allclose(own, brute(word), atol=1e-5)


def test_language_query(spark, tmp_path):
    extra = spark.createDataFrame([(1000, None, "en"), (1001, "123", None), (None, "the cat", None), (1002, "die katze", None)], "doc_id long, text string, lang string")
    samples(spark).union(extra).withColumn("score", F.lit("clash")).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op8_language_id(spark, str(tmp_path)).collect()
    assert len(found) == 64 and [f for f in ("doc_id", "held_out", "lang_pred", "score") if f in found[0]] == list(found[0].asDict())
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 4 == 2) and 0 <= r.score <= 1
    by = {r.doc_id: r.lang_pred for r in found}
    assert (by[1000], by[1001], by[1002], by[None]) == ("und", "und", "de", "en")


def test_a_full_cache_changes_nothing(spark, monkeypatch):
    model = language_id.fit(samples(spark))
    texts = ["die katze " * 40, "le chat dormait " * 30, None, "unseen words of many kinds " * 5, "the mat"]
    wanted = language_id.Scorer(model).documents(texts)
    monkeypatch.setattr(language_id, "_CACHE", 12)
    scorer = language_id.Scorer(model)
    found = [scorer.documents([t])[0] for t in texts]
    assert [x[0] for x in found] == [x[0] for x in wanted] and np.allclose([x[1] for x in found], [x[1] for x in wanted])


def test_nothing_learned(spark):
    model = language_id.fit(samples(spark).withColumn("lang", F.lit(None).cast("string")))
    assert [tuple(r) for r in language_id.predict(docs(spark, ["the"]), model).collect()] == [(0, "und", 0.0)]
    both = language_id.fit(samples(spark), max_docs=10)
    assert both.langs
