"""Operators on single texts against plain Python, libraries and held-out rows."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from llm_cases import SCHEMA, SF_DIR, awkward_rows, blank_words, sample_rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer
import zstandard

from brookledger.llm import language_id, quality_zstd
from brookledger.llm.license_rules import BASE_PHRASES, build_rules
from brookledger.llm.license_scan import detect, license_scan, suppress
from brookledger.llm.mixing import MAX_REPEATS, mixed, mixture
from brookledger.llm.sentencepiece_dropout import Pieces, default_path, encoded
from brookledger.llm.token_files import decode_ranks, encode_ranks, token_digests, token_folder, write_token_files

import public_tokenizers


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# ---- licences -------------------------------------------------------------------
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _base_answer(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    found = [(k, label) for phrase, label in BASE_PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    at = [k for k, _ in found]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({label for _, label in found}))


def test_license_base_phrases(spark, docs, awkward):
    for table in (docs, awkward):
        rows = table.select("doc_id", "text").collect()
        got = {r["doc_id"]: tuple(r)[1:6] for r in license_scan(table).collect()}
        assert got == {r["doc_id"]: _base_answer(r["text"]) for r in rows}


def test_license_labels_hold_the_base_labels(docs):
    for r in license_scan(docs).collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))
        assert 0 <= r["score"] <= 1 and r["labels"] == ",".join(sorted(r["labels"].split(",")))


def test_license_prefilter_loses_nothing():
    texts = [t.lower() for t in (r["text"] for r in sample_rows())] + ["licensed under the bsd-3-clause. all rights reserved", "spdx-license-identifier: gpl-2.0-or-later", "see https://creativecommons.org/licenses/by-sa/4.0"]
    for text in texts:
        every = suppress([(*m.span(), p, label) for p, label, pattern, _ in build_rules() for m in re.finditer(pattern, text)])
        assert detect(text)[0] == every


def test_license_rules_and_suppression():
    assert len(build_rules()) > 200
    assert suppress([(0, 9, 2, "b"), (0, 9, 1, "a"), (2, 5, 0, "c"), (9, 12, 9, "d")]) == [(0, 9, 1, "a"), (9, 12, 9, "d")]
    assert suppress([(0, 9, 1, "a"), (5, 12, 9, "d")]) == [(0, 9, 1, "a")]
    assert suppress([(0, 9, 3, "a"), (5, 12, 2, "b"), (11, 20, 1, "c")]) == [(0, 9, 3, "a"), (11, 20, 1, "c")]
    assert suppress([(0, 9, 1, "a"), (5, 12, 1, "d")]) == [(0, 9, 1, "a"), (5, 12, 1, "d")]
    assert license_scan_labels("licensed under the apache license, version 2.0") == {"apache-2.0"}
    assert license_scan_labels("licensed under gnu gpl-3.0") == {"gpl-3.0"}
    assert license_scan_labels("the lesser general public license version 2.1") == {"lgpl-2.1"}
    assert license_scan_labels("under the gnu lesser general public licence, version 2.1 or later") == {"lgpl-2.1"}


def _suppressed_plainly(found):
    """Every detection against every other one."""
    def order(d):
        return d[2], d[3]

    found = sorted(set(found))
    outer = [
        d for d in found
        if not any(o != d and o[0] <= d[0] and d[1] <= o[1] and (o[:2] != d[:2] or order(o) < order(d)) for o in found)]
    kept = []
    for d in sorted(outer, key=lambda d: d[2]):
        if not any(o[0] < d[1] and d[0] < o[1] and o[2] < d[2] for o in kept):
            kept.append(d)
    return sorted(kept)


def test_license_suppression_like_all_against_all():
    draw = random.Random(5)
    for _ in range(300):
        found = [(s, s + draw.randint(1, 12), draw.randint(0, 4), draw.choice("abc")) for s in (draw.randint(0, 40) for _ in range(draw.randint(0, 14)))]
        assert suppress(found) == _suppressed_plainly(found)


def license_scan_labels(text):
    return {label for *_, label in detect(text)[0]}


def test_license_scan_of_no_rows(empty):
    assert license_scan(empty).count() == 0


# ---- language ---------------------------------------------------------------------
def test_language_of_held_out_documents(docs):
    got = {r["doc_id"]: r for r in language_id.language_id(docs, language_id.learn(docs)).collect()}
    rows = docs.collect()
    assert all(got[r["doc_id"]]["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if got[r["doc_id"]]["held_out"]]
    assert np.mean([got[r["doc_id"]]["lang_pred"] == r["lang"] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_of_awkward_rows(docs, awkward, empty):
    model = language_id.learn(docs)
    got = {r["doc_id"]: r for r in language_id.language_id(awkward, model).collect()}
    assert all(got[k]["lang_pred"] == "und" and got[k]["score"] == 0 for k in (3, 4, 5, 9))
    kept = language_id.in_known_language(awkward, model)
    assert kept.columns == awkward.columns and not {3, 4, 5, 9} & {r["doc_id"] for r in kept.collect()}
    nothing = language_id.learn(empty)
    assert {r["lang_pred"] for r in language_id.language_id(awkward, nothing).collect()} == {"und"}
    assert language_id.language_id(empty, model).count() == 0


def test_language_model_keeps_every_context_of_its_sample(docs):
    model = language_id.learn(docs).build()
    grams = set()
    for r in docs.where("text is not null and lang is not null").collect():
        if zlib.crc32(str(r["doc_id"]).encode()) % 4 != 2:
            codes = language_id._grams(language_id.Texts(pa.array([r["text"]])), language_id.LOWER)
            grams.update((codes >> 8).tolist())
    assert (model.levels[3].context >= 0).sum() == len(grams)


def test_language_code_lengths_are_those_of_the_trees():
    """Bits of a text against a direct computation from the counts."""
    texts = {"aa": "abracadabra abra", "bb": "banana bandana"}
    grams = [(lang, g) for lang, t in texts.items() for g in language_id._grams(language_id.Texts(pa.array([t])), language_id.LOWER).tolist()]
    seen = sorted(set(grams))
    model = language_id.Model(["aa", "bb"], np.array([["aa", "bb"].index(x) for x, _ in seen]), np.array([g for _, g in seen]), np.array([grams.count(x) for x in seen]))
    text = "abra banana q"
    bits = model.build().bits(language_id.Texts(pa.array([text])))[0]

    def direct(lang):
        total, learned = 0.0, "\0\0\0" + texts[lang]
        every = "".join(texts.values())
        string = "\0\0\0" + text
        for at in range(3, len(string)):
            c, cost = string[at], 0.0
            for order in (3, 2, 1, 0):
                context = "".join(x if x in every else "\0" for x in string[at - order : at])
                follow = [learned[k] for k in range(3, len(learned)) if learned[k - order : k] == context]
                if not follow:
                    continue
                n, u = len(follow), len(set(follow))
                if c in follow:
                    cost -= np.log2(follow.count(c) / (n + u))
                    break
                cost -= np.log2(u / (n + u))
            else:
                cost += 8
            total += cost
        return total

    assert np.allclose(bits, [direct("aa"), direct("bb")], rtol=1e-5)


# ---- quality ------------------------------------------------------------------------
def test_quality_of_held_out_documents(spark):
    big = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    rows = quality_zstd.quality(docs, quality_zstd.learn(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.1
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_quality_scores_are_those_of_a_plain_recomputation(spark, docs):
    """Sample, halves, dictionaries, compressed sizes, curve and its shift, each worked out again from the rows."""
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality_zstd.learn(docs, labels)
    got = {r["doc_id"]: r["score"] for r in quality_zstd.quality(docs, model).collect()}
    mark = {r["doc_id"]: r["quality"] for r in sample_rows("labels") if r["quality"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1}
    learned = sorted((r["doc_id"], r["text"]) for r in sample_rows() if r["doc_id"] in mark and r["text"] is not None)
    assert max(list(mark.values()).count(q) for q in (0, 1)) < quality_zstd.PER_LABEL  # so all labelled rows are the sample
    half = {}
    for k, (i, text) in enumerate(learned):
        half.setdefault((mark[i], k % 2), []).append(text.encode())
    content = [quality_zstd._dictionary(half[q, 0], quality_zstd.DICTIONARY_BYTES) for q in (0, 1)]

    def features(raw):
        n = [
            len(zstandard.ZstdCompressor(level=quality_zstd.LEVEL, dict_data=zstandard.ZstdCompressionDict(c, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_dict_id=False).compress(raw))
            for c in content
        ]
        return [(n[0] - n[1]) / sum(n), min(n) / (len(raw) + 16), np.log1p(len(raw))]

    x = np.array([features(t) for q in (0, 1) for t in half[q, 1]])
    y = np.repeat([0.0, 1.0], [len(half[0, 1]), len(half[1, 1])])
    centre, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    shift = np.log(list(mark.values()).count(1) / list(mark.values()).count(0)) - np.log(y.sum() / (len(y) - y.sum()))
    weights = np.array(model.weights) - np.array([shift, 0, 0, 0])
    a = np.column_stack([np.ones(len(x)), (x - centre) / scale])
    slope = a.T @ (y - 1 / (1 + np.exp(-a @ weights))) - np.array([1e-6, 1e-2, 1e-2, 1e-2]) * weights
    assert np.abs(slope).max() < 1e-6  # the penalised likelihood has its maximum there
    for r in sample_rows():
        z = model.weights[0] + ((np.array(features((r["text"] or "").encode())) - centre) / scale) @ model.weights[1:]
        assert abs(got[r["doc_id"]] - 1 / (1 + np.exp(-z))) < 1e-9


def test_quality_of_awkward_rows(spark, docs, awkward, empty):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality_zstd.learn(docs, labels)
    assert quality_zstd.quality(awkward, model).count() == 16
    assert quality_zstd.quality(empty, model).count() == 0
    none = quality_zstd.learn(docs, labels.limit(0))
    assert none is None and {r["score"] for r in quality_zstd.quality(awkward, none).collect()} == {0.5}


# ---- SentencePiece ------------------------------------------------------------------
def _encoded(texts, dropout, seed=5):
    pieces = Pieces(default_path())
    ids, counts = pieces.encode(pa.array(texts), np.arange(len(texts)), seed, dropout, 4)
    ends = np.cumsum(counts)
    return pieces, [ids[e - n : e].tolist() for e, n in zip(ends, counts)]


def test_sentencepiece_without_dropout_is_the_library():
    texts = [r["text"] for r in sample_rows()] + ["", " ", "  a  b\n\tc", "ﬁ ① 😀\x00z", "x();\r\n"]
    model = sentencepiece.SentencePieceProcessor(model_file=default_path())
    assert _encoded(texts, 0.0)[1] == model.encode(texts)


def test_sentencepiece_dropout_varies_and_decodes():
    texts = [r["text"] for r in sample_rows()] + ["", " ", "▁a▁ b▁", "\n\n", "😀" * 50]
    model = sentencepiece.SentencePieceProcessor(model_file=default_path())
    pieces, ids = _encoded(texts, 0.1)
    assert [b.decode() for b in pieces.decode(np.array([x for i in ids for x in i], np.int64), np.array([len(i) for i in ids]))] == texts
    assert all(model.decode(i) == t for i, t in zip(ids, texts))
    plain, other = _encoded(texts, 0.0)[1], _encoded(texts, 0.1, seed=6)[1]
    assert ids != plain and ids != other and ids == _encoded(texts, 0.1)[1]
    assert sum(map(len, ids)) > sum(map(len, plain))
    assert all(len(i) >= len(p) for i, p in zip(_encoded(texts, 1.0)[1], plain))


def test_sentencepiece_drops_a_frequent_word_s_merge_at_its_rate():
    """Each of these words has one candidate; it is dropped in a tenth of the word's occurrences, not in 0, 25 or 50 percent."""
    letters = "abcdefghijklmnop"
    pieces, (ids,) = _encoded(["x" + "".join(f" {c}" for c in letters) * 5000], 0.1)
    plain = {c: _encoded([f"x {c}"], 0.0)[1][0][-1] for c in letters}
    assert all(0.08 < 1 - ids.count(k) / 5000 < 0.12 for k in plain.values())


def test_sentencepiece_remembered_words_are_those_drawn_in_full(monkeypatch):
    texts = [r["text"] for r in sample_rows()][:200] + ["the people " * 300, "", "ﬁ ünï 😀\x00"]
    for dropout in (0.1, 0.6, 1.0):
        remembered = _encoded(texts, dropout)[1]
        with monkeypatch.context() as m:
            m.setattr("brookledger.llm.sentencepiece_dropout.SHORT", 0)
            assert _encoded(texts, dropout)[1] == remembered


def test_sentencepiece_with_dropout_is_the_plain_merging_of_each_word():
    from brookledger.llm.batches import mix

    model = sentencepiece.SentencePieceProcessor(model_file=default_path())
    ids_of = {model.id_to_piece(k): k for k in range(model.get_piece_size()) if not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k))}

    def scramble(x: int) -> int:
        return int(mix(np.array([x % 2**64], np.uint64))[0])

    def plain(text: str, key: int, seed: int, dropout: float, copy: int) -> list[int]:
        of_text, out = scramble(scramble(key + seed) + copy * 0xD1B54A32D192ED03), []
        # Line ends, which no merge takes in, are words too.
        for place, word in enumerate(re.findall(r"\n| +[^ \n]*|[^ \n]+", " " + text)):
            word, draw = word.replace(" ", "▁"), scramble(of_text + place * 0x9E3779B97F4A7C15)
            ends = [*range(len(word) + 1)]
            while True:
                pairs = [(a, c) for a, c in zip(ends, ends[2:]) if word[a:c] in ids_of]
                kept = [(-model.get_score(ids_of[word[a:c]]), a, c) for a, c in pairs
                    if (scramble(draw ^ (a * 0x9E3779B97F4A7C15 + c * 0xD1B54A32D192ED03) % 2**64) >> 11) * 2.0**-53 >= dropout]
                if not kept:
                    break
                _, a, c = min(kept)
                ends = [e for e in ends if not a < e < c]
            for a, c in zip(ends, ends[1:]):
                out += [ids_of[word[a:c]]] if word[a:c] in ids_of else [model.piece_to_id(f"<0x{b:02X}>") for b in word[a:c].encode()]
        return out

    texts = [r["text"][:300] for r in sample_rows() if r["text"] and not re.search("[\x00-\x09\x0b-\x1f▁]", r["text"])][:12]
    texts += ["the people  of a 😀 international\nunderstanding, internationalunderstandings!", "x\n\ny ", "a" * 40]
    for dropout in (0.1, 0.5):
        assert _encoded(texts * 2, dropout)[1] == [plain(t, k, 5, dropout, 4) for k, t in enumerate(texts * 2)]


def test_sentencepiece_makes_no_segmentation_for_a_dropped_candidate_that_would_not_merge(monkeypatch):
    """An occurrence is made anew only where candidates are dropped that merged."""
    made, real = [], Pieces._made
    monkeypatch.setattr(Pieces, "_made", lambda self, words, gone_at, gone, spelled: made.append((len(words), len(gone))) or real(self, words, gone_at, gone, spelled))
    pieces, (ids,) = _encoded(["x" + " the" * 20_000], 0.1)
    assert made[0] == (2, 0)
    # Each set of the three merges of the word, but the empty one; those that were met and did not merge are not in it.
    assert made[1][0] <= 7 and ids.count(sentencepiece.SentencePieceProcessor(model_file=default_path()).encode("x the")[-1]) > 0.7 * 20_000


def test_numbers_of_many_keys():
    from brookledger.llm.word_cache import Numbers, WordCache

    keys = np.random.default_rng(1).permutation(np.arange(200_000, dtype=np.uint64) * np.uint64(0x100000001))
    numbers = Numbers()
    assert (numbers.get(keys[:5]) == -1).all()
    for k in range(0, 150_000, 15_000):
        numbers.add(keys[k : k + 15_000])
    assert (numbers.get(keys[:150_000]) == np.arange(150_000)).all() and (numbers.get(keys[150_000:]) == -1).all()
    cache = WordCache(limit=100)  # smaller than a call's words: generations follow each other
    for _ in range(3):
        for k in range(0, 400, 80):
            own = np.repeat(keys[k : k + 130], 2)
            ids, lengths = cache.ids(own, lambda which: ((own[which] % np.uint64(1000)).astype(np.uint32), np.ones(len(which), np.int64)))
            assert (ids == own % np.uint64(1000)).all() and (lengths == 1).all()


def test_sentencepiece_draws_anew_for_each_copy(spark):
    import corpus_pipeline

    rows = [(k // 3, f"some words that are the same in every copy of text {k // 3}", "en") for k in range(30)] + [(None, None, None)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, _copy string")
    got = corpus_pipeline.encoding_stage(spark, docs, SF_DIR).collect()
    assert [r["doc_id"] for r in got] == [i for i, *_ in rows] and all(r["lossless"] for r in got)
    assert len({(r["doc_id"], tuple(r["ids"])) for r in got[:30]}) > 25
    again = corpus_pipeline.encoding_stage(spark, docs.repartition(4), SF_DIR).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_sentencepiece_of_awkward_rows(awkward, empty):
    got = encoded(awkward).collect()
    assert len(got) == 16 and all(r["lossless"] and r["n_tokens"] == len(r["ids"]) for r in got)
    assert {r["n_tokens"] for r in got if r["doc_id"] in (3, 4)} == {0}
    assert encoded(empty).count() == 0


# ---- token files ----------------------------------------------------------------------
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def test_ranks_round_trip():
    draw = np.random.default_rng(0)
    ranks = draw.integers(0, 2**32, 1003, dtype=np.uint32) >> draw.integers(0, 32, 1003).astype(np.uint32)
    for n in (0, 1, 2, 3, 4, 5, 1003):
        assert (decode_ranks(*encode_ranks(ranks[:n]), n) == ranks[:n]).all()


@pytest.mark.parametrize("name", ["docs", "awkward"])
def test_token_files_hold_the_library_s_ids(spark, request, name):
    table = request.getfixturevalue(name)
    folder = token_folder(spark)
    write_token_files(table.repartition(5), folder, WORD_BPE)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    rows = sorted({(r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in table.collect()})
    got = sorted(token_digests(spark, folder).collect(), key=lambda r: r["start"])
    ids = {t: tokenizer.encode(t, add_special_tokens=False).ids + [1] for _, _, t in rows}
    want = []
    for _, i, t in rows:
        for _ in range(2 if name == "awkward" and i == 8 else 1):
            want.append((i, sum(n for *_, n, _ in want), len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())))
    assert [(r["doc_id"] or 0, r["start"], r["n_tokens"], r["ids_crc32"]) for r in got] == want


def test_words_encode_like_whole_texts():
    from brookledger.llm.token_files import token_ids

    texts = ["a b", "A\x1cb é é ́x", "<|endoftext|> x<|startoftext|>y", "ΣΑΣ Σ. İ", "don't 've x　y", "", " ", "a<|endoftext|> <| endoftext |>"]
    ids, counts = token_ids(pa.array(texts), WORD_BPE)
    ends = np.cumsum(counts)
    assert [ids[e - n : e - 1].tolist() for e, n in zip(ends, counts)] == [e.ids for e in Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)]


def test_words_cut_at_signs_encode_like_whole_texts():
    from brookledger.llm.batches import NOT_SPACE, Texts
    from brookledger.llm.token_files import _cut, token_ids

    words = Texts(pa.array(["été, été. ab's", ", x|y a×. 9≠"]))
    words.split(NOT_SPACE)
    _cut(words)
    got = [words.text[a : a + n].tobytes().decode() for a, n in zip(words.starts, words.lengths)]
    assert got == ["été", ",", "été", ".", "ab's", ",", "x|y", "a×.", "9", "≠"] and words.counts.tolist() == [5, 5]
    signs = [*"aZ9éÿ×÷ß'.,<|>=-_ \u0301\u0338\n…İ", "'s", "<|endoftext|>", "<|endoftext|", "|>", "<<"]
    rng = np.random.default_rng(6)
    texts = ["".join(rng.choice(signs, rng.integers(0, 30))) for _ in range(3000)]
    ids, counts = token_ids(pa.array(texts), WORD_BPE)
    ends = np.cumsum(counts)
    assert [ids[e - n : e - 1].tolist() for e, n in zip(ends, counts)] == [e.ids for e in Tokenizer.from_file(WORD_BPE).encode_batch(texts, add_special_tokens=False)]


def test_token_files_remember_more_words_than_some_slices_have(monkeypatch):
    from brookledger.llm import token_files

    asked = []

    def encode(tokenizer, words):
        asked.append(len(words))
        return np.zeros(len(words), np.uint32), np.ones(len(words), np.int64)

    monkeypatch.setattr(token_files, "_encode_words", encode)
    token_files._tokenizer.cache_clear()
    try:
        slices = [pa.array([" ".join(f"w{k}" for k in range(a, a + 250_000))]) for a in (0, 250_000, 500_000, 0)]
        assert [token_files.token_ids(s, WORD_BPE)[1].tolist() for s in slices] == [[250_001]] * 4 and asked == [250_000] * 3
    finally:
        token_files._tokenizer.cache_clear()


def test_token_files_of_no_rows(spark, empty):
    folder = token_folder(spark)
    write_token_files(empty, folder, WORD_BPE)
    assert token_digests(spark, folder).count() == 0


# ---- mixing -----------------------------------------------------------------------------
def _targets_answer(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    full: set = set()
    while True:
        rest = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        level = rest / sum(weight[s] for s in names if s not in full) if len(full) < len(names) else 0
        over = {s for s in names if s not in full and weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3 * sizes[s] if s in full else weight[s] * level for s in names}
        full |= over


def test_mixture_meets_its_targets(spark):
    draw = np.random.default_rng(4)
    share = [0, 1, 1, 2, 5, 9, 300]
    rows = [(i, " ".join(["w"] * int(draw.integers(0, 40))), f"s{k}" if k else None) for k, n in enumerate(share) for i in range(1000 * k, 1000 * k + n * 3)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, text string, source string, size int, target int, copies int")
    got = mixture(docs).collect()
    sizes: dict = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(blank_words(text))
    want = _targets_answer(sizes)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert all(abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) and r["source_size"] == sizes[s] for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(r["size"] for r in own)
        assert all(r["taken"] == r["copies"] * r["size"] <= MAX_REPEATS * r["size"] and len(r["times"]) == r["copies"] for r in own)
        assert all(0 <= t <= 1 for r in own for t in r["times"])
    again = {r["doc_id"]: r["taken"] for r in mixture(docs.repartition(9)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_mixed_rows_follow_the_schedule(docs):
    plan = {r["doc_id"]: r for r in mixture(docs).collect()}
    rows = mixed(docs).select("doc_id").collect()
    taken: dict = {}
    for r in rows:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + 1
    assert taken == {i: r["copies"] for i, r in plan.items() if r["copies"]}
    order = [t for i, t in sorted((t, i) for i, r in plan.items() for t in r["times"])]
    assert [r["doc_id"] for r in rows] == order


def test_mixture_of_awkward_rows(awkward, empty):
    got = mixture(awkward).collect()
    assert len(got) == 16 and all(r["taken"] == 0 for r in got if r["doc_id"] in (3, 4, 5))
    kept = mixed(awkward)
    assert kept.columns == awkward.columns and kept.count() == sum(r["copies"] for r in got)
    assert mixture(empty).count() == 0 and mixed(empty).count() == 0


def test_mixing_queries_follow_the_schedule(spark, docs, monkeypatch):
    from brookledger.llm import mixing, queries

    def orders():
        plan = mixture(docs).collect()
        want = [i for *_, i in sorted((not r["times"], min(r["times"], default=0), r["doc_id"]) for r in plan)]
        copies = [i for _, i in sorted((t, r["doc_id"]) for r in plan for t in r["times"])]
        got = [r["doc_id"] for r in queries.op9_mixing(spark, SF_DIR).collect()]
        assert got == want and [r["doc_id"] for r in queries.op9_mixing_order(spark, SF_DIR).collect()] == copies
        return got

    before = orders()
    monkeypatch.setattr(mixing, "SLOPES", (0.5, -0.5, 0.25))
    assert orders() != before
