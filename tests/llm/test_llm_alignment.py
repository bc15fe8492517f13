"""Cross-tokenizer alignment against a plain-Python version over whole tables."""

from __future__ import annotations

import bisect
import collections
import hashlib
import json

import numpy as np
import pytest
from llm_cases import SCHEMA, awkward_rows, sample_rows

from brookledger.llm.tokenizer_alignment import align, alignment, alignment_groups, byte_of_character

P = pytest.importorskip("public_tokenizers")
A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def answer(rows: list[tuple]) -> list[tuple]:
    """The definition, with the tokenizers' own libraries; rows: (id, text)."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A_PATH)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    to_byte = byte_of_character()
    out, links, holding = [], [], collections.Counter()
    for i, text in rows:
        a = b = []
        if text:
            a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        raw_a = [bytes(to_byte[c] for c in first.id_to_token(x)) for x in a]
        raw_b = [
            bytes([int(second.id_to_piece(x)[3:5], 16)]) if second.is_byte(x) else second.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if text and not b"".join(raw_a) == b"".join(raw_b) == (" " + text).encode():
            a = b = raw_a = raw_b = []
        ends_a, ends_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        common = sorted(set(ends_a) & set(ends_b))
        groups, i_a, i_b = [], 0, 0
        for e in common:
            to_a, to_b = bisect.bisect_right(ends_a, e), bisect.bisect_right(ends_b, e)
            groups.append(",".join(map(str, a[i_a:to_a])) + "|" + ",".join(map(str, b[i_b:to_b])))
            i_a, i_b = to_a, to_b
        own = []
        j = 0
        for k, e in enumerate(ends_a):
            s = ends_a[k - 1] if k else 0
            while j and ends_b[j - 1] > s:
                j -= 1
            while j < len(b) and ends_b[j] <= s:
                j += 1
            m = j
            while m < len(b) and (ends_b[m - 1] if m else 0) < e:
                own.append((a[k], b[m]))
                m += 1
        holding.update(set(own))
        links.append(own)
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        out.append((i, len(a), len(b), len(common), len(own), digest))
    highest: dict[int, int] = {}
    for (x, _), n in holding.items():
        highest[x] = max(highest.get(x, 0), n)
    return [
        (*r[:5], sum(holding[p] == highest[p[0]] for p in own), sum(holding[p] for p in own), r[5]) for r, own in zip(out, links)]


def check(found: list[tuple], expected: list[tuple]) -> None:
    found, expected = sorted(found, key=str), sorted(expected, key=str)
    assert found == expected


def test_the_sample_equals_the_definition(spark):
    from brookledger.llm.queries import QUERIES

    rows = [(r["doc_id"], r["text"]) for r in sample_rows()]
    found = QUERIES["op11_tokenizer_alignment"](spark, "/root/testdata/sf0.001").collect()
    check([tuple(r) for r in found], answer(rows))


def test_awkward_rows(spark):
    rows = awkward_rows()
    extra = [(20, "<|endoftext|> <s> </s> <unk> <0x41>  two   blanks ", *["x"] * 17), (21, "ab" * 20_000, *["x"] * 17), (22, "▁ ﬁ café", *["x"] * 17)]
    rows += [(i, t, "x", "x", 1, *["x"] * 14) for i, t, *_ in extra]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    check([tuple(r) for r in alignment(docs, A_PATH, B_PATH).collect()], answer([(r[0], r[1]) for r in rows]))


def test_an_empty_table_gives_no_rows(spark):
    assert alignment(spark.createDataFrame([], "doc_id long, text string"), A_PATH, B_PATH).count() == 0


def test_groups_cover_both_sequences(spark):
    docs = spark.createDataFrame([(1, "an invented sentence: Zürich 1234"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in alignment_groups(docs, A_PATH, B_PATH).collect()}
    assert rows[1].a_cuts[-1] == len(rows[1].a_ids) and rows[1].b_cuts[-1] == len(rows[1].b_ids)
    assert len(rows[1].a_cuts) == len(rows[1].b_cuts) > 1
    assert rows[2].a_ids == rows[2].b_ids == rows[2].a_cuts == []


def test_runs_of_any_length_are_skipped_whole():
    draw = np.random.default_rng(4)
    for n in (1, 2, 3, 7, 8, 9, 64, 1000):
        for share in (0.0, 0.02, 0.5, 1.0):
            ends = np.arange(1, n + 1)
            a = np.unique(np.append(ends[draw.random(n) >= share], n))
            b = np.unique(np.append(ends[draw.random(n) >= share / 2], n))
            g = align(a, b)
            assert a[g.a_cuts - 1].tolist() == b[g.b_cuts - 1].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
            links = {(i, j) for i in range(len(a)) for j in range(len(b)) if max(a[i - 1] if i else 0, b[j - 1] if j else 0) < min(a[i], b[j])}
            assert links == set(zip(g.link_a.tolist(), g.link_b.tolist())) and len(links) == len(g.link_a)


def test_the_file_states_ids_in_the_order_of_merges():
    model = json.load(open(A_PATH))["model"]
    assert all(model["vocab"]["".join(m)] == 256 + k for k, m in enumerate(model["merges"]))
