"""Cross-tokenizer alignment: groups of tokens of two tokenizers that cover the same bytes, by diagonal run skipping."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brookledger.llm.batches import column, slices, small_batches
from brookledger.llm.shared_folder import written
from brookledger.llm.word_cache import ragged

#: Text of a block, about: documents whose id pairs are looked up together. A longer document is a block of its own.
BLOCK_BYTES = 8_000_000
#: Pre-tokenisation of byte-level BPE (fixed value of the tokenizer's format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# ---- the two tokenizers --------------------------------------------------------
def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable bytes stand for themselves, the others, in order, are moved to 256 and up.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(moved)}


@dataclass
class Vocabulary:
    """The bytes of each id, one after the other, and the ids' digits."""

    flat: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    digits: np.ndarray
    n_digits: np.ndarray

    @staticmethod
    def of(tokens: list[bytes]) -> "Vocabulary":
        lengths = np.array([len(t) for t in tokens], np.int64)
        names = [str(k).encode() for k in range(len(tokens))]
        digits = np.array([list(n.ljust(8)) for n in names], np.uint8)
        return Vocabulary(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(lengths) - lengths, lengths, digits, np.array([len(n) for n in names]))

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.starts[ids], self.lengths[ids])]


@functools.lru_cache(maxsize=2)
def byte_level(path: str):
    """(encode a text to ids, Vocabulary) of a byte-level BPE file.

    Where the file's ids are in the order of its merges, its ranks serve a
    faster encoder of the same rule; otherwise the file's own library encodes.
    Special tokens are ordinary text.
    """
    import json

    import tiktoken

    with open(path, encoding="utf-8") as file:
        model = json.load(file)["model"]
    to_byte = byte_of_character()
    ranks = {bytes(to_byte[c] for c in token): i for token, i in model["vocab"].items()}
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if all(model["vocab"].get(a + b) == 256 + k for k, (a, b) in enumerate(pairs)) and len(ranks) == 256 + len(pairs):
        return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, Vocabulary.of(tokens)
    return library_encoder(path), Vocabulary.of(tokens)


def library_encoder(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode_batch([text], add_special_tokens=False)[0].ids


@functools.lru_cache(maxsize=2)
def pieces(path: str):
    """(processor, Vocabulary) of a SentencePiece model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def raw(i: int) -> bytes:
        piece = model.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    return model, Vocabulary.of([raw(i) for i in range(model.get_piece_size())])


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in ids], np.int64)
    return np.fromiter((i for x in ids for i in x), np.int64, int(counts.sum())), counts


# ---- alignment -----------------------------------------------------------------
@dataclass
class Groups:
    """Groups of tokens: where each ends in either sequence, and all pairs of tokens that overlap."""

    a_cuts: np.ndarray
    b_cuts: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(a_ends: np.ndarray, b_ends: np.ndarray) -> Groups:
    """Cut two token sequences over the same bytes into groups wherever both end.

    The ends are compared at the current shift between the two indices: runs
    of equal ends, where tokens are one to one, are jumped over by probing 1, 2,
    4, ... tokens ahead and halving back in the step that differs. Where the
    ends differ, the group is resolved token by token, which gives the new shift;
    each of its steps is a pair of tokens that overlap.
    """
    a, b = a_ends.astype("<i8").tobytes(), b_ends.astype("<i8").tobytes()
    ends_a, ends_b = a_ends.tolist(), b_ends.tolist()
    n_a, n_b = len(ends_a), len(ends_b)
    run_i: list[int] = []  # one to one: begin in either sequence, tokens
    run_j: list[int] = []
    run_n: list[int] = []
    cut_i: list[int] = []  # irregular groups: end in either sequence
    cut_j: list[int] = []
    link_i: list[int] = []
    link_j: list[int] = []
    i = j = 0
    while i < n_a:
        x, y = ends_a[i], ends_b[j]
        if x == y:
            n, step, left = 1, 1, min(n_a - i, n_b - j)
            p, q = 8 * i, 8 * j
            while n + step <= left and a[p + 8 * n : p + 8 * (n + step)] == b[q + 8 * n : q + 8 * (n + step)]:
                n += step
                step *= 2
            while step > 1:
                step >>= 1
                if n + step <= left and a[p + 8 * n : p + 8 * (n + step)] == b[q + 8 * n : q + 8 * (n + step)]:
                    n += step
            run_i.append(i)
            run_j.append(j)
            run_n.append(n)
            i += n
            j += n
            continue
        while x != y:
            link_i.append(i)
            link_j.append(j)
            if x < y:
                i += 1
                x = ends_a[i]
            else:
                j += 1
                y = ends_b[j]
        link_i.append(i)
        link_j.append(j)
        i += 1
        j += 1
        cut_i.append(i)
        cut_j.append(j)
    runs = np.array(run_n, np.int64)
    straight_i, straight_j = ragged(np.array(run_i, np.int64), runs), ragged(np.array(run_j, np.int64), runs)
    cuts_a = np.concatenate([straight_i + 1, np.array(cut_i, np.int64)])
    order = np.argsort(cuts_a, kind="stable")
    return Groups(
        cuts_a[order], np.concatenate([straight_j + 1, np.array(cut_j, np.int64)])[order],
        np.concatenate([straight_i, np.array(link_i, np.int64)]), np.concatenate([straight_j, np.array(link_j, np.int64)]))


@dataclass
class Aligned:
    """The tokens and groups of the texts of a slice; texts that either tokenizer changes have none."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray  # by text
    n_b: np.ndarray
    groups: Groups

    @property
    def a_first(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.n_a)])

    def group_counts(self) -> np.ndarray:
        return np.diff(np.searchsorted(self.groups.a_cuts, self.a_first, side="right"))

    def link_owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.n_a)), self.n_a)[self.groups.link_a]


def align_texts(texts: pa.Array, byte_path: str, piece_path: str) -> Aligned:
    encode, vocabulary_a = byte_level(byte_path)
    model, vocabulary_b = pieces(piece_path)
    plain = texts.to_pylist()
    ids_a = [encode(" " + t) if t else [] for t in plain]
    ids_b = model.encode(plain, num_threads=1) if plain else []
    ids_b = [x if t else [] for x, t in zip(ids_b, plain)]
    a, n_a = _flat(ids_a)
    b, n_b = _flat(ids_b)

    # Keep the texts whose bytes both sequences give back.
    raw = [(" " + t).encode() if t else b"" for t in plain]
    size = np.array([len(r) for r in raw], np.int64)
    want = np.frombuffer(b"".join(raw), np.uint8)
    good = _gives_back(vocabulary_a, a, n_a, want, size) & _gives_back(vocabulary_b, b, n_b, want, size)
    a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
    n_a, n_b = n_a * good, n_b * good
    groups = align(np.cumsum(vocabulary_a.lengths[a]), np.cumsum(vocabulary_b.lengths[b]))
    return Aligned(a, b, n_a, n_b, groups)


def _gives_back(vocabulary: Vocabulary, ids: np.ndarray, counts: np.ndarray, want: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether each text's ids stand for its bytes."""
    owner = np.repeat(np.arange(len(counts)), counts)
    total = np.bincount(owner, vocabulary.lengths[ids], len(counts)).astype(np.int64)
    good = total == size
    ids = ids[np.repeat(good, counts)]
    same = vocabulary.bytes_of(ids) == want[np.repeat(good, size)]
    wrong = np.bincount(np.repeat(np.arange(len(size)), size * good)[~same], minlength=len(size))
    return good & (wrong == 0)


def group_digests(aligned: Aligned, byte_path: str, piece_path: str) -> list[str]:
    """For each text the SHA-256 of its groups as 'a1,a2|b1;a3|b2,b3'; '' without tokens."""
    g = aligned.groups
    before_a, before_b = np.diff(g.a_cuts, prepend=0), np.diff(g.b_cuts, prepend=0)
    n = len(aligned.a) + len(aligned.b)
    # A token comes after the other sequence's tokens of the groups before it, and B's after A's of its own group too.
    at_a = np.arange(len(aligned.a)) + np.repeat(g.b_cuts - before_b, before_a)
    at_b = np.arange(len(aligned.b)) + np.repeat(g.a_cuts, before_b)
    letters, lengths = np.empty((n, 8), np.uint8), np.empty(n, np.int64)
    for at, ids, cuts, mark, vocabulary in (
        (at_a, aligned.a, g.a_cuts, b"|", byte_level(byte_path)[1]), (at_b, aligned.b, g.b_cuts, b";", pieces(piece_path)[1])
    ):
        separator = np.full(len(ids), b","[0], np.uint8)
        separator[cuts - 1] = mark[0]
        part = vocabulary.digits[ids]
        part[np.arange(len(ids)), vocabulary.n_digits[ids]] = separator
        letters[at], lengths[at] = part, vocabulary.n_digits[ids] + 1
    ends = np.cumsum(aligned.n_a + aligned.n_b)
    stops = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], ends])]
    joined = memoryview(letters[np.arange(8) < lengths[:, None]].tobytes())
    return [hashlib.sha256(joined[s : e - 1]).hexdigest() if e > s else "" for s, e in zip(stops[:-1].tolist(), stops[1:].tolist())]


# ---- corpus --------------------------------------------------------------------
BLOCKS = (
    "block long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>, "
    "pairs array<long>, documents array<int>, n_pairs array<int>, which binary, times binary"
)


def _blocks(byte_path: str, piece_path: str):
    """Rows of BLOCKS: some documents, the different id pairs linked in them, and each document's share of those."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, number = 0, TaskContext.get().partitionId() << 32

        def block() -> pa.RecordBatch:
            nonlocal number
            pairs = np.unique(np.concatenate([h[7] for h in held]))
            which = np.concatenate([np.searchsorted(pairs, h[7])[h[8]] for h in held]).astype("<i4")
            times = np.concatenate([h[9] for h in held]).astype("<i4")
            values = [
                number, [i for h in held for i in h[0]], *(np.concatenate([h[k] for h in held]) for k in (1, 2, 3, 4)), [d for h in held for d in h[5]],
                pairs, np.bincount(which, minlength=len(pairs)).astype(np.int32), np.concatenate([h[6] for h in held]).astype(np.int32), which.tobytes(), times.tobytes(),
            ]
            kinds = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 2, pa.binary(), pa.binary()]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], [f.split(" ")[0] for f in BLOCKS.split(", ")])

        for part, texts in slices(batches):
            aligned = align_texts(texts, byte_path, piece_path)
            g, n_texts = aligned.groups, len(texts)
            owners = aligned.link_owners()
            codes, inverse = np.unique(aligned.a[g.link_a] << 32 | aligned.b[g.link_b], return_inverse=True)
            own, times = np.unique(owners * max(1, len(codes)) + inverse, return_counts=True)
            owner, which = np.divmod(own, max(1, len(codes)))
            held.append((
                column(part, "doc_id").to_pylist(), aligned.n_a, aligned.n_b, aligned.group_counts(), np.bincount(owners, minlength=n_texts),
                group_digests(aligned, byte_path, piece_path), np.bincount(owner, minlength=n_texts), codes, which, times))
            size += texts.nbytes
            if size >= BLOCK_BYTES:
                yield block()
                held, size = [], 0
        if held:
            yield block()

    return run


def _totals(blocks: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """n_best and count_sum of a block's documents, from the corpus-wide counts of its id pairs."""
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    out = {n: [] for n in ["doc_id", *names, "n_best", "count_sum"]}
    for row in blocks.itertuples():
        order = np.argsort(counts["pair"].to_numpy(), kind="stable")
        count, best = counts["count"].to_numpy()[order], counts["best"].to_numpy()[order]
        which, times = np.frombuffer(row.which, "<i4"), np.frombuffer(row.times, "<i4").astype(np.int64)
        ends = np.concatenate([[0], np.cumsum(row.n_pairs)])
        sums = np.concatenate([[0], np.cumsum(times * count[which])])[ends]
        bests = np.concatenate([[0], np.cumsum(times * best[which])])[ends]
        out["doc_id"] += list(row.doc_ids)
        for n in names:
            out[n] += list(getattr(row, n))
        out["n_best"] += np.diff(bests).tolist()
        out["count_sum"] += np.diff(sums).tolist()
    return pd.DataFrame(out).astype({n: "Int64" for n in out if n != "groups_sha256"})


def aligned_blocks(docs: DataFrame, byte_path: str, piece_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of BLOCKS, stored. By row, without a shuffle."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return written(rows.mapInArrow(_blocks(byte_path, piece_path), BLOCKS), "alignments", codec="zstd")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold an id pair linked, and whether no pair of its first id is in more.

    A pair is the first id in the upper, the second in the lower 32 bits.
    Counts are summed in a block before they are shuffled, so a pair that every
    document holds is one row a block.
    """
    counted = blocks.select(F.explode(F.arrays_zip("pairs", "documents")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(
        F.sum("x.documents").alias("count"))
    counted = written(counted, "pair-counts")
    highest = counted.groupBy(F.shiftright("pair", 32).alias("first")).agg(F.max("count").alias("highest"))
    return counted.join(highest, F.shiftright("pair", 32) == F.col("first")).select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def alignment(docs: DataFrame, byte_path: str, piece_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is the byte-level BPE over a space and the text, B the SentencePiece model
    over the text. A group ends wherever tokens of both end; all A-B pairs of
    token occurrences whose bytes overlap are links. A pair of ids counts the
    documents (rows) that hold it linked; ``n_best`` are links whose count no
    other pair of their A id exceeds, ``count_sum`` sums the counts over links.

    Null and empty texts, and texts that a tokenizer does not give back byte for
    byte, have no tokens: zeros and ''. Null ids stay null, repeated rows count
    each, other columns are ignored.

    Documents lie in blocks of about BLOCK_BYTES of text that name each of their
    id pairs once; only those names meet the corpus-wide counts, and a block's
    documents are summed up where its names come back.
    """
    blocks = aligned_blocks(docs, byte_path, piece_path, doc_id, text)
    counts = pair_counts(blocks)
    named = blocks.select(F.col("block").alias("of_block"), F.explode("pairs").alias("pair")).join(counts, "pair")
    return blocks.groupBy("block").cogroup(named.groupBy("of_block")).applyInPandas(
        lambda own, found: _totals(own, found),
        "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long",
    ).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def alignment_groups(docs: DataFrame, byte_path: str, piece_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The alignments themselves, one row per input row: doc_id, a_ids, b_ids, a_cuts, b_cuts.

    Group k holds the ids from cut k - 1 (0 for the first) to cut k of either list.
    """
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            x = align_texts(texts, byte_path, piece_path)
            a, b = x.a_first, np.concatenate([[0], np.cumsum(x.n_b)])
            cuts = np.searchsorted(x.groups.a_cuts, a, side="right")
            spans = [*zip(a[:-1], a[1:], b[:-1], b[1:], cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [column(part, "doc_id"), *(pa.array(v, pa.list_(pa.int32())) for v in (
                    [x.a[s:e] for s, e, *_ in spans], [x.b[s:e] for _, _, s, e, *_ in spans],
                    [x.groups.a_cuts[s:e] - first for first, _, _, _, s, e in spans], [x.groups.b_cuts[s:e] - first for _, _, first, _, s, e in spans]))],
                ["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>")
