"""Token files: ids ranked by frequency, in bytes of variable number with control bytes apart."""

from __future__ import annotations

import functools
import json
import posixpath
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brookledger.llm.batches import NOT_SPACE, Hasher, Texts, byte_table, column, slices, small_batches
from brookledger.llm.shared_folder import release_exchanges, written
from brookledger.llm.word_cache import WordCache
from brookledger.sources.tables import new_folder

END_ID = 1
#: Documents of a block hold about this many ids (a longer one is a block of its own).
BLOCK_IDS = 1 << 18


# ---- the coding ------------------------------------------------------------
#: Bytes of the four values that a control byte describes, two bits each.
SIZES = np.array([[(c >> (2 * k)) & 3 for k in range(4)] for c in range(256)], np.int64) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes): a value takes 1 to 4 bytes, little end first."""
    ranks = ranks.astype(np.uint32)
    sizes = 1 + (ranks > 0xFF).astype(np.int64) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = sizes - 1
    four = padded.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = np.empty(int(sizes.sum()), np.uint8)
    at = np.cumsum(sizes) - sizes
    for k in range(4):
        has = sizes > k
        data[at[has] + k] = (ranks[has] >> np.uint32(8 * k)) & np.uint32(0xFF)
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The values back, by a table of the control bytes."""
    sizes = SIZES[np.frombuffer(control, np.uint8)].ravel()[:n]
    raw = np.frombuffer(data, np.uint8)
    at = np.cumsum(sizes) - sizes
    values = np.zeros(n, np.uint32)
    for k in range(4):
        has = sizes > k
        values[has] |= raw[at[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return values


# ---- tokens ----------------------------------------------------------------
@functools.cache
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return tokenizer, WordCache(1_000_000), Hasher(6), _cuts_words(tokenizer)


#: A special token put between words: where its id comes out, a word ends.
MARK = "<|endoftext|>"
#: Letters and digits, and signs that no token joins to one before them: a word is cut between the two.
#: The apostrophe begins tokens such as 's, and | is part of the special tokens.
ALNUM = byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])
SIGN = byte_table(k for k in range(0x21, 0x7F) if not chr(k).isalnum() and chr(k) not in "'|")
#: How the tokenizer must split for words to be cut.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _cuts_words(tokenizer) -> bool:
    """Whether signs after a letter always begin a token."""
    first = (json.loads(tokenizer.to_str())["pre_tokenizer"] or {}).get("pretokenizers", [{}])[0]
    return first.get("pattern") == {"Regex": SPLIT}


def _cut(words: Texts) -> None:
    """Cut the words before signs that follow a letter or digit: fewer different ones are left."""
    text = words.text
    letter = ALNUM[text]
    letter[1:] |= (text[:-1] == 0xC3) & (text[1:] >= 0x80) & (text[1:] < 0xC0) & (text[1:] != 0x97) & (text[1:] != 0xB7)
    at = np.flatnonzero(letter[:-1] & SIGN[text[1:]]) + 1
    # Only inside a word, not where a text ends in a letter and the next begins with a sign.
    at = at[~np.isin(at, words.starts)]
    ends = words.starts + words.lengths
    words.starts = np.sort(np.concatenate([words.starts, at]))
    words.lengths = np.sort(np.concatenate([ends, at])) - words.starts
    words.first = np.searchsorted(words.starts, words.bounds)


def _encode_words(tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the words one after the other, number of each), from one call over all of them.

    Words are told apart by a special token between them; where a word holds
    its text, by the places in which tokens begin.
    """
    mark = tokenizer.token_to_id(MARK)
    if mark is not None:
        ids = np.array(tokenizer.encode_batch_fast([MARK.join(words)], add_special_tokens=False)[0].ids, np.uint32)
        at = np.flatnonzero(ids == mark)
        if len(at) == len(words) - 1:
            return np.delete(ids, at), np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1
    starts = np.cumsum([0] + [len(w) + 1 for w in words])
    encoding = tokenizer.encode_batch([" ".join(words)], add_special_tokens=False)[0]
    begins = np.fromiter((o[0] for o in encoding.offsets), np.int64, len(encoding.ids))
    lengths = np.diff(np.searchsorted(begins, starts))
    return np.array(encoding.ids, np.uint32), lengths


def token_ids(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after the other, number of ids of each text), each text ended by END_ID.

    The tokenizer drops white space and its tokens, normal forms and lower case
    do not reach across it, so the ids of a text are those of its words in turn
    and words are encoded once. Words are cut at six blanks only, which are
    white space for the tokenizer; tests compare with whole texts.
    """
    tokenizer, cache, hasher, cuts = _tokenizer(path)
    words = Texts(texts)
    words.split(NOT_SPACE)
    if cuts:
        _cut(words)

    def encode(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ends = words.starts[which] + words.lengths[which]
        raw = words.text.tobytes()
        return _encode_words(tokenizer, [raw[s:e].decode() for s, e in zip(words.starts[which].tolist(), ends.tolist())])

    ids, lengths = cache.ids(hasher.words(words.text, words.starts, words.lengths), encode)
    ends = np.concatenate([[0], np.cumsum(lengths)])[words.first]
    counts = np.diff(ends)
    out = np.full(len(ids) + len(counts), END_ID, np.uint32)
    out[np.arange(len(ids)) + np.repeat(np.arange(len(counts)), counts)] = ids
    return out, counts + 1


def _binaries(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())


PLAIN = "shard int, block int, before long, doc_ids array<long>, counts array<long>, n_ids long, ids binary"


def tokenized_blocks(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Blocks of documents in ascending order of the id, with their plain ids (2 bytes each where all fit, else 4).

    The texts are dealt by ranges of the id and encoded where they arrive; to
    find the ranges Spark reads the ids only. ``shard`` numbers the ranges,
    ``block`` the blocks of a range, ``before`` counts the ids before it in its range. Null ids come last; rows of one id are
    ordered by a hash of their text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = "<u2" if _tokenizer(path)[0].get_vocab_size() <= 1 << 16 else "<u4"
        block, shard, before, held, doc_ids, counts = 0, 0, 0, [], [], []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(held)
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (doc_ids, counts)]
            return pa.RecordBatch.from_arrays(
                [pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), *lists, pa.array([len(ids)], pa.int64()), _binaries([ids.astype(width).tobytes()])],
                ["shard", "block", "before", "doc_ids", "counts", "n_ids", "ids"],
            )

        for part, texts in slices(batches):
            ids, n = token_ids(texts, path)
            shard = column(part, "shard")[0].as_py()
            held.append(ids)
            doc_ids += column(part, "doc_id").to_pylist()
            counts += n.tolist()
            if sum(map(len, held)) >= BLOCK_IDS:
                yield flush()
                block, before, held, doc_ids, counts = block + 1, before + sum(map(len, held)), [], [], []
        if held:
            yield flush()

    order = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("tie")]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text"))
    ranges = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return ranges.select("doc_id", F.spark_partition_id().alias("shard"), "text").mapInArrow(run, PLAIN)


def _ids_of(batch: pa.RecordBatch, row: int) -> np.ndarray:
    raw, n = column(batch, "ids")[row].as_buffer(), column(batch, "n_ids")[row].as_py()
    return np.frombuffer(raw, f"<u{len(raw) // max(1, n)}") if n else np.zeros(0, np.uint32)


def ranked_ids(blocks: DataFrame) -> np.ndarray:
    """Ids by falling frequency over all blocks, then rising id; at most the vocabulary's size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                n = np.bincount(_ids_of(batch, row))
                if len(n) > len(total):
                    total, n = n, total
                total[: len(n)] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counts = blocks.select("n_ids", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return counts.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.uint32)


# ---- files -----------------------------------------------------------------
BLOCK = "shard int, block int, before long, doc_ids array<long>, counts array<long>, n_ids long, control binary, data binary"


def write_token_files(docs: DataFrame, folder: str, path: str, doc_id: str = "doc_id", text: str = "text") -> None:
    """Write the coded ids of all rows under ``folder``, in ascending order of the id.

    ``folder/ranks`` has the id of each rank, ``folder/blocks`` blocks of
    documents by range and number, each with the ids and counts of its
    documents, control bytes and data bytes. Files are Parquet containers, so
    that Spark's committer leaves one copy of each, whatever is lost or retried.
    Null ids come last; rows of one id are ordered by a hash of their text.
    Null text has no ids but END_ID. Other columns are ignored; an empty table
    gives files without blocks.
    """
    spark = docs.sparkSession
    small_batches(spark)
    blocks = written(tokenized_blocks(docs, path, doc_id, text), "tokens", codec="zstd")
    release_exchanges(spark)  # the texts that were dealt by ranges
    ranked = ranked_ids(blocks)
    spark.createDataFrame(
        [(k, int(x)) for k, x in enumerate(ranked)], "rank int, id long"
    ).coalesce(1).write.parquet(posixpath.join(folder, "ranks"))
    shared = spark.sparkContext.broadcast(ranked)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranked = shared.value
        rank_of = np.zeros(int(ranked.max()) + 1 if len(ranked) else 1, np.uint32)
        rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
        for batch in batches:
            coded = [encode_ranks(rank_of[_ids_of(batch, row)]) for row in range(batch.num_rows)]
            same = ["shard", "block", "before", "doc_ids", "counts", "n_ids"]
            yield pa.RecordBatch.from_arrays([column(batch, n) for n in same] + [_binaries([c[k] for c in coded]) for k in (0, 1)], [*same, "control", "data"])

    blocks.mapInArrow(code, BLOCK).write.option("compression", "zstd").parquet(posixpath.join(folder, "blocks"))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids (little-endian, 4 bytes each)."""
    ranks = spark.read.schema("rank int, id long").parquet(posixpath.join(folder, "ranks")).orderBy("rank").toPandas()
    shared = spark.sparkContext.broadcast(ranks["id"].to_numpy(np.uint32))
    blocks = spark.read.schema(BLOCK).parquet(posixpath.join(folder, "blocks"))
    # Ids before a range: a row for each, at most spark.sql.shuffle.partitions of them when they were written.
    per_shard = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shard_from"))
    placed = blocks.join(F.broadcast(per_shard), "shard").withColumn("start", F.col("shard_from") + F.col("before"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = shared.value
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: column(batch, n)[row] for n in ("doc_ids", "counts", "n_ids", "control", "data", "start")}
                ids = ids_of[decode_ranks(one["control"].as_buffer(), one["data"].as_buffer(), one["n_ids"].as_py())].astype("<u4")
                counts = np.array(one["counts"].as_py(), np.int64)
                ends = np.cumsum(counts)
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one["doc_ids"].as_py(), pa.int64()), pa.array(ends - counts + one["start"].as_py()), pa.array(counts),
                        _binaries([raw[4 * (e - c) : 4 * e] for e, c in zip(ends.tolist(), counts.tolist())]),
                    ],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    return placed.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary")


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, from the files."""
    return read_token_files(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def token_folder(spark: SparkSession) -> str:
    return new_folder(spark, "llm-token-files")
