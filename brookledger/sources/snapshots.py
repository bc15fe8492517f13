"""Versioned tables: one commit log for all tables of a run, and a file index for copy-on-write.

A version is a small JSON file in ``_log`` that names, for each table, a
manifest: one Parquet row per data file and key column with the range of the
keys' hashes and a Bloom filter of them. Data files are never changed. A commit
writes new files and manifests first and then publishes all of them by one
rename to the next version's name, which fails if another writer has taken it.
Readers pin a version and see one state of all its tables.
"""

from __future__ import annotations

import json
import math
import posixpath
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a data file, about, unless a table says otherwise.
ROWS_PER_FILE = 1_000_000
#: Bits of one block of a Bloom filter (what a bitmap aggregate holds), bits set for a key, keys of a block.
BLOCK_BITS, BITS_PER_KEY, KEYS_PER_BLOCK = 32_768, 5, 3_000
#: Equal bins of the hash range, by which keys find the files whose range holds them: so many bits of the hash at
#: least and at most, and keys of a bin, about, between these.
BIN_BITS_MIN, BIN_BITS, KEYS_PER_BIN = 6, 12, 64
#: A file whose range holds so many of the keys asked for is opened without its filter, which would let some through by chance.
CROWD = 4_096
MANIFEST = "path string, key string, rows long, low long, high long, blocks int, block int, bits binary"


class Conflict(RuntimeError):
    """Another writer has published the version that this commit was to become."""


@dataclass(frozen=True)
class TableState:
    """Where a table's manifest is, what its rows look like, and a job's own notes on it."""

    manifest: str
    schema: str
    keys: tuple[str, ...]
    notes: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class Version:
    number: int
    tables: Mapping[str, TableState]


EMPTY = Version(0, {})


# ---- the log -------------------------------------------------------------------
def _log(root: str) -> str:
    return posixpath.join(root, "_log")


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def latest(spark: SparkSession, root: str) -> Version:
    """The newest published version; EMPTY where nothing has been published."""
    folder = _path(spark, _log(root))
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return EMPTY
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    numbers = [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]
    return at(spark, root, max(numbers)) if numbers else EMPTY


def at(spark: SparkSession, root: str, number: int) -> Version:
    """One version by its number."""
    path = posixpath.join(_log(root), f"{number:020d}.json")
    text = spark.read.text(path, wholetext=True).first()[0]
    content = json.loads(text)
    return Version(number, {n: TableState(t["manifest"], t["schema"], tuple(t["keys"]), t["notes"]) for n, t in content.items()})


def commit(spark: SparkSession, root: str, base: Version, changed: Mapping[str, TableState]) -> Version:
    """Publish ``base`` with some tables changed as the version after it.

    All tables change at once, by the rename of one file. If that version is
    there already the rename is refused and Conflict raised; nothing that
    readers see has changed then, and the files written for it are orphans.
    """
    tables = {**base.tables, **changed}
    content = {n: {"manifest": t.manifest, "schema": t.schema, "keys": list(t.keys), "notes": dict(t.notes)} for n, t in tables.items()}
    number = base.number + 1
    target = _path(spark, posixpath.join(_log(root), f"{number:020d}.json"))
    draft = _path(spark, posixpath.join(_log(root), f".{number}-{uuid.uuid4().hex}"))
    conf, jvm = spark._jsc.hadoopConfiguration(), spark._jvm
    fs = target.getFileSystem(conf)
    stream = fs.create(draft, False)
    stream.write(bytearray(json.dumps(content).encode()))
    stream.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
            fs.makeQualified(draft), fs.makeQualified(target), options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if fs.exists(target):
            raise Conflict(f"version {number} of {root} is taken") from error
        raise
    return Version(number, tables)


# ---- files and their index -----------------------------------------------------
def key_hash(key: Column) -> Column:
    return F.xxhash64(key)


def _bit(key: Column, k: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(f"bit-{k}")), F.lit(BLOCK_BITS)).cast("int")


def _block(key: Column, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), blocks).cast("int")


def write_files(df: DataFrame, folder: str, key: str, *, rows_per_file: int = ROWS_PER_FILE, spread: Sequence[str] = ()) -> str:
    """Write rows as files of about ``rows_per_file``, each a range of the key's hash; returns the folder.

    ``spread`` has columns that tell the rows of one key apart, so that a key
    with very many rows is several files (and tasks). ``df`` is read twice,
    first to count it: pass a stored table.
    """
    n = max(1, math.ceil(df.count() / rows_per_file))
    order = [key_hash(F.col(key)), *([F.xxhash64(*spread)] if spread else [])]
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(folder)
    return folder


def index_files(spark: SparkSession, folder: str, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """MANIFEST rows of the files in a folder, from their key columns alone.

    A file's filter is cut into blocks of KEYS_PER_BLOCK keys or so; all bits
    of a key lie in one block. Null keys are left out of filter and range.
    Keys of one type are read and dealt together, under the names of the files.
    """
    path, file = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file")
    rows = spark.read.schema(schema).parquet(folder)
    counted = rows.select(path, file).groupBy("path", "file").agg(F.count(F.lit(1)).alias("rows"))

    def of(keys: Sequence[str]) -> DataFrame:
        cells = rows.select(file, F.inline(F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).alias("value")) for k in keys])))
        held = cells.where(F.col("value").isNotNull()).groupBy("file", "key", "value").agg(F.lit(1).alias("one"))
        ranges = held.groupBy("file", "key").agg(
            F.min(key_hash(F.col("value"))).alias("low"), F.max(key_hash(F.col("value"))).alias("high"),
            F.ceil(F.count(F.lit(1)) / KEYS_PER_BLOCK).cast("int").alias("blocks"))
        bits = held.join(ranges, ["file", "key"]).select("file", "key", _block(F.col("value"), F.col("blocks")).alias("block"), F.explode(
            F.array(*[_bit(F.col("value"), k) for k in range(BITS_PER_KEY)])).alias("bit"))
        filters = bits.groupBy("file", "key", "block").agg(F.bitmap_construct_agg(F.col("bit")).alias("bits"))
        files = counted.withColumn("key", F.explode(F.array(*map(F.lit, keys))))
        whole = files.join(ranges, ["file", "key"], "left").join(filters, ["file", "key"], "left")
        return whole.select("path", "key", "rows", "low", "high", "blocks", "block", "bits")

    types = list(dict.fromkeys(schema[k].dataType for k in keys))
    return reduce(DataFrame.unionAll, [of([k for k in keys if schema[k].dataType == t]) for t in types])


def _bin(h: Column, bits: int = BIN_BITS) -> Column:
    return F.shiftright(h, 64 - bits)


def _wanted(values: DataFrame) -> DataFrame:
    """(value, h): the distinct values of a one-column table that are not null, with their hashes."""
    wanted = values.select(F.col(values.columns[0]).alias("value")).where("value IS NOT NULL").distinct()
    return wanted.withColumn("h", key_hash(F.col("value")))


def _bin_counts(wanted: DataFrame) -> dict[int, int]:
    """How many values each bin holds; at most 2**BIN_BITS short rows come to the driver."""
    return dict(map(tuple, wanted.groupBy(_bin(F.col("h")).alias("bin")).count().collect()))


def _bin_bits(n: int) -> int:
    return min(BIN_BITS, max(BIN_BITS_MIN, math.ceil(math.log2(max(1, n) / KEYS_PER_BIN))))


def _probed(manifest: DataFrame, key: str, wanted: DataFrame, n: int) -> DataFrame:
    """(path, value) of the files whose range and filter let a value through; ``n`` is about the number of values."""
    bits, own = _bin_bits(n), manifest.where((F.col("key") == key) & F.col("blocks").isNotNull())
    # A file is a row for each bin that it reaches, and what is counted before that says nothing of their number:
    # the hint keeps them from being taken for few and sent through the driver.
    reached = own.select("path", "low", "high", "blocks").distinct().withColumn(
        "bin", F.explode(F.sequence(_bin(F.col("low"), bits), _bin(F.col("high"), bits)))).hint("merge")
    inside = wanted.withColumn("bin", _bin(F.col("h"), bits)).join(reached, "bin").where(
        (F.col("h") >= F.col("low")) & (F.col("h") <= F.col("high")))
    asked = inside.select("path", "value", _block(F.col("value"), F.col("blocks")).alias("block"))
    met = asked.join(own.select("path", "block", "bits"), ["path", "block"])
    return met.where(reduce(and_, [_is_set(F.col("bits"), _bit(F.col("value"), k)) for k in range(BITS_PER_KEY)])).select("path", "value")


def files_holding(manifest: DataFrame, key: str, values: DataFrame) -> DataFrame:
    """(path, value): the files that may hold each value of the one-column table ``values``.

    A file that holds a value is always found; one that does not is found with
    the small chance of its Bloom filter. Files lie under the bins of the hash
    range that they reach, so a value meets only files whose range holds it.
    ``values`` is counted first: pass a stored table.
    """
    wanted = _wanted(values)
    return _probed(manifest, key, wanted, wanted.count())


def paths_holding(spark: SparkSession, manifest: DataFrame, sets: Sequence[tuple[str, DataFrame]]) -> list[str]:
    """The files that may hold a value of any of the sets (key column, one-column table of values), in order.

    Every file that holds one is found. Values are counted by bin first, and a
    file whose range holds CROWD of a set is found without asking its filter,
    so a file meets CROWD values or so of a set at most, however many there
    are. A file that was found for one set is not looked at for the next. The
    driver gets a short row for each bin and each file. Values are read twice:
    pass stored tables.
    """
    reach: dict[str, list[tuple[str, int, int]]] = {key: [] for key, _ in sets}
    held = manifest.where(F.col("key").isin(*reach) & F.col("blocks").isNotNull())
    for key, *file in held.select("key", "path", _bin(F.col("low")), _bin(F.col("high"))).distinct().collect():
        reach[key].append(file)
    found: set[str] = set()
    first = -1 << (BIN_BITS - 1)
    for key, values in sets:
        files = [f for f in reach[key] if f[0] not in found]
        wanted = _wanted(values)
        counts = _bin_counts(wanted) if files else {}
        before = [0, *accumulate(counts.get(b, 0) for b in range(first, -first))]
        # All values of the bins between those in which a range begins and ends lie inside it.
        inside = {path: before[max(high, low + 1) - first] - before[low + 1 - first] for path, low, high in files}
        found |= {path for path, n in inside.items() if n >= CROWD}
        rest = [path for path, low, high in files if path not in found and before[high + 1 - first] > before[low - first]]
        if rest:
            looked_at = manifest.join(_paths(spark, rest), "path", "left_semi")
            found |= {r[0] for r in _probed(looked_at, key, wanted, before[-1]).select("path").distinct().collect()}
    return sorted(found)


def _paths(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A table of paths, made without Python workers on the executors."""
    strings = spark._jvm.org.apache.spark.sql.Encoders.STRING()
    return DataFrame(spark._jsparkSession.createDataset(list(paths), strings), spark).toDF("path")


def _is_set(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, place % 8) == 1


# ---- tables --------------------------------------------------------------------
def manifest_of(spark: SparkSession, state: TableState) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(state.manifest)


def file_paths(spark: SparkSession, state: TableState) -> list[str]:
    """The data files of a table; as many as a listing of its folder would give the driver."""
    return [r[0] for r in manifest_of(spark, state).select("path").distinct().orderBy("path").collect()]


def read_files(spark: SparkSession, state: TableState, paths: Sequence[str]) -> DataFrame:
    schema = T.StructType.fromJson(json.loads(state.schema))
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, version: Version, name: str) -> DataFrame:
    """A table as of a version; later commits make no difference to it."""
    state = version.tables[name]
    return read_files(spark, state, file_paths(spark, state))


def new_data_folder(root: str, name: str) -> str:
    return posixpath.join(root, name, f"files-{uuid.uuid4().hex[:12]}")


def create_table(
    spark: SparkSession, root: str, name: str, df: DataFrame, keys: Sequence[str], *,
    rows_per_file: int = ROWS_PER_FILE, spread: Sequence[str] = (), notes: Mapping[str, object] | None = None,
) -> TableState:
    """Write all rows of a table, laid out by its first key, and its manifest; nothing is published yet."""
    folder = write_files(df, new_data_folder(root, name), keys[0], rows_per_file=rows_per_file, spread=spread)
    manifest = posixpath.join(root, name, f"manifest-{uuid.uuid4().hex[:12]}")
    index_files(spark, folder, df.schema, keys).write.parquet(manifest)
    return TableState(manifest, df.schema.json(), tuple(keys), dict(notes or {}))


def replace_files(
    spark: SparkSession, root: str, name: str, state: TableState, touched: Sequence[str], rows: DataFrame, *,
    rows_per_file: int = ROWS_PER_FILE, spread: Sequence[str] = (), notes: Mapping[str, object] | None = None,
) -> TableState:
    """The table with ``rows`` in place of the touched files; all other files stay as they are.

    ``rows`` may read the touched files: they are left in place for readers of
    earlier versions.
    """
    folder = write_files(rows, new_data_folder(root, name), state.keys[0], rows_per_file=rows_per_file, spread=spread)
    kept = manifest_of(spark, state).join(_paths(spark, touched), "path", "left_anti")
    fresh = index_files(spark, folder, T.StructType.fromJson(json.loads(state.schema)), state.keys)
    manifest = posixpath.join(root, name, f"manifest-{uuid.uuid4().hex[:12]}")
    kept.unionByName(fresh).write.parquet(manifest)
    return TableState(manifest, state.schema, state.keys, {**state.notes, **(notes or {})})
