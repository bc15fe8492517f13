"""Writing tables, and staging intermediate results where a plan should end."""

from __future__ import annotations

import contextlib
import posixpath
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Item = TypeVar("Item")
Result = TypeVar("Result")


_own_folder: list[str] = []


def use_folder(folder: str) -> None:
    """Name the folder for sessions of this process that set no spark.checkpoint.dir."""
    _own_folder[:] = [folder]


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as spark.checkpoint.dir names it.

    Where the setting is missing, it is the one that ``use_folder`` named.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or next(iter(_own_folder), None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return posixpath.join(folder, "brookledger", spark.sparkContext.applicationId)


_open_scopes: list[list[str]] = []


def new_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing else uses."""
    path = posixpath.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex[:12]}")
    for scope in _open_scopes[-1:]:
        scope.append(path)
    return path


@contextlib.contextmanager
def staged_copies_removed(spark: SparkSession) -> Iterator[None]:
    """Delete the copies staged inside the block when it ends.

    For jobs that write all their output inside it; what they return must not
    read a staged copy. Jobs of one driver open such blocks one at a time.
    """
    scope: list[str] = []
    _open_scopes.append(scope)
    try:
        yield
    finally:
        _open_scopes.remove(scope)
        for folder in scope:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once and go on from the stored copy.

    Used where several branches read one expensive result. The copy outlives
    executors, and later reads prune its columns.
    """
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(
    spark: SparkSession, work: Callable[[Item], Result], items: Iterable[Item]
) -> list[Result]:
    """Run independent Spark jobs at the same time, one thread each.

    They must not write to one folder. The first failure is raised after the
    others have finished.
    """
    listed = list(items)
    with ThreadPoolExecutor(max_workers=max(1, len(listed))) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), listed))


def session_of(tables: Mapping[str, DataFrame]) -> SparkSession:
    return next(iter(tables.values())).sparkSession


def write_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    """Write independent tables side by side, one folder each under ``root``."""

    def write(name: str) -> None:
        tables[name].write.mode(mode).parquet(posixpath.join(root, name))

    side_by_side(session_of(tables), write, tables)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(posixpath.join(root, name))


def stage_all(tables: Mapping[str, DataFrame], label: str) -> dict[str, DataFrame]:
    """``stage`` for several independent tables at once."""
    spark = session_of(tables)
    root = new_folder(spark, label)
    write_tables(tables, root)
    return {
        name: spark.read.schema(df.schema).parquet(posixpath.join(root, name))
        for name, df in tables.items()
    }


def add_missing_columns(df: DataFrame, defaults: Mapping[str, tuple[T.DataType, object]]) -> DataFrame:
    """Schema growth: columns the table lacks come with their default value."""
    return df.withColumns(
        {
            name: F.lit(value).cast(dtype)
            for name, (dtype, value) in defaults.items()
            if name not in df.columns
        }
    )


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark a side for broadcast only after counting that it is small enough.

    Beyond the bound it is returned as it is and joined like any table.
    """
    return F.broadcast(df) if df.count() <= max_rows else df


# ---- catalog tables -------------------------------------------------------
def publish(spark: SparkSession, database: str, name: str, path: str) -> None:
    """Make a stored table readable by name, or move the name to a new version.

    Moving the name is the last step of a rewrite: readers see the old table
    until then, and the files they are reading stay in place. Columns the new
    version adds are added to the table first.
    """
    table = f"`{database}`.`{name}`"
    if spark.catalog.tableExists(f"{database}.{name}"):
        known = spark.table(table).columns
        added = [f for f in spark.read.parquet(path).schema if f.name not in known]
        if added:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(f"{database}.{name}")
    else:
        spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{path}'")


def publish_bucketed(
    df: DataFrame, database: str, name: str, path: str, key: str, buckets: int
) -> None:
    """Store a table hashed and sorted by a key, and make it readable by name.

    Tables of one key and bucket count join and group on it without a shuffle,
    which pays for tables joined every day, such as a dimension and the Silver
    table it is kept up from. Each bucket is written by one task, so the key
    has to be one whose values are all rare, such as a business id.
    """
    (
        df.repartition(buckets, key)
        .write.bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(f"`{database}`.`{name}`")
    )


def table_listing(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables in a database."""
    return spark.sql(f"SHOW TABLES IN `{database}`").select("namespace", "tableName")


def required_tables(spark: SparkSession, database: str, names: list[str]) -> DataFrame:
    """Which of the named tables exist."""
    wanted = spark.range(1).select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("table_name")
    )
    present = table_listing(spark, database).select(
        F.col("tableName").alias("table_name"), F.lit(True).alias("found")
    )
    return wanted.join(present, "table_name", "left").select(
        "table_name", F.coalesce("found", F.lit(False)).alias("table_exists")
    )
