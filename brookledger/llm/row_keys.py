"""Choosing rows of a table by a key computed from them, without carrying the other columns around."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brookledger.llm.shared_folder import written


def free_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted column names, lengthened where a table has them already (case aside)."""
    lower = {n.lower() for n in taken}
    out = []
    for name in wanted:
        while name.lower() in lower:
            name += "_"
        out.append(name)
    return out


def rows_of_keys(docs: DataFrame, doc_id: str, content: Column, wanted: DataFrame) -> DataFrame:
    """One row of ``docs`` for each (id, content) of ``wanted``, with the columns of ``docs``.

    wanted: columns id and content, without repeats; a null id is a value.
    Rows that repeat a key cannot be told apart by it. They, and only they, are
    made distinct by an aggregate; all others pass through semi-joins.
    """
    names = docs.columns
    id_key, content_key = free_names(names, "_key_id", "_key_content")
    keyed = docs.select(*names, F.col(doc_id).alias(id_key), content.alias(content_key))
    keys = wanted.select(F.col("id").alias(id_key), F.col("content").alias(content_key))
    counted = keyed.groupBy(id_key, content_key).agg(F.count(F.lit(1)).alias("rows"))
    repeated = written(counted.where("rows > 1").drop("rows"), "repeated-keys")

    def same(left: DataFrame, right: DataFrame) -> Column:
        return left[id_key].eqNullSafe(right[id_key]) & (left[content_key] == right[content_key])

    chosen = keyed.join(keys, same(keyed, keys), "left_semi")
    if repeated.isEmpty():
        return chosen.select(*names)
    single = chosen.join(repeated, same(chosen, repeated), "left_anti")
    several = chosen.join(repeated, same(chosen, repeated), "left_semi").dropDuplicates([id_key, content_key])
    return single.select(*names).unionAll(several.select(*names))


def position_in_files(docs: DataFrame) -> Column | None:
    """Where each row of stored Parquet files lies: larger for later rows of a file, and for later files of a write.

    A table that was written in an order is read in another, as Spark packs
    files by size; the number of the file and the row's own in it still tell
    the order. None for rows that come from no file.
    """
    try:
        docs.select("_metadata.row_index").schema  # noqa: B018 - resolves the column or raises
    except AnalysisException:
        return None
    number = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).try_cast("long")
    return F.shiftleft(F.coalesce(number, F.lit(0)), 32) + F.col("_metadata.row_index")


def numbered_copies(docs: DataFrame, doc_id: str, text: str, name: str, position: str) -> DataFrame:
    """``docs`` in the order of the files they are stored in, with the number (from 0) of each row among those of equal id and text.

    ``position`` is the row's place in the files; rows that come from no file
    have none and stay in the order they are read in.
    """
    at, content = free_names([*docs.columns, name, position], "_at", "_content")
    same = Window.partitionBy(doc_id, content).orderBy(at)
    place = position_in_files(docs)
    placed = docs.withColumns({
        position: F.lit(None).cast("long") if place is None else place,
        at: F.monotonically_increasing_id() if place is None else place,
        content: F.sha2(text, 256),
    })
    return placed.withColumn(name, F.row_number().over(same) - 1).orderBy(at).select(*docs.columns, name, position)
