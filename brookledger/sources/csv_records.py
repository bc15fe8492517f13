"""CSV records with quoted line breaks, read from many splits of a file at once.

A line break ends a record unless it stands inside quotes, and whether it does
depends on all quotes before it in the file. So the physical lines are read in
parallel and grouped into blocks; one pass counts each block's lines and the
parity of its quotes, a prefix scan over the blocks of a file gives the state
and line number each begins with, and then all blocks are cut into records at
once. Lines of blocks in which no quote is open, which are nearly all, go
through without a shuffle; only the others are put in order and joined up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brookledger.fixed_values import SOURCE_COLUMNS
from brookledger.sources.bronze import BAD_RECORD, CSV_FILES, csv_options, extract_schema
from brookledger.sources.tables import broadcast_if_small, stage

#: Lines of a block: 2 to this power, at most.
BLOCK_LINES_BITS = 16
#: Blocks whose 50-byte rows are broadcast; more of them are joined like any table.
BROADCAST_BLOCKS = 200_000
#: Lines of a record. A quote left open runs to the end of its file: beyond this its lines are bad records of their own.
MAX_LINES = 1000
BLOCK = ["file", "start", "block"]


def _plain(path: Column) -> Column:
    """A path as listings spell it; rows have it encoded like an address."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def physical_lines(spark: SparkSession, path: str, *, glob: str = CSV_FILES) -> DataFrame:
    """(path, file, start, block, at, quotes, value): the lines of each split, ``at`` in their order.

    A line belongs to the split it begins in. ``at`` rises within a split;
    it is the same in every reading under the same settings.
    """
    lines = spark.read.option("lineSep", "\n").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(path)
    return lines.select(
        _plain(F.col("_metadata.file_path")).alias("path"), F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value",
    ).select(
        "path", "file", "start", F.shiftright("at", BLOCK_LINES_BITS).alias("block"), "at",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"), "value")


def block_states(lines: DataFrame) -> DataFrame:
    """For each block: its first ``at``, its first line's number, whether it begins inside quotes, whether quotes are open in it."""
    odd = F.col("quotes") % 2
    counted = lines.groupBy(*BLOCK).agg(
        F.min("at").alias("first_at"), F.count(F.lit(1)).alias("n"), F.sum(odd).alias("odd"))
    before = Window.partitionBy("file").orderBy("start", "block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select(
        *BLOCK, "first_at", (F.coalesce(F.sum("n").over(before), F.lit(0)) + 1).alias("first_line"),
        (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"), "odd",
    ).withColumn("open", F.col("inside") | (F.col("odd") > 0)).drop("odd")


def records(spark: SparkSession, path: str, *, glob: str = CSV_FILES, max_lines: int = MAX_LINES) -> DataFrame:
    """(path, line, record, too_long): each record's text and the number (from 1) of its first line.

    Records keep their inner line breaks; blank lines are none. A record of more
    than ``max_lines`` lines is not joined up: its lines come one by one, marked
    as too long. The first record of a file, the header, is among them.
    """
    lines = physical_lines(spark, path, glob=glob)
    states = stage(block_states(lines), "csv-blocks")
    placed = lines.join(broadcast_if_small(states, BROADCAST_BLOCKS), BLOCK).withColumn(
        "line", F.col("first_line") + F.col("at") - F.col("first_at"))
    plain = placed.where(~F.col("open")).select("path", "line", F.col("value").alias("record"), F.lit(False).alias("too_long"))
    joined = _joined_up(placed.where("open"), max_lines)
    whole = plain.unionAll(joined).withColumn("record", F.regexp_replace("record", r"\r$", ""))
    return whole.where(F.trim("record") != "")


def _joined_up(placed: DataFrame, max_lines: int) -> DataFrame:
    """The records of blocks in which quotes are open."""
    in_block = Window.partitionBy(*BLOCK).orderBy("at")
    quotes = F.coalesce(F.sum("quotes").over(in_block.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = F.when((quotes + F.col("inside").cast("int")) % 2 == 0, F.col("line"))
    marked = placed.select("path", *BLOCK, "at", "line", "value", begins.alias("begins")).withColumn(
        "begun", F.max("begins").over(in_block.rowsBetween(Window.unboundedPreceding, 0)))
    marked = stage(marked.select("path", *BLOCK, "line", "value", "begun"), "csv-open-lines")

    # A block that begins inside quotes goes on with the last record of the blocks before it.
    last = marked.groupBy(*BLOCK).agg(F.max("begun").alias("last_begun"))
    before = Window.partitionBy("file").orderBy("start", "block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*BLOCK, F.last("last_begun", ignorenulls=True).over(before).alias("carried"))
    owned = marked.join(carried, BLOCK).withColumn("first", F.coalesce("begun", "carried"))
    sizes = owned.groupBy("file", "first").agg(F.count(F.lit(1)).alias("n_lines"))
    sized = owned.join(sizes, ["file", "first"])
    fitting = sized.where(F.col("n_lines") <= max_lines).groupBy("path", F.col("first").alias("line")).agg(
        F.array_sort(F.collect_list(F.struct("line", "value"))).alias("parts"))
    return fitting.select(
        "path", "line", F.array_join(F.col("parts.value"), "\n").alias("record"), F.lit(False).alias("too_long"),
    ).unionAll(
        sized.where(F.col("n_lines") > max_lines).select("path", "line", F.col("value").alias("record"), F.lit(True).alias("too_long")))


def parsed(found: DataFrame, entity: str) -> DataFrame:
    """The entity's columns of each record but the header, BAD_RECORD, path and line; as ``bronze.read_extract`` parses them.

    A record with too few or too many fields, or one that is too long, has its
    text in BAD_RECORD.
    """
    fields = F.from_csv(F.col("record"), extract_schema(entity).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), csv_options())
    bad = F.when(F.col("too_long"), F.col("record")).otherwise(F.col(f"fields.{BAD_RECORD}"))
    rows = found.where((F.col("line") > 1) | F.col("too_long")).withColumn("fields", fields)
    return rows.select(
        *[F.when(~F.col("too_long"), F.col(f"fields.{c}")).alias(c) for c in SOURCE_COLUMNS[entity]], bad.alias(BAD_RECORD), "path", "line")


def n_fields(record: Column) -> Column:
    """Fields of a record: separators outside quotes, and one."""
    bare = F.regexp_replace(record, '"([^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def load_results(files: DataFrame, rows: DataFrame, entity: str) -> DataFrame:
    """One row a file: rows parsed and loaded, errors seen, the first error with line and column, and a status.

    ``files`` has a column ``path`` (a listing, which leaves out files of no
    bytes), so files without a record have a row too; ``rows`` come from ``parsed``. A record with n fields too few
    fails at the first column it lacks, one with too many at the first that it
    has beyond the table's.
    """
    names = SOURCE_COLUMNS[entity]
    n = n_fields(F.col(BAD_RECORD))
    column = (F.least(n, F.lit(len(names))) + 1).cast("int")
    text = F.when(n == len(names), F.lit("Record has too many lines")).otherwise(F.format_string(
        f"Record has %d columns, the table has {len(names)}", n.cast("int")))
    error = F.when(F.col(BAD_RECORD).isNotNull(), F.struct("line", column.alias("column"), text.alias("text")))
    counted = rows.groupBy("path").agg(
        F.count(F.lit(1)).alias("parsed"), F.count(BAD_RECORD).alias("errors"), F.min(error).alias("first"))
    known = files.select("path").join(counted, "path", "left")
    errors, all_rows = F.coalesce("errors", F.lit(0)), F.coalesce("parsed", F.lit(0))
    status = F.when(errors == 0, "LOADED").when(errors < all_rows, "PARTIALLY_LOADED").otherwise("LOAD_FAILED")
    return known.select(
        "path", status.alias("status"), all_rows.alias("rows_parsed"), (all_rows - errors).alias("rows_loaded"), errors.alias("errors_seen"),
        F.col("first.text").alias("first_error"), F.col("first.line").alias("first_error_line"),
        F.col("first.column").alias("first_error_column"),
        F.get(F.array(*map(F.lit, names)), F.col("first.column") - 1).alias("first_error_column_name"))
