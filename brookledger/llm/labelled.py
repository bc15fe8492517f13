"""Bounded, repeatable samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the folds; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def sampled(rows: DataFrame, label: str, doc_id: str, per_label: int) -> DataFrame:
    """About ``per_label`` rows of each label (all, where there are fewer), by a hash of the id.

    Reads the labels once to count them; no sort and no shuffle of the texts.
    """
    counts = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    draw = F.pmod(F.xxhash64(F.col(doc_id), F.lit("sample")), F.lit(1_000_000)) / 1_000_000
    limit = F.lit(0.0)
    for value, n in counts.items():
        limit = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_label / n))).otherwise(limit)
    return rows.where(draw < limit)
