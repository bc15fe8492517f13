"""Running balances: do the balances of an account follow from its amounts?"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def balance_breaks(
    entries: DataFrame,
    *,
    account: str,
    order: list[str],
    amount: str,
    balance: str,
    chunk: str,
) -> DataFrame:
    """Entries whose balance is not the previous one plus their amount.

    ``order`` sorts the entries of an account without ties, and ``chunk`` is a
    column that never decreases in that order, such as the day. The previous
    entry is looked up inside (account, chunk), so an account with a third of
    all entries is spread over its chunks. Only the last balance of each chunk
    crosses to the next chunk: one row per account and chunk.
    """
    last = (
        entries.groupBy(account, chunk)
        .agg(F.max_by(balance, F.struct(*order)).alias("_last"))
    )
    by_account = Window.partitionBy(account).orderBy(chunk)
    carried = last.select(
        account, chunk, F.lag("_last").over(by_account).alias("_carried")
    )
    in_chunk = Window.partitionBy(account, chunk).orderBy(*order)
    chained = entries.withColumns(
        {
            "_previous": F.lag(balance).over(in_chunk),
            "_first": F.row_number().over(in_chunk) == 1,
        }
    ).join(carried, [account, chunk], "left")
    previous = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_previous"))
    return (
        chained.withColumn("expected_balance", previous + F.col(amount))
        .filter(F.col(balance) != F.col("expected_balance"))
        .select(*entries.columns, "expected_balance", F.lit("ARITHMETIC_FAILURE").alias("reason_code"))
    )
