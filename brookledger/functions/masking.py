"""Account-number masking."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brookledger.fixed_values import ACCOUNT_MASK

MASKED_PATTERN = r"^\*{4}\d{4}$"


def mask_account_number(number: Column) -> Column:
    """Keep the last four characters; a number masked already is unchanged.

    Of a number of four characters or fewer nothing is shown.
    """
    shown = F.when(F.length(number) > 4, F.right(number, F.lit(4))).when(number.isNotNull(), "")
    return F.when(number.rlike(MASKED_PATTERN), number).otherwise(
        F.concat(F.lit(ACCOUNT_MASK), shown)
    )


def is_masked(number: Column) -> Column:
    return number.rlike(MASKED_PATTERN)
