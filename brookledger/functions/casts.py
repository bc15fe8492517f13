"""Tolerant typing of source text: a bad value becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Only ISO text is accepted. Without the guard Spark also reads '2023' as a
# date, which the contract does not allow.
_ISO_DATE_HEAD = r"^\d{4}-\d{2}-\d{2}"

# Characters besides white space after which a new word begins.
_WORD_BREAKS = r"""[!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>]"""


def text(name: str) -> Column:
    """Blanks trimmed; text of blanks only becomes '' and stays not null."""
    return F.trim(F.col(name))


def title(name: str) -> Column:
    """Trimmed text with each word capitalised.

    ``initcap`` knows words between blanks only. Text with other word breaks,
    such as a hyphen or a tab, is cut after each break and put together again.
    """
    words = F.split(F.lower(text(name)), rf"(?<={_WORD_BREAKS}|\s)")
    capitalised = F.transform(
        words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.substr(w, F.lit(2)))
    )
    unusual = text(name).rlike(rf"{_WORD_BREAKS}|[\s&&[^ ]]")
    return F.when(unusual, F.array_join(capitalised, "")).otherwise(F.initcap(text(name)))


def whole_number(name: str) -> Column:
    """Rounded half up to an integral decimal, so '720.6' reads as 721."""
    return F.col(name).try_cast("decimal(38,0)")


def money(name: str) -> Column:
    return F.col(name).try_cast("decimal(18,2)")


def ratio(name: str) -> Column:
    return F.col(name).try_cast("decimal(8,4)")


def iso_date(name: str) -> Column:
    return F.when(F.col(name).rlike(_ISO_DATE_HEAD), F.col(name).try_cast("date"))


def iso_timestamp(name: str) -> Column:
    """Wall-clock timestamp; a zone suffix in the text is ignored."""
    return F.when(
        F.col(name).rlike(_ISO_DATE_HEAD), F.col(name).try_cast("timestamp_ntz")
    )
