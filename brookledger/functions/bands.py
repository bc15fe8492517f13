"""Threshold bands and value maps; NULL always takes the default label."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _first_match(tests: list[tuple[Column, object]], default: object) -> Column:
    head, *rest = tests
    chain = F.when(head[0], F.lit(head[1]))
    chain = reduce(lambda acc, test: acc.when(test[0], F.lit(test[1])), rest, chain)
    return chain.otherwise(F.lit(default))


def band_at_least(value: Column, bands: tuple) -> Column:
    """Label of the first bound, from the top, that the value reaches."""
    bounds, default = bands
    return _first_match([(value >= F.expr(str(b)), label) for b, label in bounds], default)


def band_below(value: Column, bands: tuple) -> Column:
    """Label of the first bound, from the bottom, that the value stays under."""
    bounds, default = bands
    return _first_match([(value < F.expr(str(b)), label) for b, label in bounds], default)


def value_map(value: Column, mapping: Mapping[str, object], default: object) -> Column:
    return _first_match([(value == F.lit(k), v) for k, v in mapping.items()], default)


def is_true(condition: Column) -> Column:
    """Two-valued flag: an unknown condition counts as FALSE."""
    return F.coalesce(condition, F.lit(False))
