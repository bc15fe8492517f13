"""What Python workers remember between tasks, given back when another operator's turn comes.

Spark reuses Python workers, so what one operator keeps there for its next task
(tables, words seen) would stay while later operators run. Nothing that is
remembered changes a result.
"""

from __future__ import annotations

import ctypes
import gc

_remembered: dict[str, object] = {}


def remembered_by(owner: str, cached) -> None:
    """Name a cached function (``functools.cache``) of an operator."""
    _remembered[owner] = cached


def turn_of(owner: str) -> None:
    """Clear what other operators remember in this worker, and return the memory to the system."""
    held = [cached for name, cached in _remembered.items() if name != owner and cached.cache_info().currsize]
    for cached in held:
        cached.cache_clear()
    if held:
        gc.collect()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # another C library: it frees what it frees
            pass
