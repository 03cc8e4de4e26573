"""What a reused Python worker keeps between tasks, and how it gives memory back.

Spark keeps Python workers for later tasks, of other stages too. A stage may keep
one thing in a worker (ids of pieces that were seen, say); it goes when a stage
that keeps something else, or nothing, begins, so a worker never holds what two
stages gathered. Freed memory is returned to the system after each slice of a batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Hashable
from typing import Any

import pyarrow as pa

_kept: dict[Hashable, Any] = {}


def _trim() -> Callable[[int], int]:
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):  # another C library: its freed memory is its own affair
        return lambda pad: 0


_malloc_trim = _trim()


def release() -> None:
    """Return freed memory of Arrow and of the C library to the system."""
    pa.default_memory_pool().release_unused()
    _malloc_trim(0)


def keep(key: Hashable, make: Callable[[], Any]) -> Any:
    """What this worker keeps under ``key``, made if need be; anything else that it kept goes."""
    if key not in _kept:
        drop_kept()
        _kept[key] = make()
    return _kept[key]


def drop_kept() -> None:
    """Keep nothing."""
    if _kept:
        _kept.clear()
        release()
