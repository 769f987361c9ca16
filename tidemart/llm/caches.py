"""Caches of a Python worker. Workers outlive stages, so an operator that starts frees what others left."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable

import pyarrow as pa

_HELD: dict[str, Callable[[], object]] = {}


def hold(name: str, clear: Callable[[], object] | None = None) -> None:
    """From now on `name` is the one operator that holds caches or models in this process; `clear` lets go of them."""
    others = [k for k in _HELD if k != name]
    for k in others:
        _HELD.pop(k)()
    if others:
        release()
    _HELD[name] = clear or (lambda: None)


def release() -> None:
    """Gives freed memory of this process back to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)
