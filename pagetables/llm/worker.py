"""What a Python worker keeps from task to task."""

from __future__ import annotations

import ctypes
from collections.abc import Callable

_held: dict[tuple, object] = {}


def held(make: Callable, *key):
    """``make()``, made once per key while a worker uses it. Only the last is held, so stages don't add up in memory."""
    name = (make.__module__, make.__qualname__, *key)
    if name not in _held:
        release()
        _held[name] = make()
    else:
        _trim()
    return _held[name]


def release() -> None:
    """Let go of what earlier stages held; at the begin of tasks that hold nothing."""
    _held.clear()
    _trim()


def _trim() -> None:
    """Give memory that is free within the allocators back to the machine."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass
