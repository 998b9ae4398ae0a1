"""What a Python worker keeps from one task to the next, and what it gives back."""

from __future__ import annotations

import ctypes
import hashlib
import sys
from collections.abc import Callable, Iterator
from types import ModuleType
from typing import Any

import pyarrow as pa

_PLACE = "gridstats_worker_state"


def _values() -> dict[str, tuple[bytes, Any]]:
    return sys.modules.setdefault(_PLACE, ModuleType(_PLACE)).__dict__.setdefault("values", {})


def kept(name: str, content: str, make: Callable[[str], Any]) -> Any:
    """``make(content)``, made once in a worker process for each ``name`` while ``content`` stays the same.

    Functions travel to a worker with each job and have no globals that last, so the value is held by a module of the
    process. One value is held for each name, until ``tidied`` work that does not name it runs in the process.
    """
    place = _values()
    mark = hashlib.sha256(content.encode()).digest()
    if name not in place or place[name][0] != mark:
        place[name] = mark, make(content)
    return place[name][1]


def tidied(
    work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work``, after which the worker gives its free memory back: workers stay alive beside the stages that follow, and
    what their allocators hold would count against the executor all the time. Before it, the worker drops what other work
    ``kept``; only the value named ``keeps`` stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = _values()
        for name in [n for n in values if n != keeps]:
            del values[name]
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
        if trim is not None:
            trim(0)

    return run
