"""Memory of Python workers, which Spark keeps from one task to the next."""

from __future__ import annotations

import ctypes
import sys
import types

import pyarrow as pa

# Modules of the worker process are the only place that outlives a task: the package travels with it.
_KEPT = "_civicloom_kept"


def kept(name: str, default):
    """What earlier tasks of this worker process have kept under this name, or else ``default``."""
    memory = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT))
    return memory.__dict__.setdefault(name, default)


def let_go() -> None:
    """Forget what tasks before have kept and give all freed memory back to the machine: an
    operator that needs none of it begins its tasks so. Results never depend on what is kept."""
    sys.modules.pop(_KEPT, None)
    pa.default_memory_pool().release_unused()
    # Only the GNU library has it; others give memory back by themselves.
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)
