"""Values that live as long as a Python worker."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable
from typing import Any


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """The value of a key, made once in each Python worker and shared by all its tasks.

    Functions reach the workers by value, so a global of this package would be made
    anew in every task; a module of the worker's own keeps it.
    """
    store = sys.modules.setdefault("_worker_store", types.ModuleType("_worker_store"))
    if not hasattr(store, key):
        setattr(store, key, make())
    return getattr(store, key)
