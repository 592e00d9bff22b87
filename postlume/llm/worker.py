"""What the Python workers share: code by value, and objects kept for the life of the process."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable


def pickle_by_value(cloudpickle) -> None:
    """Let this subpackage travel inside the functions, for workers that cannot import it."""
    for name, module in list(sys.modules.items()):
        if name.startswith("postlume.llm.") and module is not None:
            cloudpickle.register_pickle_by_value(module)


def once(key: tuple, build: Callable[[], object]) -> object:
    """What ``build`` makes, made once in each worker process and reused by its later tasks."""
    kept = sys.modules.setdefault("_postlume_kept", types.ModuleType("_postlume_kept")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]
