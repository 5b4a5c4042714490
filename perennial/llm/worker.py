"""What a Python worker keeps from one task to the next."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable

_NAME = "perennial_worker_state"


def kept(key: str, make: Callable):
    """The worker's value for a key, made at its first use.

    Functions reach the workers by value, and their module's globals with
    them, anew for each task; a module of its own outlives the task.
    """
    state = sys.modules.setdefault(_NAME, types.ModuleType(_NAME)).__dict__
    if key not in state:
        state[key] = make()
    return state[key]
