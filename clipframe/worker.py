"""What a Python worker keeps from task to task."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Hashable
from typing import Any


def kept(name: str, version: Hashable, make: Callable[[], Any]) -> Any:
    """The object of that name and version, made once in each worker.

    Functions travel to the workers by value, so their own globals start anew with every
    task; this lives in a module of the worker. Another version takes the place of
    the one before.
    """
    holder = sys.modules.setdefault("_clipframe_kept", types.ModuleType("_clipframe_kept"))
    held = holder.__dict__.get(name)
    if held is None or held[0] != version:
        holder.__dict__[name] = held = (version, make())
    return held[1]
