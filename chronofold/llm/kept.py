"""What a Python worker keeps between its tasks: one model at a time.

Spark reuses its workers for later stages, so what one operator builds would lie beside what the next one needs.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

_KEPT: dict[Any, Any] = {}


def kept(key: Any, build: Callable[[], Any]) -> Any:
    """The model of this key. Any other that the worker keeps is dropped before it is built."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = build()
    return _KEPT[key]


def dropped() -> None:
    """For operators without a model: nothing is kept any longer."""
    _KEPT.clear()
