"""What a Python worker remembers between tasks.

Workers outlive their tasks and serve the next stages too, beside their executor's heap. An operator that
keeps something large for its next task says how to forget it; when a task of another operator
begins in that worker, it is forgotten.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa

_FORGET: dict[str, Callable[[], None]] = {}


def give_back() -> None:
    """Return what Arrow has set aside; a Python worker lives on after its task, beside its executor's heap."""
    pa.default_memory_pool().release_unused()


def remembered_by(owner: str, forget: Callable[[], None]) -> None:
    _FORGET[owner] = forget


def forget_others(owner: str | None = None) -> None:
    """Forget what operators other than ``owner`` remember in this worker."""
    for other in [o for o in _FORGET if o != owner]:
        _FORGET.pop(other)()
    give_back()
