"""Source names, which the models put into their column and table names."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Names:
    """``track`` records activities, ``body`` records sleeps, workouts and cycles."""

    track: str = "track"
    body: str = "body"


DEFAULT_NAMES = Names()
