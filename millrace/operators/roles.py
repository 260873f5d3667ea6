"""Names of the columns that composite operators work on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    origin: str = "origin"
    dest: str = "dest"
    day: str = "day"
    hhmm: str = "hhmm"
    carrier: str = "carrier"
    tail: str = "tail"
    outcome: str = "late"
    cancelled: str = "cancelled"
    distance: str = "distance"
    duration: str = "minutes"
