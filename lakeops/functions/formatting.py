"""Small value formatters of the audit rows (SCL-7..SCL-10)."""

from __future__ import annotations

import datetime as dt

MAX_ERROR_CHARS = 1000


def _clock(seconds: float) -> tuple[int, int, int]:
    """Whole hours, minutes and seconds."""
    minutes, rest = divmod(int(seconds), 60)
    return (*divmod(minutes, 60), rest)


def hms(seconds: float | None) -> str | None:
    """Elapsed time as ``HH:MM:SS``; hours may exceed 99 (SCL-7)."""
    return None if seconds is None else ":".join(f"{part:02}" for part in _clock(seconds))


def hms_words(seconds: float | None) -> str | None:
    """Elapsed time as ``HH Hour MM Minutes SS Seconds`` (SCL-8)."""
    units = ("Hour", "Minutes", "Seconds")
    return None if seconds is None else " ".join(f"{part:02} {unit}" for part, unit in zip(_clock(seconds), units))


def batch_number(group_id: int, at: dt.datetime | None = None) -> str:
    """``<epoch seconds>_<group>`` (SCL-9); pass ``at`` for reproducible runs."""
    at = at or dt.datetime.now(dt.timezone.utc)
    return f"{int(at.timestamp())}_{group_id}"


def truncate_error(message: object, limit: int = MAX_ERROR_CHARS) -> str:
    """Error text cut to ``limit`` characters (SCL-10)."""
    return str(message)[:limit]
