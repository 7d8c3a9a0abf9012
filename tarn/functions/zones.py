"""Zone transition tables as numpy arrays, with the version of the zone database they come from."""

from __future__ import annotations

import datetime as dt
from functools import lru_cache
from zoneinfo import ZoneInfo, available_timezones

import numpy as np

FIRST, LAST = -(50 * 365 + 12) * 86400, 4102444800  # 1920 to 2100
STEP = 7 * 86400

#: Hours from UTC of zone abbreviations that name one offset in common use.
ABBREVIATIONS = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "BST": 1, "CET": 1, "WEST": 1, "MEZ": 1, "CEST": 2, "EET": 2, "MESZ": 2,
    "EEST": 3, "MSK": 3, "PKT": 5, "IST": 5.5, "NPT": 5.75, "ICT": 7, "HKT": 8, "SGT": 8, "JST": 9, "KST": 9, "AEST": 10,
    "AEDT": 11, "NZST": 12, "NZDT": 13, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8,
    "PDT": -7, "AKST": -9, "AKDT": -8, "HST": -10,
}


def database_version() -> str:
    """Version of the zone database of this machine, such as 2025b."""
    from zoneinfo import TZPATH
    from pathlib import Path

    for folder in map(Path, TZPATH):
        for name in ("tzdata.zi", "+VERSION"):
            if (file := folder / name).exists():
                with file.open() as lines:
                    return lines.readline().replace("# version", "").strip()
    try:
        import tzdata

        return tzdata.IANA_VERSION
    except ImportError:
        return "none"


@lru_cache(None)
def zone_names() -> dict[str, str]:
    return {name.lower(): name for name in available_timezones()}


def _offset(zone: ZoneInfo, at: int) -> int:
    return int((dt.datetime(1970, 1, 1, tzinfo=dt.UTC) + dt.timedelta(seconds=at)).astimezone(zone).utcoffset().total_seconds())


@lru_cache(None)
def transitions(name: str, version: str) -> tuple[np.ndarray, np.ndarray] | None:
    """(instants, offsets): offsets[i] holds from instants[i - 1] until instants[i]; None for an unknown zone.

    version guards against machines that differ: it must be this machine's own.
    """
    if version != (here := database_version()):
        raise RuntimeError(f"zone database {here} here, {version} on the driver")
    if (known := zone_names().get(name.lower())) is None:
        return None
    zone = ZoneInfo(known)
    at, offset, instants, offsets = FIRST, _offset(zone, FIRST), [], [_offset(zone, FIRST)]
    while at < LAST:
        to = at + STEP
        if (after := _offset(zone, to)) != offset:
            low, high = at, to
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if _offset(zone, middle) == offset else (low, middle)
            instants.append(high)
            offsets.append(after)
            offset = after
        at = to
    return np.array(instants, np.int64), np.array(offsets, np.int64)


def local_to_utc(local: np.ndarray, name: str, version: str) -> np.ndarray | None:
    """Epoch seconds of wall-clock seconds; a doubled hour is read as its first pass, a skipped one by the offset before."""
    if (table := transitions(name, version)) is None:
        return None
    instants, offsets = table
    ends = instants + np.maximum(offsets[:-1], offsets[1:])
    return local - offsets[np.searchsorted(ends, local, side="right")]


def utc_to_local(second: np.ndarray, name: str, version: str) -> np.ndarray:
    """Wall-clock seconds, counted like epoch seconds, of instants."""
    instants, offsets = transitions(name, version)
    return second + offsets[np.searchsorted(instants, second, side="right")]
