"""All queries of the core and their SQL."""

from __future__ import annotations

from tarn.plans import evidence, places, problems, reference


def queries() -> dict:
    return {**problems.QUERIES, **reference.QUERIES, **places.QUERIES, **evidence.QUERIES}


def oracles() -> dict[str, str]:
    return {**problems.ORACLES, **reference.ORACLES, **places.ORACLES, **evidence.ORACLES}
