"""The catalogue of queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Run
    covers: str
    sql: str | None = None


CATALOG: dict[str, Entry] = {}

# The test period, from 2024-01-01 to 2024-01-31 00:00 UTC; instant queries are evaluated at its end.
START_US = 1_704_067_200_000_000
END_US = 1_706_659_200_000_000


def add(name: str, run: Run, covers: str, sql: str | None = None) -> None:
    """Register a query. ``covers`` lists the survey items it answers."""
    if name in CATALOG:
        raise ValueError(f"{name} is registered twice")
    CATALOG[name] = Entry(run, covers, sql)


def _load() -> None:
    from tickharbor.plans import archive, config, dashboards, frames, payloads, quality, streams  # noqa: F401


def queries() -> dict[str, Run]:
    _load()
    return {name: entry.run for name, entry in CATALOG.items()}


def oracle_sql() -> dict[str, str]:
    _load()
    return {name: entry.sql for name, entry in CATALOG.items() if entry.sql}
