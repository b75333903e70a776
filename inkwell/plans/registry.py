"""All core queries and their SQL, gathered from the query modules."""

from __future__ import annotations

import importlib
from collections.abc import Callable

MODULES = ("audits", "calendars", "repairs", "retrieval", "texts", "answers", "pages", "serving", "files")
_FOUND: dict[str, tuple[Callable, str | None]] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a query function under its own name, with the SQL that gives the same rows if there is one."""

    def add(f: Callable) -> Callable:
        assert f.__name__ not in _FOUND, f.__name__
        _FOUND[f.__name__] = f, sql
        return f

    return add


def _load() -> None:
    for m in MODULES:
        importlib.import_module(f"inkwell.plans.{m}")


def queries() -> dict[str, Callable]:
    """Core queries by name."""
    _load()
    return {k: f for k, (f, _) in _FOUND.items()}


def oracle_sql() -> dict[str, str]:
    """SQL by query name."""
    _load()
    return {k: s for k, (_, s) in _FOUND.items() if s}
