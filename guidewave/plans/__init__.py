"""Compositions of operators: the screen run and the registered queries."""

from __future__ import annotations

import importlib
import pkgutil


def _load() -> None:
    from . import screen_tables  # noqa: F401  (defines the shared subqueries first)

    for module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
        if module.startswith("queries_"):
            importlib.import_module(f"{__name__}.{module}")


def all_queries() -> dict:
    _load()
    from .registry import QUERIES

    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    from .registry import ORACLES

    return dict(ORACLES)
