"""Registry of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
#: named subqueries in dependency order
SUBQUERIES: dict[str, str] = {}


def with_subqueries(body: str) -> str:
    """Prefix ``body`` with every named subquery it reaches."""
    needed: set[str] = set()
    frontier = [body]
    while frontier:
        words = set(re.findall(r"\b[a-z_][a-z0-9_]*\b", frontier.pop()))
        for name in words & SUBQUERIES.keys() - needed:
            needed.add(name)
            frontier.append(SUBQUERIES[name])
    if not needed:
        return body
    parts = [f"{name} AS (\n{SUBQUERIES[name]}\n)" for name in SUBQUERIES if name in needed]
    return "WITH " + ",\n".join(parts) + "\n" + body


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def wrap(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_subqueries(sql)
        return fn
    return wrap
