"""Named queries, each with the operators it covers and its check SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from touchline.catalog import fixtures


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}

# Common table expressions of the check SQL, by name.
CTES: dict[str, str] = {name: fixtures.duckdb_text(name) for name in fixtures.SQL}


def query(name: str, covers: str, sql: str | None = None):
    """Register a query; ``covers`` lists inventory ids."""
    def register(run):
        QUERIES[name] = Query(name, tuple(covers.split()), run, with_ctes(sql) if sql else None)
        return run
    return register


def _named(text: str) -> list[str]:
    return [n for n in re.findall(r"\b(?:fx|q)_\w+", text) if n in CTES]


def with_ctes(body: str) -> str:
    """Put the expressions a statement names, and those they name, before it."""
    order: list[str] = []

    def visit(name):
        if name in order:
            return
        for other in _named(CTES[name]):
            if other != name:
                visit(other)
        order.append(name)

    for name in _named(body):
        visit(name)
    if not order:
        return body.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in order) + "\n" + body.strip()


def rnd(expression: str, digits: int) -> str:
    """Round half up on the decimal value, as Spark rounds doubles."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


def first_per_key(source: str, keys: str, columns: str, where: str = "true", order: str = "") -> str:
    """First row per key by ``order``, then by all columns, missing values first."""
    names = [c.strip() for c in columns.split(",")]
    by = ", ".join([order] * bool(order) + [f"{c} NULLS FIRST" for c in names])
    return (f"SELECT {keys}, {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {by}) AS rn"
            f" FROM {source} WHERE {where}) ranked WHERE rn = 1")
