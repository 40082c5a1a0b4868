"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.registry.inputs import CTES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def with_inputs(body: str, *names: str) -> str:
    """Put the stand-in inputs in front of a query as common table expressions."""
    body = body.strip()
    if not names:
        return body
    head = "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in names)
    if body[:5].upper() == "WITH ":
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_inputs(sql, *uses)
        return fn

    return register
