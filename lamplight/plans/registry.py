"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: White space as the SQL patterns write it; the same characters as lamplight.functions.text.SPACE.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip_sql(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the equivalent SQL if it has one."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register
