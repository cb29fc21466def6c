"""Named queries over the test tables, each with the SQL it is checked against."""

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelspark.testtables import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SQL_VIEWS: dict[str, str] = dict(VIEWS)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name, with its SQL if there is any."""

    def register(function: Query) -> Query:
        name = function.__name__
        QUERIES[name] = function
        if sql:
            ORACLES[name] = with_views(sql)
        return function

    return register


def with_views(sql: str) -> str:
    """The SQL with the views it uses as common table expressions, in order of need."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name, body in SQL_VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                needed.append(name)

    visit(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{name} as ({SQL_VIEWS[name]})" for name in needed)
    return f"with {views}\n{sql}"


# --- SQL text shared by the checks -----------------------------------------


def sql_round2(value: str) -> str:
    """A double rounded half-up to two places by its decimal text, as Spark rounds."""
    return f"cast(cast(cast({value} as varchar) as decimal(38, 2)) as double)"


def sql_percent(part: str, whole: str) -> str:
    return sql_round2(f"cast({part} as double) / nullif({whole}, 0) * 100")


def sql_mean(percent: str) -> str:
    """Exact mean of two-place percentages, rounded half away from zero."""
    total, count = f"sum(cast(round({percent} * 100) as hugeint))", f"count({percent})"
    return (
        f"(case when {total} < 0 then -1 else 1 end"
        f" * ((2 * abs({total}) + nullif({count}, 0)) // (2 * nullif({count}, 0)))) / 1e2"
    )
