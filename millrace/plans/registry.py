"""All queries outside the llm subpackage, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import contract_queries, contract_sql, declared_sql, general_problems, general_sql, validation_sql

Query = Callable[[SparkSession, str], DataFrame]

#: Functions of the query modules that are no queries of their own.
_PARTS = {"star_results", "orders_clauses", "lineitem_clauses", "customer_clauses"}


def queries() -> dict[str, Query]:
    problems = {n: f for n, f in vars(general_problems).items() if n[:1] == "p" and n[1:2].isdigit()}
    own = {n: f for n, f in vars(contract_queries).items() if callable(f) and n[0].islower() and n not in _PARTS and getattr(f, "__module__", "") == contract_queries.__name__}
    return problems | own


def oracle_sql() -> dict[str, str]:
    return general_sql.SQL | contract_sql.SQL | validation_sql.SQL | declared_sql.SQL
