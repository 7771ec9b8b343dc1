"""Registry of named queries: a Spark plan and, where SQL can say it, its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    def register(plan: Plan) -> Plan:
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = plan
        if sql is not None:
            SQL[name] = sql
        return plan

    return register
