"""Registry of the engine's own queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its oracle."""

    def put(f: Query) -> Query:
        _queries[name] = f
        if sql:
            _sql[name] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _load() -> None:
    from tidemark.plans import detail_queries, flow_queries, graph_queries, more_queries, pass_queries, payload_queries, section_queries, source_queries, strategy_queries, study_queries, text_queries, value_queries  # noqa: F401  they register themselves


def queries() -> dict[str, Query]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
