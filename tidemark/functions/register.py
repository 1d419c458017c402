"""The engine's transforms as SQL functions of a session."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Name, parameters, result and body; bodies are built-in expressions, so calls stay in the JVM and are optimised.
FUNCTIONS = (
    ("squeezed", "v STRING", "STRING", r"trim(regexp_replace(v, r'\s+', ' '))"),
    ("fact_key", "v STRING", "STRING", "regexp_replace(lower(v), '[^a-z0-9]', '')"),
    ("semicolon_part", "v STRING, n INT", "STRING", "try_element_at(filter(split(v, ';'), x -> x <> ''), n)"),
    ("backoff_seconds", "attempts INT", "BIGINT", "CAST(least(30D * power(2D, greatest(attempts, 1) - 1), 3600D) AS BIGINT)"),
    ("percent_value", "v STRING", "STRING", "trim(regexp_replace(nullif(trim(v), ''), '%$', ''))"),
)


def register(spark: SparkSession, prefix: str = "tm_") -> list[str]:
    """Create the functions for this session; gives their names."""
    names = []
    for name, parameters, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}({parameters}) RETURNS {result} RETURN {body}")
        names.append(prefix + name)
    return names
