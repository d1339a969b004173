"""User functions named inside extra-column values and residual predicates.

Prefer a SQL function: Catalyst inlines its body, so it stays inside
whole-stage codegen.  A pandas function is the fallback for logic SQL cannot
state; it runs Arrow-batched, never row by row.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import SparkSession
from pyspark.sql.functions import pandas_udf


def register_sql_function(spark: SparkSession, name: str, params: str, returns: str, body: str) -> None:
    """``CREATE TEMPORARY FUNCTION name(params) RETURNS returns RETURN body``."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")


def register_pandas_function(spark: SparkSession, name: str, fn: Callable, return_type: str) -> None:
    """Register a vectorised (Series -> Series) function for use in SQL text."""
    spark.udf.register(name, pandas_udf(fn, return_type))
