"""Registration of queries and their SQL twins, and readers of the benchmark tables."""
from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the decorated function under its name; without `sql` only rows are checked."""
    def register(function: Query) -> Query:
        @wraps(function)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(tune(spark), sf_dir)

        if function.__name__ in QUERIES:
            raise ValueError(f"query {function.__name__} is registered twice")
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLES[function.__name__] = sql
        return run
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def padded(prefix: str, column: str | Column, width: int) -> Column:
    """Prefix and a number of at least `width` digits: a longer number is kept whole, as two ids must not become one."""
    return F.concat(F.lit(prefix), F.lpad(text(column), F.greatest(F.lit(width), F.length(text(column))), F.lit("0")))


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Decimals leave a query as doubles, the same type the SQL twin gives."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})
