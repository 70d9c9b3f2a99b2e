"""Registry of the queries: a Spark callable and, where SQL can say it, the DuckDB statement it must agree with."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

DIGITS = 6


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return register


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles to a fixed number of digits: sums of doubles depend on their order in the last bits. Adding zero turns
    a negative zero into a plain one."""
    return df.select(*[(F.round(F.col(f"`{f.name}`"), digits) + F.lit(0.0)).alias(f.name)
                       if isinstance(f.dataType, DoubleType) else F.col(f"`{f.name}`") for f in df.schema.fields])
