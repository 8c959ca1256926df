"""Where queries and their SQL are named."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.fixtures import dealt, duck, frame, laid, tasks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Inputs:
    """Views and tables of one folder by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return frame(self.spark, self.sf_dir, name)

    def laid(self, name: str, **by: str) -> DataFrame:
        """A view whose tables (names of `by`) are dealt out by a column first."""
        return laid(self.spark, self.sf_dir, name, by)

    def by_security(self) -> DataFrame:
        """The bars, each security's together."""
        return self.laid("bars", lineitem="l_suppkey")

    def dealt(self, df: DataFrame, *keys: str) -> DataFrame:
        """df, which has no more rows than lineitem, dealt out by its keys."""
        return dealt(df, tasks(self.spark, self.sf_dir, "lineitem"), *keys)


def query(name: str, oracle: str | None = None):
    """Registers a function of Inputs; oracle: DuckDB SQL with views and tables in braces."""

    def put(f: Callable[[Inputs], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Inputs(spark, sf_dir))
        if oracle:
            ORACLE[name] = duck(oracle)
        return f

    return put


def both(name: str, text: str, oracle: str | None = None) -> None:
    """A query whose SQL is the same on both engines, or has an oracle of its own."""
    from ..sources.fixtures import needs

    QUERIES[name] = lambda spark, sf_dir: spark.sql(text, **{n: frame(spark, sf_dir, n) for n in needs(text)})
    ORACLE[name] = duck(oracle or text)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*(F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes))
