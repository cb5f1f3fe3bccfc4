"""Query registry: a Spark callable and, where SQL can say it, the same result in SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Comparable output: doubles rounded, dates as text, booleans as 0/1."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.round(c.cast("double"), digits)
        elif isinstance(f.dataType, (T.DateType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.BooleanType):
            c = c.cast("int")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a query; `doubles` names the columns the SQL side rounds."""

    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: tidy(fn(spark, sf_dir))
        if sql is not None:
            names = doubles.split()
            body = sql.strip().rstrip(";")
            if names:
                rounded = ", ".join(f"round(CAST({n} AS DOUBLE), 6) AS {n}" for n in names)
                body = f"SELECT * REPLACE ({rounded}) FROM ({body}) AS q"
            ORACLES[name] = body
        return fn

    return wrap
