"""Reference tables: population, coordinates, climate, class dictionary (SRC11-SRC15, SRC20, SRC21)."""
from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import numbers as N
from ..functions import text as X


def _integer(c: Column) -> Column:
    """'1.234.567', "1'234" -> number; thousands marks removed, decimal comma accepted."""
    s = F.regexp_replace(F.regexp_replace(c.cast("string"), "[.' ]", ""), ",", ".")
    return s.try_cast("double")


def population_long(df: DataFrame, code: str, state_col: str | None = None, state: str | None = None) -> DataFrame:
    """SRC11: one row per territory and year out of a table with one column per year."""
    years = [c for c in df.columns if re.fullmatch(r"(19|20)\d{2}", c)]
    if state_col is not None and state is not None:
        df = df.filter(F.upper(F.trim(state_col)) == state)
    text = df.select(X.code6(code).alias("code6"), *[F.col(f"`{y}`").cast("string").alias(y) for y in years])
    long = text.unpivot(["code6"], years, "year", "_p")
    return long.select("code6", F.col("year").cast("int").alias("year"), _integer(F.col("_p")).alias("population"))


def population_std(df: DataFrame) -> DataFrame:
    """SRC12: population table with guessed column names."""
    names = {c: re.sub(r"[^a-z0-9]+", "_", c.lower()) for c in df.columns}
    find = lambda *marks: next((c for m in marks for c, n in names.items() if m in n), None)
    code, year, pop = find("cod", "ibge"), find("ano", "year"), find("pop")
    return df.select(X.code6(F.col(f"`{code}`")).alias("code6"), F.col(f"`{year}`").try_cast("double").cast("int").alias("year"),
                     F.col(f"`{pop}`").try_cast("double").alias("population"))


def extend_population(base: DataFrame, extra: DataFrame) -> DataFrame:
    """SRC13: append the years the base does not have; one row per (code, year)."""
    years = base.select("year").distinct()
    both = base.unionByName(extra.join(years, "year", "left_anti").select(*base.columns))
    return both.filter(F.col("code6").isNotNull()).groupBy("code6", "year").agg(F.max("population").alias("population"))


def read_coordinates(df: DataFrame, lat_box: tuple[float, float], lon_box: tuple[float, float]) -> DataFrame:
    """SRC14: coordinates with guessed columns, repaired degrees, rows without a position dropped."""
    names = {c: re.sub(r"[^a-z0-9]+", "_", c.lower()) for c in df.columns}
    find = lambda test: next((c for c, n in names.items() if test(n)), None)
    name, lat, lon = find(lambda n: "municip" in n), find(lambda n: n.startswith("lat")), find(lambda n: n.startswith("lon"))
    code = find(lambda n: "ibge" in n or n.startswith("cod"))
    out = df.select(
        F.trim(F.col(f"`{name}`")).alias("name"),
        (X.code6(F.col(f"`{code}`")) if code else F.lit(None).cast("string")).alias("code"),
        N.fix_coord(F.col(f"`{lat}`"), "lat", lat_box).alias("lat"), N.fix_coord(F.col(f"`{lon}`"), "lon", lon_box).alias("lon"))
    return out.dropna(subset=["lat", "lon"])


def climate_daily(df: DataFrame, bounds: Mapping[str, tuple[float, float]], date: str = "date") -> DataFrame:
    """SRC15: daily means over the stations, implausible readings left out."""
    clean = [N.clip_null(F.col(c).try_cast("double") if dict(df.dtypes)[c] == "string" else F.col(c), lo, hi).alias(c)
             for c, (lo, hi) in bounds.items()]
    return df.filter(F.col(date).isNotNull()).select(F.col(date).alias("date"), *clean).groupBy("date").agg(*[F.avg(c).alias(c) for c in bounds])


def class_dictionary(spark: SparkSession) -> DataFrame:
    """SRC20: code, detailed label, grouped label."""
    return spark.createDataFrame(list(K.CLASS_DICTIONARY), "code string, class_detail string, class_group string")


def slice_years(df: DataFrame, lo: int, hi: int, dates: Sequence[str] = (), years: Sequence[str] = ()) -> DataFrame:
    """SRC21: rows of a period; the year comes from the first known date, else from a year column."""
    y = F.coalesce(*[F.year(c) for c in dates], *[F.col(c).try_cast("double").cast("int") if t == "string" else F.col(c).cast("int")
                                                  for c, t in ((c, dict(df.dtypes)[c]) for c in years)])
    return df.withColumn("slice_year", y).filter(F.col("slice_year").between(lo, hi))
