"""Result-table bookkeeping (AL12, AL13)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def freshness(inventory: DataFrame, expected: DataFrame, runs: DataFrame, as_of: Column, hours: int = 48, run_start: Column | None = None) -> DataFrame:
    """AL12: fresh, late or missing per expected file, with the last status of the step that makes it.

    inventory: file, modified; expected: file, module; runs: module, run_status.
    """
    j = expected.join(inventory, "file", "left").join(runs, "module", "left")
    age = (F.unix_timestamp(as_of) - F.unix_timestamp("modified")) / 3600.0
    broken = F.col("run_status").isin("falhou", "pulado")
    stale = (broken & (F.col("modified") < run_start)) if run_start is not None else F.lit(False)
    status = F.when(F.col("modified").isNull(), "ausente").when(F.coalesce(stale, F.lit(False)), "atrasado").when(age <= hours, "fresco").otherwise("atrasado")
    return j.select("file", "module", F.round(age, 2).alias("age_hours"), status.alias("status"), F.coalesce("run_status", F.lit("")).alias("run_status"))


def validate_contracts(tables: Mapping[str, DataFrame], required: Mapping[str, Sequence[str]], ranges: Mapping[str, tuple[str, float, float]], spark) -> DataFrame:
    """AL13: missing tables and columns, empty tables and values outside their range, one row per check."""
    from .ordering import union_all

    parts = []
    fact = lambda t, c, ok, n: spark.range(1).select(F.lit(t).alias("table"), F.lit(c).alias("check"), F.lit(bool(ok)).alias("ok"), F.lit(int(n)).cast("bigint").alias("n"))
    for name, cols in required.items():
        if name not in tables:
            parts.append(fact(name, "present", False, 0))
            continue
        gone = [c for c in cols if c not in tables[name].columns]
        parts.append(fact(name, "columns", not gone, len(gone)))
        parts.append(tables[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), F.lit("rows").alias("check"), (F.col("n") > 0).alias("ok"), "n"))
    for name, (col, lo, hi) in ranges.items():
        if name in tables and col in tables[name].columns:
            bad = F.count_if(F.col(col).isNotNull() & ~F.col(col).between(lo, hi))
            parts.append(tables[name].agg(bad.alias("n")).select(F.lit(name).alias("table"), F.lit(f"range of {col}").alias("check"), (F.col("n") == 0).alias("ok"), "n"))
    return union_all(*parts)
