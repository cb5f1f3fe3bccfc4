"""Sorting, top-k, deduplication and reshaping (OR1-OR4, ST1, ST2, ST4, WN11)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import fixed as K


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Ordered drop-duplicates as an aggregation: partial results are merged before the shuffle,
    so a key that holds much of the table costs no more than any other."""
    rest = [c for c in df.columns if c not in keys]
    ranked = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], *rest)
    kinds = dict(df.dtypes)
    # rows of a key are brought together by sorting: a number first decides nearly every comparison of long texts
    lead = [F.xxhash64(*keys).alias("_lead")] if all(kinds[k] == "string" for k in keys) else []
    best = df.groupBy(*lead, *keys).agg(F.min(ranked).alias("_b"))
    return best.select(*keys, *[F.col(f"_b.{c}").alias(c) for c in rest]).select(*df.columns)


def severity_rank(c: Column | str, order: Mapping[str, int] = K.SEVERITY_ORDER) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    m = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])
    return F.coalesce(m[col], F.lit(0))


def order_by_severity(df: DataFrame, severity: str = "severity", then: Sequence[Column] = ()) -> DataFrame:
    """OR1: most severe first, then the given keys."""
    return df.orderBy(severity_rank(severity).desc(), *then)


def top_queue(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """OR2: head of a queue (Spark keeps n rows per task, then merges)."""
    return df.orderBy(*order).limit(n)


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    """WN11: n rows per group. The rank filter is pushed below the shuffle (window group limit)."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def top_categories(df: DataFrame, col: str, n: int = 12, min_n: int = 10, other: str | None = None) -> DataFrame:
    """OR3: the n most frequent categories with at least min_n rows; the rest dropped or folded."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("category")).count()
    counts = counts.withColumnRenamed("count", "n")
    top = counts.filter(F.col("n") >= min_n).orderBy(F.col("n").desc(), "category").limit(n)
    if other is None:
        return top
    kept = counts.join(top.select(F.col("category").alias("_top")), F.col("category") == F.col("_top"), "left")
    return kept.groupBy(F.coalesce("_top", F.lit(other)).alias("category")).agg(F.sum("n").alias("n"))


def worst_k(long: DataFrame, k: int, indicator: str = "indicator", unit: str = "slice", value: str = "value",
            ascending: bool = True) -> DataFrame:
    """OR4: the k worst units of every indicator."""
    v = F.col(value)
    order = v.asc() if ascending else v.desc()
    w = W.partitionBy(indicator).orderBy(order, unit)
    return (
        long.filter(v.isNotNull()).withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    )


def union_all(*dfs: DataFrame) -> DataFrame:
    """ST1: rows of tables with different columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def dedup_queue(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """ST2: first row per (type, place, evidence) in queue order."""
    return first_per_key(df, keys, order)


def to_wide(long: DataFrame, keys: Sequence[str], indicators: Sequence[str]) -> DataFrame:
    """ST4: one column per indicator (names are given, so no pass to discover them)."""
    return long.groupBy(*keys).pivot("indicator", list(indicators)).agg(F.first("value", ignorenulls=True))


def to_long(wide: DataFrame, keys: Sequence[str], indicators: Sequence[str]) -> DataFrame:
    return wide.unpivot(list(keys), list(indicators), "indicator", "value")


def running_total(df: DataFrame, order: Sequence[str], amount: Column, out: str, parts: int | None = None) -> DataFrame:
    """Cumulative sum over the whole table in the order of the columns, which must be unique; no task sees all rows.

    The rows are range-partitioned and stored, each range is summed by itself, and the totals of the ranges before
    it, one number per range, are added.
    """
    from .filters import fold

    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = fold(df.repartitionByRange(n, *order).withColumns({"_range": F.spark_partition_id(), "_amount": amount}))
    totals = ranged.groupBy("_range").agg(F.sum("_amount").alias("t"))
    before = totals.agg(F.sort_array(F.collect_list(F.struct("_range", "t"))).alias("r")).select(
        F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.aggregate(F.filter("r", lambda x: x["_range"] < i), F.lit(0).cast("long"), lambda acc, x: acc + x["t"]))).scalar()
    own = F.sum("_amount").over(W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0))
    return ranged.withColumn(out, own + F.get(before, F.col("_range"))).drop("_range", "_amount")


def numbered(df: DataFrame, order: Sequence[str], out: str = "pos") -> DataFrame:
    """Numbers 1..n over the whole table in the order of the columns, which must be unique."""
    return running_total(df, order, F.lit(1).cast("long"), out)


def competition_rank(df: DataFrame, col: str, out: str = "rank") -> DataFrame:
    """Rank of the values, best first, equal values share the best place, none for NULL. Equal values are counted first,
    so a value that many rows have is one row of the ranking."""
    known = F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double"))
    values = df.filter(known).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_n")).withColumn("_down", -F.col("_v"))
    placed = running_total(values, ["_down"], F.col("_n"), "_upto").select("_v", (F.col("_upto") - F.col("_n") + 1).cast("int").alias(out))
    return df.join(placed, F.when(known, F.col(col)) == F.col("_v"), "left").drop("_v")
