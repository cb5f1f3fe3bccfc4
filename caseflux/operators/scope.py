"""Scope roll-up (AG14, AG15) and the long indicator table (AG25, AG60).

The big table is aggregated once to (finest dimensions x small integer value); the grouping sets
then run on that histogram, so the expansion into scopes never touches the case rows. Percentiles
are exact: they are taken over integer day counts or contact counts with their frequencies.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = {"STATE": ()}
SCOPES = {"STATE": (), "REGION": ("region",), "YEAR": ("event_year",)}
SCOPES_NO_YEAR = {"STATE": (), "REGION": ("region",)}
SCOPES_CLASS = {**SCOPES, "CLASS": ("class_group",), "REGION_CLASS": ("region", "class_group")}


def _dims(scopes: Mapping[str, Sequence[str]]) -> list[str]:
    out: list[str] = []
    for keys in scopes.values():
        out += [k for k in keys if k not in out]
    return out


def roll_up(pre: DataFrame, scopes: Mapping[str, Sequence[str]], aggs: Sequence[Column]) -> DataFrame:
    """Grouping sets over an already aggregated table, labelled with scope and slice."""
    dims = _dims(scopes)
    if not dims:
        return pre.agg(*aggs).select(F.lit(next(iter(scopes))).alias("scope"), F.lit("ALL").alias("slice"), "*")
    g = pre.groupingSets([[F.col(k) for k in keys] for keys in scopes.values()], *[F.col(k) for k in dims]).agg(
        F.grouping_id().alias("_g"), *aggs)
    scope, piece = F.lit(None).cast("string"), F.lit(None).cast("string")
    for label, keys in scopes.items():
        gid = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in keys)
        text = F.concat_ws(" | ", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("ALL")
        scope = F.when(F.col("_g") == gid, label).otherwise(scope)
        piece = F.when(F.col("_g") == gid, text).otherwise(piece)
    return g.select(scope.alias("scope"), piece.alias("slice"), *[c for c in g.columns if c not in dims and c != "_g"])


def by_scope(
    df: DataFrame,
    counts: Mapping[str, Column],
    value: Column | None = None,
    percentiles: Mapping[str, float] | None = None,
    scopes: Mapping[str, Sequence[str]] = SCOPES,
) -> DataFrame:
    """Counts (boolean or integer columns, summed) and exact percentiles of an integer value per scope."""
    dims = _dims(scopes)
    keyed = {d: (F.coalesce(F.col(d), F.lit("Sem regional")) if d == "region" else F.col(d)) for d in dims}
    v = value if value is not None else F.lit(None).cast("int")
    flat = df.select(
        *[c.alias(d) for d, c in keyed.items()], v.alias("_v"),
        *[F.coalesce(c.cast("bigint"), F.lit(0)).alias(n) for n, c in counts.items()],
    )
    pre = flat.groupBy(*dims, "_v").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(n).alias(n) for n in counts])
    aggs = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts]
    for name, p in (percentiles or {}).items():
        aggs.append(F.percentile("_v", F.lit(p), F.col("_n")).alias(name))
    return roll_up(pre, scopes, aggs)


def to_long(wide: DataFrame, family: str, spec: Mapping[str, tuple[str, str | None, str | None]]) -> DataFrame:
    """AG25: value column -> (unit, numerator column, denominator column) as indicator rows."""
    d = lambda c: (F.col(c) if c else F.lit(None)).cast("double")
    rows = F.array(*[
        F.struct(F.lit(v).alias("indicator"), d(v).alias("value"), d(n).alias("numerator"),
                 d(m).alias("denominator"), F.lit(u).alias("unit"))
        for v, (u, n, m) in spec.items()
    ])
    return wide.select(F.lit(family).alias("family"), "scope", "slice", F.inline(rows))


def across_units(long: DataFrame, target: float, scope: str = "REGION") -> DataFrame:
    """AG60: median over the units, number of units below target, worst unit, per indicator."""
    u = long.filter((F.col("scope") == scope) & F.col("value").isNotNull())
    return u.groupBy("indicator").agg(
        F.percentile("value", F.lit(0.5)).alias("median_value"),
        F.count_if(F.col("value") < target).alias("below_target"),
        F.count(F.lit(1)).alias("units"),
        F.min(F.struct("value", "slice"))["slice"].alias("worst_unit"),
    )
