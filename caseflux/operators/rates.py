"""Series and rates (AG1-AG6, AG10-AG13, AG58, JN22)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import fixed as K
from ..functions import numbers as N
from .filters import closed_parts

MEASURES = {"cases": "case_n", "confirmed_n": "confirmed", "hospitalised_n": "hospitalised", "deaths": "death"}
WEEK_MEASURES = {**MEASURES, "discharged_n": "discharged"}


def _sums(measures) -> list[Column]:
    return [F.sum(c).alias(n) for n, c in measures.items()]


def daily_series(df: DataFrame, date: str = "event_date", measures=MEASURES) -> DataFrame:
    """AG1: one row per day."""
    return df.groupBy(F.col(date).alias("date")).agg(*_sums(measures))


def weekly_series(df: DataFrame, dims: Sequence[str] = (), measures=WEEK_MEASURES) -> DataFrame:
    """AG2/AG3: one row per ISO week (and dimension) with fatality among confirmed."""
    g = df.filter(F.col("iso_year").isNotNull() & F.col("iso_week").isNotNull())
    for d in dims:
        g = g.filter(F.col(d).isNotNull())
    g = g.groupBy("iso_year", "iso_week", *dims).agg(*_sums(measures))
    return g.withColumn("pct_fatality", N.pct("deaths", "confirmed_n"))


def rates(df: DataFrame, keys: Sequence[str] = ("event_year", "code6", "municipality", "region")) -> DataFrame:
    """AG4/AG5: incidence and mortality per 100 thousand and fatality; NULL keys are left out."""
    g = df
    for k in keys:
        g = g.filter(F.col(k).isNotNull())
    g = g.groupBy(*keys).agg(*_sums(MEASURES), F.max("population").alias("population"))
    return g.withColumns({
        "incidence_100k": N.ratio("cases", "population", 100000.0),
        "mortality_100k": N.ratio("deaths", "population", 100000.0),
        "pct_fatality": N.pct("deaths", "confirmed_n")})


def weekly_kpis(df: DataFrame) -> DataFrame:
    """AG6: last closed week against the week before, with light."""
    weeks = weekly_series(df)
    at = closed_parts(df).get
    now = (F.col("iso_year") == at("closed_year")) & (F.col("iso_week") == at("closed_week"))
    before = (F.col("iso_year") == at("previous_year")) & (F.col("iso_week") == at("previous_week"))
    names = [*WEEK_MEASURES, "pct_fatality"]
    one = weeks.agg(*[F.max(F.when(c, F.col(n)).cast("double")).alias(f"{p}_{n}") for n in names
                      for p, c in (("a", now), ("b", before))])
    rows = F.array(*[F.struct(F.lit(n).alias("indicator"), F.col(f"a_{n}").alias("value_now"),
                              F.col(f"b_{n}").alias("value_before")) for n in names])
    out = one.select(at("closed_year").alias("iso_year"), at("closed_week").alias("iso_week"), F.inline(rows))
    change = N.pct_change("value_now", "value_before")
    return out.withColumns({"diff": F.col("value_now") - F.col("value_before"), "pct_change": change,
                            "light": N.light_change(change)})


def state_population(pop: DataFrame, years: DataFrame) -> DataFrame:
    """AG12: total population per year from the population table itself, carried over year gaps."""
    from .series import fill_gaps

    tot = pop.groupBy("year").agg(F.sum("population").alias("_sum"))
    y = years.select(F.col("event_year").alias("year")).filter(F.col("year").isNotNull()).distinct()
    j = y.join(tot, "year", "left").withColumn("_k", F.lit(0))
    return fill_gaps(j, ["_k"], "year", "_sum", "state_population").select("year", "state_population")


def epi_panel(df: DataFrame, keys: Sequence[str], pop: DataFrame, confirmed_only: bool = True) -> DataFrame:
    """AG10: confirmed cases and deaths per key set with state or municipal population."""
    from .series import fill_gaps

    d = df.filter(F.col("confirmed") == 1) if confirmed_only else df
    g = d.groupBy(*keys).agg(F.sum("case_n").alias("cases"), F.sum("death").alias("deaths"))
    sp = state_population(pop, df).withColumnRenamed("year", "_sy")
    g = g.join(sp, F.col("event_year") == F.col("_sy"), "left").drop("_sy")
    ref = F.col("state_population")
    if "code6" in keys:
        own = df.filter(F.col("code6").isNotNull()).groupBy("code6", "event_year").agg(F.max("population").alias("_mp"))
        own = fill_gaps(own, ["code6"], "event_year", "_mp", "municipal_population").select(
            F.col("code6").alias("_c"), F.col("event_year").alias("_y"), "municipal_population")
        g = g.join(own, (F.col("code6") == F.col("_c")) & (F.col("event_year") == F.col("_y")), "left").drop("_c", "_y")
        ref = F.coalesce("municipal_population", "state_population")
    g = g.withColumn("population_ref", ref)
    return g.select(*keys, "cases", "deaths", "population_ref",
                    N.ratio("cases", "population_ref", 1e5).alias("incidence_100k"),
                    N.ratio("deaths", "population_ref", 1e5).alias("mortality_100k"),
                    N.pct("deaths", "cases").alias("pct_fatality"))


def year_summary(df: DataFrame, pop: DataFrame) -> DataFrame:
    """AG11: one row per year with the bacterial sub-group and the share confirmed."""
    conf = F.col("confirmed") == 1
    bact, dead = conf & F.col("class_group").isin(*K.BACTERIAL), F.col("death") == 1
    g = df.filter(F.col("event_year").isNotNull()).groupBy("event_year").agg(
        F.count(F.lit(1)).alias("notified"), F.count_if(conf).alias("confirmed_n"), F.count_if(conf & dead).alias("deaths"),
        F.count_if(bact).alias("bact_confirmed"), F.count_if(bact & dead).alias("bact_deaths"))
    sp = state_population(pop, df)
    g = g.join(sp, F.col("event_year") == F.col("year"), "left").drop("year").filter(F.col("confirmed_n") > 0)
    return g.withColumns({
        "incidence_100k": N.ratio("confirmed_n", "state_population", 1e5),
        "mortality_100k": N.ratio("deaths", "state_population", 1e5),
        "pct_fatality": N.pct("deaths", "confirmed_n"),
        "bact_incidence_100k": N.ratio("bact_confirmed", "state_population", 1e5),
        "bact_fatality": N.pct("bact_deaths", "bact_confirmed"),
        "pct_confirmed": N.pct("confirmed_n", "notified")})


def reference_year(df: DataFrame) -> Column:
    """AG13: newest year with a native population, else the newest year."""
    return df.agg(F.coalesce(F.max(F.when(F.col("population") > 0, F.col("event_year"))), F.max("event_year"))).scalar()


def distinct_n(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """AG58: exact distinct count in two steps, so that no key is collected."""
    return df.filter(F.col(col).isNotNull()).select(*keys, col).distinct().groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_distinct"))


def distribution(df: DataFrame, col: str | Column, name: str = "category", missing: str = K.BLANK_LABEL) -> DataFrame:
    """AG36: counts and shares of one column."""
    c = F.col(col) if isinstance(col, str) else col
    g = df.groupBy(F.coalesce(c.cast("string"), F.lit(missing)).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", N.pct("n", F.sum("n").over(W.partitionBy(F.lit(0)))))


def distributions(df: DataFrame, cols: Sequence[str], missing: str = K.BLANK_LABEL) -> DataFrame:
    """AG38: value counts of many columns in one pass (folded before the shuffle)."""
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias("category"))
                     for c in cols])
    g = df.select(F.inline(rows)).groupBy("variable", "category").agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("pct", N.pct("n", F.sum("n").over(W.partitionBy("variable"))))
