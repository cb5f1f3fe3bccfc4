"""Calendar, windows and seasonal operators (WN1-WN19, AG59).

Windows run on aggregated series only: one row per day or week and stratum.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import fixed as K
from ..functions import numbers as N
from .filters import as_of_date, fold
from .joins import null_safe_left


def fill_gaps(df: DataFrame, keys: Sequence[str], order: str, col: str, out: str | None = None) -> DataFrame:
    """WN8: forward, then backward fill; both stay inside the key."""
    w = W.partitionBy(*keys).orderBy(order)
    fwd = F.last(col, ignorenulls=True).over(w.rowsBetween(W.unboundedPreceding, 0))
    back = F.first(col, ignorenulls=True).over(w.rowsBetween(0, W.unboundedFollowing))
    return df.withColumn(out or col, F.coalesce(fwd, back))


def _calendar(agg: DataFrame, keys: Sequence[str], step: str, end: Column | None, col: str) -> DataFrame:
    span = agg.groupBy(*keys).agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    hi = F.col("_hi") if end is None else F.greatest("_hi", end)
    days = F.sequence(F.col("_lo"), hi, F.expr(f"interval {step}"))
    return span.select(*keys, F.explode(days).alias(col))


def fill_days(series: DataFrame, keys: Sequence[str] = (), measures: Sequence[str] = ("y",), date: str = "date") -> DataFrame:
    """WN1: a row for every day between the first and the last, 0 where nothing happened."""
    j = _calendar(series, keys, "1 day", None, date).join(series, [*keys, date], "left")
    return j.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in measures})


def weekly_counts(df: DataFrame, keys: Sequence[str] = (), date: str = "event_date", value: Column | None = None) -> DataFrame:
    """Cases per ISO week; the week is its Monday, so weeks 52/53 need no special case."""
    v = F.count(F.lit(1)) if value is None else F.sum(value)
    return df.filter(F.col(date).isNotNull()).groupBy(*keys, D.iso_monday(date).alias("monday")).agg(v.alias("y"))


def fill_weeks(weekly: DataFrame, keys: Sequence[str] = (), as_of: Column | None = None) -> DataFrame:
    """WN2: a row for every Monday up to the week of as_of."""
    end = None if as_of is None else D.iso_monday(as_of)
    j = _calendar(weekly, keys, "7 days", end, "monday").join(weekly, [*keys, "monday"], "left")
    return j.withColumn("y", F.coalesce("y", F.lit(0))).withColumns({
        "iso_year": D.iso_year("monday"), "iso_week": D.iso_week("monday"),
        "period": D.period_label(D.iso_year("monday"), D.iso_week("monday"))})


def _w(keys: Sequence[str], order: str):
    return W.partitionBy(*(keys or [F.lit(0)])).orderBy(order)


def moving_avg(series: DataFrame, windows: Sequence[int] = (7, 14, 30), keys: Sequence[str] = (), date: str = "date",
               value: str = "y") -> DataFrame:
    """WN3: trailing means, shorter at the start."""
    w = _w(keys, date)
    return series.withColumns({f"ma{n}": F.avg(value).over(w.rowsBetween(-(n - 1), 0)) for n in windows})


def lag_features(series: DataFrame, lags: Sequence[int] = (1, 7), keys: Sequence[str] = (), date: str = "date",
                 value: str = "y") -> DataFrame:
    """WN4: lags and calendar features."""
    w = _w(keys, date)
    out = series.withColumns({f"lag{n}": F.lag(value, n).over(w) for n in lags})
    return out.withColumns({"t": F.row_number().over(w) - 1, "dow": F.weekday(date), "month": F.month(date),
                            "doy": F.dayofyear(date)})


def pct_rank(col: Column | str, keys: Sequence[str] = ()) -> Column:
    """S5: average rank of ties divided by n."""
    c = F.col(col) if isinstance(col, str) else col
    base = W.partitionBy(*(keys or [F.lit(0)]))
    ties = F.count(F.lit(1)).over(W.partitionBy(*(list(keys) or [F.lit(0)]), c))
    return (F.rank().over(base.orderBy(c)) + (ties - 1) / 2) / F.count(F.lit(1)).over(base)


def pct_rank_score(df: DataFrame, cols: Sequence[str], out: str = "risk_score", keys: Sequence[str] = ()) -> DataFrame:
    """WN5: sum of the percentile ranks of the indicators inside `keys`, NULL counted as 0."""
    filled = df.withColumns({f"_f_{c}": F.coalesce(F.col(c), F.lit(0.0)) for c in cols})
    ranked = filled.withColumns({f"_r_{c}": pct_rank(f"_f_{c}", keys) for c in cols})
    total = F.lit(0.0)
    for c in cols:
        total = total + F.col(f"_r_{c}")
    return ranked.withColumn(out, total).drop(*[f"_{k}_{c}" for c in cols for k in "fr"])


def rank_min(df: DataFrame, col: str, out: str = "rank", keys: Sequence[str] = ()) -> DataFrame:
    """WN6: competition rank, best first; rows without a value get none. Without keys the ranking is distributed."""
    if not keys:
        from .ordering import competition_rank

        return competition_rank(df, col, out)
    w = W.partitionBy(*keys).orderBy(F.col(col).desc_nulls_last())
    return df.withColumn(out, F.when(F.col(col).isNotNull(), F.rank().over(w)))


def space_time_scan(df: DataFrame, unit: str = "municipality", window: int = 4, baseline: int = 52,
                    last_weeks: int = 26, floor: float = 0.25) -> DataFrame:
    """WN7: observed in a moving window against the unit's own preceding weeks."""
    wk = fold(weekly_counts(df, [unit]))
    span = wk.agg(F.min("monday").alias("_lo"), F.max("monday").alias("_hi"))
    lo, hi = span.select("_lo").scalar(), span.select("_hi").scalar()
    units = wk.select(unit).distinct()
    grid = units.select(unit, F.explode(F.sequence(lo, hi, F.expr("interval 7 days"))).alias("monday"))
    s = grid.join(wk, [unit, "monday"], "left").withColumn("y", F.coalesce("y", F.lit(0)))
    w = _w([unit], "monday")
    past = w.rowsBetween(-(window + baseline - 1), -window)
    obs = F.sum("y").over(w.rowsBetween(-(window - 1), 0))
    exp = F.when(F.count("y").over(past) >= window, F.avg("y").over(past) * window)
    s = s.withColumns({"observed": obs, "expected": exp})
    s = s.filter((F.col("monday") >= F.date_sub(hi, 7 * last_weeks)) & (F.col("observed") > 0))
    adj = F.greatest(F.coalesce("expected", F.lit(0.0)), F.lit(floor))
    s = s.withColumns({"expected_adj": adj, "ratio": F.col("observed") / adj})
    return s.select(unit, "monday", "observed", "expected", "expected_adj", "ratio",
                    ((F.col("observed") >= 2) & (F.col("ratio") >= 2)).cast("int").alias("emerging"))


def doubling(series: DataFrame, keys: Sequence[str], order: str, value: str = "y") -> DataFrame:
    """WN9: whether some week with cases at least doubled the previous listed week."""
    prev = F.lag(value).over(W.partitionBy(*keys).orderBy(order))
    s = series.withColumn("_d", (F.col(value) >= 2 * prev) & (prev >= 1))
    return s.groupBy(*keys).agg(F.coalesce(F.bool_or("_d"), F.lit(False)).alias("doubling"))


def relative_to_mean(df: DataFrame, keys: Sequence[str], value: str, out: str = "index") -> DataFrame:
    """WN10: value divided by the mean of its group."""
    mean = F.avg(value).over(W.partitionBy(*(keys or [F.lit(0)])))
    return df.withColumn(out, F.col(value) / F.nullif(mean, F.lit(0.0)))


def delta_prev(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str = "delta") -> DataFrame:
    """WN12: change against the previous period."""
    return df.withColumn(out, F.col(value) - F.lag(value).over(_w(keys, order)))


def weekly_baseline(weekly: DataFrame, keys: Sequence[str] = ("iso_week", "code6", "class_group"), before: Column | int | None = None,
                    value: str = "cases") -> DataFrame:
    """WN13: mean, sample deviation, maximum, P95 and limit of earlier years."""
    h = weekly if before is None else weekly.filter(F.col("iso_year") < before)
    g = h.groupBy(*keys).agg(
        F.avg(value).alias("mean_hist"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("sd_hist"),
        F.max(value).alias("max_hist"), F.percentile(value, F.lit(0.95)).alias("p95_hist"))
    g = g.withColumn("mean_2sd", F.col("mean_hist") + 2 * F.col("sd_hist"))
    return g.withColumn("limit_hist", F.greatest(F.col("max_hist").cast("double"), "p95_hist", "mean_2sd"))


def vs_baseline(current: DataFrame, hist: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JN3: current week with its baseline; NULL keys match each other."""
    return null_safe_left(current, hist, keys)


def endemic_channel(df: DataFrame, dims: Sequence[str] = ("class_group",)) -> DataFrame:
    """WN14: quantiles of earlier years per week against the newest year, with level."""
    wk = df.groupBy("iso_year", "iso_week", *dims).agg(F.sum("case_n").alias("cases"))
    now = df.agg(F.max("iso_year")).scalar()
    q = lambda p, n: F.percentile("cases", F.lit(p)).alias(n)
    keys = ["iso_week", *dims]
    ch = wk.filter(F.col("iso_year") < now).groupBy(*keys).agg(
        F.min("cases").alias("min_cases"), q(0.25, "p25"), F.avg("cases").alias("mean_cases"), q(0.5, "median_cases"),
        q(0.75, "p75"), F.max("cases").alias("max_cases"), q(0.9, "p90"), q(0.95, "p95"))
    obs = wk.filter(F.col("iso_year") == now).select(*keys, F.col("cases").alias("observed"))
    j = ch.join(obs, keys, "left").withColumn("observed", F.coalesce("observed", F.lit(0)))
    o = F.col("observed")
    level = F.when(o > F.col("p90"), "epidêmico/alerta").when(o > F.col("p75"), "alto").when(
        o > F.col("median_cases"), "médio").otherwise("baixo/esperado")
    return j.withColumns({"year_observed": now, "level": level, "above_p95": (o > F.col("p95")).cast("int")})


def seasonal_index(df: DataFrame) -> DataFrame:
    """WN15: month means over the years and their ratio to the mean month."""
    m = df.groupBy("event_year", "event_month").agg(
        F.sum("case_n").alias("cases"), F.sum("confirmed").alias("conf"), F.sum("death").alias("dead"))
    g = m.groupBy("event_month").agg(F.avg("cases").alias("mean_cases"), F.percentile("cases", F.lit(0.5)).alias("median_cases"),
                                     F.avg("conf").alias("mean_confirmed"), F.avg("dead").alias("mean_deaths"))
    g = relative_to_mean(g, [], "mean_cases", "seasonal_index")
    return g.withColumns({"label": D.month_label("event_month"), "above_mean": (F.col("seasonal_index") > 1.0).cast("int")})


def seasonal_index_by(df: DataFrame, dim: str) -> DataFrame:
    """WN15: monthly mean over all years inside a dimension, relative to the dimension's mean month."""
    pre = df.filter(F.col(dim).isNotNull()).groupBy(dim, "event_month", "event_year").agg(F.sum("case_n").alias("cases"))
    years = df.select("event_year").distinct().agg(F.count(F.lit(1))).scalar()
    g = pre.groupBy(dim, "event_month").agg(F.sum("cases").alias("cases")).withColumn("monthly_mean", F.col("cases") / years)
    return relative_to_mean(g, [dim], "monthly_mean", "seasonal_index")


def week_heat(df: DataFrame) -> DataFrame:
    """WN16: cases per ISO year and week."""
    return df.groupBy("iso_year", "iso_week").agg(F.sum("case_n").alias("cases"), F.sum("confirmed").alias("confirmed_n"))


def heat_pivot(df: DataFrame, years: Sequence[int]) -> DataFrame:
    """WN16: weeks as rows, years as columns (years are given, so no discovery pass)."""
    g = week_heat(df).groupBy("iso_week").pivot("iso_year", list(years)).agg(F.sum("cases"))
    return g.withColumnsRenamed({str(y): f"y{y}" for y in years})


def week_profile(df: DataFrame) -> DataFrame:
    """WN17: profile of a week of the year over all years."""
    q = lambda p, n: F.percentile("cases", F.lit(p)).alias(n)
    return week_heat(df).groupBy("iso_week").agg(F.avg("cases").alias("mean_cases"), q(0.5, "median_cases"), q(0.75, "p75"), q(0.95, "p95"))


def peak_months(df: DataFrame, n: int = 3) -> DataFrame:
    """WN17: the n highest and lowest months of the seasonal index."""
    s = seasonal_index(df).select("event_month", "label", "seasonal_index")
    one = W.partitionBy(F.lit(0))
    r = s.withColumns({"rank_high": F.row_number().over(one.orderBy(F.col("seasonal_index").desc(), "event_month")),
                       "rank_low": F.row_number().over(one.orderBy("seasonal_index", "event_month"))})
    return r.filter((F.col("rank_high") <= n) | (F.col("rank_low") <= n))


def lag_corr(daily: DataFrame, outcomes: Sequence[str], variables: Sequence[str], max_lag: int = 30, n_min: int = 30,
             date: str = "date") -> DataFrame:
    """WN18: Pearson and Spearman between an outcome and a variable 0..max_lag rows earlier."""
    w = _w([], date)
    xs = F.inline(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("x")) for v in variables]))
    pos = daily.withColumn("_t", F.row_number().over(w))
    left = pos.select("_t", F.inline(F.array(*[
        F.struct(F.lit(o).alias("outcome"), F.col(o).cast("double").alias("y")) for o in outcomes]))).filter(F.col("y").isNotNull())
    right = pos.select("_t", xs).filter(F.col("x").isNotNull()).select(
        "variable", "x", F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("lag"), F.col("_t"))
    right = right.withColumn("_t", F.col("_t") + F.col("lag"))
    pairs = left.join(right, "_t")
    g = ["outcome", "variable", "lag"]
    ranked = pairs.withColumns({"rx": pct_rank("x", g), "ry": pct_rank("y", g)})
    out = ranked.groupBy(*g).agg(F.count(F.lit(1)).alias("n"), F.corr("x", "y").alias("_p"), F.corr("rx", "ry").alias("_s"))
    ok = lambda c: F.when((F.col("n") >= n_min) & ~F.isnan(c), F.col(c))
    return out.select(*g, "n", ok("_p").alias("pearson"), ok("_s").alias("spearman"), F.pow(ok("_p"), 2).alias("r2"))


def decompose(series: DataFrame, period: int = 7, date: str = "date", value: str = "y") -> DataFrame:
    """WN19: centred moving-average trend, seasonal means (sum 0) and residual; edge trend is NULL."""
    w, half = _w([], date), period // 2
    y = F.col(value).cast("double")
    if period % 2:
        win = w.rowsBetween(-half, half)
        trend = F.when(F.count(y).over(win) == period, F.avg(y).over(win))
    else:
        win = w.rowsBetween(-half, half)
        inner = F.sum(y).over(w.rowsBetween(-half + 1, half - 1))
        edge = (F.lag(y, half).over(w) + F.lead(y, half).over(w)) / 2
        trend = F.when(F.count(y).over(win) == period + 1, (inner + edge) / period)
    s = series.withColumns({"trend": trend, "_pos": (F.row_number().over(w) - 1) % period})
    s = s.withColumn("_raw", F.avg(y - F.col("trend")).over(W.partitionBy("_pos")))
    # every position of the cycle counts once in the centring mean
    means = s.groupBy("_pos").agg(F.max("_raw").alias("_m"))
    centre = means.agg(F.avg("_m")).scalar()
    s = s.withColumn("seasonal", F.col("_raw") - centre)
    return s.withColumn("residual", y - F.col("trend") - F.col("seasonal")).drop("_pos", "_raw")


def above_own_p75(df: DataFrame, unit: str = "region", as_of: Column | str | None = None, min_weeks: int = 20,
                  history: int = 52, last: int = 6) -> DataFrame:
    """AG59: units whose last week with cases lies in the last weeks and above their own P75."""
    end = D.iso_monday(as_of_date(df, as_of))
    wk = weekly_counts(df.filter(F.col(unit).isNotNull()), [unit])
    span = wk.groupBy(unit).agg(F.min("monday").alias("_lo"), F.count(F.lit(1)).alias("_nz"))
    recent = wk.withColumn("_rn", F.row_number().over(W.partitionBy(unit).orderBy(F.col("monday").desc())))
    g = recent.join(span, unit).filter((F.col("_rn") <= history) | (F.col("_nz") < 8)).groupBy(unit).agg(
        F.percentile("y", F.lit(0.75)).alias("p75"), F.max_by("y", "monday").alias("last_y"),
        F.max("monday").alias("last_monday"), F.min("_lo").alias("_lo"))
    weeks = F.datediff(end, "_lo") / 7 + 1
    hit = (weeks >= min_weeks) & (F.datediff(end, "last_monday") < 7 * last) & (F.col("last_y") > F.col("p75")) & (F.col("p75") > 0)
    return g.select(unit, "p75", "last_y", "last_monday", hit.cast("int").alias("above"))
