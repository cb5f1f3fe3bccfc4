"""Reporting delay and nowcast (MD14-MD17, MD19, MD24, MD25)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import fixed as K
from . import series as T
from .filters import as_of_date, fold

FLOOR = {"week": 0.08, "day": 0.05}
LIMIT = {"week": 52, "day": 365}


def delay_histogram(df: DataFrame, keys: Sequence[str] = (), unit: str = "week", onset: str = "onset_date", report: str = "notified_date") -> DataFrame:
    """Counts per delay. In weeks the delay is the distance of the two ISO Mondays; negatives count as 0."""
    o = F.coalesce(F.col(onset), F.col("event_date"))
    r = F.coalesce(F.col(report), o)
    if unit == "week":
        lag = F.greatest((F.datediff(D.iso_monday(r), D.iso_monday(o)) / 7).cast("int"), F.lit(0))
    else:
        lag = F.datediff(r, o)
    h = df.groupBy(*keys, lag.alias("delay")).agg(F.count(F.lit(1)).alias("n"))
    return h.filter(F.col("delay").between(0, LIMIT[unit]))


def delay_cdf(hist: DataFrame, strata: DataFrame | None = None, keys: Sequence[str] = (), unit: str = "week", max_delay: int = 12) -> DataFrame:
    """MD14: share reported by delay 0..max, clipped from below, with an exponential fallback for strata without delays."""
    if keys:
        base = (strata if strata is not None else hist).select(*keys).distinct()
    else:
        base = hist.agg(F.count(F.lit(1)).alias("_x"))
    grid = base.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(max_delay))).alias("delay"))
    tot = hist.groupBy(*keys).agg(F.sum("n").alias("n_obs"))
    j = grid.join(hist.select(*keys, "delay", "n"), [*keys, "delay"], "left")
    if keys:
        j = j.join(tot, list(keys), "left")
    else:
        j = j.withColumn("n_obs", tot.scalar())
    w = W.partitionBy(*(keys or [F.lit(0)])).orderBy("delay")
    cum = F.sum(F.coalesce("n", F.lit(0))).over(w)
    d = F.col("delay").cast("double")
    fallback = F.least(F.lit(1.0), 0.35 + 0.65 * (1 - F.exp(-d / 2.5))) if unit == "week" else F.least(F.lit(1.0), 0.15 + 0.85 * (1 - F.exp(-d / 10)))
    p = F.when(F.coalesce("n_obs", F.lit(0)) > 0, F.least(F.greatest(cum / F.col("n_obs"), F.lit(FLOOR[unit])), F.lit(1.0))).otherwise(fallback)
    return j.select(*keys, "delay", p.alias("cdf"), F.coalesce("n_obs", F.lit(0)).alias("n_obs"))


def nowcast(weekly: DataFrame, cdf: DataFrame, as_of: Column, keys: Sequence[str] = (), last: int = 6, max_delay: int = 12) -> DataFrame:
    """MD15: last weeks divided by the share reported by their age. weekly: keys, monday, y."""
    w = W.partitionBy(*(keys or [F.lit(0)])).orderBy(F.col("monday").desc())
    age = F.greatest(F.lit(0), F.datediff(as_of, F.date_add("monday", 6)))
    nc_days = F.floor(age / 7)
    t = weekly.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= last).withColumn(
        "delay", F.least(nc_days, F.lit(max_delay)).cast("int"))
    j = t.join(cdf.select(*keys, "delay", F.col("cdf").alias("p_reported")), [*keys, "delay"], "left")
    nc = F.col("y") / F.col("p_reported")
    return j.select(*keys, "monday", F.col("y").cast("double").alias("observed"), "delay", "p_reported", nc.alias("nowcast"),
                    F.greatest(F.lit(0.0), nc - F.col("y")).alias("increment"))


def nowcast_days(weekly: DataFrame, cdf: DataFrame, as_of: Column, last: int = 4, max_delay: int = 60) -> DataFrame:
    """MD15, older variant: age of the week in days."""
    t = weekly.orderBy(F.col("monday").desc()).limit(last)
    age = F.greatest(F.lit(0), F.datediff(as_of, F.date_add("monday", 6)))
    t = t.withColumn("delay", F.least(age, F.lit(max_delay)).cast("int"))
    j = t.join(cdf.select("delay", F.col("cdf").alias("p_reported")), "delay", "left")
    return j.select("monday", F.col("y").cast("double").alias("observed"), "delay", "p_reported", (F.col("y") / F.col("p_reported")).alias("nowcast"))


def _uniform(key: Column, start: int) -> Column:
    return (F.conv(F.substring(key, start, 8), 16, 10).cast("double") + 1) / 4294967297.0


def nowcast_band(nc: DataFrame, hist: DataFrame, keys: Sequence[str] = (), draws: int = 200, seed: int = 42, n_min: int = 30) -> DataFrame:
    """MD16: P10/P90 of the nowcast by a bootstrap of the delay histogram.

    A cell with n delays is redrawn as n + sqrt(n) z (the normal limit of its Poisson count); z comes
    from a hash of (stratum, delay, replicate), so the band does not depend on the partitioning.
    """
    nc, hist = fold(nc), fold(hist)
    stratum = F.concat_ws("|", *[F.col(k) for k in keys]) if keys else F.lit("")
    r = hist.select(*keys, "delay", "n", F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("rep"))
    key = F.md5(F.concat_ws("|", stratum, F.col("delay").cast("string"), F.col("rep").cast("string"), F.lit(str(seed))))
    r = r.withColumn("_k", key)
    z = F.sqrt(-2 * F.log(_uniform(F.col("_k"), 1))) * F.cos(2 * F.pi() * _uniform(F.col("_k"), 9))
    r = r.withColumn("_w", F.greatest(F.lit(0.0), F.col("n") + F.sqrt(F.col("n").cast("double")) * z))
    lags = nc.select(*keys, F.col("delay").alias("lag")).distinct()
    on = list(keys)
    both = r.join(lags, on) if on else r.withColumn("lag", F.explode(lags.agg(F.collect_set("lag")).scalar()))  # one row per week back
    p = both.groupBy(*keys, "lag", "rep").agg((F.sum(F.when(F.col("delay") <= F.col("lag"), F.col("_w")).otherwise(0.0)) / F.sum("_w")).alias("_p"))
    p = p.withColumn("_p", F.least(F.greatest("_p", F.lit(FLOOR["week"])), F.lit(1.0)))
    q = p.groupBy(*keys, F.col("lag").alias("delay")).agg(F.percentile("_p", F.lit(0.1)).alias("_p10"), F.percentile("_p", F.lit(0.9)).alias("_p90"))
    size = hist.groupBy(*keys).agg(F.sum("n").alias("_n"))
    j = nc.join(q, [*keys, "delay"], "left")
    j = j.join(size, on, "left") if on else j.withColumn("_n", size.scalar())
    ok = F.coalesce(F.col("_n"), F.lit(0)) >= n_min
    lo = F.when(ok, F.col("observed") / F.col("_p90")).otherwise(F.col("nowcast") * 0.85)
    hi = F.when(ok, F.col("observed") / F.col("_p10")).otherwise(F.col("nowcast") * 1.25)
    return j.withColumns({"nowcast_p10": F.least(lo, hi), "nowcast_p90": F.greatest(lo, hi)}).drop("_p10", "_p90", "_n")


def nowcast_simple(df: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """MD17: last 7 days scaled by the ratio of the previous days to them."""
    m = as_of_date(df, as_of)
    near = df.filter(F.col("event_date") >= F.date_sub(m, 14))
    last = F.col("event_date") >= F.date_sub(m, 6)
    g = near.agg(F.count_if(last).alias("observed_7d"), F.count_if(~last).alias("previous"))
    f = F.when((F.col("observed_7d") > 0) & (F.col("previous") > 0), F.col("previous") / F.col("observed_7d")).otherwise(1.0)
    return g.select("observed_7d", f.alias("factor"), (F.col("observed_7d") * f).alias("nowcast_7d"))


def nowcast_median(df: DataFrame, outcomes: Sequence[str] = ("case_n", "hospitalised", "death")) -> DataFrame:
    """MD17: newest week raised to the median of the eight listed weeks before it, per outcome."""
    wk = df.groupBy("iso_year", "iso_week").agg(*[F.sum(o).alias(o) for o in outcomes])
    long = wk.select("iso_year", "iso_week", F.inline(F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(o).cast("double").alias("v")) for o in outcomes])))
    w = W.partitionBy("outcome").orderBy("iso_year", "iso_week")
    rn = F.row_number().over(W.partitionBy("outcome").orderBy(F.col("iso_year").desc(), F.col("iso_week").desc()))
    med = F.percentile("v", F.lit(0.5)).over(w.rowsBetween(-8, -1))
    r = long.withColumns({"_rn": rn, "_m": med}).filter("_rn = 1")
    exp = F.greatest("v", F.coalesce("_m", "v"))
    return r.select("outcome", "iso_year", "iso_week", F.col("v").alias("observed"), F.coalesce("_m", "v").alias("median_8"), exp.alias("nowcast"),
                    (exp - F.col("v")).alias("delay_estimate"), F.when(F.col("v") > 0, exp / F.col("v")).alias("factor"))


def apply_nowcast(weekly: DataFrame, nc: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MD19: recent weeks replaced by their nowcast."""
    j = weekly.join(nc.select(*keys, "monday", "nowcast"), [*keys, "monday"], "left")
    return j.withColumn("y", F.coalesce("nowcast", F.col("y").cast("double"))).drop("nowcast")


def strata_weekly(df: DataFrame, class_label: str = K.MENINGOCOCCAL, class_name: str = "DM") -> tuple[DataFrame, DataFrame]:
    """MD24: weekly series and delay histograms of the state, one class and every region.

    The case rows are first folded to (region, class flag, week, delay); only those rows are copied
    into the strata they belong to.
    """
    o = F.coalesce("onset_date", "event_date")
    r = F.coalesce(F.col("notified_date"), o)
    lag = F.greatest((F.datediff(D.iso_monday(r), D.iso_monday(o)) / 7).cast("int"), F.lit(0))
    pre = df.groupBy("region", (F.col("class_group") == class_label).alias("_dm"), D.iso_monday(o).alias("monday"), lag.alias("delay")).agg(F.count(F.lit(1)).alias("n"))
    pre = fold(pre)
    strata = F.array_compact(F.array(F.lit("STATE"), F.when(F.col("_dm"), F.lit(class_name)), F.concat(F.lit("REGION::"), F.col("region"))))
    s = pre.select(F.explode(strata).alias("stratum"), "monday", "delay", "n")
    weekly = s.groupBy("stratum", "monday").agg(F.sum("n").alias("y"))
    hist = s.filter(F.col("delay").between(0, LIMIT["week"])).groupBy("stratum", "delay").agg(F.sum("n").alias("n"))
    return weekly, hist


def usable_strata(weekly: DataFrame, min_state: int = 20, min_other: int = 12) -> DataFrame:
    """MD24: strata with enough weeks with cases."""
    g = weekly.groupBy("stratum").agg(F.count_if(F.col("y") > 0).alias("_w"))
    ok = F.col("_w") >= F.when(F.col("stratum") == "STATE", min_state).otherwise(min_other)
    return weekly.join(g.filter(ok).select("stratum"), "stratum", "left_semi")


def reference_week(nc: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """MD25: last nowcast week with cases, else the newest one."""
    pick = F.coalesce(F.max(F.when(F.col("observed") > 0, F.struct("monday", "observed", "nowcast"))), F.max(F.struct("monday", "observed", "nowcast")))
    return nc.groupBy(*keys).agg(pick.alias("_b")).select(*keys, F.col("_b.monday").alias("monday"), F.col("_b.observed").alias("observed"), F.col("_b.nowcast").alias("nowcast"))


def seasonal_alert(ref: DataFrame, profile: DataFrame) -> DataFrame:
    """MD25: reference week against P75/P95 of its week of the year."""
    j = ref.withColumn("iso_week", D.iso_week("monday")).join(profile.select("iso_week", "p75", "p95"), "iso_week", "left")
    a = (F.when(F.col("p75").isNull(), "sem_perfil").when(F.col("nowcast") > F.col("p95"), "acima_p95_sazonal")
         .when(F.col("nowcast") > F.col("p75"), "acima_p75_sazonal").otherwise("rotina"))
    return j.withColumn("alert", a)
