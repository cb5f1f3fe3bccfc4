"""Forecasts and backtests (MD18, MD20-MD24). A series is one array row; strata run in parallel.

The arrays hold one value per week or day of one stratum, so their length is bounded by the calendar.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import dates as D
from .nowcast import apply_nowcast, nowcast, nowcast_band, delay_cdf, reference_week, seasonal_alert, strata_weekly, usable_strata
from . import series as T
from .filters import fold

_SUM = "aggregate({a}, 0D, (acc, v) -> acc + v)"


def _tail(n: int) -> str:
    return f"slice(s.h, greatest(size(s.h) - {n - 1}, 1), {n})"


def _mean(n: int) -> str:
    return f"({_SUM.format(a=_tail(n))} / least(size(s.h), {n}))"


def _step() -> str:
    """One week: four members, their mean and band; the mean is appended to the history."""
    trend = f"({_mean(6)} + 3.5D * aggregate(zip_with({_tail(6)}, array(-2.5D, -1.5D, -0.5D, 0.5D, 1.5D, 2.5D), (v, c) -> v * c), 0D, (acc, v) -> acc + v) / 17.5D)"
    seasonal = f"if(size(s.h) >= 52, element_at(s.h, greatest(size(s.h) - 51, 1)), {_mean(8)})"
    members = f"array({_mean(4)}, {_mean(8)}, {seasonal}, greatest(0D, {trend}))"
    sd12 = f"sqrt(greatest(0D, aggregate(transform({_tail(12)}, v -> v * v), 0D, (acc, v) -> acc + v) / least(size(s.h), 12) - pow({_mean(12)}, 2)))"
    row = (f"transform(array(named_struct('m', {members}, 's12', {sd12})), q -> transform(array(aggregate(q.m, 0D, (acc, v) -> acc + v) / 4D), mu -> "
           "named_struct('h', i, 'mu', mu, 'sd', sqrt(aggregate(transform(q.m, v -> (v - mu) * (v - mu)), 0D, (acc, v) -> acc + v) / 4D) + 0.3D * q.s12, 'm', q.m))[0])[0]")
    return row


def _run(col: str, horizon: int) -> str:
    start = f"named_struct('h', {col}, 'o', cast(array() as array<struct<h:int,mu:double,sd:double,m:array<double>>>))"
    nxt = f"transform(array({_step()}), z -> named_struct('h', concat(s.h, array(z.mu)), 'o', concat(s.o, array(z))))[0]"
    return f"aggregate(sequence(1, {horizon}), {start}, (s, i) -> {nxt}, s -> s.o)"


def _arrays(weekly: DataFrame, keys: Sequence[str]) -> DataFrame:
    pts = F.sort_array(F.collect_list(F.struct("monday", F.col("y").cast("double").alias("y"))))
    g = weekly.groupBy(*keys).agg(pts.alias("_p"))
    return g.select(*keys, F.transform("_p", lambda x: x["y"]).alias("_y"), F.transform("_p", lambda x: x["monday"]).alias("_d")).filter(F.size("_y") >= 8)


def forecast_weekly(weekly: DataFrame, horizon: int = 8, keys: Sequence[str] = ("stratum",)) -> DataFrame:
    """MD18: recursive ensemble (MA4, MA8, same week last year, 6-week trend) with an 80 % band."""
    a = _arrays(weekly, keys).withColumn("_last", F.element_at("_d", -1))
    x = a.select(*keys, "_last", F.inline(F.expr(_run("_y", horizon))))
    monday = F.date_add("_last", 7 * F.col("h"))
    return x.select(*keys, F.col("h").alias("horizon"), monday.alias("monday"), D.period_label(D.iso_year(monday), D.iso_week(monday)).alias("period"),
                    F.greatest(F.lit(0.0), "mu").alias("pred"), F.greatest(F.lit(0.0), F.col("mu") - 1.28 * F.col("sd")).alias("lower_80"),
                    (F.col("mu") + 1.28 * F.col("sd")).alias("upper_80"), *[F.col("m")[i].alias(n) for i, n in enumerate(("ma4", "ma8", "seasonal_52", "trend"))])


def backtest(weekly: DataFrame, n_hold: int = 8, keys: Sequence[str] = ("stratum",)) -> DataFrame:
    """MD23: one-step forecasts from growing histories for the last weeks."""
    a = _arrays(weekly, keys).filter(F.size("_y") >= n_hold + 12)
    a = a.select(*keys, "_y", "_d", F.explode(F.sequence(F.lit(1), F.lit(n_hold))).alias("_i"))
    a = a.withColumns({"_t": F.slice("_y", 1, F.size("_y") - F.col("_i")), "observed": F.element_at("_y", -F.col("_i")), "monday": F.element_at("_d", -F.col("_i"))})
    x = a.select(*keys, "monday", "observed", F.greatest(F.lit(0.0), F.expr(_run("_t", 1))[0]["mu"]).alias("predicted"))
    err = F.abs(F.col("predicted") - F.col("observed"))
    return x.withColumns({"abs_error": err, "pct_error": F.when(F.col("observed") > 0, 100.0 * err / F.col("observed"))})


def backtest_summary(bt: DataFrame, keys: Sequence[str] = ("stratum",)) -> DataFrame:
    """MD23: MAE, MAPE and whether the forecast may be published."""
    g = bt.groupBy(*keys).agg(F.avg("abs_error").alias("mae"), F.avg("pct_error").alias("mape"))
    q = F.when(F.col("mape") <= 60, "publicavel").when(F.col("mape") <= 100, "cautela").otherwise("nao_publicavel")
    return g.withColumn("quality", q)


def run_strata(df: DataFrame, as_of, min_state: int = 20, min_other: int = 12, draws: int = 200) -> dict[str, DataFrame]:
    """MD24: nowcast, forecast, backtest and summary of every stratum; all tables stay lazy."""
    weekly, hist = strata_weekly(df)
    weekly = fold(usable_strata(T.fill_weeks(weekly, ["stratum"], as_of), min_state, min_other))
    cdf = delay_cdf(hist, weekly, ["stratum"])
    nc = fold(nowcast_band(nowcast(weekly, cdf, as_of, ["stratum"]), hist, ["stratum"], draws))
    corrected = apply_nowcast(weekly, nc, ["stratum"])
    fc = forecast_weekly(corrected)
    bt = backtest(weekly)
    # weeks with cases of the state series are the history of the seasonal profile
    state = weekly.filter((F.col("stratum") == "STATE") & (F.col("y") > 0))
    q = lambda p, n: F.percentile("y", F.lit(p)).alias(n)
    ref = seasonal_alert(reference_week(nc, ["stratum"]), state.groupBy("iso_week").agg(q(0.75, "p75"), q(0.95, "p95")))
    steps = fc.filter(F.col("horizon").isin(1, 4)).groupBy("stratum").pivot("horizon", [1, 4]).agg(F.first("pred")).withColumnsRenamed({"1": "forecast_1", "4": "forecast_4"})
    summary = ref.select("stratum", "monday", "observed", "nowcast", "alert").join(backtest_summary(bt), "stratum", "left").join(steps, "stratum", "left")
    return {"weekly": weekly, "cdf": cdf, "nowcast": nc, "forecast": fc, "backtest": bt, "summary": summary}


def regional_ranking(summary: DataFrame) -> DataFrame:
    """MD24: regions by nowcast."""
    r = summary.filter(F.col("stratum").startswith("REGION::")).withColumn("region", F.regexp_replace("stratum", "^REGION::", ""))
    return r.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.col("nowcast").desc(), "region")))


# ---- daily ensemble ----------------------------------------------------------------------------

def daily_members(daily: DataFrame, horizon: int, keys: Sequence[str] = ("outcome",), date: str = "date") -> DataFrame:
    """MD20/MD22: closed-form members for every day ahead: naive, seasonal-naive, MA7, MA14, AR(1)."""
    w = W.partitionBy(*keys).orderBy(date)
    back = W.partitionBy(*keys).orderBy(F.col(date).desc())
    s = daily.withColumns({"_l1": F.lag("y").over(w), "_rn": F.row_number().over(back)})
    y = F.col("y").cast("double")
    last = lambda n: F.when(F.col("_rn") <= n, y)
    g = s.groupBy(*keys).agg(
        F.max(date).alias("_last"), F.max(F.when(F.col("_rn") == 1, y)).alias("_y1"), F.avg(last(7)).alias("_m7"), F.avg(last(14)).alias("_m14"),
        F.stddev_pop(last(30)).alias("resid_sd"), F.regr_slope(y, F.col("_l1").cast("double")).alias("_phi"), F.regr_intercept(y, F.col("_l1").cast("double")).alias("_c"),
        *[F.max(F.when(F.col("_rn") == 7 - i, y)).alias(f"_s{i}") for i in range(7)])
    x = g.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"))
    mu = F.col("_c") / (1 - F.col("_phi"))
    ar = mu + F.pow(F.col("_phi"), F.col("horizon")) * (F.col("_y1") - mu)
    seas = F.element_at(F.array(*[F.col(f"_s{i}") for i in range(7)]), ((F.col("horizon") - 1) % 7 + 1).cast("int"))
    members = {"naive": F.col("_y1"), "seasonal_7": seas, "ma7": F.col("_m7"), "ma14": F.col("_m14"), "ar1": F.greatest(F.lit(0.0), ar)}
    rows = F.array(*[F.struct(F.lit(n).alias("member"), v.cast("double").alias("pred")) for n, v in members.items()])
    return x.select(*keys, "horizon", F.date_add("_last", F.col("horizon")).alias("date"), "resid_sd", F.inline(rows))


STEPS, LAGS = (1, 7, 15, 30, 45, 60), 14
ML_FEATURES = [*[f"lag{i}" for i in range(LAGS)], "mean7", "mean14", "step", "dow", "month", "doy"]


def _features(rows: DataFrame, origin: Column, date: str) -> DataFrame:
    """Lags and means of the LAGS values that end at `origin` places before the end of `_past`, and calendar columns."""
    lag = lambda i: F.element_at("_past", -(origin + i + 1))
    known = rows.filter(F.size("_past") >= origin + LAGS).withColumns({f"lag{i}": lag(i) for i in range(LAGS)})
    mean = lambda n: sum((F.col(f"lag{i}") for i in range(1, n)), F.col("lag0")) / n
    return known.withColumns({"mean7": mean(7), "mean14": mean(14), "dow": F.weekday(date).cast("double"), "month": F.month(date).cast("double"), "doy": F.dayofyear(date).cast("double")}).drop("_past")


def direct_rows(daily: DataFrame, steps: Sequence[int] = STEPS, keys: Sequence[str] = ("outcome",), date: str = "date") -> DataFrame:
    """MD21: training rows of a direct forecast: a day's value, a step, and the LAGS values known that many days before.

    All series are trained together; the step is a feature, so one model serves every day ahead without recursion.
    """
    w = W.partitionBy(*keys).orderBy(date).rowsBetween(-(max(steps) + LAGS - 1), 0)
    x = daily.select(*keys, date, F.col("y").cast("double").alias("y"), F.collect_list(F.col("y").cast("double")).over(w).alias("_past"))
    x = x.withColumn("step", F.explode(F.array(*[F.lit(h) for h in steps])))
    return _features(x, F.col("step"), date).withColumn("step", F.col("step").cast("double"))


def future_rows(daily: DataFrame, horizon: int, keys: Sequence[str] = ("outcome",), date: str = "date") -> DataFrame:
    """MD21: the rows to forecast: every day ahead with the last LAGS values of its series."""
    back = W.partitionBy(*keys).orderBy(F.col(date).desc())
    tail = daily.withColumn("_rn", F.row_number().over(back)).filter(F.col("_rn") <= LAGS)
    past = F.transform(F.sort_array(F.collect_list(F.struct(F.col(date).alias("d"), F.col("y").cast("double").alias("y")))), lambda x: x["y"])
    g = tail.groupBy(*keys).agg(F.max(date).alias("_last"), past.alias("_past"))
    x = g.select(*keys, "_last", "_past", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"))
    x = x.withColumns({date: F.date_add("_last", F.col("horizon")), "step": F.col("horizon").cast("double")}).drop("_last")
    return _features(x, F.lit(0), date)


def ml_members(daily: DataFrame, horizon: int, keys: Sequence[str] = ("outcome",), date: str = "date", seed: int = 17, trees: int = 50) -> DataFrame:
    """MD21: random forest, boosted trees and Poisson regression, fitted on all series at once; forecasts of every day ahead."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression, RandomForestRegressor

    logs = [f"log_{c}" for c in ML_FEATURES if c.startswith(("lag", "mean"))]
    prepare = lambda df: df.withColumns({c: F.log1p(F.greatest(F.lit(0.0), c[4:])) for c in logs})
    train, future = fold(prepare(direct_rows(daily, [h for h in STEPS if h <= max(horizon, STEPS[0])], keys, date))), prepare(future_rows(daily, horizon, keys, date))
    whole = VectorAssembler(inputCols=ML_FEATURES, outputCol="features")
    linear = [OneHotEncoder(inputCols=["dow"], outputCols=["day"], handleInvalid="keep"), VectorAssembler(inputCols=[*logs, "step", "day"], outputCol="features")]
    models = {"random_forest": [whole, RandomForestRegressor(labelCol="y", numTrees=trees, seed=seed, minInstancesPerNode=2)],
              "gradient_boosting": [whole, GBTRegressor(labelCol="y", maxIter=20, seed=seed)],
              "poisson": [*linear, GeneralizedLinearRegression(labelCol="y", family="poisson", link="log", regParam=0.1, maxIter=50)]}
    out = None
    for n, stages in models.items():
        p = Pipeline(stages=stages).fit(train).transform(future).select(*keys, "horizon", F.col(date), F.lit(n).alias("member"), F.greatest(F.lit(0.0), "prediction").alias("pred"))
        out = p if out is None else out.unionByName(p)
    return out


def all_members(daily: DataFrame, horizon: int, keys: Sequence[str] = ("outcome",), date: str = "date", trees: int = 50) -> DataFrame:
    """MD20: closed-form and machine-learning members in one table."""
    return daily_members(daily, horizon, keys, date).unionByName(ml_members(daily, horizon, keys, date, trees=trees), allowMissingColumns=True)


def holdout_error(daily: DataFrame, horizon: int, keys: Sequence[str] = ("outcome",), date: str = "date", trees: int = 50) -> DataFrame:
    """MD20: root mean square error of the ensemble mean on the last `horizon` days, forecast from the days before, up to each step of STEPS."""
    last = W.partitionBy(*keys)
    d = daily.withColumn("_cut", F.date_sub(F.max(date).over(last), horizon))
    seen = fold(d.filter(F.col(date) <= F.col("_cut")).drop("_cut"))
    mean = all_members(seen, horizon, keys, date, trees).groupBy(*keys, "horizon", date).agg(F.avg("pred").alias("pred"))
    miss = mean.join(daily.select(*keys, date, F.col("y").cast("double").alias("y")), [*keys, date])
    upto = miss.select(*keys, F.explode(F.array(*[F.lit(h) for h in STEPS[1:] if h <= horizon])).alias("upto"), "horizon", F.pow(F.col("pred") - F.col("y"), 2).alias("e")).filter(F.col("horizon") <= F.col("upto"))
    return upto.groupBy(*keys, "upto").agg(F.sqrt(F.avg("e")).alias("rmse"), F.count(F.lit(1)).alias("days"))


def ensemble_with_holdout(members: DataFrame, errors: DataFrame, keys: Sequence[str] = ("outcome",)) -> DataFrame:
    """MD20: `ensemble_daily` whose band takes the error seen on held-out days in place of the recent spread of the series."""
    m = members.drop("resid_sd")
    step = m.select(*keys, "horizon").distinct().join(errors, list(keys)).filter(F.col("upto") >= F.col("horizon"))
    first = step.groupBy(*keys, "horizon").agg(F.min(F.struct("upto", "rmse"))["rmse"].alias("resid_sd"))
    return ensemble_daily(m.join(first, [*keys, "horizon"], "left"), keys)


def ensemble_daily(members: DataFrame, keys: Sequence[str] = ("outcome",)) -> DataFrame:
    """MD20: mean of the members, band from their spread and the recent residual, and member quantiles."""
    g = members.groupBy(*keys, "horizon", "date").agg(
        F.avg("pred").alias("pred"), F.stddev_pop("pred").alias("_sd"), F.max("resid_sd").alias("_r"), F.count(F.lit(1)).alias("members"),
        F.percentile("pred", F.lit(0.025)).alias("q025"), F.percentile("pred", F.lit(0.975)).alias("q975"))
    sd = F.sqrt(F.pow("_sd", 2) + F.pow(F.coalesce("_r", F.lit(0.0)), 2))
    return g.select(*keys, "horizon", "date", "pred", F.greatest(F.lit(0.0), F.col("pred") - 1.96 * sd).alias("lower_95"), (F.col("pred") + 1.96 * sd).alias("upper_95"),
                    "q025", "q975", "members")


def horizon_totals(ens: DataFrame, horizons: Sequence[int] = (7, 15, 30, 45, 60), keys: Sequence[str] = ("outcome",), population=None) -> DataFrame:
    """MD20: totals per horizon and, with a population, the predicted incidence."""
    x = ens.select("*", F.explode(F.array(*[F.lit(h) for h in horizons])).alias("days")).filter(F.col("horizon") <= F.col("days"))
    g = x.groupBy(*keys, "days").agg(F.sum("pred").alias("total"), F.sum("lower_95").alias("lower_95"), F.sum("upper_95").alias("upper_95"))
    return g if population is None else g.withColumn("incidence_100k", F.col("total") / population * 100000.0)
