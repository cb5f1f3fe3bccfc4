"""Nowcast, forecast and backtest (MD14-MD25, AG53)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import forecast as P
from ..operators import nowcast as N
from ..operators import series as T
from ..operators.filters import fold, latest
from ..plans import cases as C
from .q_expressions import CASES
from .registry import query

ON = "coalesce(onset_date, event_date)"
WLAG = f"CAST(greatest(0, (date_trunc('week', coalesce(notified_date, {ON}))::DATE - date_trunc('week', {ON})::DATE) // 7) AS INTEGER)"
STRATA = f""", aso AS (SELECT max(event_date) AS d FROM cases), pre AS (SELECT region, class_group = 'Doença meningocócica' AS dm, date_trunc('week', {ON})::DATE AS monday, {WLAG} AS delay FROM cases),
st AS (SELECT 'STATE' AS stratum, monday, delay FROM pre UNION ALL SELECT 'DM', monday, delay FROM pre WHERE dm UNION ALL SELECT 'REGION::' || region, monday, delay FROM pre),
hist AS (SELECT stratum, delay, count(*) AS n FROM st WHERE delay BETWEEN 0 AND 52 GROUP BY 1, 2), wk0 AS (SELECT stratum, monday, count(*) AS y FROM st GROUP BY 1, 2),
cal AS (SELECT stratum, unnest(generate_series(lo, greatest(hi, (SELECT date_trunc('week', d)::DATE FROM aso)), INTERVAL 7 DAY))::DATE AS monday FROM (SELECT stratum, min(monday) AS lo, max(monday) AS hi FROM wk0 GROUP BY 1)),
wk AS (SELECT stratum, monday, coalesce(y, 0) AS y FROM cal LEFT JOIN wk0 USING (stratum, monday)),
grid AS (SELECT stratum, delay FROM (SELECT DISTINCT stratum FROM wk), (SELECT unnest(range(0, 13))::INTEGER AS delay)),
cdf AS (SELECT grid.stratum, grid.delay, least(1.0, greatest(0.08, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY grid.stratum ORDER BY grid.delay) AS DOUBLE) / tot)) AS cdf, tot AS n_obs
  FROM grid LEFT JOIN hist USING (stratum, delay) JOIN (SELECT stratum, CAST(sum(n) AS BIGINT) AS tot FROM hist GROUP BY 1) USING (stratum)),
nc AS (SELECT stratum, monday, y::DOUBLE AS observed, delay, cdf AS p_reported, y / cdf AS nowcast, greatest(0, y / cdf - y) AS increment FROM (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY monday DESC) AS rn, CAST(least(12, greatest(0, (SELECT d FROM aso) - (monday + 6)) // 7) AS INTEGER) AS delay FROM wk) JOIN cdf USING (stratum, delay) WHERE rn <= 6)"""


def parts(s, d):
    c = C.cases(s, d)
    w, h = N.strata_weekly(c)
    day = latest(c)
    return c, T.fill_weeks(w, ["stratum"], day), h, day


@query("md14_delay_cdf_weeks", CASES + STRATA + " SELECT stratum, delay, cdf, n_obs FROM cdf", "cdf")
def _(s, d):
    _, w, h, _ = parts(s, d)
    return N.delay_cdf(h, w, ["stratum"])


@query("md14_delay_cdf_days", CASES + f""", h AS (SELECT coalesce(notified_date, {ON}) - {ON} AS delay, count(*) AS n FROM cases GROUP BY 1 HAVING delay BETWEEN 0 AND 365), g AS (SELECT unnest(range(0, 61)) AS delay)
SELECT CAST(g.delay AS INTEGER) AS delay, least(1.0, greatest(0.05, CAST(sum(coalesce(n, 0)) OVER (ORDER BY g.delay) AS DOUBLE) / (SELECT sum(n) FROM h))) AS cdf, (SELECT CAST(sum(n) AS BIGINT) FROM h) AS n_obs FROM g LEFT JOIN h ON g.delay = h.delay""", "cdf")
def _(s, d):
    return N.delay_cdf(N.delay_histogram(C.cases(s, d), unit="day"), unit="day", max_delay=60)


@query("md15_nowcast", CASES + STRATA + " SELECT stratum, monday::VARCHAR AS monday, observed, delay, p_reported, nowcast, increment FROM nc", "observed p_reported nowcast increment")
def _(s, d):
    _, w, h, day = parts(s, d)
    return N.nowcast(w, N.delay_cdf(h, w, ["stratum"]), day, ["stratum"])


@query("md15_nowcast_days", CASES + f""", h AS (SELECT coalesce(notified_date, {ON}) - {ON} AS delay, count(*) AS n FROM cases GROUP BY 1 HAVING delay BETWEEN 0 AND 365),
w AS (SELECT date_trunc('week', event_date)::DATE AS monday, count(*) AS y FROM cases GROUP BY 1 ORDER BY 1 DESC LIMIT 4),
x AS (SELECT *, CAST(least(60, greatest(0, (SELECT max(event_date) FROM cases) - (monday + 6))) AS INTEGER) AS delay FROM w),
y AS (SELECT x.*, (SELECT least(1.0, greatest(0.05, CAST(sum(n) AS DOUBLE) / (SELECT sum(n) FROM h))) FROM h WHERE h.delay <= x.delay) AS p_reported FROM x)
SELECT monday::VARCHAR AS monday, y::DOUBLE AS observed, delay, p_reported, y / p_reported AS nowcast FROM y""", "observed p_reported nowcast")
def _(s, d):
    c = C.cases(s, d)
    return N.nowcast_days(T.weekly_counts(c), N.delay_cdf(N.delay_histogram(c, unit="day"), unit="day", max_delay=60), latest(c))


BAND = """, rep AS (SELECT stratum, delay, n, rep, md5(stratum || '|' || delay || '|' || rep || '|42') AS k FROM hist, (SELECT unnest(range(1, 201)) AS rep)),
wt AS (SELECT stratum, delay, rep, greatest(0, n + sqrt(n) * sqrt(-2 * ln((('0x' || substr(k, 1, 8))::BIGINT + 1) / 4294967297.0)) * cos(2 * pi() * ((('0x' || substr(k, 9, 8))::BIGINT + 1) / 4294967297.0))) AS w FROM rep),
pp AS (SELECT wt.stratum, l.delay AS lag, rep, least(1.0, greatest(0.08, sum(CASE WHEN wt.delay <= l.delay THEN w ELSE 0 END) / sum(w))) AS p FROM wt JOIN (SELECT DISTINCT stratum, delay FROM nc) l ON l.stratum = wt.stratum GROUP BY 1, 2, 3),
qq AS (SELECT stratum, lag, quantile_cont(p, 0.1) AS p10, quantile_cont(p, 0.9) AS p90 FROM pp GROUP BY 1, 2),
nb AS (SELECT nc.*, least(observed / p90, observed / p10) AS nowcast_p10, greatest(observed / p90, observed / p10) AS nowcast_p90 FROM nc JOIN qq ON nc.stratum = qq.stratum AND nc.delay = lag)"""


@query("md16_nowcast_band", CASES + STRATA + BAND + " SELECT stratum, monday::VARCHAR AS monday, observed, nowcast, nowcast_p10, nowcast_p90 FROM nb", "observed nowcast nowcast_p10 nowcast_p90")
def _(s, d):
    _, w, h, day = parts(s, d)
    b = N.nowcast_band(N.nowcast(w, N.delay_cdf(h, w, ["stratum"]), day, ["stratum"]), h, ["stratum"])
    return b.select("stratum", "monday", "observed", "nowcast", "nowcast_p10", "nowcast_p90")


@query("md17_nowcast_simple", CASES + """, m AS (SELECT max(event_date) AS m FROM cases), g AS (SELECT count(*) FILTER (WHERE event_date >= m - 6) AS o, count(*) FILTER (WHERE event_date < m - 6) AS p FROM cases, m WHERE event_date >= m - 14)
SELECT o AS observed_7d, CASE WHEN o > 0 AND p > 0 THEN p / o::DOUBLE ELSE 1 END AS factor, o * CASE WHEN o > 0 AND p > 0 THEN p / o::DOUBLE ELSE 1 END AS nowcast_7d FROM g""", "factor nowcast_7d")
def _(s, d):
    return N.nowcast_simple(C.cases(s, d))


@query("md17_nowcast_median", CASES + " UNION ALL ".join(f"""{'SELECT' if i else ' SELECT'} '{o}' AS outcome, iso_year, iso_week, v AS observed, m AS median_8, greatest(v, m) AS nowcast, greatest(v, m) - v AS delay_estimate, CASE WHEN v > 0 THEN greatest(v, m) / v END AS factor FROM (
 SELECT iso_year, iso_week, sum({o})::DOUBLE AS v, (SELECT quantile_cont(x, 0.5) FROM (SELECT sum({o}) AS x FROM cases GROUP BY iso_year, iso_week ORDER BY iso_year DESC, iso_week DESC LIMIT 8 OFFSET 1)) AS m FROM cases GROUP BY 1, 2 ORDER BY iso_year DESC, iso_week DESC LIMIT 1)"""
                                                              for i, o in enumerate(["case_n", "hospitalised", "death"])), "observed median_8 nowcast delay_estimate factor")
def _(s, d):
    return N.nowcast_median(C.cases(s, d))


_MU = "(list_avg(x[-4:]) + list_avg(x[-8:]) + CASE WHEN len(x) >= 52 THEN x[-52] ELSE list_avg(x[-8:]) END + greatest(0, list_avg(x[-6:]) + 3.5 * (-2.5 * x[-6] - 1.5 * x[-5] - 0.5 * x[-4] + 0.5 * x[-3] + 1.5 * x[-2] + 2.5 * x[-1]) / 17.5)) / 4"
_MEM = "[list_avg(x[-4:]), list_avg(x[-8:]), CASE WHEN len(x) >= 52 THEN x[-52] ELSE list_avg(x[-8:]) END, greatest(0, list_avg(x[-6:]) + 3.5 * (-2.5 * x[-6] - 1.5 * x[-5] - 0.5 * x[-4] + 0.5 * x[-3] + 1.5 * x[-2] + 2.5 * x[-1]) / 17.5)]"


def rec(source, horizon=8):
    head, tail = CASES.split("WITH ", 1)[0], CASES.split("WITH ", 1)[1]
    return head + "WITH RECURSIVE " + tail + STRATA, f""", {source}, f AS (SELECT stratum, 0 AS h, list(y::DOUBLE ORDER BY monday) AS x, max(monday) AS last, NULL::DOUBLE[] AS m, NULL::DOUBLE AS s12 FROM ser GROUP BY 1 UNION ALL
 SELECT stratum, h + 1, list_append(x, {_MU}), last, {_MEM}, list_stddev_pop(x[-12:]) FROM f WHERE h < {horizon}),
fc AS (SELECT stratum, CAST(h AS INTEGER) AS horizon, (last + CAST(7 * h AS INTEGER))::DATE AS monday, x[-1] AS mu, list_stddev_pop(m) + 0.3 * s12 AS sd, m FROM f WHERE h > 0)"""


_h, _t = rec("ser AS (SELECT * FROM wk)")
FC_COLS = """stratum, horizon, monday::VARCHAR AS monday, CAST(isoyear(monday) AS VARCHAR) || '-S' || lpad(CAST(weekofyear(monday) AS VARCHAR), 2, '0') AS period, greatest(0, mu) AS pred, greatest(0, mu - 1.28 * sd) AS lower_80, mu + 1.28 * sd AS upper_80,
 m[1] AS ma4, m[2] AS ma8, m[3] AS seasonal_52, m[4] AS trend"""


@query("md18_forecast_weekly", _h + _t + f" SELECT {FC_COLS} FROM fc", "pred lower_80 upper_80 ma4 ma8 seasonal_52 trend")
def _(s, d):
    _, w, _, _ = parts(s, d)
    return P.forecast_weekly(w)


@query("md19_apply_nowcast", CASES + STRATA + " SELECT wk.stratum, wk.monday::VARCHAR AS monday, coalesce(nowcast, wk.y) AS y FROM wk LEFT JOIN nc USING (stratum, monday)", "y")
def _(s, d):
    _, w, h, day = parts(s, d)
    nc = N.nowcast(w, N.delay_cdf(h, w, ["stratum"]), day, ["stratum"])
    return N.apply_nowcast(w, nc, ["stratum"]).select("stratum", "monday", "y")


@query("md23_backtest", CASES + STRATA + f""", a AS (SELECT stratum, list(y::DOUBLE ORDER BY monday) AS v, list(monday ORDER BY monday) AS dd FROM wk GROUP BY 1), b AS (SELECT stratum, v[:len(v) - i] AS x, v[-i] AS observed, dd[-i] AS monday FROM a, (SELECT unnest(range(1, 9)) AS i)),
p AS (SELECT stratum, monday::VARCHAR AS monday, observed, greatest(0, {_MU}) AS predicted FROM b) SELECT *, abs(predicted - observed) AS abs_error, CASE WHEN observed > 0 THEN 1e2 * abs(predicted - observed) / observed END AS pct_error FROM p""", "observed predicted abs_error pct_error")
def _(s, d):
    return P.backtest(parts(s, d)[1])


_BT = f""", a AS (SELECT stratum, list(y::DOUBLE ORDER BY monday) AS v FROM wk GROUP BY 1), b AS (SELECT stratum, v[:len(v) - i] AS x, v[-i] AS observed FROM a, (SELECT unnest(range(1, 9)) AS i)),
bts AS (SELECT stratum, avg(abs(p - observed)) AS mae, avg(CASE WHEN observed > 0 THEN 1e2 * abs(p - observed) / observed END) AS mape FROM (SELECT stratum, observed, greatest(0, {_MU}) AS p FROM b) GROUP BY 1)"""


@query("md23_backtest_summary", CASES + STRATA + _BT + " SELECT *, CASE WHEN mape <= 60 THEN 'publicavel' WHEN mape <= 100 THEN 'cautela' ELSE 'nao_publicavel' END AS quality FROM bts", "mae mape")
def _(s, d):
    return P.backtest_summary(P.backtest(parts(s, d)[1]))


_h2, _t2 = rec("ser AS (SELECT wk.stratum, wk.monday, coalesce(nowcast, wk.y) AS y FROM wk LEFT JOIN nc USING (stratum, monday))")


@query("md24_run_strata", _h2 + _t2 + _BT + """, rf AS (SELECT stratum, coalesce(max(monday) FILTER (WHERE observed > 0), max(monday)) AS monday FROM nc GROUP BY 1),
prof AS (SELECT iso_week, quantile_cont(c, 0.75) AS p75, quantile_cont(c, 0.95) AS p95 FROM (SELECT iso_year, iso_week, count(*) AS c FROM cases GROUP BY 1, 2) GROUP BY 1)
SELECT stratum, rf.monday::VARCHAR AS monday, observed, nowcast, CASE WHEN p75 IS NULL THEN 'sem_perfil' WHEN nowcast > p95 THEN 'acima_p95_sazonal' WHEN nowcast > p75 THEN 'acima_p75_sazonal' ELSE 'rotina' END AS alert, mae, mape,
  CASE WHEN mape <= 60 THEN 'publicavel' WHEN mape <= 100 THEN 'cautela' ELSE 'nao_publicavel' END AS quality, f1.mu AS forecast_1, f4.mu AS forecast_4
FROM rf JOIN nc USING (stratum, monday) JOIN bts USING (stratum) LEFT JOIN prof ON iso_week = weekofyear(rf.monday) JOIN (SELECT stratum, greatest(0, mu) AS mu FROM fc WHERE horizon = 1) f1 USING (stratum) JOIN (SELECT stratum, greatest(0, mu) AS mu FROM fc WHERE horizon = 4) f4 USING (stratum)""",
       "observed nowcast mae mape forecast_1 forecast_4")
def _(s, d):
    c = C.cases(s, d)
    return P.run_strata(c, latest(c))["summary"]


@query("md24_regional_ranking", CASES + STRATA + """, rf AS (SELECT stratum, coalesce(max(monday) FILTER (WHERE observed > 0), max(monday)) AS monday FROM nc GROUP BY 1)
SELECT replace(stratum, 'REGION::', '') AS region, nowcast, row_number() OVER (ORDER BY nowcast DESC, stratum) AS rank FROM rf JOIN nc USING (stratum, monday) WHERE stratum LIKE 'REGION::%'""", "nowcast")
def _(s, d):
    _, w, h, day = parts(s, d)
    r = N.reference_week(N.nowcast(w, N.delay_cdf(h, w, ["stratum"]), day, ["stratum"]), ["stratum"])
    return P.regional_ranking(r).select("region", "nowcast", "rank")


@query("md25_seasonal_alert", CASES + STRATA + """, rf AS (SELECT stratum, coalesce(max(monday) FILTER (WHERE observed > 0), max(monday)) AS monday FROM nc GROUP BY 1),
prof AS (SELECT iso_week, quantile_cont(c, 0.75) AS p75, quantile_cont(c, 0.95) AS p95 FROM (SELECT iso_year, iso_week, count(*) AS c FROM cases GROUP BY 1, 2) GROUP BY 1)
SELECT stratum, rf.monday::VARCHAR AS monday, nowcast, p75, p95, CASE WHEN p75 IS NULL THEN 'sem_perfil' WHEN nowcast > p95 THEN 'acima_p95_sazonal' WHEN nowcast > p75 THEN 'acima_p75_sazonal' ELSE 'rotina' END AS alert
FROM rf JOIN nc USING (stratum, monday) LEFT JOIN prof ON iso_week = weekofyear(rf.monday)""", "nowcast p75 p95")
def _(s, d):
    c, w, h, day = parts(s, d)
    r = N.reference_week(N.nowcast(w, N.delay_cdf(h, w, ["stratum"]), day, ["stratum"]), ["stratum"])
    return N.seasonal_alert(r, T.week_profile(c)).select("stratum", "monday", "nowcast", "p75", "p95", "alert")


# ---- daily ensemble --------------------------------------------------------------------------

OUTS = {"cases": "case_n", "hospitalised": "hospitalised", "deaths": "death"}
DAILY = """, dc AS (SELECT event_date AS date, sum(case_n) AS cases, sum(hospitalised) AS hospitalised, sum(death) AS deaths FROM cases GROUP BY 1),
dd AS (SELECT unnest(generate_series((SELECT min(date) FROM dc), (SELECT max(date) FROM dc), INTERVAL 1 DAY))::DATE AS date),
ds AS (""" + " UNION ALL ".join(f"SELECT '{o}' AS outcome, dd.date, coalesce({o}, 0)::DOUBLE AS y FROM dd LEFT JOIN dc USING (date)" for o in OUTS) + """),
a AS (SELECT outcome, max(date) AS last, list(y ORDER BY date) AS x FROM ds GROUP BY 1), ar AS (SELECT outcome, regr_slope(y, l) AS phi, regr_intercept(y, l) AS c FROM (SELECT outcome, y, lag(y) OVER (PARTITION BY outcome ORDER BY date) AS l FROM ds) GROUP BY 1),
hz AS (SELECT unnest(range(1, 61)) AS h), mb AS (SELECT outcome, CAST(h AS INTEGER) AS horizon, (last + CAST(h AS INTEGER))::DATE AS date, list_stddev_pop(x[-30:]) AS rs,
  [x[-1], x[-7 + (h - 1) % 7], list_avg(x[-7:]), list_avg(x[-14:]), greatest(0, c / (1 - phi) + pow(phi, h) * (x[-1] - c / (1 - phi)))] AS p FROM a JOIN ar USING (outcome), hz),
en AS (SELECT outcome, horizon, date, list_avg(p) AS pred, greatest(0, list_avg(p) - 1.96 * sqrt(pow(list_stddev_pop(p), 2) + pow(rs, 2))) AS lower_95, list_avg(p) + 1.96 * sqrt(pow(list_stddev_pop(p), 2) + pow(rs, 2)) AS upper_95,
  list_aggregate(p, 'quantile_cont', 0.025) AS q025, list_aggregate(p, 'quantile_cont', 0.975) AS q975, 5::BIGINT AS members FROM mb)"""


def daily(s, d):
    g = C.cases(s, d).groupBy(F.col("event_date").alias("date")).agg(*[F.sum(c).alias(o) for o, c in OUTS.items()])
    full = T.fill_days(g, measures=list(OUTS))
    return full.select("date", F.inline(F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(o).alias("y")) for o in OUTS])))


@query("md20_forecast_daily", CASES + DAILY + " SELECT outcome, horizon, date::VARCHAR AS date, pred, lower_95, upper_95, q025, q975, members FROM en", "pred lower_95 upper_95 q025 q975")
def _(s, d):
    return P.ensemble_daily(P.daily_members(daily(s, d), 60))


@query("md20_horizon_totals", CASES + DAILY + """, pp AS (SELECT sum(p) AS p FROM (SELECT arg_max(population, year) AS p FROM pop GROUP BY code6))
SELECT outcome, CAST(days AS INTEGER) AS days, sum(pred) AS total, sum(lower_95) AS lower_95, sum(upper_95) AS upper_95, sum(pred) / (SELECT p FROM pp) * 1e5 AS incidence_100k FROM en, (SELECT unnest([7, 15, 30, 45, 60]) AS days) WHERE horizon <= days GROUP BY 1, 2""",
       "total lower_95 upper_95 incidence_100k")
def _(s, d):
    from ..operators.joins import latest_population

    pop = latest_population(C.population(s, d)).agg(F.sum("population")).scalar()
    return P.horizon_totals(P.ensemble_daily(P.daily_members(daily(s, d), 60)), population=pop)


@query("md22_ar1_member", CASES + DAILY + " SELECT outcome, horizon, p[5] AS pred FROM mb", "pred")
def _(s, d):
    return P.daily_members(daily(s, d), 60).filter(F.col("member") == "ar1").select("outcome", "horizon", "pred")


@query("md20_ensemble_all")
def _(s, d):
    """Closed-form and machine-learning members; the band from 60 held-out days."""
    days = fold(daily(s, d))
    return P.ensemble_with_holdout(P.all_members(days, 60, trees=20), P.holdout_error(days, 60, trees=20))


@query("md21_ml_members")
def _(s, d):
    return P.ml_members(fold(daily(s, d)), 60, trees=20)


_PAST = ", ".join(f"v[len(v) - h - {i}] AS lag{i}" for i in range(P.LAGS))
_CAL = "CAST(isodow(date) - 1 AS DOUBLE) AS dow, CAST(month(date) AS DOUBLE) AS month, CAST(dayofyear(date) AS DOUBLE) AS doy"
_MEANS = ", ".join(f"({' + '.join(f'lag{i}' for i in range(n))}) / {n} AS mean{n}" for n in (7, 14))


@query("md21_training_rows", CASES + DAILY + f""", pv AS (SELECT outcome, date, y, list(y) OVER (PARTITION BY outcome ORDER BY date ROWS BETWEEN 73 PRECEDING AND CURRENT ROW) AS v FROM ds),
tr AS (SELECT outcome, date, y, CAST(h AS DOUBLE) AS step, {_PAST} FROM pv, (SELECT unnest({list(P.STEPS)}) AS h) WHERE len(v) >= h + 14)
SELECT * REPLACE (date::VARCHAR AS date), {_MEANS}, {_CAL} FROM tr""", "mean7 mean14")
def _(s, d):
    return P.direct_rows(daily(s, d))


@query("md21_future_rows", CASES + DAILY + f""", pv AS (SELECT outcome, max(date) AS last, list(y ORDER BY date) AS v FROM ds GROUP BY 1),
fr AS (SELECT outcome, CAST(k AS INTEGER) AS horizon, (last + CAST(k AS INTEGER))::DATE AS date, CAST(k AS DOUBLE) AS step, {_PAST} FROM (SELECT *, 0 AS h FROM pv), (SELECT unnest(range(1, 61)) AS k))
SELECT * REPLACE (date::VARCHAR AS date), {_MEANS}, {_CAL} FROM fr""", "mean7 mean14")
def _(s, d):
    return P.future_rows(daily(s, d), 60)


@query("ag53_week_summary", CASES + STRATA + f""", rf AS (SELECT stratum, coalesce(max(monday) FILTER (WHERE observed > 0), max(monday)) AS monday FROM nc GROUP BY 1), r AS (SELECT * FROM rf JOIN nc USING (stratum, monday)),
lg AS (SELECT quantile_cont(l, 0.5) AS p50, quantile_cont(l, 0.9) AS p90 FROM (SELECT lag_onset_notif AS l FROM cases) WHERE l BETWEEN 0 AND 365)
SELECT CAST(weekofyear(monday) AS INTEGER) AS iso_week, observed, nowcast, (SELECT nowcast FROM r WHERE stratum = 'DM') AS dm_nowcast, p50 AS delay_p50, p90 AS delay_p90,
  (SELECT count(*) FROM cases WHERE closed_date IS NULL) AS open_cases, (SELECT 1e2 * count(*) FILTER (WHERE lag_notif_invest BETWEEN 0 AND 2) / count(*) FROM cases) AS pct_investigated_48h FROM r, lg WHERE stratum = 'STATE'""",
       "observed nowcast dm_nowcast delay_p50 delay_p90 pct_investigated_48h")
def _(s, d):
    from ..operators.digest import week_summary

    c, w, h, day = parts(s, d)
    return week_summary(c, N.reference_week(N.nowcast(w, N.delay_cdf(h, w, ["stratum"]), day, ["stratum"]), ["stratum"]))
