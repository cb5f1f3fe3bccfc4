"""Windows and time series (WN1-WN19, AG59)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rates as R
from ..operators import series as T
from ..plans import cases as C
from .q_expressions import CASES
from .registry import query

DAY = """, s AS (SELECT event_date AS date, count(*) AS y FROM cases GROUP BY 1),
cal AS (SELECT unnest(generate_series((SELECT min(date) FROM s), (SELECT max(date) FROM s), INTERVAL 1 DAY))::DATE AS date),
ds AS (SELECT cal.date, coalesce(y, 0) AS y FROM cal LEFT JOIN s USING (date))"""


def daily(s, d):
    return T.fill_days(C.cases(s, d).groupBy(F.col("event_date").alias("date")).agg(F.count(F.lit(1)).alias("y")))


WEEK = """, wk AS (SELECT region, date_trunc('week', event_date)::DATE AS monday, count(*) AS y FROM cases GROUP BY 1, 2),
wcal AS (SELECT region, unnest(generate_series(lo, hi, INTERVAL 7 DAY))::DATE AS monday FROM (
  SELECT region, min(monday) AS lo, (SELECT date_trunc('week', max(event_date)) FROM cases)::DATE AS hi FROM wk GROUP BY 1)),
ws AS (SELECT region, monday, coalesce(y, 0) AS y, CAST(isoyear(monday) AS INTEGER) AS iso_year, CAST(weekofyear(monday) AS INTEGER) AS iso_week
  FROM wcal LEFT JOIN wk USING (region, monday))"""


@query("wn01_fill_days", CASES + DAY + " SELECT date::VARCHAR AS date, y FROM ds")
def _(s, d):
    return daily(s, d)


@query("wn02_fill_weeks", CASES + WEEK + """ SELECT region, monday::VARCHAR AS monday, y, iso_year, iso_week,
  iso_year || '-S' || lpad(CAST(iso_week AS VARCHAR), 2, '0') AS period FROM ws""")
def _(s, d):
    from ..operators.filters import latest

    c = C.cases(s, d)
    return T.fill_weeks(T.weekly_counts(c, ["region"]), ["region"], latest(c))


@query("wn03_moving_avg", CASES + DAY + """ SELECT date::VARCHAR AS date, y, avg(y) OVER (ORDER BY date ROWS 6 PRECEDING) AS ma7,
  avg(y) OVER (ORDER BY date ROWS 13 PRECEDING) AS ma14, avg(y) OVER (ORDER BY date ROWS 29 PRECEDING) AS ma30 FROM ds""", "ma7 ma14 ma30")
def _(s, d):
    return T.moving_avg(daily(s, d))


@query("wn04_lag_features", CASES + DAY + """ SELECT date::VARCHAR AS date, y, lag(y, 1) OVER (ORDER BY date) AS lag1, lag(y, 7) OVER (ORDER BY date) AS lag7,
  CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS t, CAST(isodow(date) - 1 AS INTEGER) AS dow, CAST(month(date) AS INTEGER) AS month, CAST(dayofyear(date) AS INTEGER) AS doy FROM ds""")
def _(s, d):
    return T.lag_features(daily(s, d))


_MUN = """, m AS (SELECT municipality, event_year, 1e5 * sum(case_n) / nullif(max(population), 0) AS inc, 1e5 * sum(death) / nullif(max(population), 0) AS mort,
  1e2 * sum(death) / nullif(sum(confirmed), 0) AS fat FROM cases GROUP BY 1, 2)"""


def pr(c):
    return f"((rank() OVER (PARTITION BY event_year ORDER BY coalesce({c}, 0)) + (count(*) OVER (PARTITION BY event_year, coalesce({c}, 0)) - 1) / 2.0) / count(*) OVER (PARTITION BY event_year))"


@query("wn05_risk_rank", CASES + _MUN + f" SELECT municipality, event_year, {pr('inc')} + {pr('mort')} + {pr('fat')} AS risk_score FROM m", "risk_score")
def _(s, d):
    r = R.rates(C.cases(s, d), ["municipality", "event_year"])
    return T.pct_rank_score(r, ["incidence_100k", "mortality_100k", "pct_fatality"], keys=["event_year"]).select("municipality", "event_year", "risk_score")


@query("wn06_rank_min", CASES + """ SELECT municipality, p, rank() OVER (ORDER BY p DESC) AS rank FROM (
  SELECT municipality, 1e2 * count(*) FILTER (WHERE closed_date IS NOT NULL) / count(*) AS p FROM cases GROUP BY 1)""", "p")
def _(s, d):
    g = C.cases(s, d).groupBy("municipality").agg((100.0 * F.count("closed_date") / F.count(F.lit(1))).alias("p"))
    return T.rank_min(g, "p")


@query("wn07_space_time_scan", CASES + """, k AS (SELECT municipality, date_trunc('week', event_date)::DATE AS monday, count(*) AS y FROM cases
  WHERE class_group = 'Doença meningocócica' GROUP BY 1, 2), b AS (SELECT min(monday) AS lo, max(monday) AS hi FROM k),
u AS (SELECT m.municipality, w.monday FROM (SELECT DISTINCT municipality FROM k) m CROSS JOIN (SELECT unnest(generate_series(lo, hi, INTERVAL 7 DAY))::DATE AS monday FROM b) w),
g AS (SELECT u.municipality, u.monday, coalesce(y, 0) AS y FROM u LEFT JOIN k ON k.municipality = u.municipality AND k.monday = u.monday),
r AS (SELECT *, sum(y) OVER (PARTITION BY municipality ORDER BY monday ROWS 3 PRECEDING) AS observed,
  CASE WHEN count(y) OVER p >= 4 THEN avg(y) OVER p * 4 END AS expected FROM g
  WINDOW p AS (PARTITION BY municipality ORDER BY monday ROWS BETWEEN 55 PRECEDING AND 4 PRECEDING)),
f AS (SELECT r.*, greatest(coalesce(expected, 0), 0.25) AS expected_adj FROM r, b WHERE monday >= hi - 182 AND observed > 0)
SELECT municipality, monday::VARCHAR AS monday, CAST(observed AS BIGINT) AS observed, expected, expected_adj, observed / expected_adj AS ratio,
  CAST(observed >= 2 AND observed / expected_adj >= 2 AS INTEGER) AS emerging FROM f""", "expected expected_adj ratio")
def _(s, d):
    return T.space_time_scan(C.cases(s, d).filter(F.col("class_group") == "Doença meningocócica"))


@query("wn08_fill_gaps", """WITH g AS (SELECT n_nationkey, y, CASE WHEN c > 80 THEN c END AS v FROM (SELECT n_nationkey, CAST(year(o_orderdate) AS INTEGER) AS y, count(*) AS c
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2))
SELECT n_nationkey, y, coalesce(last_value(v IGNORE NULLS) OVER (PARTITION BY n_nationkey ORDER BY y ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(v IGNORE NULLS) OVER (PARTITION BY n_nationkey ORDER BY y ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS v FROM g""")
def _(s, d):
    o, c = C.table(s, d, "orders"), C.table(s, d, "customer")
    g = o.join(c, o.o_custkey == c.c_custkey).groupBy(F.col("c_nationkey").alias("n_nationkey"), F.year("o_orderdate").alias("y")).agg(
        F.count(F.lit(1)).alias("c"))
    g = g.select("n_nationkey", "y", F.when(F.col("c") > 80, F.col("c")).alias("v"))
    return T.fill_gaps(g, ["n_nationkey"], "y", "v")


@query("wn09_doubling", CASES + WEEK + """ SELECT region, CAST(coalesce(bool_or(y >= 2 * p AND p >= 1), false) AS INTEGER) AS doubling FROM (
  SELECT region, y, lag(y) OVER (PARTITION BY region ORDER BY monday) AS p FROM wk) GROUP BY 1""")
def _(s, d):
    return T.doubling(T.weekly_counts(C.cases(s, d), ["region"]), ["region"], "monday")


@query("wn10_relative_to_mean", CASES + """ SELECT region, municipality, n, n / avg(n) OVER (PARTITION BY region) AS index FROM (
  SELECT region, municipality, count(*) AS n FROM cases GROUP BY 1, 2)""", "index")
def _(s, d):
    g = C.cases(s, d).groupBy("region", "municipality").agg(F.count(F.lit(1)).alias("n"))
    return T.relative_to_mean(g, ["region"], "n")


@query("wn12_delta_prev", CASES + """ SELECT event_year, n, n - lag(n) OVER (ORDER BY event_year) AS delta FROM (SELECT event_year, count(*) AS n FROM cases GROUP BY 1)""")
def _(s, d):
    g = C.cases(s, d).groupBy("event_year").agg(F.count(F.lit(1)).alias("n"))
    return T.delta_prev(g, [], "event_year", "n")


BASE = """, w AS (SELECT iso_year, iso_week, code6, class_group, count(*) AS cases FROM cases GROUP BY 1, 2, 3, 4),
cy AS (SELECT CAST(isoyear(max(event_date) - 7) AS INTEGER) AS y, CAST(weekofyear(max(event_date) - 7) AS INTEGER) AS k FROM cases),
b AS (SELECT iso_week, code6, class_group, avg(cases) AS mean_hist, coalesce(stddev_samp(cases), 0) AS sd_hist, max(cases) AS max_hist, quantile_cont(cases, 0.95) AS p95_hist
  FROM w, cy WHERE iso_year < y GROUP BY 1, 2, 3),
bl AS (SELECT *, mean_hist + 2 * sd_hist AS mean_2sd, greatest(max_hist, p95_hist, mean_hist + 2 * sd_hist) AS limit_hist FROM b)"""
_BD = "mean_hist sd_hist p95_hist mean_2sd limit_hist"


@query("wn13_weekly_baseline", CASES + BASE + " SELECT * FROM bl", _BD)
def _(s, d):
    from ..operators.filters import closed_parts

    c = C.cases(s, d)
    w = c.groupBy("iso_year", "iso_week", "code6", "class_group").agg(F.count(F.lit(1)).alias("cases"))
    return T.weekly_baseline(w, before=closed_parts(c)["closed_year"])


@query("jn03_vs_baseline", CASES + BASE + """ SELECT w.*, mean_hist, sd_hist, max_hist, p95_hist, mean_2sd, limit_hist FROM w JOIN cy ON iso_year = y AND iso_week = k
  LEFT JOIN bl USING (iso_week, code6, class_group)""", _BD)
def _(s, d):
    from ..operators.filters import closed_parts

    c = C.cases(s, d)
    w = c.groupBy("iso_year", "iso_week", "code6", "class_group").agg(F.count(F.lit(1)).alias("cases"))
    ref = closed_parts(c)
    y, k = ref["closed_year"], ref["closed_week"]
    cur = w.filter((F.col("iso_year") == y) & (F.col("iso_week") == k))
    return T.vs_baseline(cur, T.weekly_baseline(w, before=y), ["iso_week", "code6", "class_group"])


@query("wn14_endemic_channel", CASES + """, w AS (SELECT iso_year, iso_week, class_group, count(*) AS cases FROM cases GROUP BY 1, 2, 3), m AS (SELECT max(iso_year) AS y FROM w),
h AS (SELECT iso_week, class_group, min(cases) AS min_cases, quantile_cont(cases, 0.25) AS p25, avg(cases) AS mean_cases, quantile_cont(cases, 0.5) AS median_cases,
  quantile_cont(cases, 0.75) AS p75, max(cases) AS max_cases, quantile_cont(cases, 0.9) AS p90, quantile_cont(cases, 0.95) AS p95 FROM w, m WHERE iso_year < y GROUP BY 1, 2),
j AS (SELECT h.*, y AS year_observed, coalesce(cases, 0) AS observed FROM h, m LEFT JOIN w ON w.iso_year = y AND w.iso_week = h.iso_week AND w.class_group = h.class_group)
SELECT *, CASE WHEN observed > p90 THEN 'epidêmico/alerta' WHEN observed > p75 THEN 'alto' WHEN observed > median_cases THEN 'médio' ELSE 'baixo/esperado' END AS level,
  CAST(observed > p95 AS INTEGER) AS above_p95 FROM j""", "p25 mean_cases median_cases p75 p90 p95")
def _(s, d):
    return T.endemic_channel(C.cases(s, d))


@query("jn04_vs_observed", CASES + """, w AS (SELECT iso_year, iso_week, count(*) AS cases FROM cases GROUP BY 1, 2)
SELECT a.iso_week, a.mean_cases, coalesce(b.cases, 0) AS observed FROM (SELECT iso_week, avg(cases) AS mean_cases FROM w WHERE iso_year < 2001 GROUP BY 1) a
LEFT JOIN w b ON b.iso_year = 2001 AND a.iso_week = b.iso_week""", "mean_cases")
def _(s, d):
    from ..operators.joins import left_fill

    w = C.cases(s, d).groupBy("iso_year", "iso_week").agg(F.count(F.lit(1)).alias("cases"))
    h = w.filter("iso_year < 2001").groupBy("iso_week").agg(F.avg("cases").alias("mean_cases"))
    return left_fill(h, w.filter("iso_year = 2001").select("iso_week", F.col("cases").alias("observed")), ["iso_week"], {"observed": 0})


_MONTHS = "(['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez'])[event_month]"
SEAS = f""", mm AS (SELECT event_year, event_month, count(*) AS cases, sum(confirmed) AS cf, sum(death) AS dd FROM cases GROUP BY 1, 2),
pm AS (SELECT event_month, avg(cases) AS mean_cases, quantile_cont(cases, 0.5) AS median_cases, avg(cf) AS mean_confirmed, avg(dd) AS mean_deaths FROM mm GROUP BY 1),
si AS (SELECT *, mean_cases / avg(mean_cases) OVER () AS seasonal_index, {_MONTHS} AS label FROM pm)"""


@query("wn15_seasonal_index", CASES + SEAS + " SELECT *, CAST(seasonal_index > 1 AS INTEGER) AS above_mean FROM si",
       "mean_cases median_cases mean_confirmed mean_deaths seasonal_index")
def _(s, d):
    return T.seasonal_index(C.cases(s, d))


@query("wn15_seasonal_index_class", CASES + """, g AS (SELECT class_group, event_month, count(*) AS cases, count(*) / (SELECT CAST(count(DISTINCT event_year) AS DOUBLE) FROM cases) AS monthly_mean
  FROM cases GROUP BY 1, 2) SELECT *, monthly_mean / avg(monthly_mean) OVER (PARTITION BY class_group) AS seasonal_index FROM g""", "monthly_mean seasonal_index")
def _(s, d):
    return T.seasonal_index_by(C.cases(s, d), "class_group")


@query("wn15_seasonal_index_region", CASES + """, g AS (SELECT region, event_month, count(*) AS cases, count(*) / (SELECT CAST(count(DISTINCT event_year) AS DOUBLE) FROM cases) AS monthly_mean
  FROM cases GROUP BY 1, 2) SELECT *, monthly_mean / avg(monthly_mean) OVER (PARTITION BY region) AS seasonal_index FROM g""", "monthly_mean seasonal_index")
def _(s, d):
    return T.seasonal_index_by(C.cases(s, d), "region")


@query("wn16_week_heat", CASES + " SELECT iso_year, iso_week, count(*) AS cases, CAST(sum(confirmed) AS BIGINT) AS confirmed_n FROM cases GROUP BY 1, 2")
def _(s, d):
    return T.week_heat(C.cases(s, d))


@query("wn16_heat_pivot", CASES + " SELECT iso_week, " + ", ".join(
    f"nullif(count(*) FILTER (WHERE iso_year = {y}), 0) AS y{y}" for y in range(1995, 2002)) + " FROM cases GROUP BY 1")
def _(s, d):
    return T.heat_pivot(C.cases(s, d), range(1995, 2002))


@query("wn17_week_profile", CASES + """ SELECT iso_week, avg(c) AS mean_cases, quantile_cont(c, 0.5) AS median_cases, quantile_cont(c, 0.75) AS p75, quantile_cont(c, 0.95) AS p95
FROM (SELECT iso_year, iso_week, count(*) AS c FROM cases GROUP BY 1, 2) GROUP BY 1""", "mean_cases median_cases p75 p95")
def _(s, d):
    return T.week_profile(C.cases(s, d))


@query("wn17_peak_months", CASES + SEAS + """ SELECT * FROM (SELECT event_month, label, seasonal_index, row_number() OVER (ORDER BY seasonal_index DESC, event_month) AS rank_high,
  row_number() OVER (ORDER BY seasonal_index, event_month) AS rank_low FROM si) WHERE rank_high <= 3 OR rank_low <= 3""", "seasonal_index")
def _(s, d):
    return T.peak_months(C.cases(s, d))


LAGD = """, lc AS (SELECT CAST(l_shipdate AS DATE) AS date, avg(CASE WHEN l_quantity BETWEEN 2 AND 49 THEN l_quantity END) AS temperature, avg(l_discount) AS humidity FROM lineitem GROUP BY 1),
cc AS (SELECT event_date AS date, count(*) AS cases, sum(confirmed) AS confirmed_n FROM cases GROUP BY 1),
j AS (SELECT lc.date, temperature, humidity, coalesce(cases, 0) AS cases, coalesce(confirmed_n, 0) AS confirmed_n, row_number() OVER (ORDER BY lc.date) AS t FROM lc LEFT JOIN cc USING (date))"""


def climate_cases(s, d):
    from ..functions import numbers as N
    from ..operators.joins import left_fill
    from ..sources.reference import climate_daily

    li = C.table(s, d, "lineitem").select(F.to_date("l_shipdate").alias("date"), F.col("l_quantity").alias("temperature"), F.col("l_discount").alias("humidity"))
    clim = climate_daily(li, {"temperature": (2, 49), "humidity": (0, 1)})
    cc = C.cases(s, d).groupBy(F.col("event_date").alias("date")).agg(F.sum("case_n").alias("cases"), F.sum("confirmed").alias("confirmed_n"))
    return left_fill(clim, cc, ["date"], {"cases": 0, "confirmed_n": 0})


@query("jn05_climate_daily_join", CASES + LAGD + " SELECT date::VARCHAR AS date, temperature, humidity, cases, CAST(confirmed_n AS BIGINT) AS confirmed_n FROM j", "temperature humidity")
def _(s, d):
    return climate_cases(s, d)


_LC = "".join(f"""{' UNION ALL ' if i else ''}SELECT '{o}' AS outcome, '{v}' AS variable, lag, a.{o}::DOUBLE AS y, b.{v} AS x FROM lags JOIN j a ON true JOIN j b ON b.t = a.t - lag WHERE b.{v} IS NOT NULL"""
              for i, (o, v) in enumerate([(o, v) for o in ("cases", "confirmed_n") for v in ("temperature", "humidity")]))


@query("wn18_lag_corr", CASES + LAGD + f""", lags AS (SELECT unnest(range(0, 31)) AS lag), p AS ({_LC}),
rk AS (SELECT *, rank() OVER (PARTITION BY outcome, variable, lag ORDER BY x) + (count(*) OVER (PARTITION BY outcome, variable, lag, x) - 1) / 2.0 AS rx,
  rank() OVER (PARTITION BY outcome, variable, lag ORDER BY y) + (count(*) OVER (PARTITION BY outcome, variable, lag, y) - 1) / 2.0 AS ry FROM p)
SELECT outcome, variable, CAST(lag AS INTEGER) AS lag, count(*) AS n, corr(x, y) AS pearson, corr(rx, ry) AS spearman, pow(corr(x, y), 2) AS r2 FROM rk GROUP BY 1, 2, 3""",
       "pearson spearman r2")
def _(s, d):
    return T.lag_corr(climate_cases(s, d), ["cases", "confirmed_n"], ["temperature", "humidity"])


@query("wn11_top_lags", CASES + LAGD + f""", lags AS (SELECT unnest(range(0, 31)) AS lag), p AS ({_LC}),
g AS (SELECT outcome, variable, CAST(lag AS INTEGER) AS lag, corr(x, y) AS pearson FROM p GROUP BY 1, 2, 3)
SELECT outcome, variable, lag, pearson FROM (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY abs(pearson) DESC, variable, lag) AS rn FROM g) WHERE rn <= 8""", "pearson")
def _(s, d):
    from ..operators.ordering import top_n

    g = T.lag_corr(climate_cases(s, d), ["cases", "confirmed_n"], ["temperature", "humidity"])
    return top_n(g, ["outcome"], [F.abs("pearson").desc(), F.col("variable"), F.col("lag")], 8).select("outcome", "variable", "lag", "pearson")


@query("wn19_decompose", CASES + DAY + """, tr AS (SELECT date, y, CASE WHEN count(*) OVER w = 7 THEN avg(y) OVER w END AS trend, (row_number() OVER (ORDER BY date) - 1) % 7 AS pos
  FROM ds WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)), se AS (SELECT pos, avg(y - trend) AS m FROM tr GROUP BY 1)
SELECT date::VARCHAR AS date, y, trend, m - (SELECT avg(m) FROM se) AS seasonal, y - trend - (m - (SELECT avg(m) FROM se)) AS residual FROM tr JOIN se USING (pos)""",
       "trend seasonal residual")
def _(s, d):
    return T.decompose(daily(s, d), 7)


@query("ag59_above_own_p75", CASES + WEEK + """, e AS (SELECT date_trunc('week', max(event_date))::DATE AS m FROM cases),
r AS (SELECT *, row_number() OVER (PARTITION BY region ORDER BY monday DESC) AS rn, min(monday) OVER (PARTITION BY region) AS lo FROM wk),
g AS (SELECT region, quantile_cont(y, 0.75) AS p75, arg_max(y, monday) AS last_y, max(monday) AS last_monday, min(lo) AS lo FROM r WHERE rn <= 52 GROUP BY 1)
SELECT region, p75, last_y, last_monday::VARCHAR AS last_monday, CAST((m - lo) / 7 + 1 >= 20 AND m - last_monday < 42 AND last_y > p75 AND p75 > 0 AS INTEGER) AS above FROM g, e""", "p75")
def _(s, d):
    return T.above_own_p75(C.cases(s, d))
