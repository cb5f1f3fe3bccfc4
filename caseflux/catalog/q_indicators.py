"""Series, rates, operational indicators and scope tables (AG1-AG25, AG36-AG44, AG53, AG56, AG58, AG60)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import text as X
from ..operators import joins as J
from ..operators import kpis as P
from ..operators import rates as R
from ..operators import scope as S
from ..plans import cases as C
from .q_expressions import _BAND_SQL, CASES, LAB_SQL, PROPH_SQL
from .registry import query

DM = "class_group = 'Doença meningocócica'"
HIB = "class_group = 'Meningite por Hib/Hemófilo'"
BACT = "class_group IN ('Doença meningocócica', 'Meningite tuberculosa', 'Meningite por Hib/Hemófilo', 'Meningite pneumocócica')"
SERO = "coalesce(serogroup_raw, '') IN ('B', 'W135', 'Sorogrupo C')"
STRICT = "coalesce(criterion, '') IN ('Cultura', 'PCR', '9')"
BROAD = "coalesce(criterion, '') IN ('Cultura', 'PCR', 'Látex', '9')"


def cnt(cond: str) -> str:
    return f"count(*) FILTER (WHERE {cond})"


def pc(a: str, b: str) -> str:
    return f"(1e2 * {a} / nullif({b}, 0))"


MEAS = """CAST(sum(case_n) AS BIGINT) AS cases, CAST(sum(confirmed) AS BIGINT) AS confirmed_n,
  CAST(sum(hospitalised) AS BIGINT) AS hospitalised_n, CAST(sum(death) AS BIGINT) AS deaths"""
WEEKLY = f"""SELECT iso_year, iso_week, {MEAS}, CAST(sum(discharged) AS BIGINT) AS discharged_n,
  1e2 * sum(death) / nullif(sum(confirmed), 0) AS pct_fatality FROM cases GROUP BY 1, 2"""


@query("ag01_daily_series", CASES + f"SELECT event_date::VARCHAR AS date, {MEAS} FROM cases GROUP BY 1")
def _(s, d):
    return R.daily_series(C.cases(s, d))


@query("ag02_weekly_series", CASES + WEEKLY, "pct_fatality")
def _(s, d):
    return R.weekly_series(C.cases(s, d))


@query("ag03_weekly_by_class", CASES + WEEKLY.replace("iso_week,", "iso_week, class_group,", 1).replace("BY 1, 2", "BY 1, 2, 3"), "pct_fatality")
def _(s, d):
    return R.weekly_series(C.cases(s, d), ["class_group"])


RATE = f"""{MEAS}, max(population) AS population, 1e5 * sum(case_n) / nullif(max(population), 0) AS incidence_100k,
  1e5 * sum(death) / nullif(max(population), 0) AS mortality_100k, 1e2 * sum(death) / nullif(sum(confirmed), 0) AS pct_fatality"""


@query("ag04_rates", CASES + f"SELECT event_year, code6, municipality, region, {RATE} FROM cases GROUP BY 1, 2, 3, 4",
       "incidence_100k mortality_100k pct_fatality")
def _(s, d):
    return R.rates(C.cases(s, d))


@query("ag05_rates_by_class", CASES + f"SELECT event_year, code6, municipality, region, class_group, {RATE} FROM cases GROUP BY 1, 2, 3, 4, 5",
       "incidence_100k mortality_100k pct_fatality")
def _(s, d):
    return R.rates(C.cases(s, d), ["event_year", "code6", "municipality", "region", "class_group"])


@query("ag06_weekly_kpis", CASES + f""", wk AS ({WEEKLY}), ref AS (SELECT max(event_date) - 7 AS a, max(event_date) - 14 AS b FROM cases),
u AS (SELECT iso_year, iso_week, name AS indicator, value FROM (SELECT iso_year, iso_week, cases::DOUBLE AS cases, confirmed_n::DOUBLE AS confirmed_n,
   hospitalised_n::DOUBLE AS hospitalised_n, deaths::DOUBLE AS deaths, discharged_n::DOUBLE AS discharged_n, pct_fatality::DOUBLE AS pct_fatality FROM wk)
   UNPIVOT INCLUDE NULLS (value FOR name IN (cases, confirmed_n, hospitalised_n, deaths, discharged_n, pct_fatality))),
p AS (SELECT CAST(isoyear(a) AS INTEGER) AS iso_year, CAST(weekofyear(a) AS INTEGER) AS iso_week, x.indicator, x.value AS value_now, y.value AS value_before
  FROM ref JOIN u x ON x.iso_year = isoyear(a) AND x.iso_week = weekofyear(a)
  LEFT JOIN u y ON y.iso_year = isoyear(b) AND y.iso_week = weekofyear(b) AND x.indicator = y.indicator),
q AS (SELECT *, value_now - value_before AS diff, CASE WHEN value_now = 0 AND value_before = 0 THEN 0 ELSE 1e2 * (value_now - value_before) / nullif(value_before, 0) END AS pct_change FROM p)
SELECT *, CASE WHEN pct_change IS NULL THEN 'Cinza' WHEN pct_change > 5 THEN 'Vermelho' WHEN pct_change < -5 THEN 'Verde' ELSE 'Amarelo' END AS light FROM q""",
       "value_now value_before diff pct_change")
def _(s, d):
    return R.weekly_kpis(C.cases(s, d))


KPI_COUNTS = f"""count(*) AS notified, CAST(sum(confirmed) AS BIGINT) AS confirmed_n,
  {cnt(f"confirmed = 1 AND {BACT}")} AS bact_confirmed, {cnt(f"confirmed = 1 AND {BACT} AND {BROAD}")} AS bact_lab_broad,
  {cnt(f"confirmed = 1 AND {BACT} AND {STRICT}")} AS bact_lab_strict,
  {cnt("lag_notif_invest BETWEEN 0 AND 364")} AS investigated_dated, {cnt("lag_notif_invest BETWEEN 0 AND 2")} AS investigated_48h,
  {cnt("lag_notif_close BETWEEN 0 AND 799")} AS closed_dated, {cnt("lag_notif_close BETWEEN 0 AND 60")} AS closed_60d,
  {cnt(DM)} AS dm_cases, {cnt(f"{DM} AND {PROPH_SQL}")} AS dm_prophylaxis_any, {cnt(f"{DM} AND lag_notif_proph BETWEEN 0 AND 2")} AS dm_prophylaxis_48h,
  {cnt(HIB)} AS hib_cases, {cnt(f"{HIB} AND {PROPH_SQL}")} AS hib_prophylaxis_any, {cnt(f"{HIB} AND lag_notif_proph BETWEEN 0 AND 2")} AS hib_prophylaxis_48h,
  {cnt("lag_onset_notif BETWEEN 0 AND 364")} AS notified_dated, {cnt("lag_onset_notif BETWEEN 0 AND 1")} AS notified_24h,
  {cnt(f"{DM} AND {SERO}")} AS dm_serogroup, {cnt(f"{PROPH_SQL} AND NOT ({DM}) AND NOT ({HIB})")} AS undue_prophylaxis"""
KPI_PCTS = ", ".join(f"{pc(a, b)} AS {n}" for n, (a, b) in P.KPI_RATIOS.items()) + """,
  1e2 * notified_24h / CASE WHEN notified_dated > 0 THEN notified_dated ELSE nullif(notified, 0) END AS pct_notified_24h"""
KPI_NAMES = " ".join([*P.KPI_RATIOS, "pct_notified_24h"])


@query("ag07_ops_kpis", CASES + f"SELECT *, {KPI_PCTS} FROM (SELECT {KPI_COUNTS} FROM cases)", KPI_NAMES)
def _(s, d):
    return P.ops_kpis(C.cases(s, d))


@query("ag08_kpi_long", CASES + f""", k AS (SELECT *, {KPI_PCTS} FROM (SELECT {KPI_COUNTS} FROM cases)), l AS (""" + " UNION ALL ".join(
    f"""SELECT '{n}' AS indicator, {P.KPI_RATIOS[n][0]} AS numerator, {P.KPI_RATIOS[n][1]} AS denominator, {n} AS value,
    CAST({'NULL' if ref is None else ref} AS DOUBLE) AS reference, {target} AS target, {tol} AS tol FROM k""" for n, (ref, target, tol) in P.KPI_TARGETS.items()
) + """ UNION ALL SELECT 'pct_notified_24h', notified_24h, notified_dated, pct_notified_24h, NULL, 80.0, 5.0 FROM k)
SELECT indicator, numerator, denominator, value, reference, CASE WHEN value IS NULL THEN 'Cinza' WHEN value >= target THEN 'Verde'
  WHEN value >= target - tol THEN 'Amarelo' ELSE 'Vermelho' END AS light FROM l""", "value reference")
def _(s, d):
    return P.kpi_long(P.ops_kpis(C.cases(s, d)))


@query("ag09_kpis_by_region_year", CASES + f"SELECT *, {KPI_PCTS} FROM (SELECT region, event_year, {KPI_COUNTS} FROM cases GROUP BY 1, 2)", KPI_NAMES)
def _(s, d):
    return P.ops_kpis(C.cases(s, d), ["region", "event_year"])


STATE_POP = """sp AS (SELECT y.event_year AS year, coalesce(
    last_value(t.state IGNORE NULLS) OVER (ORDER BY y.event_year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    first_value(t.state IGNORE NULLS) OVER (ORDER BY y.event_year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS state_population
  FROM (SELECT DISTINCT event_year FROM cases) y LEFT JOIN (SELECT year, CAST(sum(population) AS BIGINT) AS state FROM pop GROUP BY 1) t ON t.year = y.event_year)"""


@query("ag10_epi_panel_class", CASES + f""", {STATE_POP}, g AS (SELECT event_year, class_group, CAST(sum(case_n) AS BIGINT) AS cases, CAST(sum(death) AS BIGINT) AS deaths
  FROM cases WHERE confirmed = 1 GROUP BY 1, 2)
SELECT event_year, class_group, cases, deaths, state_population AS population_ref, 1e5 * cases / state_population AS incidence_100k,
  1e5 * deaths / state_population AS mortality_100k, 1e2 * deaths / cases AS pct_fatality FROM g JOIN sp ON sp.year = event_year""",
       "incidence_100k mortality_100k pct_fatality")
def _(s, d):
    return R.epi_panel(C.cases(s, d), ["event_year", "class_group"], C.population(s, d))


@query("ag10_epi_panel_municipality", CASES + f""", {STATE_POP},
mp AS (SELECT code6, event_year, coalesce(last_value(p IGNORE NULLS) OVER (PARTITION BY code6 ORDER BY event_year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(p IGNORE NULLS) OVER (PARTITION BY code6 ORDER BY event_year ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS mun
  FROM (SELECT code6, event_year, max(population) AS p FROM cases GROUP BY 1, 2)),
g AS (SELECT event_year, code6, region, CAST(sum(case_n) AS BIGINT) AS cases, CAST(sum(death) AS BIGINT) AS deaths FROM cases WHERE confirmed = 1 GROUP BY 1, 2, 3)
SELECT g.event_year, g.code6, region, cases, deaths, coalesce(mun, state_population) AS population_ref, 1e5 * cases / coalesce(mun, state_population) AS incidence_100k,
  1e5 * deaths / coalesce(mun, state_population) AS mortality_100k, 1e2 * deaths / cases AS pct_fatality
FROM g JOIN sp ON sp.year = event_year LEFT JOIN mp ON mp.code6 = g.code6 AND mp.event_year = g.event_year""", "incidence_100k mortality_100k pct_fatality")
def _(s, d):
    return R.epi_panel(C.cases(s, d), ["event_year", "code6", "region"], C.population(s, d))


@query("ag11_year_summary", CASES + f""", {STATE_POP}, g AS (SELECT event_year, count(*) AS notified, {cnt("confirmed = 1")} AS confirmed_n,
  {cnt("confirmed = 1 AND death = 1")} AS deaths, {cnt(f"confirmed = 1 AND {BACT}")} AS bact_confirmed, {cnt(f"confirmed = 1 AND {BACT} AND death = 1")} AS bact_deaths
  FROM cases GROUP BY 1)
SELECT g.*, state_population, 1e5 * confirmed_n / state_population AS incidence_100k, 1e5 * deaths / state_population AS mortality_100k,
  {pc('deaths', 'confirmed_n')} AS pct_fatality, 1e5 * bact_confirmed / state_population AS bact_incidence_100k,
  {pc('bact_deaths', 'bact_confirmed')} AS bact_fatality, {pc('confirmed_n', 'notified')} AS pct_confirmed FROM g JOIN sp ON sp.year = event_year WHERE confirmed_n > 0""",
       "incidence_100k mortality_100k pct_fatality bact_incidence_100k bact_fatality pct_confirmed")
def _(s, d):
    return R.year_summary(C.cases(s, d), C.population(s, d))


@query("ag12_state_population", CASES + f", {STATE_POP} SELECT year, state_population FROM sp")
def _(s, d):
    return R.state_population(C.population(s, d), C.cases(s, d))


@query("ag13_reference_year_snapshot", CASES + """
SELECT event_year, region, count(*) AS n FROM cases WHERE event_year = (SELECT max(event_year) FROM cases WHERE population > 0) GROUP BY 1, 2""")
def _(s, d):
    c = C.cases(s, d)
    return c.filter(F.col("event_year") == R.reference_year(c)).groupBy("event_year", "region").agg(F.count(F.lit(1)).alias("n"))


def scope_sql(body: str, scopes=S.SCOPES, source: str = "cases") -> str:
    """The same aggregate once per grouping set."""
    parts = []
    for label, keys in scopes.items():
        piece = " || ' | ' || ".join(f"CAST({k} AS VARCHAR)" for k in keys) if keys else "'ALL'"
        group = f"GROUP BY {', '.join(keys)}" if keys else ""
        parts.append(f"SELECT '{label}' AS scope, {piece} AS slice, {body} FROM {source} {group}")
    return " UNION ALL ".join(parts)


def family(counts: str, pcts: str = "", scopes=S.SCOPES, source: str = "cases") -> str:
    inner = scope_sql(counts, scopes, source)
    return CASES + (f"SELECT *, {pcts} FROM ({inner})" if pcts else inner)


def pq(p: float, col: str, cond: str) -> str:
    return f"quantile_cont({col}, {p}) FILTER (WHERE {cond})"


@query("ag14_scope_rollup", family(f"count(*) AS cases, CAST(sum(confirmed) AS BIGINT) AS confirmed_n, CAST(sum(death) AS BIGINT) AS deaths"))
def _(s, d):
    return S.by_scope(C.cases(s, d), {"cases": F.lit(1), "confirmed_n": F.col("confirmed"), "deaths": F.col("death")})


_OKN = "lag_onset_notif BETWEEN 0 AND 364"
_DET = f"count(*) AS cases_total, {cnt(_OKN)} AS with_lag, {cnt('lag_onset_notif BETWEEN 0 AND 1')} AS le_1d, {pq(.5, 'lag_onset_notif', _OKN)} AS p50_days, {pq(.9, 'lag_onset_notif', _OKN)} AS p90_days"


@query("ag15_scope_class_rollup", family(_DET, f"{pc('le_1d', 'with_lag')} AS pct_le_1d", S.SCOPES_CLASS), "p50_days p90_days pct_le_1d")
def _(s, d):
    return P.detection_time(C.cases(s, d))


_OKL = "lp_date IS NOT NULL AND lag_onset_lp BETWEEN 0 AND 364"


@query("ag16_csf_timeliness", family(
    f"count(*) AS cases_total, {cnt('lp_date IS NOT NULL')} AS with_tap, {cnt(_OKL)} AS with_lag, {cnt(_OKL + ' AND lag_onset_lp <= 1')} AS le_1d, {cnt(_OKL + ' AND lag_onset_lp <= 2')} AS le_2d, {pq(.5, 'lag_onset_lp', _OKL)} AS p50_days, {pq(.9, 'lag_onset_lp', _OKL)} AS p90_days",
    f"{pc('le_1d', 'with_lag')} AS pct_le_1d, {pc('le_2d', 'with_lag')} AS pct_le_2d"), "p50_days p90_days pct_le_1d pct_le_2d")
def _(s, d):
    return P.csf_timeliness(C.cases(s, d))


_ELI = f"({DM} OR {HIB})"
_OKP = f"{_ELI} AND lag_notif_proph BETWEEN 0 AND 364"


@query("ag17_prophylaxis_time", family(
    f"{cnt(_ELI)} AS eligible, {cnt(f'{_ELI} AND {PROPH_SQL}')} AS done, {cnt(_OKP)} AS with_lag, {cnt(_OKP + ' AND lag_notif_proph <= 2')} AS le_2d, {pq(.5, 'lag_notif_proph', _OKP)} AS p50_days, {pq(.9, 'lag_notif_proph', _OKP)} AS p90_days",
    f"{pc('le_2d', 'eligible')} AS pct_le_2d_eligible, {pc('le_2d', 'with_lag')} AS pct_le_2d_dated, {pc('done', 'eligible')} AS pct_done"),
    "p50_days p90_days pct_le_2d_eligible pct_le_2d_dated pct_done")
def _(s, d):
    return P.prophylaxis_time(C.cases(s, d))


@query("ag18_serogroup_coverage", family(
    f"{cnt(f'{DM} AND confirmed = 1')} AS dm_confirmed, {cnt(f'{DM} AND confirmed = 1 AND {SERO}')} AS serogroup_known, {cnt(DM)} AS dm_total",
    f"{pc('serogroup_known', 'dm_confirmed')} AS pct_serogroup"), "pct_serogroup")
def _(s, d):
    return P.serogroup_coverage(C.cases(s, d))


@query("ag19_contacts_per_case", family(
    f"{cnt(DM)} AS dm_cases, {cnt(f'{DM} AND contacts >= 0')} AS known, {cnt(f'{DM} AND contacts IS NULL')} AS unknown, {cnt(f'{DM} AND contacts = 0')} AS zero, {cnt(f'{DM} AND coalesce(contacts, 0) = 0')} AS zero_or_unknown, CAST(coalesce(sum(contacts) FILTER (WHERE {DM}), 0) AS BIGINT) AS contacts_total, {pq(.5, 'contacts', DM)} AS p50_contacts, {pq(.9, 'contacts', DM)} AS p90_contacts",
    f"{pc('zero_or_unknown', 'dm_cases')} AS pct_zero_or_unknown"), "p50_contacts p90_contacts pct_zero_or_unknown")
def _(s, d):
    return P.contacts_per_case(C.cases(s, d))


def linked_deaths(s, d):
    """Second registry: returned lines stand for death certificates of the order."""
    li = C.table(s, d, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"))
    return li.select(F.col("l_orderkey").alias("case_id"), F.lit(1).alias("death_linked"))


LINKED = """, linked AS (SELECT c.*, coalesce(dl, 0) AS death_linked, CAST(death = 1 OR coalesce(dl, 0) = 1 AS INTEGER) AS death_union,
  CAST(death = 0 AND coalesce(dl, 0) = 1 AS INTEGER) AS death_only_linked
  FROM cases c LEFT JOIN (SELECT DISTINCT l_orderkey, 1 AS dl FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O') ON l_orderkey = case_id)"""


@query("ag20_underreported_deaths", CASES + LINKED + " SELECT *, " + f"{pc('only_linked', 'deaths_linked')} AS pct_of_linked, {pc('only_linked', 'deaths_union')} AS pct_of_union, {pc('only_linked', 'cases_total')} AS pct_of_cases FROM (" + scope_sql(
    "count(*) AS cases_total, CAST(sum(death) AS BIGINT) AS deaths_own, CAST(sum(death_linked) AS BIGINT) AS deaths_linked, CAST(sum(death_union) AS BIGINT) AS deaths_union, CAST(sum(death_only_linked) AS BIGINT) AS only_linked", source="linked") + ")",
    "pct_of_linked pct_of_union pct_of_cases")
def _(s, d):
    return P.underreported_deaths(J.attach_outcomes(C.cases(s, d), linked_deaths(s, d)))


@query("ag21_detection_time", family(_DET, f"{pc('le_1d', 'with_lag')} AS pct_le_1d"), "p50_days p90_days pct_le_1d")
def _(s, d):
    return P.detection_time(C.cases(s, d), S.SCOPES)


@query("ag22_no_denominator", family(
    f"count(*) AS cases_total, {cnt('population IS NOT NULL')} AS with_denominator, {cnt('population IS NULL')} AS without_denominator",
    f"{pc('without_denominator', 'cases_total')} AS pct_without"), "pct_without")
def _(s, d):
    return P.no_denominator(C.cases(s, d))


@query("ag22_denominator_by_year", CASES + f"""SELECT *, {pc('without_denominator', 'cases_total')} AS pct_without,
  CASE WHEN without_denominator = 0 THEN 'denominador_real_ibge' WHEN with_denominator = 0 THEN 'sem_denominador' ELSE 'parcial' END AS status
FROM (SELECT event_year, count(*) AS cases_total, count(population) AS with_denominator, count(*) - count(population) AS without_denominator FROM cases GROUP BY 1)""", "pct_without")
def _(s, d):
    return P.denominator_by_year(C.cases(s, d))


FIELDS = ("onset_date", "investigated_date", "serogroup_raw", "criterion", "closed_date", "lab_pcr")
_COMP = {
    "onset_date": "onset_date IS NOT NULL", "investigated_date": "investigated_date IS NOT NULL",
    "serogroup_raw": "coalesce(serogroup_raw, 'Ignorado') <> 'Ignorado'", "criterion": "coalesce(criterion, '*Em Branco') <> '*Em Branco'",
    "closed_date": "closed_date IS NOT NULL", "lab_pcr": "lab_pcr IS NOT NULL",
}
_CB = "count(*) AS cases_total, " + ", ".join(f"1e2 * {cnt(c)} / count(*) AS comp_{f}" for f, c in _COMP.items())
_WORST = "least(" + ", ".join(f"comp_{f}" for f in FIELDS) + ")"
_WSQL = "(" + " + ".join(f"comp_{f}" for f in FIELDS) + f") / {len(FIELDS)} AS pct_mean, {_WORST} AS pct_worst, CASE " + " ".join(
    f"WHEN comp_{f} = {_WORST} THEN '{f}'" for f in FIELDS) + " END AS worst_field"
_CNAMES = " ".join(f"comp_{f}" for f in FIELDS) + " pct_mean pct_worst"


@query("ag23_completeness", family(_CB, _WSQL, S.SCOPES_NO_YEAR), _CNAMES)
def _(s, d):
    return P.completeness(C.cases(s, d), FIELDS)


@query("ag23_completeness_municipality", family(_CB, _WSQL, {"MUNICIPALITY": ("code6", "municipality", "region")}), _CNAMES)
def _(s, d):
    return P.completeness(C.cases(s, d), FIELDS, {"MUNICIPALITY": ("code6", "municipality", "region")})


AGE_SQL = "(CASE WHEN age_raw LIKE '%a' THEN CAST(left(age_raw, 3) AS DOUBLE) ELSE CAST(left(age_raw, 3) AS DOUBLE) / 12 END)"
STD_SCOPES = {"STATE": (), "REGION": ("region",), "MUNICIPALITY": ("municipality",)}


@query("ag24_standardized_fatality", CASES + f""", b AS (SELECT *, {_BAND_SQL} AS age_band FROM (SELECT *, {AGE_SQL} AS age FROM cases) WHERE confirmed = 1),
w AS (SELECT age_band, 1.0 * count(*) / (SELECT count(*) FROM b) AS weight FROM b GROUP BY 1),
allc AS ({scope_sql("count(*) AS cases_n", STD_SCOPES)}),
st AS ({scope_sql("age_band, count(*) AS n, sum(death) AS dd", {"REGION": ("region", "age_band"), "MUNICIPALITY": ("municipality", "age_band")}, "b").replace("CAST(region AS VARCHAR) || ' | ' || CAST(age_band AS VARCHAR)", "region").replace("CAST(municipality AS VARCHAR) || ' | ' || CAST(age_band AS VARCHAR)", "municipality")}
  UNION ALL SELECT 'STATE', 'ALL', age_band, count(*), sum(death) FROM b GROUP BY age_band),
u AS (SELECT scope, slice, CAST(sum(n) AS BIGINT) AS denominator, CAST(sum(dd) AS BIGINT) AS deaths, 1e2 * sum(dd) / sum(n) AS pct_crude,
  1e2 * sum(weight * dd / n) / sum(weight) AS pct_standardized, 1e2 * sum(weight) AS pct_weight_covered, count(*) AS strata_with_cases
  FROM st JOIN w USING (age_band) GROUP BY 1, 2)
SELECT u.*, cases_n FROM u JOIN allc USING (scope, slice)""", "pct_crude pct_standardized pct_weight_covered")
def _(s, d):
    c = C.cases(s, d).withColumn("age_band", X.age_band(F.lit(None), X.age_years("age_raw")))
    return P.standardized_fatality(c)


@query("ag25_indicator_long", CASES + f""", w AS (SELECT *, {pc('le_1d', 'with_lag')} AS pct_le_1d FROM ({scope_sql(_DET)}))
SELECT 'detection' AS family, scope, slice, 'pct_le_1d' AS indicator, pct_le_1d AS value, le_1d::DOUBLE AS numerator, with_lag::DOUBLE AS denominator, '%' AS unit FROM w
UNION ALL SELECT 'detection', scope, slice, 'p50_days', p50_days, NULL, with_lag::DOUBLE, 'days' FROM w""", "value numerator denominator")
def _(s, d):
    return S.to_long(P.detection_time(C.cases(s, d), S.SCOPES), "detection",
                     {"pct_le_1d": ("%", "le_1d", "with_lag"), "p50_days": ("days", None, "with_lag")})


@query("ag36_criterion_distribution", CASES + """SELECT coalesce(criterion, 'Ignorado/em branco') AS category, count(*) AS n,
  1e2 * count(*) / (SELECT count(*) FROM cases) AS pct FROM cases GROUP BY 1""", "pct")
def _(s, d):
    return R.distribution(C.cases(s, d), "criterion")


@query("ag38_distributions", CASES + """, v AS (SELECT 'sex_raw' AS variable, sex_raw AS category FROM cases UNION ALL
  SELECT 'region', region FROM cases UNION ALL SELECT 'criterion', coalesce(criterion, 'Ignorado/em branco') FROM cases UNION ALL
  SELECT 'vaccine_menc_bin', coalesce(CAST(vaccine_menc_bin AS VARCHAR), 'Ignorado/em branco') FROM cases)
SELECT variable, category, count(*) AS n, 1e2 * count(*) / (SELECT count(*) FROM cases) AS pct FROM v GROUP BY 1, 2""", "pct")
def _(s, d):
    return R.distributions(C.cases(s, d), ["sex_raw", "region", "criterion", "vaccine_menc_bin"])


SEROG = "CASE serogroup_raw WHEN 'B' THEN 'B' WHEN 'W135' THEN 'W' WHEN 'Sorogrupo C' THEN 'C' ELSE 'Não informado' END"


@query("ag39_serogroup_trend", CASES + f"""SELECT event_year, iso_week, {SEROG} AS serogroup, count(*) AS cases,
  1e2 * count(*) / sum(count(*)) OVER (PARTITION BY event_year, iso_week) AS pct FROM cases WHERE {DM} GROUP BY 1, 2, 3""", "pct")
def _(s, d):
    return P.serogroup_trend(C.cases(s, d))


@query("ag40_share_shift", CASES + f""", y AS (SELECT max(event_year) AS a FROM cases), z AS (SELECT max(event_year) AS b FROM cases, y WHERE event_year < a),
g AS (SELECT class_group AS category, count(*) FILTER (WHERE event_year = a) AS na, count(*) FILTER (WHERE event_year = b) AS nb FROM cases, y, z GROUP BY 1),
h AS (SELECT category, a AS period_now, b AS period_before, 1e2 * na / (SELECT sum(na) FROM g) AS pct_now, 1e2 * nb / (SELECT sum(nb) FROM g) AS pct_before FROM g, y, z)
SELECT *, pct_now - pct_before AS delta_pp FROM h WHERE abs(pct_now - pct_before) >= 0.5""", "pct_now pct_before delta_pp")
def _(s, d):
    return P.share_shift(C.cases(s, d), "class_group", "event_year", threshold_pp=0.5)


_TGT = f"({BACT})"


@query("ag41_lp_lab_vaccine", CASES + f""", w AS (SELECT {cnt(_TGT)} AS target, {cnt(f"{_TGT} AND (lp_date IS NOT NULL OR lp_raw = 'Sim')")} AS tap,
  {cnt(f"{_TGT} AND lab_pcr IS NULL AND lab_culture IS NULL AND coalesce(lab_latex, 'Ignorado') = 'Ignorado'")} AS pending,
  {cnt('lag_onset_lp BETWEEN 0 AND 364')} AS wl, {pq(.5, 'lag_onset_lp', 'lag_onset_lp BETWEEN 0 AND 364')} AS p50, {pq(.9, 'lag_onset_lp', 'lag_onset_lp BETWEEN 0 AND 364')} AS p90,
  {cnt(DM)} AS dm, {cnt(DM + ' AND vaccine_menc_bin = 1')} AS dmv, {cnt(HIB)} AS hib, {cnt(HIB + ' AND vaccine_hib_bin = 1')} AS hibv,
  {cnt("class_group = 'Meningite pneumocócica'")} AS pn, {cnt("class_group = 'Meningite pneumocócica' AND vaccine_pneumo_bin = 1")} AS pnv FROM cases)
SELECT 'pct_lp_done' AS indicator, tap AS numerator, target AS denominator, 1e2 * tap / target AS value FROM w UNION ALL
SELECT 'pct_lab_pending', pending, target, 1e2 * pending / target FROM w UNION ALL SELECT 'p50_onset_lp_days', wl, wl, p50 FROM w UNION ALL
SELECT 'p90_onset_lp_days', wl, wl, p90 FROM w UNION ALL SELECT 'pct_menc_in_dm', dmv, dm, 1e2 * dmv / dm FROM w UNION ALL
SELECT 'pct_hib_in_hib', hibv, hib, 1e2 * hibv / hib FROM w UNION ALL SELECT 'pct_pneumo_in_pneumo', pnv, pn, 1e2 * pnv / pn FROM w""", "value")
def _(s, d):
    return P.lp_vaccine_kpis(C.cases(s, d))


@query("ag42_severity_week", CASES + f""", m AS (SELECT max(date_trunc('week', event_date)) AS mo FROM cases),
cur AS (SELECT cases.* FROM cases, m WHERE date_trunc('week', event_date) = mo),
g AS (SELECT coalesce(class_group, 'TOTAL') AS class_group, count(*) AS cases, CAST(sum(confirmed) AS BIGINT) AS confirmed_n, CAST(sum(death) AS BIGINT) AS deaths,
  CAST(sum(hospitalised) AS BIGINT) AS hospitalised_n, {cnt('death = 1 AND event_date - onset_date <= 7')} AS deaths_le_7d, {cnt('death = 1 OR hospitalised = 1')} AS severe
  FROM cur GROUP BY GROUPING SETS ((), (class_group)))
SELECT CAST(isoyear(mo) AS INTEGER) AS iso_year, CAST(weekofyear(mo) AS INTEGER) AS iso_week, class_group, cases, confirmed_n, deaths, hospitalised_n, deaths_le_7d,
  1e2 * deaths / CASE WHEN confirmed_n > 0 THEN confirmed_n ELSE cases END AS pct_fatality, 1e2 * hospitalised_n / cases AS pct_hospitalised,
  1e2 * severe / cases AS pct_severe FROM g, m""", "pct_fatality pct_hospitalised pct_severe")
def _(s, d):
    return P.severity_week(C.cases(s, d))


_OPEN = "closed_date IS NULL"
_PEND = f"({DM} OR {HIB}) AND NOT {PROPH_SQL}"


@query("ag43_backlog", CASES + ", t AS (SELECT *, (SELECT max(notified_date) FROM cases) - notified_date AS age FROM cases) " + scope_sql(
    f"""{cnt(_OPEN)} AS open_cases, {cnt(f"{_OPEN} AND coalesce(lag_notif_invest, 99) > 2 AND age >= 2")} AS late_investigation,
    {cnt(f"{_OPEN} AND age BETWEEN 45 AND 60")} AS closing_d45_d60, {cnt(f"{_OPEN} AND age > 60")} AS closing_gt60, {cnt(f"{_OPEN} AND {_PEND}")} AS prophylaxis_pending,
    {cnt(f"{DM} AND NOT {PROPH_SQL}")} AS dm_without_prophylaxis, {cnt(f"{HIB} AND NOT {PROPH_SQL}")} AS hib_without_prophylaxis""", S.SCOPES_NO_YEAR, "t"))
def _(s, d):
    return P.backlog(C.cases(s, d))


@query("ag56_risk_score", CASES + f""", d AS (SELECT max(event_date) - 90 AS lo FROM cases),
lp AS (SELECT code6, arg_max(population, year) AS population FROM pop GROUP BY 1),
g AS (SELECT code6, municipality, region, {cnt(f"{DM} AND event_date >= lo AND confirmed = 1")} AS dm_lab_90d, {cnt(f"{DM} AND event_date >= lo")} AS dm_90d,
  {cnt(f"{DM} AND event_date >= lo AND {SERO}")} AS se, {cnt(f"{DM} AND event_date >= lo AND {PROPH_SQL}")} AS pr FROM cases, d GROUP BY 1, 2, 3),
h AS (SELECT g.*, {pc('se', 'dm_90d')} AS pct_serogroup_90d, {pc('pr', 'dm_90d')} AS pct_prophylaxis_90d, 1e5 * dm_lab_90d / nullif(population, 0) AS incidence_90d
  FROM g LEFT JOIN lp USING (code6)),
r AS (SELECT *, least(dm_lab_90d * 15.0, 45.0) + coalesce(greatest(0, (70.0 - pct_serogroup_90d) / 70.0 * 20.0), 0)
  + coalesce(greatest(0, (80.0 - pct_prophylaxis_90d) / 80.0 * 20.0), 0) + coalesce(least(incidence_90d * 2, 15.0), 0) AS raw FROM h)
SELECT code6, municipality, region, dm_lab_90d, dm_90d, pct_serogroup_90d, pct_prophylaxis_90d, incidence_90d, round(CAST(least(raw, 100.0) AS DOUBLE), 1) AS score,
  CASE WHEN raw >= 50 THEN 'Alta' WHEN raw >= 25 THEN 'Média' ELSE 'Baixa' END AS priority FROM r""", "pct_serogroup_90d pct_prophylaxis_90d incidence_90d score")
def _(s, d):
    return P.risk_score(C.cases(s, d), C.population(s, d))


@query("ag58_distinct_n", CASES + "SELECT region, count(DISTINCT person_id) AS n_distinct FROM cases GROUP BY 1")
def _(s, d):
    return R.distinct_n(C.cases(s, d), ["region"], "person_id")


@query("ag60_across_units", CASES + f""", w AS (SELECT *, {pc('le_1d', 'with_lag')} AS pct_le_1d FROM ({scope_sql(_DET, {"REGION": ("region",)})})),
l AS (SELECT slice, 'pct_le_1d' AS indicator, pct_le_1d AS value FROM w UNION ALL SELECT slice, 'p50_days', p50_days FROM w)
SELECT indicator, quantile_cont(value, 0.5) AS median_value, count(*) FILTER (WHERE value < 25) AS below_target, count(*) AS units,
  arg_min(slice, (value, slice)) AS worst_unit FROM l WHERE value IS NOT NULL GROUP BY 1""", "median_value")
def _(s, d):
    long = S.to_long(P.detection_time(C.cases(s, d), S.SCOPES), "detection",
                     {"pct_le_1d": ("%", "le_1d", "with_lag"), "p50_days": ("days", None, "with_lag")})
    return S.across_units(long, 25.0)
