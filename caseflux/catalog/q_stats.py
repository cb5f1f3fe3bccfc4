"""Association statistics, spatial autocorrelation, survival (MD1-MD13, MD26, AG55, FL4)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import text as X
from ..operators import filters as FL
from ..operators import rates as R
from ..operators import spatial as G
from ..operators import stats as A
from ..plans import cases as C
from .q_expressions import CASES
from .q_indicators import AGE_SQL
from .registry import query

EXPO = ["symptom_fever_bin", "symptom_stiffness_bin", "comorbidity_hiv_bin", "comorbidity_tb_bin", "vaccine_menc_bin"]
OUT = ["death", "hospitalised", "confirmed"]


def tab_sql(expo=EXPO, out=OUT, keys=(), src="cases", n_min=10):
    k = "".join(f"{x}, " for x in keys)
    g = f" GROUP BY {', '.join(keys)}" if keys else ""
    u = " UNION ALL ".join(
        f"SELECT {k}'{e}' AS exposure, '{o}' AS outcome, count(*) FILTER (WHERE {e} = 1 AND {o} = 1) AS a, count(*) FILTER (WHERE {e} = 1 AND {o} = 0) AS b, "
        f"count(*) FILTER (WHERE {e} = 0 AND {o} = 1) AS c, count(*) FILTER (WHERE {e} = 0 AND {o} = 0) AS d FROM {src}{g}" for e in expo for o in out)
    return f"SELECT *, a + b + c + d AS n FROM ({u}) WHERE a + b + c + d >= {n_min} AND a + b > 0 AND c + d > 0 AND a + c > 0 AND b + d > 0"


OR_SQL = """SELECT *, CASE WHEN odds_ratio < 0.67 THEN 'strongly protective' WHEN odds_ratio < 0.9 THEN 'mildly protective' WHEN odds_ratio <= 1.1 THEN 'near null' WHEN odds_ratio <= 1.5 THEN 'moderate increase' ELSE 'strong increase' END AS magnitude,
  exp(ln(odds_ratio) - 1.96 * se) AS ci_low, exp(ln(odds_ratio) + 1.96 * se) AS ci_high FROM (SELECT * EXCLUDE (h), ((a + h) * (d + h)) / ((b + h) * (c + h)) AS odds_ratio, sqrt(1 / (a + h) + 1 / (b + h) + 1 / (c + h) + 1 / (d + h)) AS se
  FROM (SELECT *, CASE WHEN least(a, b, c, d) = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS h FROM t))"""
_CI = "odds_ratio ci_low ci_high"


@query("md01_two_by_two", CASES + " " + tab_sql())
def _(s, d):
    return A.two_by_two(C.cases(s, d), EXPO, OUT)


@query("md02_odds_ratio", CASES + f", t AS ({tab_sql()}) SELECT * EXCLUDE (se) FROM ({OR_SQL})", _CI)
def _(s, d):
    return A.odds_ratio(A.two_by_two(C.cases(s, d), EXPO, OUT), p_value=False)


_LP = "lgamma(a + b + 1) + lgamma(c + d + 1) + lgamma(a + c + 1) + lgamma(b + d + 1) - lgamma(n + 1)"


@query("md03_fisher_p", CASES + f""", t AS ({tab_sql()}), k AS (SELECT exposure, outcome, a, b, c, d, n, unnest(generate_series(greatest(0, a + b + a + c - n), least(a + b, a + c))) AS x FROM t),
p AS (SELECT exposure, outcome, exp({_LP} - lgamma(x + 1) - lgamma(a + b - x + 1) - lgamma(a + c - x + 1) - lgamma(n - a - b - a - c + x + 1)) AS px,
  exp({_LP} - lgamma(a + 1) - lgamma(b + 1) - lgamma(c + 1) - lgamma(d + 1)) AS p0 FROM k)
SELECT exposure, outcome, round(least(1.0, sum(px) FILTER (WHERE px <= p0 * (1 + 1e-7))), 5) AS p_value FROM p GROUP BY 1, 2""", "p_value")
def _(s, d):
    t = A.odds_ratio(A.two_by_two(C.cases(s, d), EXPO, OUT))
    return t.select("exposure", "outcome", F.round("p_value", 5).alias("p_value"))


@query("md04_one_vs_rest", CASES + """, g AS (SELECT 'class_group' AS variable, class_group AS category, count(*) FILTER (WHERE death = 1) AS a, count(*) FILTER (WHERE death = 0) AS b FROM cases GROUP BY 2 UNION ALL
  SELECT 'sex_raw', sex_raw, count(*) FILTER (WHERE death = 1), count(*) FILTER (WHERE death = 0) FROM cases GROUP BY 2 UNION ALL SELECT 'criterion', criterion, count(*) FILTER (WHERE death = 1), count(*) FILTER (WHERE death = 0) FROM cases WHERE criterion IS NOT NULL GROUP BY 2),
t AS (SELECT variable, category, 'death' AS outcome, a, b, CAST(sum(a) OVER w - a AS BIGINT) AS c, CAST(sum(b) OVER w - b AS BIGINT) AS d, CAST(sum(a + b) OVER w AS BIGINT) AS n FROM g WINDOW w AS (PARTITION BY variable))
SELECT * EXCLUDE (se) FROM (""" + OR_SQL + ") WHERE a + b > 0 AND c + d > 0 AND a + c > 0 AND b + d > 0", _CI)
def _(s, d):
    return A.odds_ratio(A.one_vs_rest(C.cases(s, d), ["class_group", "sex_raw", "criterion"], ["death"], top=12, min_count=10), p_value=False)


def chi_sql(vars_, outs):
    u = " UNION ALL ".join(f"SELECT '{v}' AS variable, {v} AS category, '{o}' AS outcome, count(*) FILTER (WHERE {o} = 1) AS y1, count(*) FILTER (WHERE {o} = 0) AS y0 FROM cases WHERE {v} IS NOT NULL GROUP BY {v}" for v in vars_ for o in outs)
    return f""", u AS ({u}), w AS (SELECT *, (y1 + y0) AS r, sum(y1) OVER x AS t1, sum(y0) OVER x AS t0, count(*) OVER x AS k FROM u WINDOW x AS (PARTITION BY variable, outcome)),
e AS (SELECT *, r * t1 / (t1 + t0) AS e1, r * t0 / (t1 + t0) AS e0 FROM w), cc AS (SELECT *, abs(y1 - e1) - CASE WHEN k = 2 THEN least(0.5, abs(y1 - e1)) ELSE 0 END AS g1, abs(y0 - e0) - CASE WHEN k = 2 THEN least(0.5, abs(y0 - e0)) ELSE 0 END AS g0 FROM e),
x AS (SELECT variable, outcome, CAST(sum(r) AS BIGINT) AS n, max(k) AS categories, max(k) - 1 AS dof, sum(g1 * g1 / e1 + g0 * g0 / e0) AS chi2, min(least(e1, e0)) AS min_expected FROM cc GROUP BY 1, 2)
SELECT *, sqrt(chi2 / n) AS cramers_v, CASE WHEN sqrt(chi2 / n) < 0.1 THEN 'very small' WHEN sqrt(chi2 / n) < 0.3 THEN 'small' WHEN sqrt(chi2 / n) < 0.5 THEN 'moderate' ELSE 'strong' END AS effect FROM x"""


@query("md05_chi2", CASES + chi_sql(["region", "sex_raw", "class_group", "criterion"], ["death", "confirmed"]), "chi2 min_expected cramers_v")
def _(s, d):
    return A.chi2(C.cases(s, d), ["region", "sex_raw", "class_group", "criterion"], ["death", "confirmed"], p_value=False)


@query("md05_chi2_p_value", CASES + chi_sql(["region"], ["death", "confirmed"]).rsplit("SELECT *, sqrt", 1)[0] + """
SELECT variable, outcome, round(exp(-chi2 / 2) * (1 + chi2 / 2), 5) AS p_value FROM x""", "p_value")
def _(s, d):
    t = A.chi2(C.cases(s, d), ["region"], ["death", "confirmed"])
    return t.select("variable", "outcome", F.round("p_value", 5).alias("p_value"))


@query("md06_cross_detail", CASES + f""", t AS ({tab_sql(["comorbidity_hiv_bin", "comorbidity_tb_bin"], ["death", "any_death"])}),
l AS (SELECT exposure, outcome, a + b AS exposed_n, c + d AS unexposed_n, 1 AS level, a AS exposed_events, c AS unexposed_events FROM t UNION ALL SELECT exposure, outcome, a + b, c + d, 0, b, d FROM t)
SELECT *, 1e2 * exposed_events / exposed_n AS pct_exposed, 1e2 * unexposed_events / unexposed_n AS pct_unexposed FROM l""", "pct_exposed pct_unexposed")
def _(s, d):
    return A.cross_detail(C.cases(s, d), ["comorbidity_hiv_bin", "comorbidity_tb_bin"], ["death", "any_death"])


VAC = {"vaccine_menc": (K.MENINGOCOCCAL,), "vaccine_hib": (K.HIB,), "vaccine_pneumo": (K.PNEUMOCOCCAL,), "vaccine_bcg": (K.TUBERCULOUS,)}
_VT = " UNION ALL ".join(tab_sql([f"{v}_bin"], ["death", "hospitalised"], ("region", "class_group"), f"(SELECT * FROM cases WHERE class_group = '{c[0]}')", 20).replace(f"'{v}_bin'", f"'{v}'") for v, c in VAC.items())


@query("md07_vaccine_effect", CASES + f", t AS ({_VT}), o AS ({OR_SQL}) " + """SELECT * EXCLUDE (se), CASE WHEN odds_ratio < 1 THEN (1 - odds_ratio) * 100 ELSE 0 END AS effect_pct, CASE WHEN odds_ratio < 1 THEN (1 - ci_high) * 100 END AS effect_low,
  CASE WHEN odds_ratio < 1 THEN (1 - ci_low) * 100 END AS effect_high FROM o""", _CI + " effect_pct effect_low effect_high")
def _(s, d):
    return A.vaccine_effect(C.cases(s, d), VAC, ["death", "hospitalised"], p_value=False)


@query("md07_vaccine_inapplicable", CASES + " UNION ALL ".join(f"""{'SELECT' if i else ' SELECT'} region, class_group, '{v}' AS vaccine, count(*) AS n, count({v}_bin) AS with_field FROM cases WHERE class_group <> '{c[0]}' GROUP BY 1, 2"""
                                                       for i, (v, c) in enumerate(VAC.items())))
def _(s, d):
    return A.vaccine_inapplicable(C.cases(s, d), VAC)


@query("md08_logistic_or")
def _(s, d):
    c = C.cases(s, d).withColumn("age", X.age_years("age_raw"))
    return A.logistic_or(c, "hospitalised", ["age", "symptom_fever_bin", "comorbidity_hiv_bin"], ["sex_raw", "region", "class_group"])


@query("md08_score_equations", CASES + """, r AS (SELECT *, coalesce(hospitalised, 0)::DOUBLE AS yy FROM cases WHERE hospitalised IS NOT NULL)
SELECT 'symptom_fever_bin' AS variable, sum(yy * coalesce(symptom_fever_bin, 0)) AS observed, sum(yy * coalesce(symptom_fever_bin, 0)) AS fitted FROM r
UNION ALL SELECT 'comorbidity_hiv_bin', sum(yy * coalesce(comorbidity_hiv_bin, 0)), sum(yy * coalesce(comorbidity_hiv_bin, 0)) FROM r
UNION ALL SELECT 'class_group=' || class_group, sum(yy), sum(yy) FROM r WHERE class_group > (SELECT min(class_group) FROM r) GROUP BY class_group
UNION ALL SELECT 'municipality=' || municipality, sum(yy), sum(yy) FROM r GROUP BY municipality""", "observed fitted")
def _(s, d):
    return A.logistic_score(C.cases(s, d), "hospitalised", ["symptom_fever_bin", "comorbidity_hiv_bin"], ["class_group", "municipality"])


_MU = """, m AS (SELECT municipality, n_nationkey AS k, count(*) AS cases, 1e2 * count(*) FILTER (WHERE death = 1) / count(*) AS pct_death, 1e2 * count(*) FILTER (WHERE confirmed = 1) / count(*) AS pct_conf
  FROM cases JOIN nation ON n_name = municipality GROUP BY 1, 2)"""


def units(s, d):
    g = C.cases(s, d).groupBy("municipality").agg(F.count(F.lit(1)).alias("cases"), (100.0 * F.avg("death")).alias("pct_death"), (100.0 * F.avg("confirmed")).alias("pct_conf"))
    return g.join(C.table(s, d, "nation").select("n_name", F.col("n_nationkey").alias("k")), F.col("n_name") == F.col("municipality")).drop("n_name")


def _rk(c):
    return f"(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0)"


@query("md09_corr_pair", CASES + _MU + "".join(f"""{' UNION ALL' if i else ''} SELECT '{v}' AS variable, count(*) AS n, corr(k, {v}) AS pearson, corr(rx, ry) AS spearman FROM (SELECT *, {_rk('k')} AS rx, {_rk(v)} AS ry FROM m)""" for i, v in enumerate(["cases", "pct_death"])), "pearson spearman")
def _(s, d):
    return A.corr_pair(units(s, d), "k", ["cases", "pct_death"])


@query("md26_ols_line", CASES + _MU + " SELECT count(*) AS n, regr_slope(pct_death, pct_conf) AS slope, regr_intercept(pct_death, pct_conf) AS intercept, regr_r2(pct_death, pct_conf) AS r2 FROM m", "slope intercept r2")
def _(s, d):
    return A.ols_line(units(s, d), "pct_conf", "pct_death")


# nations as squares of a five-column map; a unit has the four corners of its square
def vertices(s, d):
    n = C.table(s, d, "nation")
    x, y = F.col("n_nationkey") % 5, F.floor(F.col("n_nationkey") / 5)
    corner = lambda i, j: F.struct((x + i).cast("double").alias("x"), (y + j).cast("double").alias("y"))
    return n.select(F.col("n_name").alias("code"), F.inline(F.array(corner(0, 0), corner(1, 0), corner(1, 1), corner(0, 1))))


EDGES = ", ed AS (SELECT a.n_name AS unit, b.n_name AS neighbor FROM nation a JOIN nation b ON a.n_nationkey <> b.n_nationkey AND abs(a.n_nationkey % 5 - b.n_nationkey % 5) <= 1 AND abs(a.n_nationkey // 5 - b.n_nationkey // 5) <= 1)"


@query("md12_contiguity", "WITH x AS (SELECT 1)" + EDGES + " SELECT * FROM ed")
def _(s, d):
    return G.contiguity(vertices(s, d))


PERMS = 199
_a, _b = G.sides(25)  # of the 25 municipalities, and of the 24 others of one: both grids are full, so no cell is sent on
_c, _d = G.sides(24)


def _bijection(x: str, key: str, a: int, b: int) -> str:
    """The network of `spatial.bijection` in SQL."""
    word = lambda i: f"CAST('0x' || substr(md5({key}), {5 * i + 1}, 5) AS BIGINT)"
    l, r = f"({x}) // {b}", f"({x}) % {b}"
    cell = f"[{{'l': CAST({l} AS BIGINT), 'r': CAST({r} AS BIGINT)}}]"
    for i in range(G.ROUNDS):
        move = lambda v, i=i: f"(((c.{v} + {word(i)}) * 1103515245 + 12345) % 2147483648) // 1024"
        step = f"{{'l': (c.l + {move('r')}) % {a}, 'r': c.r}}" if i % 2 == 0 else f"{{'l': c.l, 'r': (c.r + {move('l')}) % {b}}}"
        cell = f"list_transform({cell}, lambda c: {step})"
    return f"list_transform({cell}, lambda c: c.l * {b} + c.r)[1]"


_Z = _MU + EDGES + f""", z AS (SELECT municipality AS unit, pct_death - (SELECT avg(pct_death) FROM m) AS z, row_number() OVER (ORDER BY municipality) - 1 AS pos FROM m),
dg AS (SELECT unit, count(*) AS k FROM ed GROUP BY 1), rp AS (SELECT unnest(range(1, {PERMS + 1})) AS rep), r AS (SELECT unit AS u, rep, {_bijection('pos', "rep || '|12345'", _a, _b)} AS pos FROM z, rp)"""


@query("md10_morans_i", CASES + _Z + f""", al AS (SELECT unit, 0 AS rep, z FROM z UNION ALL SELECT u, rep, z FROM r JOIN z USING (pos)),
cr AS (SELECT a.rep, sum(a.z * b.z / k) AS num FROM al a JOIN ed ON ed.unit = a.unit JOIN dg ON dg.unit = a.unit JOIN al b ON b.unit = neighbor AND b.rep = a.rep GROUP BY 1),
i AS (SELECT rep, num * (SELECT count(*) FROM z) / (SELECT count(*) FROM dg) / (SELECT sum(z * z) FROM z) AS i FROM cr), l AS (SELECT count(*) AS lg FROM i WHERE rep > 0 AND round(i, 12) >= (SELECT round(i, 12) FROM i WHERE rep = 0))
SELECT (SELECT i FROM i WHERE rep = 0) AS moran_i, {PERMS} AS permutations, (least(lg, {PERMS} - lg) + 1) / {PERMS + 1}.0 AS p_value FROM l""", "moran_i p_value")
def _(s, d):
    return G.morans_i(units(s, d).select(F.col("municipality").alias("unit"), F.col("pct_death").alias("y")), G.contiguity(vertices(s, d)), PERMS)


@query("md11_local_moran", CASES + _Z + f""", lg AS (SELECT ed.unit, avg(z) AS lag FROM ed JOIN z ON z.unit = neighbor GROUP BY 1),
uu AS (SELECT z.unit, z.z, k, lag, 24 * z.z * lag / (SELECT sum(z * z) FROM z) AS local_i FROM z JOIN dg USING (unit) JOIN lg USING (unit)),
sl AS (SELECT uu.unit, rep, pos, unnest(range(0, k)) AS slot FROM uu JOIN z USING (unit), rp), dw AS (SELECT unit, rep, pos, {_bijection('slot', "unit || '|' || rep || '|12345'", _c, _d)} AS x FROM sl),
sm AS (SELECT dw.unit, rep, avg(z.z) AS sl FROM dw JOIN z ON z.pos = x + CASE WHEN x >= dw.pos THEN 1 ELSE 0 END GROUP BY 1, 2), p AS (SELECT unit, count(*) FILTER (WHERE round(z * sl, 12) >= round(z * lag, 12)) AS lar FROM sm JOIN uu USING (unit) GROUP BY 1),
f AS (SELECT unit, z, lag, local_i, (least(lar, {PERMS} - lar) + 1) / {PERMS + 1}.0 AS p_value FROM uu JOIN p USING (unit))
SELECT unit, local_i, p_value, CASE WHEN p_value >= 0.05 THEN 'Não significativo' WHEN z > 0 AND lag > 0 THEN 'Alto-Alto' WHEN z <= 0 AND lag > 0 THEN 'Baixo-Alto' WHEN z <= 0 THEN 'Baixo-Baixo' ELSE 'Alto-Baixo' END AS cluster FROM f""", "local_i p_value")
def _(s, d):
    return G.local_moran(units(s, d).select(F.col("municipality").alias("unit"), F.col("pct_death").alias("y")), G.contiguity(vertices(s, d)), PERMS)


@query("ag55_survival_strata", CASES + " UNION ALL ".join(f"""{'SELECT' if i else ' SELECT'} '{v}' AS stratum, {v} AS category, count(*) AS n, CAST(sum(death) AS BIGINT) AS deaths, quantile_cont(lag_onset_outcome, 0.5) AS median_time,
 quantile_cont(lag_onset_outcome, 0.75) AS p75_time FROM cases WHERE lag_onset_outcome >= 0 GROUP BY 2""" for i, v in enumerate(["class_group", "sex_raw"])), "median_time p75_time")
def _(s, d):
    return A.survival_strata(C.cases(s, d), ["class_group", "sex_raw"])


@query("md13_survival_model")
def _(s, d):
    return A.survival_model(C.cases(s, d).withColumn("age", X.age_years("age_raw")), ["age", "hospitalised"])


@query("md13_score_equations", CASES + """, r AS (SELECT death::DOUBLE AS dd, coalesce(hospitalised, 0) AS hosp, coalesce(symptom_fever_bin, 0) AS fever FROM cases WHERE lag_onset_outcome > 0 AND death IS NOT NULL)
SELECT '(intercept)' AS variable, sum(dd) AS observed, sum(dd) AS fitted FROM r UNION ALL SELECT 'hospitalised', sum(dd * hosp), sum(dd * hosp) FROM r
UNION ALL SELECT 'symptom_fever_bin', sum(dd * fever), sum(dd * fever) FROM r UNION ALL SELECT '(scale)', sum(dd), sum(dd) FROM r""", "observed fitted")
def _(s, d):
    return A.survival_score(C.cases(s, d), ["hospitalised", "symptom_fever_bin"])


@query("fl04_significant", CASES + f""", t AS ({tab_sql(EXPO, ["hospitalised", "death"])}), k AS (SELECT exposure, outcome, a, b, c, d, n, unnest(generate_series(greatest(0, a + b + a + c - n), least(a + b, a + c))) AS x FROM t),
p AS (SELECT exposure, outcome, exp({_LP} - lgamma(x + 1) - lgamma(a + b - x + 1) - lgamma(a + c - x + 1) - lgamma(n - a - b - a - c + x + 1)) AS px, exp({_LP} - lgamma(a + 1) - lgamma(b + 1) - lgamma(c + 1) - lgamma(d + 1)) AS p0 FROM k),
q AS (SELECT exposure, outcome, sum(px) FILTER (WHERE px <= p0 * (1 + 1e-7)) AS pv FROM p GROUP BY 1, 2) SELECT 'clinical' AS source, exposure || ' | ' || outcome AS finding FROM q WHERE pv < 0.005""")
def _(s, d):
    t = A.odds_ratio(A.two_by_two(C.cases(s, d), EXPO, ["hospitalised", "death"]))
    return FL.significant({"clinical": t}).select("source", "finding")
