"""Record linkage (JN8-JN12, AG44-AG46)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import kpis as P
from ..operators import linkage as K
from ..operators import joins as J
from ..operators.filters import store
from ..plans import cases as C
from ..plans import sources_view as V
from .q_expressions import CASES, LAB_SQL
from .q_indicators import BACT, cnt, pc, scope_sql
from .registry import query


#: what the two sides, and what the rates and alerts over linked cases read of a case
SIDE = ("case_id", "birth_date", "sex_raw", "code6", "event_date", "region", "confirmed", "class_group", "death")


def sides(s, d, cases=None):
    c = (C.cases(s, d, SIDE) if cases is None else cases).select("case_id", F.col("case_id").cast("string").alias("notification"), "birth_date",
                             X.sex_letter("sex_raw").alias("sex"), "code6", "event_date", "region", "confirmed", "class_group", "death")
    e = V.exams(s, d).withColumns({"sex": X.sex_letter("sex_raw"), "result": X.join_fields(["field_1", "field_2"])}).drop("region")
    return c, e


def death_sides(s, d, cases=None):
    c, _ = sides(s, d, cases)
    return c, V.deaths(s, d).withColumn("sex", X.sex_letter("sex_raw"))


BASE = CASES + "," + V.EXAMS_CTE


def link_sql(name: str, key: str, dates: tuple[str, ...], out: str) -> tuple[str, str, str]:
    """Best partner per case over all candidate pairs, in SQL."""
    near = " ".join(f"WHEN abs(c.event_date - e.{x}) <= 15 THEN 15 WHEN abs(c.event_date - e.{x}) <= 45 THEN 8" for x in dates)
    label = " ".join(f"WHEN abs(c.event_date - e.{x}) <= 15 THEN '{x}_15d' WHEN abs(c.event_date - e.{x}) <= 45 THEN '{x}_45d'" for x in dates)
    pts = f"""CASE WHEN CAST(c.case_id AS VARCHAR) = e.notification THEN 100 ELSE least(99, 15 + CASE WHEN c.birth_date = e.birth_date THEN 45 WHEN abs(c.birth_date - e.birth_date) = 1 THEN 30 ELSE 0 END
  + CASE WHEN c.code6 = e.code6 THEN 25 ELSE 0 END + CASE {near} ELSE 0 END) END"""
    why = f"""CASE WHEN CAST(c.case_id AS VARCHAR) = e.notification THEN 'notification' ELSE concat_ws(';', CASE WHEN c.birth_date = e.birth_date THEN 'birth_date' WHEN abs(c.birth_date - e.birth_date) = 1 THEN 'birth_date_near' END,
  'sex', CASE WHEN c.code6 = e.code6 THEN 'municipality' END, CASE {label} END) END"""
    return f"""{out}_p AS (
  SELECT case_id, e.{key}, {pts} AS pts, {why} AS reasons FROM cases c JOIN {name} e ON c.sex_raw = e.sex_raw AND year(c.birth_date) = year(e.birth_date)
  UNION ALL SELECT case_id, e.{key}, {pts}, {why} FROM cases c JOIN {name} e ON c.sex_raw = e.sex_raw AND c.code6 = e.code6
  UNION ALL SELECT case_id, e.{key}, 100, 'notification' FROM cases c JOIN {name} e ON CAST(c.case_id AS VARCHAR) = e.notification),
{out} AS (SELECT case_id, arg_min({key}, (-pts, {key})) AS {key}, max(pts) / 1e2 AS score, arg_min(reasons, (-pts, {key})) AS reasons FROM {out}_p WHERE pts >= 55 GROUP BY 1)""", pts, why


_LAB, _PTS, _WHY = link_sql("exams", "exam_id", ("collected_date", "released_date"), "links")
LINK = BASE + ", " + _LAB
DLINK = V.DEATHS_CTE + ", " + link_sql("deaths", "death_id", ("death_date",), "dlinks")[0]


@query("jn08_link_exact", BASE + """ SELECT case_id, exam_id, notification, 1.0::DOUBLE AS score, 'notification' AS reasons FROM cases JOIN exams ON CAST(case_id AS VARCHAR) = notification""", "score")
def _(s, d):
    return K.link_exact(*sides(s, d))


@query("jn09_link_best", LINK + " SELECT * FROM links", "score")
def _(s, d):
    return K.link_best(*sides(s, d))


@query("jn09_link_deaths", CASES + "," + DLINK + " SELECT case_id, death_id, score, reasons, death_date::VARCHAR AS death_date, cause FROM dlinks JOIN deaths USING (death_id)", "score")
def _(s, d):
    return K.link_deaths(*death_sides(s, d))


@query("jn10_pair_score", BASE + f""" SELECT case_id, exam_id, {_PTS.replace("CAST(c.case_id AS VARCHAR) = e.notification", "false")} / 1e2 AS score,
  {_WHY.replace("CAST(c.case_id AS VARCHAR) = e.notification", "false")} AS reasons FROM cases c JOIN exams e ON CAST(c.case_id AS VARCHAR) = e.notification""", "score")
def _(s, d):
    c, e = sides(s, d)
    ex = K.link_exact(c, e).select("case_id", "exam_id")
    a = c.select("case_id", *[F.col(x).alias(f"a_{x}") for x in ("birth_date", "sex", "code6", "event_date")], F.lit("").alias("a_notification"))
    b = e.select("exam_id", *[F.col(x).alias(f"b_{x}") for x in ("birth_date", "sex", "code6", "collected_date", "released_date")], F.lit("").alias("b_notification"))
    return K.pair_score(ex.join(a, "case_id").join(b, "exam_id")).select("case_id", "exam_id", "score", "reasons")


@query("jn11_best_match", BASE + """ SELECT case_id, min(exam_id) AS exam_id, 1.0::DOUBLE AS score, 'notification' AS reasons FROM cases JOIN exams ON CAST(case_id AS VARCHAR) = notification GROUP BY 1""", "score")
def _(s, d):
    return K.best_match(K.link_exact(*sides(s, d)))


def enriched(s, d, cases=None, side=None):
    """Cases (the linkage columns, or all of the given ones) with method and result of their best exam; side: the
    linkage columns of the given ones, where they are stored."""
    c, e = sides(s, d, cases)
    c = store(c) if side is None else side
    links = K.link_best(c, e, carry=["method", "result"]).join(c.select("case_id", "notification"), "case_id")
    return K.enrich(c if cases is None else cases.withColumn("notification", F.col("case_id").cast("string")), links)


ENR = LINK + """, en AS (SELECT c.*, CAST(l.score IS NOT NULL AS INTEGER) AS lab_match, l.score AS lab_score, l.exam_id FROM cases c LEFT JOIN (SELECT * FROM links WHERE score >= 0.75) l USING (case_id))"""


@query("jn12_enrich", ENR + """ SELECT case_id, lab_match, lab_score, CASE WHEN ln <= 2 THEN 'RT-PCR' WHEN ln <= 4 THEN 'Látex' WHEN ln IS NOT NULL THEN 'Cultura' END AS lab_method FROM en LEFT JOIN exams USING (exam_id)""", "lab_score")
def _(s, d):
    return enriched(s, d).select("case_id", "lab_match", "lab_score", "lab_method")


def with_deaths(s, d, cases=None, side=None):
    """Cases with their linked death record; what counts as a death of the union."""
    c, e = death_sides(s, d, cases)
    return K.attach_deaths(C.cases(s, d) if cases is None else cases, K.link_deaths(c if side is None else side, e))


def linked_cases(s, d, cases=None, columns=SIDE):
    """Cases with their best exam and their death record, over one case build of the columns asked for."""
    c = store(C.cases(s, d, columns)) if cases is None else cases
    side = store(sides(s, d, c)[0])
    return with_deaths(s, d, enriched(s, d, c, side), side)


DEATH = "," + DLINK + """, dm AS (SELECT case_id, score AS sim_score, cause AS sim_icd, death_date AS sim_death_date FROM dlinks JOIN deaths USING (death_id) WHERE score >= 0.75),
z AS (SELECT c.*, CAST(dm.case_id IS NOT NULL AS INTEGER) AS m, sim_score, sim_icd, sim_death_date, sim_death_date IS NOT NULL AS dt, coalesce(sim_icd IN ('A39.0', 'G00.9'), false) AS ic FROM cases c LEFT JOIN dm USING (case_id)),
du AS (SELECT *, CAST(m = 1 AND (dt OR ic) AS INTEGER) AS death_linked, CASE WHEN m = 0 THEN 'sem_match_sim' WHEN dt AND ic THEN 'data_obito+cid_meningite' WHEN dt THEN 'data_obito' WHEN ic THEN 'cid_meningite'
  ELSE 'match_sem_evidencia_obito' END AS death_reason FROM z)"""


@query("ag44_linkage_kpis", ENR + DEATH + """, lk AS (SELECT en.*, death_linked, CAST(en.death = 1 OR death_linked = 1 AS INTEGER) AS death_union FROM en JOIN du USING (case_id)) SELECT *, """ + f"""{pc('lab_match_n', 'cases_total')} AS pct_lab_match,
  {pc('bact_lab_match', 'bact_n')} AS pct_bact_lab_match, {pc('deaths_linked', 'deaths_union')} AS pct_linked_of_union, {pc('discordant', 'cases_total')} AS pct_discordant FROM (""" + scope_sql(
    f"""count(*) AS cases_total, CAST(sum(lab_match) AS BIGINT) AS lab_match_n, {cnt(f'{BACT} AND confirmed = 1')} AS bact_n, {cnt(f'{BACT} AND confirmed = 1 AND lab_match = 1')} AS bact_lab_match,
    CAST(sum(death_linked) AS BIGINT) AS deaths_linked, CAST(sum(death_union) AS BIGINT) AS deaths_union, {cnt('death_linked = 1 AND death = 0')} AS discordant""", {"STATE": (), "REGION": ("region",)}, "lk") + ")",
    "pct_lab_match pct_bact_lab_match pct_linked_of_union pct_discordant")
def _(s, d):
    return P.linkage_kpis(linked_cases(s, d))


@query("ag45_linkage_status", LINK + "," + DLINK + """ SELECT 'gal' AS source, 'OK' AS status, (SELECT count(*) FROM exams) AS rows, (SELECT count(*) FROM links) AS matches
  UNION ALL SELECT 'sim', 'OK', (SELECT count(*) FROM deaths), (SELECT count(*) FROM dlinks) UNION ALL SELECT 'lacen', 'AUSENTE', 0, 0""")
def _(s, d):
    c, e = sides(s, d)
    # rows are counted where they are linked: each table is derived once
    c, e = store(c), store(e.select("exam_id", "notification", "birth_date", "sex", "code6", "collected_date", "released_date"))
    dead = store(death_sides(s, d)[1].drop("sex_raw"))
    return K.linkage_status({"gal": (e, K.link_best(c, e)), "sim": (dead, K.link_deaths(c, dead)), "lacen": (None, None)}, s)


_POS = f"(coalesce(pcr, 0) = 1 OR coalesce(culture, 0) = 1 OR coalesce(latex, 0) = 1)"


@query("ag45_proxy_summary", CASES + f""" SELECT count(*) AS cases, {cnt(_POS)} AS proxy_positive, 1e2 * {cnt(_POS)} / count(*) AS pct_proxy_positive, CAST(sum(death) AS BIGINT) AS deaths_own,
  {cnt(f'confirmed = 1 AND NOT {_POS}')} AS to_review FROM (SELECT *, {LAB_SQL} FROM cases)""", "pct_proxy_positive")
def _(s, d):
    return K.proxy_summary(C.cases(s, d))


@query("ag45_review_queue", CASES + f""" SELECT case_id, event_date::VARCHAR AS event_date FROM (SELECT *, {LAB_SQL} FROM cases) WHERE confirmed = 1 AND NOT {_POS}""")
def _(s, d):
    return K.review_queue(C.cases(s, d)).select("case_id", "event_date")


@query("ag46_death_union", CASES + DEATH + " SELECT death_reason, death_linked, CAST(death = 1 OR death_linked = 1 AS INTEGER) AS death_union, CAST(death_linked = 1 AND death = 0 AS INTEGER) AS death_only_linked, count(*) AS n FROM du GROUP BY ALL")
def _(s, d):
    k = ["death_reason", "death_linked", "death_union", "death_only_linked"]
    return with_deaths(s, d).groupBy(*k).agg(F.count(F.lit(1)).alias("n"))


@query("ag46_death_summary", CASES + DEATH + """ SELECT CAST(sum(death) AS BIGINT) AS deaths_own, CAST(sum(death_linked) AS BIGINT) AS deaths_linked, count(*) FILTER (WHERE death = 1 OR death_linked = 1) AS deaths_union,
  count(*) FILTER (WHERE death_linked = 1 AND death = 0) AS only_linked, CAST(sum(m) AS BIGINT) AS matches, CAST(sum(m) - sum(death_linked) AS BIGINT) AS matches_without_evidence FROM du""")
def _(s, d):
    return K.death_summary(with_deaths(s, d))
