"""Joins, ordering, set operations, quality, laboratory, facilities (JN*, OR*, ST*, AG26-AG37, AG45-AG52, AG57)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import text as X
from ..operators import facility as FA
from ..operators import joins as J
from ..operators import lab as L
from ..operators import ordering as O
from ..operators import quality as Q
from ..operators import rates as R
from ..plans import cases as C
from ..plans import sources_view as V
from .q_expressions import _BAND_SQL, CASES, LAB_SQL
from .q_indicators import AGE_SQL, DM, LINKED, cnt, linked_deaths, pc, scope_sql
from .registry import ORACLES, query

POPSRC = "WITH " + C.POP_CTE


@query("jn01_with_population", CASES + """SELECT code6, event_year, population, CAST(population IS NOT NULL AS INTEGER) AS has_denominator, count(*) AS n
FROM cases GROUP BY 1, 2, 3, 4""")
def _(s, d):
    return C.cases(s, d).groupBy("code6", "event_year", "population", "has_denominator").agg(F.count(F.lit(1)).alias("n"))


@query("jn02_attach_outcomes", CASES + LINKED + " SELECT death, death_linked, death_union, death_only_linked, count(*) AS n FROM linked GROUP BY 1, 2, 3, 4")
def _(s, d):
    a = J.attach_outcomes(C.cases(s, d), linked_deaths(s, d))
    k = ["death", "death_linked", "death_union", "death_only_linked"]
    return a.groupBy(*k).agg(F.count(F.lit(1)).alias("n"))


@query("jn06_with_environment", CASES + """, e AS (SELECT CAST(o_orderdate AS DATE) AS dt, '51' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS code, avg(c_acctbal) AS temperature
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT case_id, round(temperature, 4) AS temperature FROM cases LEFT JOIN e ON event_date = dt AND code6 = code""", "temperature")
def _(s, d):
    o, c = C.table(s, d, "orders"), C.table(s, d, "customer")
    env = o.filter(F.col("o_orderstatus") == "F").join(c, o.o_custkey == c.c_custkey).groupBy(
        F.to_date("o_orderdate").alias("date"), F.concat(F.lit("51"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0")).alias("code")).agg(
        F.avg("c_acctbal").alias("temperature"))
    return J.with_environment(C.cases(s, d), env).select("case_id", F.round("temperature", 4).alias("temperature"))


@query("jn07_audit_sources", """WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem)
SELECT (SELECT count(*) FROM orders) AS left_rows, (SELECT count(*) FROM a) AS left_ids, (SELECT count(*) FROM lineitem) AS right_rows, (SELECT count(*) FROM b) AS right_ids,
  (SELECT count(*) FROM a JOIN b USING (k)) AS overlap, (SELECT count(*) FROM a ANTI JOIN b USING (k)) AS only_left, (SELECT count(*) FROM b ANTI JOIN a USING (k)) AS only_right,
  (SELECT count(*) FROM b ANTI JOIN a USING (k)) - (SELECT count(*) FROM a ANTI JOIN b USING (k)) AS gain_right""")
def _(s, d):
    return J.audit_sources(C.table(s, d, "orders").select(F.col("o_orderkey").alias("id")),
                           C.table(s, d, "lineitem").select(F.col("l_orderkey").alias("id")), "id")


@query("st03_id_diff", """SELECT o_orderkey AS id, 'left' AS side FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT DISTINCT l_orderkey, 'right' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""")
def _(s, d):
    return J.id_diff(C.table(s, d, "orders").select(F.col("o_orderkey").alias("id")),
                     C.table(s, d, "lineitem").select(F.col("l_orderkey").alias("id")), "id")


FAC = """, f AS (SELECT c.*, nullif(ltrim(facility_raw, '0'), '') AS facility_key, (s_suppkey IS NOT NULL) AS hit,
  CASE WHEN s_suppkey IS NULL THEN NULL WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 3000 THEN 'POSTO DE SAÚDE' WHEN s_acctbal < 7000 THEN 'HOSPITAL GERAL' ELSE 'FARMACIA' END AS facility_type,
  CASE WHEN s_suppkey IS NULL THEN 'Sem match' WHEN s_acctbal < 0 THEN 'Sem informação' WHEN s_acctbal < 3000 THEN 'Atenção básica' WHEN s_acctbal < 7000 THEN 'Alta complexidade / hospitalar' ELSE 'Outros / intermediário' END AS facility_level
  FROM cases c LEFT JOIN supplier ON nullif(ltrim(facility_raw, '0'), '') = CAST(s_suppkey AS VARCHAR) AND s_suppkey > 0)"""


@query("jn13_with_facility", CASES + FAC + " SELECT facility_key, CAST(hit AS INTEGER) AS facility_match, facility_level, count(*) AS n FROM f GROUP BY 1, 2, 3")
def _(s, d):
    f = J.with_facility(C.cases(s, d), V.facilities(s, d))
    return f.groupBy("facility_key", "facility_match", "facility_level").agg(F.count(F.lit(1)).alias("n"))


@query("ag50_facility_profile", CASES + FAC + " SELECT *, " + f"{pc('matched', 'cases')} AS pct_match, {pc('high_n', 'cases')} AS pct_high, {pc('primary_n', 'cases')} AS pct_primary FROM (" + scope_sql(
    f"count(*) AS cases, {cnt('hit')} AS matched, {cnt(chr(39).join(['facility_level = ', 'Alta complexidade / hospitalar', '']))} AS high_n, {cnt(chr(39).join(['facility_level = ', 'Atenção básica', '']))} AS primary_n, count(DISTINCT facility_key) FILTER (WHERE hit) AS facilities",
    {"STATE": (), "REGION": ("region",)}, "f") + ")", "pct_match pct_high pct_primary")
def _(s, d):
    return FA.facility_profile(J.with_facility(C.cases(s, d), V.facilities(s, d)))


@query("ag50_facility_types", CASES + FAC + """ SELECT coalesce(facility_type, 'Sem match/sem tipo') AS facility_type, facility_level, count(*) AS cases, count(DISTINCT facility_key) AS facilities
FROM f GROUP BY 1, 2""")
def _(s, d):
    return FA.facility_types(J.with_facility(C.cases(s, d), V.facilities(s, d)))


BED = """WITH b AS (SELECT '51' || lpad(CAST(s_nationkey AS VARCHAR), 4, '0') AS code6, r_name AS region, CAST(l_quantity AS DOUBLE) AS q, p_type = 'ECONOMY' AS uti
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
m AS (SELECT code6, region, sum(q) AS beds, coalesce(sum(q) FILTER (WHERE uti), 0) AS icu_beds FROM b GROUP BY 1, 2) """


def bed_table(s, d):
    li, su, p = C.table(s, d, "lineitem"), C.table(s, d, "supplier"), C.table(s, d, "part")
    return li.join(su, li.l_suppkey == su.s_suppkey).join(p, li.l_partkey == p.p_partkey).join(
        C.territory(s, d), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("code_raw").alias("code"), "region", F.col("l_quantity").alias("quantity"),
        F.when(F.col("p_type") == "ECONOMY", "UTI adulto").otherwise("Clínico").alias("bed_type"))


@query("ag51_beds", BED + scope_sql("sum(beds) AS beds, sum(icu_beds) AS icu_beds, count(DISTINCT code6) FILTER (WHERE beds > 0) AS municipalities_with_beds, count(DISTINCT code6) FILTER (WHERE icu_beds > 0) AS municipalities_with_icu",
                                    {"STATE": (), "REGION": ("region",), "MUNICIPALITY": ("code6",)}, "m"), "beds icu_beds")
def _(s, d):
    return FA.beds(bed_table(s, d))


BIRTH = """, nv AS (SELECT '51' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS code6, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS live_births
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus = 'P' GROUP BY 1, 2)"""


def births(s, d):
    o, c = C.table(s, d, "orders"), C.table(s, d, "customer")
    return o.filter(F.col("o_orderstatus") == "P").join(c, o.o_custkey == c.c_custkey).select(
        F.concat(F.lit("51"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), F.lit("0")).alias("code"),
        F.year("o_orderdate").cast("string").alias("birth_year"))


@query("ag52_live_births", "WITH x AS (SELECT 1)" + BIRTH + " SELECT * FROM nv")
def _(s, d):
    return FA.live_births(births(s, d))


@query("ag52_infant_incidence", CASES + BIRTH + f""", i AS (SELECT code6, event_year, municipality, region, count(*) AS infant_cases FROM (SELECT *, {_BAND_SQL} AS band FROM (SELECT *, {AGE_SQL} AS age FROM cases)) WHERE band = '< 1 ano' GROUP BY 1, 2, 3, 4)
SELECT i.*, live_births, 1e3 * infant_cases / nullif(live_births, 0) AS incidence_1000, CAST(live_births IS NOT NULL AS INTEGER) AS has_births
FROM i LEFT JOIN nv ON i.code6 = nv.code6 AND event_year = year""", "incidence_1000")
def _(s, d):
    c = C.cases(s, d).withColumn("age_band", X.age_band(F.lit(None), X.age_years("age_raw")))
    return FA.infant_incidence(c, FA.live_births(births(s, d)))


@query("jn14_with_births", CASES + BIRTH + """ SELECT event_year, count(*) AS n, count(live_births) AS matched, CAST(sum(live_births) AS BIGINT) AS births
FROM cases c LEFT JOIN nv ON c.code6 = nv.code6 AND event_year = year GROUP BY 1""")
def _(s, d):
    j = J.with_births(C.cases(s, d), FA.live_births(births(s, d)))
    return j.groupBy("event_year").agg(F.count(F.lit(1)).alias("n"), F.count("live_births").alias("matched"), F.sum("live_births").alias("births"))


@query("jn16_territory_layer", """WITH i AS (SELECT n_name AS municipality, count(*) AS cases FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE o_totalprice > 490000 AND o_orderdate >= DATE '2001-05-01' GROUP BY 1)
SELECT n_name AS municipality, coalesce(cases, 0) AS cases, CAST(coalesce(cases, 0) = 0 AS INTEGER) AS silent FROM nation LEFT JOIN i ON n_name = municipality""")
def _(s, d):
    o, c, n = (C.table(s, d, t) for t in ("orders", "customer", "nation"))
    i = o.filter((F.col("o_totalprice") > 490000) & (F.col("o_orderdate") >= "2001-05-01")).join(c, o.o_custkey == c.c_custkey).join(
        n, c.c_nationkey == n.n_nationkey).groupBy(F.col("n_name").alias("municipality")).agg(F.count(F.lit(1)).alias("cases"))
    return J.territory_layer(n.select(F.col("n_name").alias("municipality")), i, "municipality", ["cases"])


@query("jn16_silent_units", """SELECT n_name AS municipality FROM nation WHERE n_nationkey NOT IN (SELECT c_nationkey FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 490000
  AND o_orderdate >= DATE '2001-05-01')""")
def _(s, d):
    o, c, n = (C.table(s, d, t) for t in ("orders", "customer", "nation"))
    hit = o.filter((F.col("o_totalprice") > 490000) & (F.col("o_orderdate") >= "2001-05-01")).join(c, o.o_custkey == c.c_custkey)
    return J.silent_units(n, hit.select(F.col("c_nationkey").alias("n_nationkey")), "n_nationkey").select(F.col("n_name").alias("municipality"))


def coords(s, d):
    n = C.table(s, d, "nation")
    k = F.col("n_nationkey")
    return n.select(F.when(k < 15, F.concat(F.lit("51"), F.lpad(k.cast("string"), 4, "0"))).alias("code"), F.lower("n_name").alias("name"),
                    (-(8.0 + k / 4.0)).alias("lat"), (-(51.0 + k / 3.0)).alias("lon"))


@query("jn17_with_coordinates", """SELECT n_nationkey, -(8.0 + n_nationkey / 4.0) AS lat, -(51.0 + n_nationkey / 3.0) AS lon FROM nation""", "lat lon")
def _(s, d):
    t = C.territory(s, d).withColumn("code6", F.substring("code_raw", 1, 6))
    return J.with_coordinates(t, coords(s, d)).select("n_nationkey", "lat", "lon")


_H = "(pow(sin(radians(-15.601 - lat) / 2), 2) + cos(radians(lat)) * cos(radians(-15.601)) * pow(sin(radians(-56.097 - lon) / 2), 2))"
LABF = f""", lb AS (SELECT *, (pcr IS NOT NULL OR culture IS NOT NULL OR latex IS NOT NULL) AS v, (coalesce(pcr, 2) < 2 OR coalesce(culture, 2) < 2 OR coalesce(latex, 2) < 2) AS c,
  (coalesce(pcr, 0) = 1 OR coalesce(culture, 0) = 1 OR coalesce(latex, 0) = 1) AS p FROM (SELECT *, {LAB_SQL} FROM cases))"""
LABM = """count(*) AS notified, CAST(sum(confirmed) AS BIGINT) AS confirmed_n, CAST(sum(hospitalised) AS BIGINT) AS hospitalised_n, CAST(sum(death) AS BIGINT) AS deaths,
  count(*) FILTER (WHERE v) AS with_valid, count(*) FILTER (WHERE c) AS with_conclusive, count(*) FILTER (WHERE p) AS positives,
  1e2 * count(*) FILTER (WHERE p) / nullif(count(*) FILTER (WHERE c), 0) AS pct_positive, 1e2 * count(*) FILTER (WHERE v) / nullif(count(*), 0) AS pct_lab_use"""


@query("ag33_lab_methods", CASES + LABF + " UNION ALL ".join(f"""{' SELECT' if i == 0 else 'SELECT'} '{lab}' AS method, count({c}) AS valid, count(*) FILTER (WHERE {c} < 2) AS conclusive,
  count(*) FILTER (WHERE {c} = 1) AS positive, count(*) FILTER (WHERE {c} = 0) AS negative, count(*) FILTER (WHERE {c} = 2) AS inconclusive,
  1e2 * count(*) FILTER (WHERE {c} = 1) / nullif(count(*) FILTER (WHERE {c} < 2), 0) AS pct_positive, 1e2 * count(*) FILTER (WHERE {c} = 1) / nullif(count({c}), 0) AS pct_positive_valid,
  1e2 * count({c}) / count(*) AS pct_coverage FROM lb""" for i, (c, lab) in enumerate([("pcr", "PCR"), ("culture", "Cultura"), ("latex", "Látex")])), "pct_positive pct_positive_valid pct_coverage")
def _(s, d):
    return L.lab_methods(C.cases(s, d))


@query("ag34_lab_by_class", CASES + LABF + f" SELECT class_group, {LABM} FROM lb GROUP BY 1", "pct_positive pct_lab_use")
def _(s, d):
    return L.lab_by(C.cases(s, d), ["class_group"])


@query("ag35_lab_access", CASES + LABF + f""", g AS (SELECT code6, municipality, region, {LABM}, -(8.0 + CAST(right(code6, 4) AS INTEGER) / 4.0) AS lat, -(51.0 + CAST(right(code6, 4) AS INTEGER) / 3.0) AS lon FROM lb GROUP BY 1, 2, 3)
SELECT *, 2 * 6371.0 * atan2(sqrt({_H}), sqrt(1 - {_H})) AS distance_km FROM g""", "pct_positive pct_lab_use lat lon distance_km")
def _(s, d):
    return L.lab_access(C.cases(s, d), coords(s, d), -15.601, -56.097)


@query("ag37_lab_kpis", CASES + LABF + f" SELECT * EXCLUDE (hospitalised_n, deaths) FROM (SELECT {LABM} FROM lb)", "pct_positive pct_lab_use")
def _(s, d):
    return L.lab_kpis(C.cases(s, d))


EX = "WITH " + C.LINES_CTE + "," + C.PEOPLE_CTE + "," + V.EXAMS_CTE


def exams(s, d):
    return L.prepare_exams(V.exams(s, d), ["field_1", "field_2"])


@query("sc29_parse_lab_text", EX + """ SELECT nm_detected, CAST(rf = 'A' AS INTEGER) AS nm_not_detected, hi_detected, lab_serogroup, lab_positive, count(*) AS n FROM ex GROUP BY ALL""")
def _(s, d):
    k = ["nm_detected", "nm_not_detected", "hi_detected", "lab_serogroup", "lab_positive"]
    return exams(s, d).groupBy(*k).agg(F.count(F.lit(1)).alias("n"))


@query("sc30_exam_flags", EX + " SELECT is_pcr, is_culture, is_latex, released, count(*) AS n FROM ex GROUP BY ALL")
def _(s, d):
    return exams(s, d).groupBy("is_pcr", "is_culture", "is_latex", "released").agg(F.count(F.lit(1)).alias("n"))


@query("ag47_exams_per_case", EX + """ SELECT notification, count(*) AS exams, max(is_pcr) AS any_pcr, max(is_culture) AS any_culture, max(lab_positive) AS any_positive, max(nm_detected) AS any_nm,
  max(hi_detected) AS any_hi, coalesce(arg_min(lab_serogroup, exam_id) FILTER (WHERE lab_serogroup <> ''), '') AS lab_serogroup, CAST(sum(released) AS BIGINT) AS released_n,
  quantile_cont(turnaround, 0.5) AS median_turnaround FROM ex WHERE notification IS NOT NULL GROUP BY 1""", "median_turnaround")
def _(s, d):
    return L.exams_per_case(exams(s, d))


@query("ag48_exam_kpis", EX + """ SELECT 'STATE' AS scope, 'ALL' AS slice, *, 1e2 * pcr_n / exams AS pct_pcr, 1e2 * culture_n / exams AS pct_culture, 1e2 * positive_released / released_n AS pct_positive_released FROM (
  SELECT count(*) AS exams, CAST(sum(released) AS BIGINT) AS released_n, CAST(sum(is_pcr) AS BIGINT) AS pcr_n, CAST(sum(is_culture) AS BIGINT) AS culture_n,
  count(*) FILTER (WHERE released = 1 AND lab_positive = 1) AS positive_released, CAST(sum(nm_detected) AS BIGINT) AS nm_detected_n, CAST(sum(hi_detected) AS BIGINT) AS hi_detected_n,
  count(*) FILTER (WHERE lab_serogroup <> '') AS with_serogroup, quantile_cont(turnaround, 0.5) AS median_turnaround FROM ex)""", "pct_pcr pct_culture pct_positive_released median_turnaround")
def _(s, d):
    return L.exam_kpis(exams(s, d))


@query("ag49_turnaround", EX + """ SELECT 'STATE' AS scope, 'ALL' AS slice, *, 1e2 * le_2d / n AS pct_48h, 1e2 * le_7d / n AS pct_7d FROM (SELECT count(*) AS n, count(*) FILTER (WHERE turnaround <= 2) AS le_2d,
  count(*) FILTER (WHERE turnaround <= 7) AS le_7d, quantile_cont(turnaround, 0.5) AS p50_days, quantile_cont(turnaround, 0.9) AS p90_days FROM ex WHERE released = 1 AND turnaround >= 0)""", "pct_48h pct_7d p50_days p90_days")
def _(s, d):
    return L.turnaround(exams(s, d))


_OWN = "CASE WHEN coalesce(serogroup_raw, 'Ignorado') = 'Ignorado' THEN '' ELSE serogroup_raw END"
CONC = "," + V.EXAMS_CTE + f""", ty AS (SELECT notification, count(*) AS exams, coalesce(arg_min(lab_serogroup, exam_id) FILTER (WHERE lab_serogroup <> ''), '') AS ls FROM ex WHERE notification IS NOT NULL GROUP BY 1),
cc AS (SELECT c.*, CAST(exams IS NOT NULL AS INTEGER) AS has_exam, {_OWN} AS own, coalesce(ls, '') AS lab_s FROM cases c LEFT JOIN ty ON CAST(case_id AS VARCHAR) = notification)"""


@query("jn15_concordance", CASES + CONC + """ SELECT has_exam, own AS own_serogroup, lab_s AS lab_serogroup, CASE WHEN own <> '' THEN own ELSE lab_s END AS serogroup_union,
  CAST(own = '' AND lab_s <> '' AS INTEGER) AS serogroup_only_lab, count(*) AS n FROM cc GROUP BY ALL""")
def _(s, d):
    k = ["has_exam", "own_serogroup", "lab_serogroup", "serogroup_union", "serogroup_only_lab"]
    return L.concordance(C.cases(s, d), exams(s, d)).groupBy(*k).agg(F.count(F.lit(1)).alias("n"))


@query("ag48_concordance_kpis", CASES + CONC + f" SELECT *, {pc('with_exam', 'cases')} AS pct_with_exam, {pc('target_with_exam', 'target_n')} AS pct_target_with_exam, {pc('target_own', 'target_n')} AS pct_serogroup_own, {pc('target_union', 'target_n')} AS pct_serogroup_union FROM (" + scope_sql(
    f"count(*) AS cases, CAST(sum(has_exam) AS BIGINT) AS with_exam, {cnt(DM)} AS target_n, {cnt(DM + ' AND has_exam = 1')} AS target_with_exam, {cnt(DM + ' AND own <> ' + chr(39) * 2)} AS target_own, {cnt(DM + ' AND own || lab_s <> ' + chr(39) * 2)} AS target_union, {cnt(DM + ' AND own = ' + chr(39) * 2 + ' AND lab_s <> ' + chr(39) * 2)} AS target_only_lab",
    {"STATE": (), "REGION": ("region",)}, "cc") + ")", "pct_with_exam pct_target_with_exam pct_serogroup_own pct_serogroup_union")
def _(s, d):
    return L.concordance_kpis(L.concordance(C.cases(s, d), exams(s, d)), F.col("class_group") == K.MENINGOCOCCAL)


@query("jn18_region_from_text", """WITH places AS (SELECT upper(n_name) AS p, min(r_name) AS r FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1),
t AS (SELECT c_custkey, 'Fila ' || n_name || ' | caso ' || c_custkey AS territory FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, territory, arg_max(p, (length(p), p)) AS place, arg_max(r, (length(p), p)) AS region_found FROM t LEFT JOIN places ON contains(upper(territory), p) GROUP BY 1, 2""")
def _(s, d):
    t = C.territory(s, d)
    c = C.table(s, d, "customer").join(t, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", F.concat(F.lit("Fila "), "municipality", F.lit(" | caso "), F.col("c_custkey").cast("string")).alias("territory"))
    return J.region_from_text(c, t.select(F.col("municipality").alias("place"), "region"), "territory", "c_custkey")


@query("jn19_duplicate_blocks", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, copies FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies FROM lineitem) WHERE copies > 1""")
def _(s, d):
    return Q.duplicate_rows(C.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copies")


@query("al14_duplicates", """WITH r AS (SELECT o_orderkey AS row_id, o_custkey AS notification, o_orderstatus || o_orderpriority AS block, CAST(o_orderdate AS DATE) AS dt FROM orders),
a AS (SELECT *, count(*) OVER (PARTITION BY notification) AS k1, count(*) OVER (PARTITION BY block, dt) AS k2 FROM r)
SELECT 'exact_id' AS kind, notification, row_id, 1.0::DOUBLE AS score, k1 AS copies FROM a WHERE k1 > 1 UNION ALL SELECT 'probable_block', notification, row_id, 0.85::DOUBLE, k2 FROM a WHERE k2 > 1""", "score")
def _(s, d):
    o = C.table(s, d, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_custkey").alias("notification"),
                                       F.concat("o_orderstatus", "o_orderpriority").alias("block"), F.to_date("o_orderdate").alias("dt"))
    return Q.duplicates(o, block=("block", "dt"))


@query("jn20_scorecard", CASES + """, a AS (SELECT region, count(*) AS cases FROM cases GROUP BY 1), b AS (SELECT region, avg(CASE WHEN closed_date IS NULL THEN 0.0 ELSE 100.0 END) AS pct_closed FROM cases GROUP BY 1),
c AS (SELECT region, max(lag_notif_close) AS max_close FROM cases GROUP BY 1) SELECT * FROM a LEFT JOIN b USING (region) LEFT JOIN c USING (region)""", "pct_closed")
def _(s, d):
    c = C.cases(s, d)
    g = c.groupBy("region")
    return J.scorecard(g.agg(F.count(F.lit(1)).alias("cases")), [
        g.agg(F.avg(F.when(F.col("closed_date").isNull(), 0.0).otherwise(100.0)).alias("pct_closed")), g.agg(F.max("lag_notif_close").alias("max_close"))], "region")


@query("jn21_refresh_flags", CASES + """ SELECT confirmed, lab_match, count(*) AS n FROM (SELECT confirmed, l.m AS lab_match FROM cases LEFT JOIN (SELECT l_orderkey, max(CAST(l_returnflag = 'R' AS INTEGER)) AS m FROM lineitem GROUP BY 1) l ON l_orderkey = case_id) GROUP BY 1, 2""")
def _(s, d):
    enr = C.table(s, d, "lineitem").select(F.col("l_orderkey").alias("case_id"), (F.col("l_returnflag") == "R").cast("int").alias("lab_match"))
    return J.refresh_flags(C.cases(s, d).withColumn("lab_match", F.lit(0)), enr, "case_id", ["lab_match"]).groupBy("confirmed", "lab_match").agg(F.count(F.lit(1)).alias("n"))


@query("jn22_latest_population", POPSRC + " SELECT code6, max(year) AS year, arg_max(population, year) AS population FROM pop GROUP BY 1")
def _(s, d):
    return J.latest_population(C.population(s, d))


# ---- ordering and set operations -------------------------------------------------------------

@query("or01_severity_order", """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'O' THEN 3 ELSE 2 END AS rank FROM orders ORDER BY rank DESC, o_orderkey""")
def _(s, d):
    sev = F.when(F.col("o_orderstatus") == "F", "Crítico").when(F.col("o_orderstatus") == "O", "Alto").otherwise("Atenção")
    o = C.table(s, d, "orders").select("o_orderkey", sev.alias("severity"))
    return O.order_by_severity(o, then=[F.col("o_orderkey")]).select("o_orderkey", O.severity_rank("severity").alias("rank"))


@query("or02_top_queue", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 200", "o_totalprice")
def _(s, d):
    return O.top_queue(C.table(s, d, "orders"), [F.col("o_totalprice").desc(), F.col("o_orderkey")], 200).select("o_orderkey", "o_totalprice")


@query("or03_top_categories", """SELECT CASE WHEN rn <= 8 AND n >= 10 THEN p_brand ELSE 'Outros' END AS category, CAST(sum(n) AS BIGINT) AS n FROM (SELECT p_brand, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, p_brand) AS rn
FROM part GROUP BY 1) GROUP BY 1""")
def _(s, d):
    return O.top_categories(C.table(s, d, "part"), "p_brand", 8, 10, "Outros")


@query("or04_worst_k", CASES + """, l AS (SELECT municipality AS slice, 'closed' AS indicator, 1e2 * count(closed_date) / count(*) AS value FROM cases GROUP BY 1 UNION ALL
  SELECT municipality, 'investigated', 1e2 * count(investigated_date) / count(*) FROM cases GROUP BY 1)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY indicator ORDER BY value, slice) AS rank FROM l) WHERE rank <= 3""", "value")
def _(s, d):
    g = C.cases(s, d).groupBy(F.col("municipality").alias("slice")).agg(
        (100.0 * F.count("closed_date") / F.count(F.lit(1))).alias("closed"), (100.0 * F.count("investigated_date") / F.count(F.lit(1))).alias("investigated"))
    return O.worst_k(O.to_long(g, ["slice"], ["closed", "investigated"]), 3)


@query("st01_union_alerts", """SELECT 'late' AS kind, o_orderkey AS id, NULL::BIGINT AS part FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'returned', l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R'""")
def _(s, d):
    a = C.table(s, d, "orders").filter("o_orderstatus = 'F'").select(F.lit("late").alias("kind"), F.col("o_orderkey").alias("id"))
    b = C.table(s, d, "lineitem").filter("l_returnflag = 'R'").select(F.lit("returned").alias("kind"), F.col("l_orderkey").alias("id"), F.col("l_partkey").alias("part"))
    return O.union_all(a, b)


@query("st02_dedup_queue", """SELECT l_orderkey, l_linenumber, arg_min(l_partkey, (l_shipdate, l_partkey, l_suppkey)) AS l_partkey FROM lineitem GROUP BY 1, 2""")
def _(s, d):
    li = C.table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return O.dedup_queue(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate"), F.col("l_partkey"), F.col("l_suppkey")]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("st04_pivot_indicators", CASES + """ SELECT region, 1e2 * count(closed_date) / count(*) AS closed, 1e2 * count(investigated_date) / count(*) AS investigated FROM cases GROUP BY 1""", "closed investigated")
def _(s, d):
    g = C.cases(s, d).groupBy("region").agg((100.0 * F.count("closed_date") / F.count(F.lit(1))).alias("closed"),
                                            (100.0 * F.count("investigated_date") / F.count(F.lit(1))).alias("investigated"))
    return O.to_wide(O.to_long(g, ["region"], ["closed", "investigated"]), ["region"], ["closed", "investigated"])


# ---- quality ---------------------------------------------------------------------------------

_QF = {"notified_date": "notified_date IS NOT NULL", "onset_date": "onset_date IS NOT NULL", "municipality": "true", "code_raw": "true", "sex_raw": "true", "age_raw": "true",
       "status_code": "true", "class_code": "class_code IS NOT NULL", "outcome_code": "true", "serogroup_raw": "coalesce(serogroup_raw, 'Ignorado') <> 'Ignorado'", "lp_raw": "lp_raw <> 'x'",
       "lab_pcr": "lab_pcr IS NOT NULL", "lab_culture": "lab_culture IS NOT NULL", "criterion": "coalesce(criterion, '*Em Branco') <> '*Em Branco'", "closed_date": "closed_date IS NOT NULL"}
_BADQ = "(coalesce(notified_date < onset_date, false) OR coalesce(closed_date < notified_date, false) OR (sex_raw = 'M' AND pregnant_raw = 'Sim'))"


def av(c):
    return f"avg(CASE WHEN {c} THEN 1e2 ELSE 0 END)"


@query("ag26_quality_score", CASES + f""", q AS (SELECT ({' + '.join(av(c) for c in _QF.values())}) / 15 AS completeness, (1e2 + 1e2 + 1e2 + {av('notified_date IS NOT NULL')} + {av('closed_date IS NOT NULL')}) / 5 AS validity,
  {av(_BADQ)} AS inc, ({"+".join(f"avg(CASE WHEN {c} < {b} AND {c} >= 0 THEN CASE WHEN {c} <= {l} THEN 1e2 ELSE 0 END END)" for c, l, b in (("lag_notif_invest", 2, 365), ("lag_notif_close", 60, 800), ("lag_onset_notif", 1, 365)))}) / 3 AS timeliness,
  {av("coalesce(criterion, '*Em Branco') <> '*Em Branco'")} AS accuracy, 1e2 * count(DISTINCT code6) / 25 AS rep FROM cases),
z AS (SELECT 'completeness' AS criterion, completeness AS indicator, CASE WHEN completeness >= 95 THEN 2 WHEN completeness >= 70 THEN 1 ELSE 0 END AS points FROM q UNION ALL
SELECT 'validity', validity, CASE WHEN validity >= 98 THEN 2 WHEN validity >= 95 THEN 1 ELSE 0 END FROM q UNION ALL SELECT 'consistency', 100 - inc, CASE WHEN inc <= 1 THEN 2 WHEN inc <= 5 THEN 1 ELSE 0 END FROM q UNION ALL
SELECT 'timeliness', timeliness, CASE WHEN timeliness >= 90 THEN 2 WHEN timeliness >= 70 THEN 1 ELSE 0 END FROM q UNION ALL SELECT 'uniqueness', 100, 2 FROM q UNION ALL SELECT 'accuracy', accuracy, CASE WHEN accuracy >= 50 THEN 1 ELSE 0 END FROM q UNION ALL
SELECT 'plausibility', 100 - inc, CASE WHEN 100 - inc >= 98 THEN 2 WHEN 100 - inc >= 95 THEN 1 ELSE 0 END FROM q UNION ALL SELECT 'representativeness', rep, CASE WHEN rep >= 90 THEN 2 WHEN rep >= 50 THEN 1 ELSE 0 END FROM q UNION ALL
SELECT 'standardisation', 100, 2 FROM q UNION ALL SELECT 'traceability', 100, 2 FROM q) SELECT * FROM z""", "indicator")
def _(s, d):
    return Q.quality_score(C.cases(s, d), C.table(s, d, "nation").agg(F.count(F.lit(1))).scalar())


@query("ag26_quality_total", "SELECT total, CASE WHEN total >= 18 THEN 'Excelente' WHEN total >= 14 THEN 'Boa' WHEN total >= 10 THEN 'Regular' WHEN total >= 6 THEN 'Ruim' ELSE 'Crítica' END AS quality_class FROM (SELECT CAST(sum(points) AS BIGINT) AS total FROM ("
       + ORACLES["ag26_quality_score"] + "))")
def _(s, d):
    return Q.quality_total(Q.quality_score(C.cases(s, d), 25))


ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query("ag27_profile", " UNION ALL ".join(f"""SELECT '{c}' AS variable, count(*) AS n, count({c}) AS filled, count(*) - count({c}) AS missing, round(1e2 * (count(*) - count({c})) / count(*), 2) AS pct_missing,
 count(DISTINCT {c}) AS distinct_values FROM orders""" for c in ORDER_COLUMNS), "pct_missing")
def _(s, d):
    return Q.profile(C.table(s, d, "orders"), ORDER_COLUMNS)


@query("ag32_completeness_table", CASES + " UNION ALL ".join(f"""{'SELECT' if i else ' SELECT'} '{f}' AS field, {cnt(c)} AS filled, count(*) - {cnt(c)} AS missing, 1e2 * {cnt(c)} / count(*) AS pct_complete FROM cases"""
       for i, (f, c) in enumerate(_QF.items())), "pct_complete")
def _(s, d):
    return Q.completeness_table(C.cases(s, d), list(_QF))


_INCONSISTENT = {"notification_before_onset": "notified_date < onset_date", "lp_before_onset": "lp_date < onset_date", "death_without_end_date": "death = 1 AND outcome_date IS NULL AND closed_date IS NULL",
                 "confirmed_without_criterion": "confirmed = 1 AND coalesce(criterion, '*Em Branco') = '*Em Branco'"}


@query("ag32_inconsistency_table", CASES + " UNION ALL ".join(f"""{'SELECT' if i else ' SELECT'} '{r}' AS rule, {cnt(c)} AS n_bad, 1e2 * {cnt(c)} / count(*) AS pct FROM cases""" for i, (r, c) in enumerate(_INCONSISTENT.items())), "pct")
def _(s, d):
    return Q.inconsistency_table(C.cases(s, d))


@query("ag28_consistency", CASES + " UNION ALL ".join(f"""{'SELECT' if i else ' SELECT'} '{r}' AS rule, {cnt(f'{a} > {b}')} AS n_bad, {pc(cnt(f'{a} > {b}'), 'count(*)')} AS pct, 'high' AS severity FROM cases""" for i, (r, a, b) in enumerate(Q.DATE_RULES)) + f"""
 UNION ALL SELECT 'male_and_pregnant', {cnt("sex_raw = 'M' AND pregnant_raw = 'Sim'")}, {pc(cnt("sex_raw = 'M' AND pregnant_raw = 'Sim'"), 'count(*)')}, 'medium' FROM cases
 UNION ALL SELECT 'duplicate_id', count(*) - count(DISTINCT case_id), 0, 'high' FROM cases""", "pct")
def _(s, d):
    return Q.consistency(C.cases(s, d))


_LC = "(coalesce(criterion, '') IN ('Cultura', 'PCR', 'Látex') OR lab_pcr IS NOT NULL OR lab_culture IS NOT NULL OR lab_latex IS NOT NULL)"


@query("ag29_ppv", CASES + f""" SELECT class_group, CAST(sum(confirmed) AS BIGINT) AS confirmed_n, {cnt(f'confirmed = 1 AND {_LC}')} AS with_lab,
  1e0 * {cnt(f'confirmed = 1 AND {_LC}')} / nullif(sum(confirmed), 0) AS ppv FROM cases GROUP BY 1""", "ppv")
def _(s, d):
    return Q.ppv(C.cases(s, d), "class_group")


@query("ag30_confusion", """WITH g AS (SELECT count(*) FILTER (WHERE t AND x) AS tp, count(*) FILTER (WHERE NOT t AND x) AS fp, count(*) FILTER (WHERE t AND NOT x) AS fn, count(*) FILTER (WHERE NOT t AND NOT x) AS tn
  FROM (SELECT quality = 1 AS t, n_chars > 800 AS x FROM labels JOIN documents USING (doc_id)))
SELECT *, 1e0 * tp / nullif(tp + fn, 0) AS sensitivity, 1e0 * tn / nullif(tn + fp, 0) AS specificity, 1e0 * tp / nullif(tp + fp, 0) AS ppv, 1e0 * tn / nullif(tn + fn, 0) AS npv FROM g""", "sensitivity specificity ppv npv")
def _(s, d):
    j = C.table(s, d, "labels").join(C.table(s, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return Q.confusion(j, "quality", (F.col("n_chars") > 800).cast("int"))


@query("ag31_leadtime_stats", CASES + " UNION ALL ".join(f"""{'SELECT' if i else ' SELECT'} '{c}' AS lead_time, count(*) AS n, avg({c}) AS mean_days, quantile_cont({c}, 0.5) AS p50, quantile_cont({c}, 0.75) AS p75, quantile_cont({c}, 0.9) AS p90
FROM cases WHERE {c} >= 0 AND {c} < {b}""" for i, (c, b) in enumerate([("lag_onset_notif", 365), ("lag_notif_invest", 365), ("lag_notif_close", 800)])), "mean_days p50 p75 p90")
def _(s, d):
    return Q.leadtime_stats(C.cases(s, d), {"lag_onset_notif": 365, "lag_notif_invest": 365, "lag_notif_close": 800})


@query("ag57_audit_table", CASES + """, g AS (SELECT class_group, count(*) AS n, nullif(sum(death), 0) AS deaths FROM cases GROUP BY 1)
SELECT 'rows' AS "check", '*' AS "column", count(*)::DOUBLE AS value FROM g UNION ALL SELECT 'filled', 'class_group', count(class_group) FROM g UNION ALL SELECT 'missing', 'class_group', count(*) - count(class_group) FROM g
UNION ALL SELECT 'total', 'n', sum(n) FROM g""", "value")
def _(s, d):
    g = C.cases(s, d).groupBy("class_group").agg(F.count(F.lit(1)).alias("n"))
    return Q.audit_table(g, ["class_group"], ["n"])
