"""Scalar expressions and filters on the case view and the text tables (SC*, FL*)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import fixed as K
from ..functions import numbers as N
from ..functions import text as X
from ..operators import filters as FL
from ..plans import base as B
from ..plans import cases as C
from .registry import query

CASES = "WITH " + C.CASES_CTE + "\n"
RAW = "WITH " + C.RAW_CTE + "\n"


def _counts(df, **exprs):
    return df.select(*[e.alias(n) for n, e in exprs.items()]).groupBy(*exprs).agg(F.count(F.lit(1)).alias("n"))


@query("sc01_text_key", """
SELECT doc_id, md5(trim(regexp_replace(upper(strip_accents(replace(text, 'ß', 'SS'))), '[^A-Z0-9]+', ' ', 'g'))) AS key_md5,
  length(trim(regexp_replace(upper(strip_accents(replace(text, 'ß', 'SS'))), '[^A-Z0-9]+', ' ', 'g'))) AS key_len FROM documents""")
def _(s, d):
    k = X.text_key("text")
    return C.table(s, d, "documents").select("doc_id", F.md5(k).alias("key_md5"), F.length(k).alias("key_len"))


@query("sc02_nullify", RAW + """
SELECT CASE WHEN lower(trim(serogroup_raw)) = 'ignorado' THEN NULL ELSE serogroup_raw END AS serogroup,
  CASE WHEN lower(criterion) = '*em branco' THEN NULL ELSE criterion END AS criterion, count(*) AS n
FROM raw GROUP BY 1, 2""")
def _(s, d):
    return _counts(C.raw_cases(s, d), serogroup=X.nullify("serogroup_raw"), criterion=X.nullify("criterion"))


@query("sc03_squeeze_spaces", """
SELECT conv_id, turn, md5(regexp_replace(trim(text), '\\s+', ' ', 'g')) AS squeezed_md5 FROM conversations""")
def _(s, d):
    df = FL.normalize_strings(C.table(s, d, "conversations"))
    return df.select("conv_id", "turn", F.md5("text").alias("squeezed_md5"))


@query("sc04_clean_names", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def _(s, d):
    n = C.table(s, d, "nation").toDF("﻿N NationKey", " N.Name ", "n_regionkey")
    return FL.clean_names(n)


@query("sc05_map_columns", """
SELECT o_orderkey AS notification, CAST(o_orderdate AS DATE)::VARCHAR AS collected_date, o_orderstatus AS result
FROM orders""")
def _(s, d):
    o = C.table(s, d, "orders").withColumnsRenamed(
        {"o_orderkey": "Num_Notificacao_SINAN", "o_orderdate": "Data Coleta", "o_orderstatus": "DS_Resultado"})
    return FL.map_columns(o).select("notification", F.to_date("collected_date").alias("collected_date"), "result")


@query("sc06_code6", RAW + "SELECT code_raw, substr(code_raw, 1, 6) AS code6, count(*) AS n FROM raw GROUP BY 1, 2")
def _(s, d):
    return _counts(C.raw_cases(s, d), code_raw=F.col("code_raw"), code6=X.code6("code_raw"))


@query("sc07_yesno", RAW + """
SELECT hospital_raw, CASE hospital_raw WHEN 'Sim' THEN 1 WHEN 'Não' THEN 0 END AS flag, count(*) AS n
FROM raw GROUP BY 1, 2""")
def _(s, d):
    return _counts(C.raw_cases(s, d), hospital_raw=F.col("hospital_raw"), flag=X.yesno("hospital_raw"))


@query("sc08_decode", CASES + """
SELECT status_code, status, outcome_code, outcome, count(*) AS n FROM cases GROUP BY 1, 2, 3, 4""")
def _(s, d):
    r = C.raw_cases(s, d)
    return _counts(r, status_code=F.col("status_code"), status=X.decode("status_code", K.STATUS_CODES),
                   outcome_code=F.col("outcome_code"), outcome=X.decode("outcome_code", K.OUTCOME_CODES))


@query("sc09_class_group", CASES + """
SELECT class_code, class_group, CASE class_code WHEN '02' THEN 'Meningite meningocócica' WHEN '4' THEN 'Meningite tuberculosa'
  WHEN '7.0' THEN 'Meningite viral/asséptica' WHEN '9' THEN 'Meningite por Hib/Hemófilo'
  WHEN '10' THEN 'Meningite por Pneumococo' ELSE 'Ignorado/em branco' END AS class_detail, count(*) AS n
FROM cases GROUP BY 1, 2, 3""")
def _(s, d):
    return _counts(C.raw_cases(s, d), class_code=F.col("class_code"),
                   class_group=X.class_group("class_code", "class_text"), class_detail=X.class_detail("class_code"))


@query("sc10_parse_dates", """
SELECT CAST(o_orderdate AS DATE)::VARCHAR AS parsed, count(*) AS n FROM orders GROUP BY 1""")
def _(s, d):
    o = C.table(s, d, "orders")
    text = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "dd/MM/yyyy")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return _counts(o, parsed=D.parse_date(text))


@query("sc11_event_date", CASES + """
SELECT event_date::VARCHAR AS event_date, event_year, event_month, count(*) AS n FROM cases GROUP BY 1, 2, 3""")
def _(s, d):
    c = C.cases(s, d)
    return _counts(c, event_date=F.col("event_date"), event_year=F.col("event_year"), event_month=F.col("event_month"))


@query("sc12_iso_week", """
SELECT CAST(isoyear(o_orderdate) AS INTEGER) AS iso_year, CAST(weekofyear(o_orderdate) AS INTEGER) AS iso_week,
  min(CAST(o_orderdate AS DATE))::VARCHAR AS first_day, count(*) AS n FROM orders GROUP BY 1, 2""")
def _(s, d):
    o = C.table(s, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return o.groupBy(D.iso_year("day").alias("iso_year"), D.iso_week("day").alias("iso_week")).agg(
        F.min("day").alias("first_day"), F.count(F.lit(1)).alias("n"))


@query("sc13_closed_week", """
SELECT CAST(isoyear(m - 7) AS INTEGER) AS closed_year, CAST(weekofyear(m - 7) AS INTEGER) AS closed_week,
  CAST(isoyear(m - 14) AS INTEGER) AS previous_year, CAST(weekofyear(m - 14) AS INTEGER) AS previous_week
FROM (SELECT CAST(max(o_orderdate) AS DATE) AS m FROM orders)""")
def _(s, d):
    o = C.table(s, d, "orders").select(F.to_date("o_orderdate").alias("event_date"))
    return FL.closed_week(o)


@query("sc14_lead_times", CASES + """
SELECT lag_onset_notif, lag_notif_invest, lag_onset_lp, lag_notif_proph, lag_onset_admit, count(*) AS n,
  min(lag_notif_close) AS min_close, max(lag_onset_outcome) AS max_outcome FROM cases GROUP BY 1, 2, 3, 4, 5""")
def _(s, d):
    df = B.lead_times(C.raw_cases(s, d))
    return df.groupBy("lag_onset_notif", "lag_notif_invest", "lag_onset_lp", "lag_notif_proph", "lag_onset_admit").agg(
        F.count(F.lit(1)).alias("n"), F.min("lag_notif_close").alias("min_close"), F.max("lag_onset_outcome").alias("max_outcome"))


@query("sc15_outcome_flags", CASES + """
SELECT status, outcome, confirmed, discarded, death, any_death, discharged, hospitalised, count(*) AS n
FROM cases GROUP BY ALL""")
def _(s, d):
    k = ["status", "outcome", "confirmed", "discarded", "death", "any_death", "discharged", "hospitalised"]
    return C.cases(s, d).groupBy(*k).agg(F.count(F.lit(1)).alias("n"))


@query("sc16_binarize_prefix", RAW + """
SELECT symptom_fever_bin, symptom_stiffness_bin, comorbidity_hiv_bin, comorbidity_tb_bin, vaccine_menc_bin,
  vaccine_hib_bin, vaccine_pneumo_bin, vaccine_bcg_bin, count(*) AS n FROM raw GROUP BY ALL""")
def _(s, d):
    df = B.binarize(C.raw_cases(s, d))
    return df.groupBy(*[c for c in df.columns if c.endswith("_bin")]).agg(F.count(F.lit(1)).alias("n"))


@query("sc17_lab_confirmed", RAW + """
SELECT criterion, CAST(coalesce(criterion, '') IN ('Cultura', 'PCR', 'Látex') OR lab_pcr IS NOT NULL
  OR lab_culture IS NOT NULL OR lab_latex IS NOT NULL AS INTEGER) AS lab_confirmed, count(*) AS n FROM raw GROUP BY 1, 2""")
def _(s, d):
    return _counts(C.raw_cases(s, d), criterion=F.col("criterion"),
                   lab_confirmed=X.lab_confirmed("criterion", ["lab_pcr", "lab_culture", "lab_latex"]))


@query("sc18_age_years", RAW + """
SELECT age_raw, CASE WHEN age_raw LIKE '%a' THEN CAST(left(age_raw, 3) AS DOUBLE) ELSE CAST(left(age_raw, 3) AS DOUBLE) / 12 END AS age,
  count(*) AS n FROM raw GROUP BY 1, 2""", "age")
def _(s, d):
    return _counts(C.raw_cases(s, d), age_raw=F.col("age_raw"), age=X.age_years("age_raw"))


_BAND_SQL = """CASE WHEN age < 1 THEN '< 1 ano' WHEN age < 5 THEN '1 a 4 anos' WHEN age < 10 THEN '5 a 9 anos'
  WHEN age < 15 THEN '10 a 14 anos' WHEN age < 20 THEN '15 a 19 anos' WHEN age < 30 THEN '20 a 29 anos'
  WHEN age < 40 THEN '30 a 39 anos' WHEN age < 50 THEN '40 a 49 anos' WHEN age < 60 THEN '50 a 59 anos'
  WHEN age IS NULL THEN 'Ignorado/sem informação' ELSE '> 60 anos' END"""


@query("sc19_age_band", RAW + f"""
SELECT age_band, count(*) AS n FROM (SELECT {_BAND_SQL} AS age_band FROM (SELECT
  CASE WHEN age_raw LIKE '%a' THEN CAST(left(age_raw, 3) AS DOUBLE) ELSE CAST(left(age_raw, 3) AS DOUBLE) / 12 END AS age FROM raw)) GROUP BY 1""")
def _(s, d):
    return _counts(C.raw_cases(s, d), age_band=X.age_band(F.lit(None), X.age_years("age_raw")))


@query("sc20_sex_std", RAW + """
SELECT sex_raw, CASE sex_raw WHEN 'M' THEN 'Masculino' WHEN 'F' THEN 'Feminino' END AS sex, sex_raw AS letter, count(*) AS n
FROM raw GROUP BY 1, 2""")
def _(s, d):
    return _counts(C.raw_cases(s, d), sex_raw=F.col("sex_raw"), sex=X.sex_std("sex_raw"), letter=X.sex_letter("sex_raw"))


@query("sc21_etiology_group", CASES + """
SELECT class_group, CASE WHEN class_group LIKE '%viral%' THEN 'Meningite viral' WHEN class_group IN ('Doença meningocócica',
  'Meningite tuberculosa', 'Meningite por Hib/Hemófilo', 'Meningite pneumocócica') THEN 'Meningite bacteriana'
  ELSE class_group END AS etiology, count(*) AS n FROM cases GROUP BY 1, 2""")
def _(s, d):
    return _counts(C.cases(s, d), class_group=F.col("class_group"), etiology=X.etiology_group("class_group"))


LAB_SQL = """CASE lab_pcr WHEN 'Detectado' THEN 1 WHEN 'Não detectado' THEN 0 WHEN 'Inconclusivo' THEN 2 END AS pcr,
  CASE lab_culture WHEN '1' THEN 1 WHEN '2' THEN 0 WHEN '3' THEN 2 END AS culture,
  CASE lab_latex WHEN 'Reagente' THEN 1 WHEN 'Não reagente' THEN 0 END AS latex"""


@query("sc22_lab_code", RAW + f"SELECT {LAB_SQL}, count(*) AS n FROM raw GROUP BY 1, 2, 3")
def _(s, d):
    return _counts(C.raw_cases(s, d), pcr=X.lab_code("lab_pcr"), culture=X.lab_code("lab_culture"), latex=X.lab_code("lab_latex"))


@query("sc23_lab_code_agents", RAW + """
SELECT result, CASE result WHEN 'Neisseria meningitidis' THEN 1 WHEN 'Nenhum agente' THEN 0 WHEN 'Não realizado' THEN NULL
  ELSE 2 END AS code, count(*) AS n FROM (SELECT CASE lab_culture WHEN '1' THEN 'Neisseria meningitidis' WHEN '2' THEN 'Nenhum agente'
  WHEN '3' THEN 'Indeterminado' ELSE 'Não realizado' END AS result FROM raw) GROUP BY 1, 2""")
def _(s, d):
    r = C.raw_cases(s, d)
    text = F.when(F.col("lab_culture") == "1", "Neisseria meningitidis").when(F.col("lab_culture") == "2", "Nenhum agente") \
        .when(F.col("lab_culture") == "3", "Indeterminado").otherwise("Não realizado")
    return _counts(r, result=text, code=X.lab_code(text, extended=True))


@query("sc24_criterion_flags", RAW + """
SELECT criterion, CAST(coalesce(criterion, '') IN ('Cultura', 'PCR', 'Látex', '9') AS INTEGER) AS broad,
  CAST(coalesce(criterion, '') IN ('Cultura', 'PCR', '9') AS INTEGER) AS strict, count(*) AS n FROM raw GROUP BY 1, 2, 3""")
def _(s, d):
    return _counts(C.raw_cases(s, d), criterion=F.col("criterion"), broad=X.criterion_broad("criterion"),
                   strict=X.criterion_strict("criterion"))


PROPH_SQL = "(prophylaxis_date IS NOT NULL OR prophylaxis_raw = 'Sim')"


@query("sc25_prophylaxis_done", CASES + f"""
SELECT prophylaxis_raw, CAST({PROPH_SQL} AS INTEGER) AS done, count(*) AS n FROM cases GROUP BY 1, 2""")
def _(s, d):
    from ..operators.kpis import prophylaxis_done

    c = C.cases(s, d)
    return _counts(c, prophylaxis_raw=F.col("prophylaxis_raw"), done=prophylaxis_done(c))


@query("sc26_serogroup", RAW + """
SELECT serogroup_raw, CASE serogroup_raw WHEN 'B' THEN 'B' WHEN 'W135' THEN 'W' WHEN 'Sorogrupo C' THEN 'C' ELSE 'Não informado' END AS serogroup,
  CAST(coalesce(serogroup_raw, '') IN ('B', 'W135', 'Sorogrupo C') AS INTEGER) AS informed, count(*) AS n FROM raw GROUP BY 1, 2, 3""")
def _(s, d):
    return _counts(C.raw_cases(s, d), serogroup_raw=F.col("serogroup_raw"), serogroup=X.serogroup("serogroup_raw"),
                   informed=X.serogroup_informed("serogroup_raw"))


@query("sc27_gal_flag", RAW + """
SELECT lab_pcr, CASE WHEN lab_pcr = 'Não detectado' THEN 0 ELSE -1 END AS flag_result,
  CASE lab_latex WHEN 'Não reagente' THEN 0 WHEN 'Reagente' THEN 1 ELSE -1 END AS flag_latex, count(*) AS n FROM raw GROUP BY 1, 2, 3""")
def _(s, d):
    return _counts(C.raw_cases(s, d), lab_pcr=F.col("lab_pcr"), flag_result=X.gal_flag("lab_pcr", F.lit("exame")),
                   flag_latex=X.gal_flag("lab_latex"))


@query("sc28_join_results", RAW + """
SELECT concat_ws(' | ', lab_pcr, lab_culture, lab_latex) AS result_text, count(*) AS n FROM raw GROUP BY 1""")
def _(s, d):
    return _counts(C.raw_cases(s, d), result_text=X.join_fields(["lab_pcr", "lab_culture", "lab_latex"]))


@query("sc31_icd_match", RAW + """
SELECT icd, CAST(icd IN ('A39.0', 'G00.9 meningite', 'b37.5', 'A87') AS INTEGER) AS compatible, count(*) AS n FROM (
  SELECT CASE contacts WHEN 0 THEN 'A39.0' WHEN 1 THEN 'I21.0' WHEN 2 THEN 'G00.9 meningite' WHEN 3 THEN 'b37.5' WHEN 4 THEN 'A87'
  WHEN 5 THEN 'C34.9' ELSE 'ignorado' END AS icd FROM raw) GROUP BY 1, 2""")
def _(s, d):
    k = F.col("contacts")
    icd = F.when(k == 0, "A39.0").when(k == 1, "I21.0").when(k == 2, "G00.9 meningite").when(k == 3, "b37.5") \
        .when(k == 4, "A87").when(k == 5, "C34.9").otherwise("ignorado")
    return _counts(C.raw_cases(s, d), icd=icd, compatible=X.icd_match(icd))


@query("sc32_facility_key_level", """
SELECT s_suppkey, CASE WHEN s_suppkey > 0 THEN CAST(s_suppkey AS VARCHAR) END AS facility_key,
  CASE WHEN s_acctbal < 0 THEN 'Sem informação' WHEN s_acctbal < 3000 THEN 'Atenção básica' WHEN s_acctbal < 7000
  THEN 'Alta complexidade / hospitalar' ELSE 'Outros / intermediário' END AS level FROM supplier""")
def _(s, d):
    from ..plans.sources_view import facilities

    return facilities(s, d).select("s_suppkey", X.facility_key("registry_code").alias("facility_key"),
                                   X.facility_level("facility_type").alias("level"))


@query("sc33_fix_coord", """
SELECT s_suppkey, -(8.0 + s_nationkey / 4.0) AS lat, -(51.0 + s_nationkey / 3.0) AS lon FROM supplier""", "lat lon")
def _(s, d):
    from ..plans.sources_view import coordinates_raw

    c = coordinates_raw(s, d)
    return c.select("s_suppkey", N.fix_coord("lat_raw", "lat", (-19, -7)).alias("lat"),
                    N.fix_coord("lon_raw", "lon", (-68, -50)).alias("lon"))


@query("sc34_haversine", """
SELECT n_nationkey, 2 * 6371.0 * atan2(sqrt(h), sqrt(1 - h)) AS km FROM (SELECT n_nationkey,
  pow(sin(radians(-15.601 + 8.0 + n_nationkey / 4.0) / 2), 2) + cos(radians(-(8.0 + n_nationkey / 4.0))) * cos(radians(-15.601))
  * pow(sin(radians(-56.097 + 51.0 + n_nationkey / 3.0) / 2), 2) AS h FROM nation)""", "km")
def _(s, d):
    n = C.table(s, d, "nation")
    lat, lon = -(8.0 + F.col("n_nationkey") / 4.0), -(51.0 + F.col("n_nationkey") / 3.0)
    return n.select("n_nationkey", N.haversine(lat, lon, -15.601, -56.097).alias("km"))


@query("sc35_ratios", CASES + """
SELECT event_year, 100.0 * sum(death) / nullif(sum(confirmed), 0) AS pct_death,
  100.0 * (sum(confirmed) - sum(discarded)) / nullif(sum(discarded), 0) AS change FROM cases GROUP BY 1""", "pct_death change")
def _(s, d):
    g = C.cases(s, d).groupBy("event_year").agg(*[F.sum(c).alias(c) for c in ("death", "confirmed", "discarded")])
    return g.select("event_year", N.pct("death", "confirmed").alias("pct_death"),
                    N.pct_change("confirmed", "discarded").alias("change"))


@query("sc36_clip", """
SELECT l_linenumber, count(*) AS n, count(*) FILTER (WHERE l_quantity BETWEEN 5 AND 40) AS kept,
  sum(CASE WHEN l_quantity BETWEEN 5 AND 40 THEN l_quantity END) AS total FROM lineitem GROUP BY 1""", "total")
def _(s, d):
    v = N.clip_null("l_quantity", 5, 40)
    return C.table(s, d, "lineitem").groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("kept"), F.sum(v).alias("total"))


@query("sc37_light_change", """
SELECT n_name, CASE WHEN b IS NULL OR b = 0 THEN 'Cinza' WHEN 100.0 * (a - b) / b > 5 THEN 'Vermelho'
  WHEN 100.0 * (a - b) / b < -5 THEN 'Verde' ELSE 'Amarelo' END AS light,
  CASE WHEN 100.0 * a / (a + b) >= 50 THEN 'Verde' WHEN 100.0 * a / (a + b) >= 48 THEN 'Amarelo' ELSE 'Vermelho' END AS light_ref
FROM (SELECT n_name, count(*) FILTER (WHERE o_orderstatus = 'F') AS a, count(*) FILTER (WHERE o_orderstatus = 'O') AS b
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)""")
def _(s, d):
    o, c, n = (C.table(s, d, t) for t in ("orders", "customer", "nation"))
    g = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).groupBy("n_name").agg(
        F.count_if(F.col("o_orderstatus") == "F").alias("a"), F.count_if(F.col("o_orderstatus") == "O").alias("b"))
    return g.select("n_name", N.light_change(N.pct_change("a", "b")).alias("light"),
                    N.light_ref(N.pct("a", F.col("a") + F.col("b")), 50.0, True, 2.0).alias("light_ref"))


@query("sc39_bands", """
SELECT p_brand, CASE WHEN r < 0.67 THEN 'strongly protective' WHEN r < 0.9 THEN 'mildly protective' WHEN r <= 1.1 THEN 'near null'
  WHEN r <= 1.5 THEN 'moderate increase' ELSE 'strong increase' END AS magnitude,
  CASE WHEN r - 1 < 0.1 AND 1 - r < 0.1 THEN 'negligible' WHEN abs(r - 1) < 0.3 THEN 'weak' WHEN abs(r - 1) < 0.5 THEN 'moderate' ELSE 'strong' END AS r_band
FROM (SELECT p_brand, CAST(count(*) FILTER (WHERE p_size > 25) AS DOUBLE) / nullif(count(*) FILTER (WHERE p_size <= 25), 0) AS r FROM part GROUP BY 1) WHERE r IS NOT NULL""")
def _(s, d):
    g = C.table(s, d, "part").groupBy("p_brand").agg(
        N.ratio(F.count_if(F.col("p_size") > 25), F.count_if(F.col("p_size") <= 25)).alias("r"))
    return g.filter(F.col("r").isNotNull()).select(
        "p_brand", N.or_magnitude("r").alias("magnitude"), N.r_band(F.col("r") - 1).alias("r_band"))


@query("sc40_period_label", """
SELECT CAST(isoyear(o_orderdate) AS VARCHAR) || '-S' || lpad(CAST(weekofyear(o_orderdate) AS VARCHAR), 2, '0') AS period, count(*) AS n
FROM orders GROUP BY 1""")
def _(s, d):
    o = C.table(s, d, "orders")
    return _counts(o, period=D.period_label(D.iso_year("o_orderdate"), D.iso_week("o_orderdate")))


@query("sc41_format_number", """
SELECT c_custkey, CASE WHEN abs(c_acctbal - round(c_acctbal)) < 1e-9 THEN replace(format('{:,}', CAST(round(c_acctbal) AS BIGINT)), ',', '.')
  ELSE replace(format('{:.2f}', c_acctbal), '.', ',') END AS shown FROM customer""")
def _(s, d):
    return C.table(s, d, "customer").select("c_custkey", X.fmt_num("c_acctbal", 2).alias("shown"))


@query("sc42_lp_and_pending", RAW + """
SELECT CAST(lp_date IS NOT NULL OR lp_raw = 'Sim' AS INTEGER) AS lp_done,
  CAST(lab_pcr IS NULL AND coalesce(lab_latex, 'Ignorado') = 'Ignorado' AS INTEGER) AS pending, count(*) AS n FROM raw GROUP BY 1, 2""")
def _(s, d):
    return _counts(C.raw_cases(s, d), lp_done=X.lp_done("lp_date", "lp_raw"), pending=X.lab_pending(["lab_pcr", "lab_latex"]))


@query("sc43_annotate_reference", """
SELECT o_orderstatus, count(*) AS n, 2024 AS reference_year, 'SE 1–36/2024' AS reference_period, 'kpis' AS module FROM orders GROUP BY 1""")
def _(s, d):
    g = C.table(s, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
    return FL.annotate_provenance(FL.annotate_reference(g), "kpis")


@query("sc44_month_label", """
SELECT CAST(month(o_orderdate) AS INTEGER) AS month,
  (['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez'])[month(o_orderdate)] AS label, count(*) AS n FROM orders GROUP BY 1, 2""")
def _(s, d):
    m = F.month("o_orderdate")
    return _counts(C.table(s, d, "orders"), month=m, label=D.month_label(m))


@query("sc45_any_flag", RAW + """
SELECT comorbidity_hiv_bin, comorbidity_tb_bin, CAST(coalesce(comorbidity_hiv_bin, 0) = 1 OR coalesce(comorbidity_tb_bin, 0) = 1
  OR coalesce(serogroup_raw, 'Ignorado') <> 'Ignorado' AS INTEGER) AS any_comorbidity, count(*) AS n FROM raw GROUP BY 1, 2, 3""")
def _(s, d):
    df = B.binarize(C.raw_cases(s, d))
    return _counts(df, comorbidity_hiv_bin=F.col("comorbidity_hiv_bin"), comorbidity_tb_bin=F.col("comorbidity_tb_bin"),
                   any_comorbidity=X.any_flag(["comorbidity_hiv_bin", "comorbidity_tb_bin"], ["serogroup_raw"]))


# ---- filters -------------------------------------------------------------------------------

@query("fl01_resident", CASES + "SELECT region, count(*) AS n FROM cases WHERE region = 'ASIA' GROUP BY 1")
def _(s, d):
    return FL.resident(C.cases(s, d), "asia", "region").groupBy("region").agg(F.count(F.lit(1)).alias("n"))


@query("fl02_filter_dims", CASES + """
SELECT event_year, region, class_group, count(*) AS n FROM cases WHERE event_year IN (1997, 1998)
  AND class_group IN ('Doença meningocócica') GROUP BY 1, 2, 3""")
def _(s, d):
    df = FL.filter_dims(C.cases(s, d), event_year=[1997, 1998], class_group=[K.MENINGOCOCCAL], region=[])
    return df.groupBy("event_year", "region", "class_group").agg(F.count(F.lit(1)).alias("n"))


@query("fl03_valid_lag", CASES + """
SELECT region, count(*) FILTER (WHERE lag_onset_notif >= 0 AND lag_onset_notif < 365) AS valid_notif,
  count(*) FILTER (WHERE lag_notif_close >= 0 AND lag_notif_close < 800) AS valid_close FROM cases GROUP BY 1""")
def _(s, d):
    return C.cases(s, d).groupBy("region").agg(
        F.count_if(D.valid_lag("lag_onset_notif")).alias("valid_notif"),
        F.count_if(D.valid_lag("lag_notif_close", 800)).alias("valid_close"))


@query("fl05_search_case", CASES + """
SELECT case_id, municipality, class_group FROM cases WHERE CAST(case_id AS VARCHAR) LIKE '%123%' ORDER BY case_id LIMIT 200""")
def _(s, d):
    return FL.search_case(C.cases(s, d), "123").select("case_id", "municipality", "class_group")


@query("fl06_since_year", CASES + """
SELECT event_year, CAST(event_year < 1997 AS INTEGER) AS suspicious, count(*) AS n FROM cases GROUP BY 1, 2""")
def _(s, d):
    return _counts(C.cases(s, d), event_year=F.col("event_year"), suspicious=FL.suspicious_year("event_year", 1997))


@query("fl07_recent", CASES + """
SELECT region, count(*) FILTER (WHERE event_date > m - 14) AS n14, count(*) AS n90 FROM cases, (SELECT max(event_date) AS m FROM cases)
WHERE event_date > m - 90 GROUP BY 1""")
def _(s, d):
    c = C.cases(s, d)
    r = FL.recent(c, 90)
    return r.groupBy("region").agg(F.count_if(FL.in_last_days(FL.latest(c), 14)).alias("n14"), F.count(F.lit(1)).alias("n90"))


@query("fl08_enough", CASES + """
SELECT municipality, count(*) AS n, count(DISTINCT class_group) AS levels FROM cases GROUP BY 1 HAVING count(*) >= 600 AND count(DISTINCT class_group) >= 2""")
def _(s, d):
    return FL.enough(C.cases(s, d), ["municipality"], "class_group", 600)
