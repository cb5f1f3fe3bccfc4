"""Case view of the driver tables: an order is a notification, its line items its history.

`CASES_CTE` is the same view in SQL, used by the oracle queries.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import standardize


_SCHEMAS: dict = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. The schema is read from the file once per process, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def line_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    n_if = lambda cond: F.count_if(cond)
    return li.groupBy(F.col("l_orderkey")).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("l_quantity").cast("int").alias("q_min"),
        F.max("l_quantity").cast("int").alias("q_max"),
        F.sum("l_quantity").cast("int").alias("q_sum"),
        n_if(F.col("l_returnflag") == "R").alias("n_ret"),
        n_if(F.col("l_returnflag") == "A").alias("n_acc"),
        n_if(F.col("l_linestatus") == "F").alias("n_fin"),
        F.min("l_linenumber").alias("ln_min"),
        F.max("l_linenumber").alias("ln_max"),
        F.round(F.max("l_discount") * 100, 0).cast("int").alias("disc_max"),
        F.min("l_suppkey").alias("supp"),
    )


def territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey",
        F.concat(F.lit("51"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), F.lit("0")).alias("code_raw"),
        F.col("n_name").alias("municipality"),
        F.col("r_name").alias("region"),
    )


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Person attributes: birth date, sex and age text out of the customer balance."""
    bal = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal",
        F.date_add(F.lit("1930-01-01").cast("date"), F.floor(F.abs(bal) * 3).cast("int")).alias("birth_date"),
        F.when(bal - F.floor(bal) < 0.5, "M").otherwise("F").alias("sex_raw"),
        F.concat(
            F.lpad(F.floor(F.abs(bal) / 100).cast("string"), 3, "0"), F.when(bal >= 0, "a").otherwise("m")
        ).alias("age_raw"),
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, p, t = table(spark, sf_dir, "orders"), people(spark, sf_dir), territory(spark, sf_dir)
    cents = F.round(F.col("o_totalprice") * 100, 0).cast("bigint")
    return (
        o.filter(F.col("o_orderdate") >= "1996-01-01")
        .join(p, o.o_custkey == p.c_custkey)
        .groupBy("c_nationkey", F.year("o_orderdate").alias("year"))
        .agg(F.sum(cents).alias("_cents"))
        .join(t, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.substring("code_raw", 1, 6).alias("code6"), "year",
                F.expr("_cents div 1000000").alias("population"))
    )


_RAW_COLUMNS = """
o_orderkey AS case_id; o_custkey AS person_id; code_raw; municipality; region; birth_date; sex_raw; age_raw;
CASE WHEN n_lines IS NOT NULL THEN d0 END AS onset_date;
notified AS notified_date;
CASE WHEN n_ret > 0 THEN date_add(notified, cast(n_lines - 3 AS int)) END AS investigated_date;
CASE WHEN n_fin >= 2 THEN date_add(d0, disc_max - 1) END AS admitted_date;
CASE WHEN n_fin > 0 THEN date_add(d0, ln_min - 1) END AS lp_date;
CASE WHEN n_acc >= 2 THEN date_add(notified, ln_max - 4) END AS prophylaxis_date;
CASE WHEN n_ret > 0 THEN date_add(d0, q_max) END AS outcome_date;
CASE WHEN o_orderstatus <> 'O' THEN date_add(notified, coalesce(q_sum, 0)) END AS closed_date;
CASE WHEN c_mktsegment = 'BUILDING' AND o_orderstatus = 'P' THEN '4' WHEN o_orderpriority = '1-URGENT' THEN '02'
  WHEN o_orderpriority = '2-HIGH' THEN '9' WHEN o_orderpriority = '3-MEDIUM' THEN '7.0' WHEN o_orderpriority = '5-LOW' THEN '10' END AS class_code;
CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Meningite não espec.' END AS class_text;
CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'P' THEN '2.0' ELSE '9' END AS status_code;
CASE WHEN n_ret >= 3 THEN '2' WHEN n_ret = 2 THEN '3' WHEN n_ret = 1 THEN '1.0' ELSE '9' END AS outcome_code;
CASE WHEN n_fin >= 2 THEN 'Sim' WHEN n_fin = 1 THEN 'Não' ELSE 'Ignorado' END AS hospital_raw;
CASE ln_min WHEN 1 THEN 'Cultura' WHEN 2 THEN 'PCR' WHEN 3 THEN 'Clínico' WHEN 4 THEN 'Látex' WHEN 5 THEN '9' WHEN 6 THEN '*Em Branco' END AS criterion;
CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'B' WHEN 'HOUSEHOLD' THEN 'W135' WHEN 'FURNITURE' THEN 'Sorogrupo C' WHEN 'MACHINERY' THEN 'Ignorado' END AS serogroup_raw;
CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Sim' ELSE 'Não' END AS pregnant_raw;
cast(n_acc AS int) AS contacts;
CASE WHEN n_fin > 0 THEN 'Sim' ELSE 'Não' END AS lp_raw;
CASE WHEN n_acc >= 3 THEN 'Sim' ELSE 'Não' END AS prophylaxis_raw;
CASE WHEN n_ret >= 2 THEN 'Detectado' WHEN n_ret = 1 THEN 'Não detectado' WHEN n_fin > 3 THEN 'Inconclusivo' END AS lab_pcr;
CASE WHEN n_acc >= 2 THEN '1' WHEN n_acc = 1 THEN '2' WHEN n_fin >= 3 THEN '3' WHEN n_lines IS NOT NULL THEN '4' END AS lab_culture;
CASE WHEN ln_max >= 6 THEN 'Reagente' WHEN ln_max = 5 THEN 'Não reagente' WHEN ln_max = 4 THEN 'Ignorado' END AS lab_latex;
CASE WHEN n_lines >= 5 THEN 'Sim' WHEN n_lines IS NOT NULL THEN 'Não' END AS symptom_fever;
CASE WHEN q_max >= 45 THEN 'Sim' WHEN n_lines IS NOT NULL THEN 'Não' END AS symptom_stiffness;
CASE WHEN disc_max >= 9 THEN 'Sim' WHEN n_lines IS NOT NULL THEN 'Não' END AS comorbidity_hiv;
CASE WHEN disc_max <= 2 THEN 'Sim' WHEN n_lines IS NOT NULL THEN 'Não' END AS comorbidity_tb;
CASE WHEN q_min <= 5 THEN 'Sim' WHEN n_lines IS NOT NULL THEN 'Não' END AS vaccine_menc;
CASE WHEN q_min >= 10 THEN 'Sim' WHEN n_lines IS NOT NULL THEN 'Não' END AS vaccine_hib;
CASE WHEN q_max >= 40 THEN 'Sim' WHEN n_lines IS NOT NULL THEN 'Não' END AS vaccine_pneumo;
CASE WHEN ln_min = 1 THEN 'Sim' WHEN n_lines IS NOT NULL THEN 'Não' END AS vaccine_bcg;
lpad(cast(supp AS string), 7, '0') AS facility_raw
"""


def raw_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").selectExpr("*", "to_date(o_orderdate) AS d0")
    p, t, li = people(spark, sf_dir), territory(spark, sf_dir), line_summary(spark, sf_dir)
    j = (  # the person first: orders are then shuffled by order once, and the history goes no further
        o.join(p, o.o_custkey == p.c_custkey)
        .join(t, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(li, o.o_orderkey == li.l_orderkey, "left")
    )
    j = j.selectExpr("*", "date_add(d0, coalesce(q_min, 3) - 3) AS notified")
    return j.selectExpr(*[x.strip() for x in _RAW_COLUMNS.split(";")])


def cases(spark: SparkSession, sf_dir: str, columns: Sequence[str] = ()) -> DataFrame:
    """The case view, or some columns of it: all cases, and the population only where one of them tells it."""
    if not columns:
        return standardize(raw_cases(spark, sf_dir), population(spark, sf_dir))
    pop = population(spark, sf_dir) if {"population", "has_denominator"} & {*columns} else None
    return standardize(raw_cases(spark, sf_dir), pop).select(*columns)


LINES_CTE = """
lines AS (
  SELECT l_orderkey, count(*) AS n_lines,
    CAST(min(l_quantity) AS INTEGER) AS q_min, CAST(max(l_quantity) AS INTEGER) AS q_max,
    CAST(sum(l_quantity) AS INTEGER) AS q_sum,
    count(*) FILTER (WHERE l_returnflag = 'R') AS n_ret,
    count(*) FILTER (WHERE l_returnflag = 'A') AS n_acc,
    count(*) FILTER (WHERE l_linestatus = 'F') AS n_fin,
    min(l_linenumber) AS ln_min, max(l_linenumber) AS ln_max,
    CAST(round(max(l_discount) * 100) AS INTEGER) AS disc_max, min(l_suppkey) AS supp
  FROM lineitem GROUP BY l_orderkey)"""

PEOPLE_CTE = """
people AS (
  SELECT c_custkey, c_nationkey, c_mktsegment, c_acctbal,
    DATE '1930-01-01' + CAST(floor(abs(c_acctbal) * 3) AS INTEGER) AS birth_date,
    CASE WHEN c_acctbal - floor(c_acctbal) < 0.5 THEN 'M' ELSE 'F' END AS sex_raw,
    lpad(CAST(CAST(floor(abs(c_acctbal) / 100) AS INTEGER) AS VARCHAR), 3, '0')
      || CASE WHEN c_acctbal >= 0 THEN 'a' ELSE 'm' END AS age_raw
  FROM customer)"""

POP_CTE = """
pop AS (
  SELECT '51' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS code6,
    CAST(year(o_orderdate) AS INTEGER) AS year,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) // 1000000 AS population
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderdate >= DATE '1996-01-01' GROUP BY 1, 2)"""

RAW_CTE = LINES_CTE + "," + PEOPLE_CTE + "," + POP_CTE + """,
raw AS (
  SELECT o_orderkey AS case_id, o_custkey AS person_id,
    '51' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') || '0' AS code_raw,
    n_name AS municipality, r_name AS region, birth_date, sex_raw, age_raw,
    CASE WHEN n_lines IS NOT NULL THEN CAST(o_orderdate AS DATE) END AS onset_date,
    CAST(o_orderdate AS DATE) + CAST(coalesce(q_min, 3) - 3 AS INTEGER) AS notified_date,
    CASE WHEN n_ret > 0 THEN CAST(o_orderdate AS DATE) + CAST(coalesce(q_min, 3) - 3 + n_lines - 3 AS INTEGER) END AS investigated_date,
    CASE WHEN n_fin >= 2 THEN CAST(o_orderdate AS DATE) + CAST(disc_max - 1 AS INTEGER) END AS admitted_date,
    CASE WHEN n_fin > 0 THEN CAST(o_orderdate AS DATE) + CAST(ln_min - 1 AS INTEGER) END AS lp_date,
    CASE WHEN n_acc >= 2 THEN CAST(o_orderdate AS DATE) + CAST(coalesce(q_min, 3) - 3 + ln_max - 4 AS INTEGER) END AS prophylaxis_date,
    CASE WHEN n_ret > 0 THEN CAST(o_orderdate AS DATE) + q_max END AS outcome_date,
    CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST(coalesce(q_min, 3) - 3 + coalesce(q_sum, 0) AS INTEGER) END AS closed_date,
    CASE WHEN c_mktsegment = 'BUILDING' AND o_orderstatus = 'P' THEN '4'
      WHEN o_orderpriority = '1-URGENT' THEN '02' WHEN o_orderpriority = '2-HIGH' THEN '9'
      WHEN o_orderpriority = '3-MEDIUM' THEN '7.0' WHEN o_orderpriority = '5-LOW' THEN '10' END AS class_code,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'Meningite não espec.' END AS class_text,
    CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'P' THEN '2.0' ELSE '9' END AS status_code,
    CASE WHEN n_ret >= 3 THEN '2' WHEN n_ret = 2 THEN '3' WHEN n_ret = 1 THEN '1.0' ELSE '9' END AS outcome_code,
    CASE WHEN n_fin >= 2 THEN 'Sim' WHEN n_fin = 1 THEN 'Não' ELSE 'Ignorado' END AS hospital_raw,
    CASE ln_min WHEN 1 THEN 'Cultura' WHEN 2 THEN 'PCR' WHEN 3 THEN 'Clínico' WHEN 4 THEN 'Látex'
      WHEN 5 THEN '9' WHEN 6 THEN '*Em Branco' END AS criterion,
    CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'B' WHEN 'HOUSEHOLD' THEN 'W135'
      WHEN 'FURNITURE' THEN 'Sorogrupo C' WHEN 'MACHINERY' THEN 'Ignorado' END AS serogroup_raw,
    CASE WHEN c_mktsegment = 'FURNITURE' THEN 'Sim' ELSE 'Não' END AS pregnant_raw,
    CAST(n_acc AS INTEGER) AS contacts,
    CASE WHEN n_fin > 0 THEN 'Sim' ELSE 'Não' END AS lp_raw,
    CASE WHEN n_acc >= 3 THEN 'Sim' ELSE 'Não' END AS prophylaxis_raw,
    CASE WHEN n_ret >= 2 THEN 'Detectado' WHEN n_ret = 1 THEN 'Não detectado'
      WHEN n_fin > 3 THEN 'Inconclusivo' END AS lab_pcr,
    CASE WHEN n_acc >= 2 THEN '1' WHEN n_acc = 1 THEN '2' WHEN n_fin >= 3 THEN '3'
      WHEN n_lines IS NOT NULL THEN '4' END AS lab_culture,
    CASE WHEN ln_max >= 6 THEN 'Reagente' WHEN ln_max = 5 THEN 'Não reagente'
      WHEN ln_max = 4 THEN 'Ignorado' END AS lab_latex,
    CASE WHEN n_lines IS NULL THEN NULL WHEN n_lines >= 5 THEN 1 ELSE 0 END AS symptom_fever_bin,
    CASE WHEN n_lines IS NULL THEN NULL WHEN q_max >= 45 THEN 1 ELSE 0 END AS symptom_stiffness_bin,
    CASE WHEN n_lines IS NULL THEN NULL WHEN disc_max >= 9 THEN 1 ELSE 0 END AS comorbidity_hiv_bin,
    CASE WHEN n_lines IS NULL THEN NULL WHEN disc_max <= 2 THEN 1 ELSE 0 END AS comorbidity_tb_bin,
    CASE WHEN n_lines IS NULL THEN NULL WHEN q_min <= 5 THEN 1 ELSE 0 END AS vaccine_menc_bin,
    CASE WHEN n_lines IS NULL THEN NULL WHEN q_min >= 10 THEN 1 ELSE 0 END AS vaccine_hib_bin,
    CASE WHEN n_lines IS NULL THEN NULL WHEN q_max >= 40 THEN 1 ELSE 0 END AS vaccine_pneumo_bin,
    CASE WHEN n_lines IS NULL THEN NULL WHEN ln_min = 1 THEN 1 ELSE 0 END AS vaccine_bcg_bin,
    lpad(CAST(supp AS VARCHAR), 7, '0') AS facility_raw
  FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey
  JOIN people ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

CASES_CTE = RAW_CTE + """,
cases0 AS (
  SELECT *, coalesce(onset_date, notified_date) AS event_date, substr(code_raw, 1, 6) AS code6,
    CASE status_code WHEN '1' THEN 'Confirmado' WHEN '2.0' THEN 'Descartado' ELSE 'Ignorado/em branco' END AS status_,
    CASE WHEN class_code = '4' THEN 'Meningite tuberculosa' WHEN class_code = '02' THEN 'Doença meningocócica'
      WHEN class_code = '9' THEN 'Meningite por Hib/Hemófilo' WHEN class_code = '7.0' THEN 'Meningite viral/asséptica'
      WHEN class_code = '10' THEN 'Meningite pneumocócica'
      ELSE 'Meningite não especificada' END AS class_group,
    CAST(status_code = '1' AS INTEGER) AS confirmed, CAST(status_code = '2.0' AS INTEGER) AS discarded,
    CAST(outcome_code = '2' AS INTEGER) AS death, CAST(outcome_code IN ('2', '3') AS INTEGER) AS any_death,
    CAST(outcome_code = '1.0' AS INTEGER) AS discharged, CAST(hospital_raw = 'Sim' AS INTEGER) AS hospitalised,
    1 AS case_n
  FROM raw),
cases AS (
  SELECT c.* EXCLUDE (status_),
    CASE status_code WHEN '1' THEN 'Confirmado' WHEN '2.0' THEN 'Descartado' ELSE 'Ignorado' END AS status,
    CASE outcome_code WHEN '2' THEN 'Óbito por meningite' WHEN '3' THEN 'Óbito por outra causa'
      WHEN '1.0' THEN 'Alta' ELSE 'Ignorado' END AS outcome,
    CAST(year(event_date) AS INTEGER) AS event_year, CAST(month(event_date) AS INTEGER) AS event_month,
    CAST(isoyear(event_date) AS INTEGER) AS iso_year, CAST(weekofyear(event_date) AS INTEGER) AS iso_week,
    CAST(notified_date - onset_date AS INTEGER) AS lag_onset_notif,
    CAST(investigated_date - notified_date AS INTEGER) AS lag_notif_invest,
    CAST(lp_date - onset_date AS INTEGER) AS lag_onset_lp,
    CAST(closed_date - notified_date AS INTEGER) AS lag_notif_close,
    CAST(prophylaxis_date - notified_date AS INTEGER) AS lag_notif_proph,
    CAST(admitted_date - onset_date AS INTEGER) AS lag_onset_admit,
    CAST(outcome_date - onset_date AS INTEGER) AS lag_onset_outcome,
    p.population, (p.population IS NOT NULL) AS has_denominator
  FROM cases0 c LEFT JOIN pop p ON c.code6 = p.code6 AND year(c.event_date) = p.year)"""
