"""Reference-table views of the driver tables: facilities, coordinates, exams, deaths, climate."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cases import line_summary, people, table, territory


def facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    bal = F.col("s_acctbal")
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey",
        F.lpad(F.col("s_suppkey").cast("string"), 7, "0").alias("registry_code"),
        F.col("s_name").alias("facility_name"),
        F.when(bal < 0, None).when(bal < 3000, "POSTO DE SAÚDE").when(bal < 7000, "HOSPITAL GERAL")
        .otherwise("FARMACIA").alias("facility_type"),
    )


def coordinates_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinates of the supplier's nation, written without or with a misplaced decimal point."""
    lat, lon = -(8.0 + F.col("s_nationkey") / 4.0), -(51.0 + F.col("s_nationkey") / 3.0)
    lat_text = F.regexp_replace(F.format_string("%.2f", lat), "\\.", ",")
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_acctbal") < 3000, (lat * 100).cast("bigint").cast("string")).otherwise(lat_text).alias("lat_raw"),
        F.when(F.col("s_acctbal") < 5000, (lon * 10000).cast("string")).otherwise(lon.cast("string")).alias("lon_raw"),
    )


def _ordered_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their person: joined before the line items, so that these are shuffled once, by order."""
    o, p = table(spark, sf_dir, "orders"), people(spark, sf_dir)
    return o.join(p, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "o_orderdate", "c_nationkey", "birth_date", "sex_raw")


def exams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Laboratory extract: a line item is an exam of the order's person."""
    li, t = table(spark, sf_dir, "lineitem"), territory(spark, sf_dir)
    j = li.join(_ordered_by(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")).join(t, F.col("c_nationkey") == F.col("n_nationkey"))
    d0, q = F.to_date("o_orderdate"), F.col("l_quantity").cast("int")
    n = F.col("l_linenumber")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("exam_id"),
        F.when(F.col("l_returnflag") == "A", F.col("l_orderkey").cast("string")).alias("notification"),
        F.date_add("birth_date", F.when(n == 7, 1).otherwise(0)).alias("birth_date"), "sex_raw", "region",
        F.when(n != 6, F.substring("code_raw", 1, 6)).alias("code6"),
        F.when(n <= 4, "Neisseria PCR").when(n == 5, "LCR - cultura").otherwise("Hemograma").alias("exam"),
        F.when(n <= 2, "RT-PCR").when(n <= 4, "Látex").otherwise("Cultura").alias("method"),
        F.when(F.col("l_linestatus") == "F", "Resultado Liberado").otherwise("Em análise").alias("exam_status"),
        F.when(F.col("l_returnflag") == "R", "Neisseria meningitidis: Detectável").when(
            F.col("l_returnflag") == "A", "Neisseria meningitidis: Não detectável").alias("field_1"),
        F.when((F.col("l_returnflag") == "R") & (n == 1), "Grupo – Neisseria meningitidis: B").when(
            (F.col("l_returnflag") == "R") & (n == 2), "Grupo Neisseria meningitidis: C").alias("field_2"),
        F.date_add(d0, q - 10).alias("collected_date"),
        F.date_add(d0, q - 10 + F.round(F.col("l_tax") * 100, 0).cast("int")).alias("released_date"),
    )


EXAMS_CTE = """
exams AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS exam_id,
    CASE WHEN l_returnflag = 'A' THEN CAST(l_orderkey AS VARCHAR) END AS notification,
    birth_date + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS birth_date, sex_raw, r_name AS region,
    CASE WHEN l_linenumber <> 6 THEN '51' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') END AS code6,
    l_linenumber AS ln, l_returnflag AS rf, l_linestatus AS ls,
    CAST(o_orderdate AS DATE) + CAST(l_quantity AS INTEGER) - 10 AS collected_date,
    CAST(o_orderdate AS DATE) + CAST(l_quantity AS INTEGER) - 10 + CAST(round(l_tax * 100) AS INTEGER) AS released_date,
    CAST(round(l_tax * 100) AS INTEGER) AS turnaround
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN people ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
ex AS (
  SELECT *, CAST(rf = 'R' AS INTEGER) AS nm_detected, CAST(rf = 'R' AS INTEGER) AS lab_positive, 0 AS hi_detected,
    CASE WHEN rf = 'R' AND ln = 1 THEN 'B' WHEN rf = 'R' AND ln = 2 THEN 'C' ELSE '' END AS lab_serogroup,
    CAST(ln <= 2 AS INTEGER) AS is_pcr, CAST(ln = 5 AS INTEGER) AS is_culture, CAST(ln BETWEEN 3 AND 4 AS INTEGER) AS is_latex,
    CAST(ls = 'F' AS INTEGER) AS released
  FROM exams WHERE ln <= 5)"""


def deaths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mortality register: a returned line item is a death record of the order's person, some without date, cause or place."""
    li, t = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'"), territory(spark, sf_dir)
    j = li.join(_ordered_by(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey")).join(t, F.col("c_nationkey") == F.col("n_nationkey"))
    n = F.col("l_linenumber")
    return j.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("death_id"),
        F.when(n == 3, F.col("l_orderkey").cast("string")).alias("notification"),
        F.date_add("birth_date", F.when(n == 7, 1).otherwise(0)).alias("birth_date"), "sex_raw",
        F.when(n != 6, F.substring("code_raw", 1, 6)).alias("code6"),
        F.when(F.col("l_linestatus") == "F", F.date_add(F.to_date("o_orderdate"), F.col("l_quantity").cast("int") - 5)).alias("death_date"),
        F.when(n == 1, "A39.0").when(n == 2, "G00.9").when(n == 3, "I21.0").when(n == 4, "J18.9").alias("cause"),
    )


DEATHS_CTE = """
deaths AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS death_id,
    CASE WHEN l_linenumber = 3 THEN CAST(l_orderkey AS VARCHAR) END AS notification,
    birth_date + CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS birth_date, sex_raw,
    CASE WHEN l_linenumber <> 6 THEN '51' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') END AS code6,
    CASE WHEN l_linestatus = 'F' THEN CAST(o_orderdate AS DATE) + CAST(l_quantity AS INTEGER) - 5 END AS death_date,
    CASE l_linenumber WHEN 1 THEN 'A39.0' WHEN 2 THEN 'G00.9' WHEN 3 THEN 'I21.0' WHEN 4 THEN 'J18.9' END AS cause
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN people ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey WHERE l_returnflag = 'R')"""


def climate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station readings: the event stream by day and type; values are the measurements."""
    e = table(spark, sf_dir, "events")
    return e.select(F.to_date("ts").alias("date"), F.col("event_type").alias("station"),
                    F.col("value").alias("temperature_mean"), (F.col("value") / 2).alias("humidity"))
