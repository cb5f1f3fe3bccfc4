"""Laboratory operators (AG33-AG35, AG37, AG47-AG49, JN15, SC29, SC30)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X
from . import scope as S

RESULTS = {"lab_pcr": "PCR", "lab_culture": "Cultura", "lab_latex": "Látex"}


def lab_methods(df: DataFrame, cols: Mapping[str, str] = RESULTS, extended: bool = False) -> DataFrame:
    """AG33: results by method out of one aggregation (no row per method is made)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(cols):
        code = X.lab_code(c, extended)
        aggs += [F.count_if(code == v).alias(f"_{k}{i}") for k, v in (("p", 1), ("n", 0), ("i", 2))]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(label).alias("method"), F.col(f"_p{i}").alias("positive"), F.col(f"_n{i}").alias("negative"),
                              F.col(f"_i{i}").alias("inconclusive")) for i, label in enumerate(cols.values())])
    out = one.select("_n", F.inline(rows))
    conc = F.col("positive") + F.col("negative")
    valid = conc + F.col("inconclusive")
    return out.select("method", valid.alias("valid"), conc.alias("conclusive"), "positive", "negative", "inconclusive",
                      N.pct("positive", conc).alias("pct_positive"), N.pct("positive", valid).alias("pct_positive_valid"),
                      N.pct(valid, "_n").alias("pct_coverage"))


def any_lab(cols: Sequence[str] = tuple(RESULTS)) -> dict[str, Column]:
    """Case level: any valid, any conclusive, any positive result."""
    codes = F.array(*[X.lab_code(c) for c in cols])
    has = lambda test: F.coalesce(F.exists(codes, test), F.lit(False)).cast("int")
    return {"lab_valid": has(lambda x: x.isNotNull()), "lab_conclusive": has(lambda x: x.isin(0, 1)), "lab_any_positive": has(lambda x: x == 1)}


def lab_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AG34/AG37: case-level laboratory coverage and positivity by key (or overall)."""
    g = df.withColumns(any_lab()).groupBy(*keys).agg(
        F.sum("case_n").alias("notified"), F.sum("confirmed").alias("confirmed_n"), F.sum("hospitalised").alias("hospitalised_n"),
        F.sum("death").alias("deaths"), F.sum("lab_valid").alias("with_valid"), F.sum("lab_conclusive").alias("with_conclusive"),
        F.sum("lab_any_positive").alias("positives"))
    return g.withColumns({"pct_positive": N.pct("positives", "with_conclusive"), "pct_lab_use": N.pct("with_valid", "notified")})


def lab_kpis(df: DataFrame) -> DataFrame:
    """AG37: one row."""
    return lab_by(df, []).drop("hospitalised_n", "deaths")


def lab_access(df: DataFrame, coords: DataFrame, lab_lat: float, lab_lon: float) -> DataFrame:
    """AG35: laboratory use by municipality with the distance to the laboratory."""
    from .joins import with_coordinates

    g = with_coordinates(lab_by(df, ["code6", "municipality", "region"]), coords)
    km = N.haversine(F.col("lat"), F.col("lon"), lab_lat, lab_lon)
    return g.withColumn("distance_km", F.when(km.between(0, 2000), km))


def prepare_exams(exams: DataFrame, results: Sequence[str]) -> DataFrame:
    """SC28-SC30: relevant exams with parsed result text, method flags and turnaround; the exam id stays."""
    e = exams.filter(X.exam_relevant("exam")).withColumn("result_text", X.join_fields(results))
    e = e.withColumn("_lab", X.lab_summary("result_text"))  # a column of its own, so that the flags share it
    e = e.withColumns({**{n: F.col("_lab")[n] for n in X.LAB_FLAGS}, **X.exam_flags("method", "exam_status")}).drop("_lab")
    number = F.regexp_replace(F.col("notification").cast("string"), "\\D", "")
    return e.withColumns({"turnaround": F.datediff("released_date", "collected_date"), "notification": F.when(number != "", number)})


def exams_per_case(exams: DataFrame, key: str = "notification") -> DataFrame:
    """AG47: exam typing per notification. The median runs over (key, days) counts."""
    e = exams.filter(F.col(key).isNotNull())
    pre = e.groupBy(key, "turnaround").agg(
        F.count(F.lit(1)).alias("_n"), *[F.max(c).alias(c) for c in ("is_pcr", "is_culture", "lab_positive", "nm_detected", "hi_detected")],
        F.sum("released").alias("released_n"),
        F.min(F.when(F.col("lab_serogroup") != "", F.struct("exam_id", "lab_serogroup"))).alias("_s"))
    return pre.groupBy(key).agg(
        F.sum("_n").alias("exams"), F.max("is_pcr").alias("any_pcr"), F.max("is_culture").alias("any_culture"),
        F.max("lab_positive").alias("any_positive"), F.max("nm_detected").alias("any_nm"), F.max("hi_detected").alias("any_hi"),
        F.coalesce(F.min("_s")["lab_serogroup"], F.lit("")).alias("lab_serogroup"), F.sum("released_n").alias("released_n"),
        F.percentile("turnaround", F.lit(0.5), F.col("_n")).alias("median_turnaround"))


def concordance(cases: DataFrame, exams: DataFrame, links: DataFrame | None = None, case_id: str = "case_id") -> DataFrame:
    """JN15: cases with their exams (by linkage where given, else by number) and the union of both serogroups."""
    if links is not None:
        keyed = exams.join(links.select(F.col(case_id).cast("string").alias("_k"), F.col("exam_id").alias("_e")), F.col("exam_id") == F.col("_e"))
        typed = exams_per_case(keyed.withColumn("notification", F.col("_k")))
    else:
        typed = exams_per_case(exams)
    j = cases.join(typed.withColumnRenamed("notification", "_nk"), F.col(case_id).cast("string") == F.col("_nk"), "left").drop("_nk")
    own = F.when(~X.is_filled("serogroup_raw") | X.text_key("serogroup_raw").rlike("EM BRANCO|IGNORADO|NAO SE APLICA"), "").otherwise(
        F.trim("serogroup_raw"))
    lab = F.coalesce("lab_serogroup", F.lit(""))
    return j.withColumns({
        "has_exam": F.coalesce(F.col("exams") > 0, F.lit(False)).cast("int"), "own_serogroup": own, "lab_serogroup": lab,
        "serogroup_union": F.when(own != "", own).otherwise(lab), "serogroup_only_lab": ((own == "") & (lab != "")).cast("int")})


def exam_kpis(exams: DataFrame) -> DataFrame:
    """AG48: exam totals, methods, positivity among released and median turnaround."""
    rel = F.col("released") == 1
    out = S.by_scope(exams, {
        "exams": F.lit(1), "released_n": rel, "pcr_n": F.col("is_pcr"), "culture_n": F.col("is_culture"),
        "positive_released": rel & (F.col("lab_positive") == 1), "nm_detected_n": F.col("nm_detected"), "hi_detected_n": F.col("hi_detected"),
        "with_serogroup": F.col("lab_serogroup") != ""}, F.col("turnaround"), {"median_turnaround": 0.5}, S.STATE)
    return out.withColumns({"pct_pcr": N.pct("pcr_n", "exams"), "pct_culture": N.pct("culture_n", "exams"),
                            "pct_positive_released": N.pct("positive_released", "released_n")})


def concordance_kpis(conc: DataFrame, target: Column) -> DataFrame:
    """AG48: share of cases with an exam and gain in serogroups, state and region."""
    out = S.by_scope(conc, {
        "cases": F.lit(1), "with_exam": F.col("has_exam"), "target_n": target, "target_with_exam": target & (F.col("has_exam") == 1),
        "target_own": target & (F.col("own_serogroup") != ""), "target_union": target & (F.col("serogroup_union") != ""),
        "target_only_lab": target & (F.col("serogroup_only_lab") == 1)}, scopes=S.SCOPES_NO_YEAR)
    return out.withColumns({"pct_with_exam": N.pct("with_exam", "cases"), "pct_target_with_exam": N.pct("target_with_exam", "target_n"),
                            "pct_serogroup_own": N.pct("target_own", "target_n"), "pct_serogroup_union": N.pct("target_union", "target_n")})


def turnaround(exams: DataFrame) -> DataFrame:
    """AG49: collection to release of released exams."""
    t = F.col("turnaround")
    ok = (F.col("released") == 1) & t.isNotNull() & (t >= 0)
    out = S.by_scope(exams, {"n": ok, "le_2d": ok & (t <= 2), "le_7d": ok & (t <= 7)}, F.when(ok, t), {"p50_days": 0.5, "p90_days": 0.9}, S.STATE)
    return out.withColumns({"pct_48h": N.pct("le_2d", "n"), "pct_7d": N.pct("le_7d", "n")})
