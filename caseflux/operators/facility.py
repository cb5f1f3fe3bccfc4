"""Facilities, beds and births (AG50-AG52)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numbers as N
from ..functions import text as X
from . import scope as S

HIGH, PRIMARY = "Alta complexidade / hospitalar", "Atenção básica"


def facility_profile(df: DataFrame) -> DataFrame:
    """AG50: match rate, level of care and distinct facilities, state and region.

    Rows are folded to (region, facility) first, so the distinct count is a count of rows.
    """
    pre = df.groupBy(F.coalesce("region", F.lit("Sem regional")).alias("region"), "facility_match",
                     F.when(F.col("facility_match") == 1, F.col("facility_key")).alias("_f"), "facility_level").agg(F.count(F.lit(1)).alias("_n"))
    when = lambda c: F.sum(F.when(c, F.col("_n")).otherwise(0))
    out = S.roll_up(pre, S.SCOPES_NO_YEAR, [
        F.sum("_n").alias("cases"), when(F.col("facility_match") == 1).alias("matched"), when(F.col("facility_level") == HIGH).alias("high_n"),
        when(F.col("facility_level") == PRIMARY).alias("primary_n"), F.countDistinct("_f").alias("facilities")])
    return out.withColumns({"pct_match": N.pct("matched", "cases"), "pct_high": N.pct("high_n", "cases"), "pct_primary": N.pct("primary_n", "cases")})


def facility_types(df: DataFrame) -> DataFrame:
    """AG50: cases and facilities by type."""
    pre = df.groupBy(F.coalesce("facility_type", F.lit("Sem match/sem tipo")).alias("facility_type"), "facility_level", "facility_key").agg(
        F.count(F.lit(1)).alias("_n"))
    return pre.groupBy("facility_type", "facility_level").agg(F.sum("_n").alias("cases"), F.count("facility_key").alias("facilities"))


def beds(table: DataFrame) -> DataFrame:
    """AG51: all beds and intensive-care beds by municipality, region and state."""
    uti = X.contains_any(X.text_key("bed_type"), ("UTI", "INTENSIV"))
    q = F.coalesce(F.col("quantity").cast("double"), F.lit(0.0))
    pre = table.groupBy(X.code6("code").alias("code6"), F.coalesce("region", F.lit("Sem regional")).alias("region")).agg(
        F.sum(q).alias("beds"), F.sum(F.when(uti, q).otherwise(0.0)).alias("icu_beds"))
    return S.roll_up(pre, {"STATE": (), "REGION": ("region",), "MUNICIPALITY": ("code6",)}, [
        F.sum("beds").alias("beds"), F.sum("icu_beds").alias("icu_beds"),
        F.countDistinct(F.when(F.col("beds") > 0, F.col("code6"))).alias("municipalities_with_beds"),
        F.countDistinct(F.when(F.col("icu_beds") > 0, F.col("code6"))).alias("municipalities_with_icu")])


def live_births(births: DataFrame, state: str | None = None) -> DataFrame:
    """AG52: births per municipality and year."""
    b = births if state is None else births.filter(F.upper(F.trim("residence_state")) == state)
    b = b.select(X.code6("code").alias("code6"), F.col("birth_year").try_cast("double").cast("int").alias("year"))
    return b.filter(F.col("code6").isNotNull() & F.col("year").isNotNull()).groupBy("code6", "year").agg(F.count(F.lit(1)).alias("live_births"))


def infant_incidence(df: DataFrame, births: DataFrame) -> DataFrame:
    """AG52: cases under one year per 1000 live births of the municipality and year."""
    from .joins import with_births

    infants = df.filter(F.col("age_band") == "< 1 ano").groupBy("code6", "event_year", "municipality", "region").agg(F.sum("case_n").alias("infant_cases"))
    j = with_births(infants, births)
    return j.withColumns({"incidence_1000": N.ratio("infant_cases", "live_births", 1000.0), "has_births": F.col("live_births").isNotNull()})
