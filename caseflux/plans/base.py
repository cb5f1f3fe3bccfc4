"""Raw notifications -> standardised base table (one lazy projection plus one left join)."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions import fixed as K
from ..functions import text as X

DATE_FIELDS = (
    "onset_date", "notified_date", "investigated_date", "admitted_date", "lp_date",
    "prophylaxis_date", "outcome_date", "closed_date", "birth_date",
)
LAGS = {
    "lag_onset_notif": ("onset_date", "notified_date"),
    "lag_notif_invest": ("notified_date", "investigated_date"),
    "lag_onset_lp": ("onset_date", "lp_date"),
    "lag_notif_close": ("notified_date", "closed_date"),
    "lag_notif_proph": ("notified_date", "prophylaxis_date"),
    "lag_onset_admit": ("onset_date", "admitted_date"),
    "lag_onset_outcome": ("onset_date", "outcome_date"),
}
PREFIXES = ("symptom_", "comorbidity_", "vaccine_")


def optional(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column, or a typed NULL when the table does not carry it."""
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def lead_times(df: DataFrame, pairs: Mapping[str, tuple[str, str]] = LAGS) -> DataFrame:
    """SC14: differences in days, only for milestones the table carries."""
    return df.withColumns(
        {n: D.days_between(a, b) for n, (a, b) in pairs.items() if a in df.columns and b in df.columns}
    )


def outcome_flags(status: str = "status", outcome: str = "outcome", hospital: str = "hospital_raw") -> dict:
    """SC15: 0/1 flags of a case."""
    is_in = lambda c, *v: F.coalesce(F.col(c).isin(*v), F.lit(False)).cast("int")
    return {
        "case_n": F.lit(1),
        "confirmed": is_in(status, "Confirmado"),
        "discarded": is_in(status, "Descartado"),
        "death": is_in(outcome, K.OUTCOME_CODES["2"]),
        "any_death": is_in(outcome, K.OUTCOME_CODES["2"], K.OUTCOME_CODES["3"]),
        "discharged": is_in(outcome, K.OUTCOME_CODES["1"]),
        "hospitalised": F.coalesce(X.yesno(hospital), F.lit(0)),
    }


def binarize(df: DataFrame, prefixes: tuple[str, ...] = PREFIXES, suffix: str = "_bin") -> DataFrame:
    """SC16: one 0/1/NULL column per yes/no field with one of the prefixes."""
    fields = [c for c in df.columns if c.startswith(prefixes) and not c.endswith(suffix)]
    return df.withColumns({f"{c}{suffix}": X.yesno(c) for c in fields}) if fields else df


def standardize(raw: DataFrame, population: DataFrame | None = None, state: str | None = None) -> DataFrame:
    """Base table: dates, ISO calendar, territory, labels, flags, lead times, denominator.

    Source columns stay; rows without any reference date are dropped.
    """
    df = raw
    if state is not None and "residence_state" in df.columns:
        df = df.filter(F.upper(F.trim("residence_state")) == state)
    kinds = {f.name: f.dataType for f in df.schema.fields}
    dates = {}
    for c in DATE_FIELDS:
        if c not in kinds:
            dates[c] = F.lit(None).cast("date")
        elif isinstance(kinds[c], T.DateType):
            continue
        elif isinstance(kinds[c], T.TimestampType):
            dates[c] = F.to_date(c)
        else:
            dates[c] = D.parse_date(c)
    if dates:
        df = df.withColumns(dates)
    df = df.withColumn("event_date", D.event_date(["onset_date", "notified_date"]))
    df = df.filter(F.col("event_date").isNotNull())
    df = df.withColumns(
        {
            "event_year": F.year("event_date"),
            "event_month": F.month("event_date"),
            "iso_year": D.iso_year("event_date"),
            "iso_week": D.iso_week("event_date"),
            "code6": X.code6("code_raw"),
            "municipality_key": X.text_key("municipality"),
            "status": X.decode("status_code", K.STATUS_CODES),
            "outcome": X.decode("outcome_code", K.OUTCOME_CODES),
            "class_detail": X.class_detail("class_code"),
            "_by_code": X.class_of_code("class_code"),
        }
    )
    # the search key is its own step, so that the keyword rules read a column and not nine copies of it
    df = df.withColumn("_class_key", F.when(F.col("_by_code").isNull(), X.class_key("class_code", optional(df, "class_text"))))
    df = df.withColumn("class_group", F.coalesce("_by_code", X.class_of_key(F.col("_class_key")))).drop("_by_code", "_class_key")
    if "criterion" in df.columns:
        df = df.withColumn("_ck", X.text_key("criterion"))
        df = df.withColumns({
            "criterion_strict": X.criterion_of_key(F.col("_ck"), K.CRITERION_STRICT_WORDS, K.CRITERION_STRICT_CODES),
            "criterion_broad": X.criterion_of_key(F.col("_ck"), K.CRITERION_BROAD_WORDS, K.CRITERION_BROAD_CODES)}).drop("_ck")
    flags = {
        "serogroup_known": ("serogroup_raw", X.serogroup_informed),
        "prophylaxis_yes": ("prophylaxis_raw", lambda c: F.coalesce(X.yesno(c) == 1, F.lit(False))),
    }
    df = df.withColumns({n: f(c) for n, (c, f) in flags.items() if c in df.columns})
    df = df.withColumns(outcome_flags())
    df = binarize(lead_times(df))
    if population is not None:
        from ..operators.joins import with_population

        df = with_population(df, population)
    return df
