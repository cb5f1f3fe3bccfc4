"""Data quality (AG26-AG32, AG57, AL14)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as X

CRITICAL_FIELDS = (
    "notified_date", "onset_date", "municipality", "code_raw", "sex_raw", "age_raw", "status_code",
    "class_code", "outcome_code", "serogroup_raw", "lp_raw", "lab_pcr", "lab_culture", "criterion", "closed_date",
)

# rule, earlier milestone, later milestone
DATE_RULES = (
    ("onset_after_notification", "onset_date", "notified_date"),
    ("notification_after_investigation", "notified_date", "investigated_date"),
    ("onset_after_admission", "onset_date", "admitted_date"),
    ("onset_after_lp", "onset_date", "lp_date"),
    ("onset_after_outcome", "onset_date", "outcome_date"),
    ("notification_after_closure", "notified_date", "closed_date"),
    ("birth_after_onset", "birth_date", "onset_date"),
)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once. Counts are aggregated, then joined back, so a hot key is
    split by the adaptive skew join instead of being windowed in one task."""
    known = df
    for k in keys:
        known = known.filter(F.col(k).isNotNull())
    c = known.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("copies"))
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"_k_{k}"))
    return df.join(c.filter(F.col("copies") > 1), cond).drop(*[f"_k_{k}" for k in keys])


def duplicates(df: DataFrame, case_id: str = "notification", block: Sequence[str] = ("birth_date", "sex_raw", "code_raw", "onset_date"),
               row_id: str = "row_id") -> DataFrame:
    """AL14/JN19: exact duplicates by id (score 1) and probable ones by demographic block (0.85)."""
    pick = lambda d, kind, score: d.select(F.lit(kind).alias("kind"), F.col(case_id), F.col(row_id), F.lit(score).alias("score"), "copies")
    return pick(duplicate_rows(df, [case_id]), "exact_id", 1.0).unionByName(pick(duplicate_rows(df, block), "probable_block", 0.85))


def consistency(df: DataFrame, case_id: str = "case_id") -> DataFrame:
    """AG28: broken date orders, sex against pregnancy, repeated ids: count, share and severity."""
    bad = {r: F.col(a) > F.col(b) for r, a, b in DATE_RULES if a in df.columns and b in df.columns}
    if {"sex_raw", "pregnant_raw"} <= set(df.columns):
        bad["male_and_pregnant"] = (X.sex_std("sex_raw") == "Masculino") & (X.yesno("pregnant_raw") == 1)
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(c).alias(r) for r, c in bad.items()])
    dup = df.groupBy(case_id).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.coalesce(F.sum(F.when(F.col("_c") > 1, F.col("_c"))), F.lit(0)).alias("_d"))
    rows = [F.struct(F.lit(r).alias("rule"), F.col(r).alias("n_bad"),
                     F.lit("medium" if r == "male_and_pregnant" else "high").alias("severity")) for r in bad]
    rows.append(F.struct(F.lit("duplicate_id").alias("rule"), dup.scalar().alias("n_bad"), F.lit("high").alias("severity")))
    return one.select("_n", F.inline(F.array(*rows))).select("rule", "n_bad", N.pct("n_bad", "_n").alias("pct"), "severity")


def completeness_table(df: DataFrame, fields: Sequence[str] = CRITICAL_FIELDS) -> DataFrame:
    """AG32: per field the filled and the missing rows and the completeness, in one pass."""
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(X.is_filled(f)).alias(f"_f{i}") for i, f in enumerate(fields)])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"_f{i}").alias("filled")) for i, f in enumerate(fields)])
    return one.select("_n", F.inline(rows)).select("field", "filled", (F.col("_n") - F.col("filled")).alias("missing"), N.pct("filled", "_n").alias("pct_complete"))


def inconsistency_table(df: DataFrame) -> DataFrame:
    """AG32: notification or puncture before the symptoms, deaths without an end date, confirmed without a criterion."""
    bad = {
        "notification_before_onset": F.col("notified_date") < F.col("onset_date"),
        "lp_before_onset": F.col("lp_date") < F.col("onset_date"),
        "death_without_end_date": (F.col("death") == 1) & F.col("outcome_date").isNull() & F.col("closed_date").isNull(),
        "confirmed_without_criterion": (F.col("confirmed") == 1) & ~X.is_filled("criterion"),
    }
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(c).alias(r) for r, c in bad.items()])
    rows = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("n_bad")) for r in bad])
    return one.select("_n", F.inline(rows)).select("rule", "n_bad", N.pct("n_bad", "_n").alias("pct"))


def profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """AG27: rows, filled, missing share and exact distinct values of every column.

    Values are folded to (column, value) before the shuffle; the second step only counts rows.
    """
    cols = list(cols or df.columns)
    pairs = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast("string").alias("_v")) for c in cols])
    v = df.select(F.inline(pairs)).groupBy("variable", "_v").agg(F.count(F.lit(1)).alias("_n"))
    g = v.groupBy("variable").agg(
        F.sum("_n").alias("n"), F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_n"))), F.lit(0)).alias("filled"),
        F.count("_v").alias("distinct_values"))
    return g.select("variable", "n", "filled", (F.col("n") - F.col("filled")).alias("missing"),
                    F.round(N.pct(F.col("n") - F.col("filled"), "n"), 2).alias("pct_missing"), "distinct_values")


def ppv(df: DataFrame, by: str | None = None) -> DataFrame:
    """AG29: confirmed cases with laboratory evidence."""
    lab = X.lab_confirmed("criterion", ["lab_pcr", "lab_culture", "lab_latex"]) == 1
    conf = F.col("confirmed") == 1
    g = df.groupBy(*([by] if by else [])).agg(F.count_if(conf).alias("confirmed_n"), F.count_if(conf & lab).alias("with_lab"))
    return g.withColumn("ppv", N.ratio("with_lab", "confirmed_n"))


def confusion(df: DataFrame, truth: str | Column, test: str | Column) -> DataFrame:
    """AG30: confusion matrix with sensitivity, specificity, PPV and NPV."""
    t = (F.col(truth) if isinstance(truth, str) else truth) == 1
    x = (F.col(test) if isinstance(test, str) else test) == 1
    g = df.agg(F.count_if(t & x).alias("tp"), F.count_if(~t & x).alias("fp"), F.count_if(t & ~x).alias("fn"), F.count_if(~t & ~x).alias("tn"))
    tot = lambda a, b: F.col(a) + F.col(b)
    return g.withColumns({"sensitivity": N.ratio("tp", tot("tp", "fn")), "specificity": N.ratio("tn", tot("tn", "fp")),
                          "ppv": N.ratio("tp", tot("tp", "fp")), "npv": N.ratio("tn", tot("tn", "fn"))})


def leadtime_stats(df: DataFrame, lags: Mapping[str, int]) -> DataFrame:
    """AG31: n, mean, P50, P75, P90 per lead time. Days are folded to a histogram before the shuffle."""
    rows = F.array(*[F.struct(F.lit(c).alias("lead_time"), F.when(D.valid_lag(c, b), F.col(c)).alias("_v")) for c, b in lags.items()])
    h = df.select(F.inline(rows)).filter(F.col("_v").isNotNull()).groupBy("lead_time", "_v").agg(F.count(F.lit(1)).alias("_n"))
    q = lambda p, n: F.percentile("_v", F.lit(p), F.col("_n")).alias(n)
    return h.groupBy("lead_time").agg(F.sum("_n").alias("n"), (F.sum(F.col("_v") * F.col("_n")) / F.sum("_n")).alias("mean_days"),
                                      q(0.5, "p50"), q(0.75, "p75"), q(0.9, "p90"))


def _points(v: Column, good: float, fair: float, higher: bool = True) -> Column:
    a, b = (v >= good, v >= fair) if higher else (v <= good, v <= fair)
    return F.when(v.isNull(), 0).when(a, 2).when(b, 1).otherwise(0)


def quality_score(df: DataFrame, n_territories: int | Column, fields: Sequence[str] = CRITICAL_FIELDS, case_id: str = "case_id",
                  traceability: float = 100.0) -> DataFrame:
    """AG26: ten criteria of 0-2 points out of one pass plus two small id counts."""
    fields = [c for c in fields if c in df.columns]
    age = X.age_years("age_raw")
    bad = F.coalesce((F.col("notified_date") < F.col("onset_date")), F.lit(False)) | F.coalesce(
        F.col("closed_date") < F.col("notified_date"), F.lit(False)) | F.coalesce(
        (X.sex_std("sex_raw") == "Masculino") & (X.yesno("pregnant_raw") == 1), F.lit(False))
    implausible = bad | F.coalesce(~age.between(0, 120), F.lit(False))
    share = lambda c: F.avg(F.when(c, 100.0).otherwise(0.0))
    timely = lambda c, lim, bound: F.avg(F.when(D.valid_lag(c, bound), F.when(F.col(c) <= lim, 100.0).otherwise(0.0)))
    total = F.lit(0.0)
    for c in fields:
        total = total + share(X.is_filled(c))
    valid = (share(age.between(0, 120)) + share(X.text_key("sex_raw").isin("M", "F", "MASCULINO", "FEMININO", "IGNORADO", "I", "9", "1", "2"))
             + share(F.col("event_date").isNotNull()) + share(F.col("notified_date").isNotNull()) + share(F.col("closed_date").isNotNull())) / 5
    lag = [timely("lag_notif_invest", 2, 365), timely("lag_notif_close", 60, 800), timely("lag_onset_notif", 1, 365)]
    n_lag = sum((F.when(x.isNotNull(), 1).otherwise(0) for x in lag), F.lit(0))
    timeliness = sum((F.coalesce(x, F.lit(0.0)) for x in lag), F.lit(0.0)) / F.nullif(n_lag, F.lit(0))
    pad = (F.when(share(F.col("code6").isNotNull()) >= 90, 1).otherwise(0) + F.when(share(F.col("event_date").isNotNull()) >= 90, 1).otherwise(0) + 1) * (100.0 / 3)
    one = df.agg(
        (total / len(fields)).alias("completeness"), valid.alias("validity"), share(bad).alias("_inc"), timeliness.alias("timeliness"),
        share(X.is_filled("criterion")).alias("accuracy"), (100.0 - share(implausible)).alias("plausibility"), pad.alias("standardisation"))
    dup = df.groupBy(case_id).agg(F.count(F.lit(1)).alias("_c")).agg(
        100.0 * F.sum(F.when(F.col("_c") > 1, F.col("_c")).otherwise(0)) / F.sum("_c")).scalar()
    seen = df.filter(F.col("code6").isNotNull()).select("code6").distinct().agg(F.count(F.lit(1))).scalar()
    units = n_territories if isinstance(n_territories, Column) else F.lit(n_territories)
    one = one.withColumns({"_dup": dup, "_rep": 100.0 * seen / units})
    c = F.col
    row = lambda n, v, p: F.struct(F.lit(n).alias("criterion"), v.cast("double").alias("indicator"), p.cast("int").alias("points"))
    rows = F.array(
        row("completeness", c("completeness"), _points(c("completeness"), 95, 70)),
        row("validity", c("validity"), _points(c("validity"), 98, 95)),
        row("consistency", 100 - c("_inc"), _points(c("_inc"), 1, 5, False)),
        row("timeliness", c("timeliness"), _points(c("timeliness"), 90, 70)),
        row("uniqueness", 100 - c("_dup"), _points(c("_dup"), 1, 3, False)),
        row("accuracy", c("accuracy"), F.when(c("accuracy") >= 50, 1).otherwise(0)),
        row("plausibility", c("plausibility"), _points(c("plausibility"), 98, 95)),
        row("representativeness", c("_rep"), _points(c("_rep"), 90, 50)),
        row("standardisation", c("standardisation"), _points(c("standardisation"), 95, 70)),
        row("traceability", F.lit(traceability), _points(F.lit(traceability), 95, 50)))
    return one.select(F.inline(rows))


def quality_total(score: DataFrame) -> DataFrame:
    """AG26: total of the ten criteria with its class."""
    t = F.col("total")
    label = F.when(t >= 18, "Excelente").when(t >= 14, "Boa").when(t >= 10, "Regular").when(t >= 6, "Ruim").otherwise("Crítica")
    return score.agg(F.sum("points").alias("total")).withColumn("quality_class", label)


def audit_table(df: DataFrame, cols: Sequence[str], total: Sequence[str] = (), p_value: str | None = None, alpha: float = 0.05) -> DataFrame:
    """AG57: rows, filled and missing per column, totals and significant findings of a result table."""
    aggs = [F.count(F.lit(1)).alias("_rows")] + [F.count(F.when(X.is_filled(c), 1)).alias(f"_f{i}") for i, c in enumerate(cols)]
    aggs += [F.sum(F.col(c).cast("double")).alias(f"_t{i}") for i, c in enumerate(total)]
    if p_value:
        aggs.append(F.count_if(F.col(p_value) < alpha).alias("_sig"))
    one = df.agg(*aggs)
    item = lambda k, c, v: F.struct(F.lit(k).alias("check"), F.lit(c).alias("column"), v.cast("double").alias("value"))
    rows = [item("rows", "*", F.col("_rows"))]
    for i, c in enumerate(cols):
        rows += [item("filled", c, F.col(f"_f{i}")), item("missing", c, F.col("_rows") - F.col(f"_f{i}"))]
    rows += [item("total", c, F.col(f"_t{i}")) for i, c in enumerate(total)]
    if p_value:
        rows.append(item("significant", p_value, F.col("_sig")))
    return one.select(F.inline(F.array(*rows)))
