"""Operational indicators (AG7-AG9, AG16-AG24, AG41-AG44, AG53, AG56, SC25).

Every indicator is a conditional count over the case rows, so any grouping needs one pass with
map-side partial aggregation.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import fixed as K
from ..functions import numbers as N
from ..functions import text as X
from . import scope as S
from .filters import as_of_date, in_last_days


def prophylaxis_done(df: DataFrame) -> Column:
    """SC25: a date, a lead time or a yes in the field."""
    out = F.lit(False)
    for c in ("prophylaxis_date", "lag_notif_proph"):
        if c in df.columns:
            out = out | F.col(c).isNotNull()
    if "prophylaxis_yes" in df.columns:
        out = out | F.col("prophylaxis_yes")
    elif "prophylaxis_raw" in df.columns:
        out = out | F.coalesce(X.yesno("prophylaxis_raw") == 1, F.lit(False))
    return out


def flag(df: DataFrame, name: str, expr: Column) -> Column:
    """The flag of the base table where it has one, else the expression."""
    return F.col(name) if name in df.columns else expr


def kpi_counts(df: DataFrame) -> dict[str, Column]:
    """Numerators and denominators of the operational block."""
    conf = F.col("confirmed") == 1
    cls = F.col("class_group")
    bact = conf & cls.isin(*K.BACTERIAL)
    dm, hib = cls == K.MENINGOCOCCAL, cls == K.HIB
    inv, clo, ntf = F.col("lag_notif_invest"), F.col("lag_notif_close"), F.col("lag_onset_notif")
    pro = F.col("lag_notif_proph")
    done, quick = prophylaxis_done(df), pro.between(0, 2)
    return {
        "notified": F.lit(1),
        "confirmed_n": conf,
        "bact_confirmed": bact,
        "bact_lab_broad": bact & flag(df, "criterion_broad", X.criterion_broad("criterion")),
        "bact_lab_strict": bact & flag(df, "criterion_strict", X.criterion_strict("criterion")),
        "investigated_dated": D.valid_lag(inv),
        "investigated_48h": D.valid_lag(inv) & (inv <= 2),
        "closed_dated": D.valid_lag(clo, 800),
        "closed_60d": D.valid_lag(clo, 800) & (clo <= 60),
        "dm_cases": dm,
        "dm_prophylaxis_any": dm & done,
        "dm_prophylaxis_48h": dm & quick,
        "hib_cases": hib,
        "hib_prophylaxis_any": hib & done,
        "hib_prophylaxis_48h": hib & quick,
        "notified_dated": D.valid_lag(ntf),
        "notified_24h": D.valid_lag(ntf) & (ntf <= 1),
        "dm_serogroup": dm & flag(df, "serogroup_known", X.serogroup_informed("serogroup_raw")),
        "undue_prophylaxis": done & ~cls.isin(*K.PROPHYLAXIS_CLASSES),
    }


KPI_RATIOS = {
    "pct_lab_broad": ("bact_lab_broad", "bact_confirmed"),
    "pct_lab_strict": ("bact_lab_strict", "bact_confirmed"),
    "pct_investigated_48h_dated": ("investigated_48h", "investigated_dated"),
    "pct_investigated_48h": ("investigated_48h", "notified"),
    "pct_closed_60d_dated": ("closed_60d", "closed_dated"),
    "pct_closed_60d": ("closed_60d", "notified"),
    "pct_prophylaxis_dm_48h": ("dm_prophylaxis_48h", "dm_cases"),
    "pct_prophylaxis_dm_any": ("dm_prophylaxis_any", "dm_cases"),
    "pct_prophylaxis_hib_48h": ("hib_prophylaxis_48h", "hib_cases"),
    "pct_serogroup_dm": ("dm_serogroup", "dm_cases"),
}


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({n: N.pct(a, b) for n, (a, b) in ratios.items()})


def ops_kpis(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """AG7/AG9: the operational block for any grouping."""
    counts = kpi_counts(df)
    g = df.groupBy(*keys).agg(
        *[F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(n) for n, c in counts.items()])
    out = add_ratios(g, KPI_RATIOS)
    den = F.when(F.col("notified_dated") > 0, F.col("notified_dated")).otherwise(F.col("notified"))
    return out.withColumn("pct_notified_24h", N.pct("notified_24h", den))


# indicator: (reference or NULL, value the light is compared with, tolerance)
KPI_TARGETS = {
    "pct_lab_strict": (K.NATIONAL_REFERENCE["pct_lab_strict"], 36.1, 5.0),
    "pct_lab_broad": (None, 70.0, 5.0),
    "pct_investigated_48h": (K.NATIONAL_REFERENCE["pct_investigated_48h"], 97.8, 3.0),
    "pct_closed_60d": (K.NATIONAL_REFERENCE["pct_closed_60d"], 94.4, 3.0),
    "pct_prophylaxis_dm_48h": (K.NATIONAL_REFERENCE["pct_prophylaxis_dm_48h"], 45.5, 5.0),
    "pct_prophylaxis_hib_48h": (None, 45.5, 5.0),
    "pct_serogroup_dm": (None, 70.0, 5.0),
}


def kpi_long(kpis: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """AG8: one row per indicator with numerator, denominator, reference and light."""
    rows = []
    for name, (ref, target, tol) in KPI_TARGETS.items():
        num, den = KPI_RATIOS[name]
        rows.append(F.struct(
            F.lit(name).alias("indicator"), F.col(num).alias("numerator"), F.col(den).alias("denominator"),
            F.col(name).alias("value"), F.lit(ref).cast("double").alias("reference"),
            N.light_ref(F.col(name), target, True, tol).alias("light")))
    rows.append(F.struct(
        F.lit("pct_notified_24h").alias("indicator"), F.col("notified_24h").alias("numerator"),
        F.col("notified_dated").alias("denominator"), F.col("pct_notified_24h").alias("value"),
        F.lit(None).cast("double").alias("reference"),
        N.light_ref(F.col("pct_notified_24h"), 80.0).alias("light")))
    return kpis.select(*keys, F.inline(F.array(*rows)))


# ---- indicator families by scope -------------------------------------------------------------

def csf_timeliness(df: DataFrame, scopes=S.SCOPES) -> DataFrame:
    """AG16: spinal-fluid collection after onset."""
    lag = F.col("lag_onset_lp")
    tap = F.col("lp_date").isNotNull()
    ok = tap & D.valid_lag(lag)
    out = S.by_scope(df, {"cases_total": F.lit(1), "with_tap": tap, "with_lag": ok, "le_1d": ok & (lag <= 1),
                          "le_2d": ok & (lag <= 2)}, F.when(ok, lag), {"p50_days": 0.5, "p90_days": 0.9}, scopes)
    return add_ratios(out, {"pct_le_1d": ("le_1d", "with_lag"), "pct_le_2d": ("le_2d", "with_lag")})


def prophylaxis_time(df: DataFrame, scopes=S.SCOPES) -> DataFrame:
    """AG17: notification to contact prophylaxis among eligible classes."""
    lag = F.col("lag_notif_proph")
    eligible = F.col("class_group").isin(*K.PROPHYLAXIS_CLASSES)
    ok = eligible & D.valid_lag(lag)
    out = S.by_scope(df, {"eligible": eligible, "done": eligible & prophylaxis_done(df), "with_lag": ok,
                          "le_2d": ok & (lag <= 2)}, F.when(ok, lag), {"p50_days": 0.5, "p90_days": 0.9}, scopes)
    return add_ratios(out, {"pct_le_2d_eligible": ("le_2d", "eligible"), "pct_le_2d_dated": ("le_2d", "with_lag"),
                            "pct_done": ("done", "eligible")})


def serogroup_coverage(df: DataFrame, scopes=S.SCOPES) -> DataFrame:
    """AG18: confirmed meningococcal cases with a known serogroup."""
    dm = F.col("class_group") == K.MENINGOCOCCAL
    target = dm & (F.col("confirmed") == 1)
    out = S.by_scope(df, {"dm_confirmed": target, "serogroup_known": target & flag(df, "serogroup_known", X.serogroup_informed("serogroup_raw")),
                          "dm_total": dm}, scopes=scopes)
    return add_ratios(out, {"pct_serogroup": ("serogroup_known", "dm_confirmed")})


def contacts_per_case(df: DataFrame, scopes=S.SCOPES) -> DataFrame:
    """AG19: contacts per meningococcal case."""
    dm, n = F.col("class_group") == K.MENINGOCOCCAL, F.col("contacts")
    known = dm & n.isNotNull() & (n >= 0)
    out = S.by_scope(df, {"dm_cases": dm, "known": known, "unknown": dm & n.isNull(), "zero": known & (n == 0),
                          "zero_or_unknown": dm & (n.isNull() | (n == 0)), "contacts_total": F.when(known, n)},
                     F.when(known, n), {"p50_contacts": 0.5, "p90_contacts": 0.9}, scopes)
    return add_ratios(out, {"pct_zero_or_unknown": ("zero_or_unknown", "dm_cases")})


def underreported_deaths(df: DataFrame, scopes=S.SCOPES) -> DataFrame:
    """AG20: deaths that only the second registry knows."""
    is1 = lambda c: F.coalesce(F.col(c), F.lit(0)) == 1
    out = S.by_scope(df, {"cases_total": F.lit(1), "deaths_own": is1("death"), "deaths_linked": is1("death_linked"),
                          "deaths_union": is1("death_union"), "only_linked": is1("death_only_linked")}, scopes=scopes)
    return add_ratios(out, {"pct_of_linked": ("only_linked", "deaths_linked"),
                            "pct_of_union": ("only_linked", "deaths_union"), "pct_of_cases": ("only_linked", "cases_total")})


def detection_time(df: DataFrame, scopes=S.SCOPES_CLASS) -> DataFrame:
    """AG21/AG15: onset to notification, also by class and region x class."""
    lag = F.col("lag_onset_notif")
    ok = D.valid_lag(lag)
    out = S.by_scope(df, {"cases_total": F.lit(1), "with_lag": ok, "le_1d": ok & (lag <= 1)}, F.when(ok, lag),
                     {"p50_days": 0.5, "p90_days": 0.9}, scopes)
    return add_ratios(out, {"pct_le_1d": ("le_1d", "with_lag")})


def no_denominator(df: DataFrame, scopes=S.SCOPES) -> DataFrame:
    """AG22: cases without a reference population."""
    has = F.coalesce(F.col("has_denominator"), F.lit(False))
    out = S.by_scope(df, {"cases_total": F.lit(1), "with_denominator": has, "without_denominator": ~has}, scopes=scopes)
    return add_ratios(out, {"pct_without": ("without_denominator", "cases_total")})


def denominator_by_year(df: DataFrame) -> DataFrame:
    """AG22: status of the denominator per year."""
    has = F.coalesce(F.col("has_denominator"), F.lit(False))
    g = df.filter(F.col("event_year").isNotNull()).groupBy("event_year").agg(
        F.count(F.lit(1)).alias("cases_total"), F.count_if(has).alias("with_denominator"))
    out = g.withColumn("without_denominator", F.col("cases_total") - F.col("with_denominator"))
    status = F.when(F.col("without_denominator") == 0, "denominador_real_ibge").when(
        F.col("with_denominator") == 0, "sem_denominador").otherwise("parcial")
    return out.withColumns({"pct_without": N.pct("without_denominator", "cases_total"), "status": status})


def completeness(df: DataFrame, fields: Sequence[str], scopes=S.SCOPES_NO_YEAR) -> DataFrame:
    """AG23: filled share per field, mean over the fields and the worst field."""
    out = S.by_scope(df, {"cases_total": F.lit(1), **{f"comp_{c}": X.is_filled(c) for c in fields}}, scopes=scopes)
    out = out.withColumns({f"comp_{c}": N.pct(f"comp_{c}", "cases_total") for c in fields})
    worst = F.array_min(F.array(*[
        F.struct(F.col(f"comp_{c}").alias("v"), F.lit(i).alias("i"), F.lit(c).alias("f")) for i, c in enumerate(fields)]))
    total = F.lit(0.0)
    for c in fields:
        total = total + F.col(f"comp_{c}")
    return out.withColumns({"pct_mean": total / len(fields), "worst_field": worst["f"], "pct_worst": worst["v"]})


def standardized_fatality(df: DataFrame, stratum: str = "age_band", weights: DataFrame | None = None,
                          scopes: Mapping[str, Sequence[str]] | None = None, death: str = "death") -> DataFrame:
    """AG24: crude and directly standardised fatality; weights of strata without cases are left out
    and the covered weight is reported. A unit without confirmed cases falls back to all its cases."""
    scopes = scopes or {**S.SCOPES_NO_YEAR, "MUNICIPALITY": ("municipality",)}
    dims = S._dims(scopes)
    conf, dead = F.col("confirmed") == 1, F.coalesce(F.col(death), F.lit(0)) == 1
    pre = df.groupBy(*dims, F.col(stratum).alias("_s")).agg(
        F.count(F.lit(1)).alias("n_all"), F.count_if(conf).alias("n_conf"),
        F.count_if(dead).alias("d_all"), F.count_if(conf & dead).alias("d_conf"))
    if weights is None:
        w = pre.groupBy("_s").agg(F.sum("n_conf").alias("_c"), F.sum("n_all").alias("_a"))
        tot = w.agg(F.sum("_c").alias("_tc"), F.sum("_a").alias("_ta"))
        use_conf = tot.select(F.col("_tc") > 0).scalar()
        total = F.when(use_conf, tot.select("_tc").scalar()).otherwise(tot.select("_ta").scalar())
        weights = w.select("_s", (F.when(use_conf, F.col("_c")).otherwise(F.col("_a")) / total).alias("weight"))
    else:
        weights = weights.select(F.col(stratum).alias("_s"), "weight")
    sums = [F.sum(c).alias(c) for c in ("n_all", "n_conf", "d_all", "d_conf")]
    by_stratum = S.roll_up(pre, {k: (*v, "_s") for k, v in scopes.items()}, sums)
    by_stratum = by_stratum.withColumns({
        "_s": F.element_at(F.split("slice", " \\| "), -1),
        "slice": F.when(F.instr("slice", " | ") > 0, F.expr("substring_index(slice, ' | ', size(split(slice, ' \\\\| ')) - 1)"))
        .otherwise("ALL")})
    unit = by_stratum.groupBy("scope", "slice").agg(
        F.sum("n_all").alias("cases_n"), F.sum("n_conf").alias("_uc"))
    j = by_stratum.join(unit, ["scope", "slice"]).join(weights, "_s", "left")
    n = F.when(F.col("_uc") > 0, F.col("n_conf")).otherwise(F.col("n_all"))
    dd = F.when(F.col("_uc") > 0, F.col("d_conf")).otherwise(F.col("d_all"))
    used = (n > 0) & F.col("weight").isNotNull()
    wt = F.when(used, F.col("weight"))
    g = j.groupBy("scope", "slice").agg(
        F.max("cases_n").alias("cases_n"), F.sum(n).alias("denominator"), F.sum(dd).alias("deaths"),
        F.sum(F.when(used, wt * dd / n)).alias("_wr"), F.sum(wt).alias("_w"), F.count_if(used).alias("strata_with_cases"))
    return g.select(
        "scope", "slice", "cases_n", "denominator", "deaths", N.pct("deaths", "denominator").alias("pct_crude"),
        (100.0 * F.col("_wr") / F.nullif(F.col("_w"), F.lit(0.0))).alias("pct_standardized"),
        F.coalesce(100.0 * F.col("_w"), F.lit(0.0)).alias("pct_weight_covered"), "strata_with_cases")


# ---- backlog, severity, vaccination, risk ----------------------------------------------------

def backlog(df: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """AG43: open cases by delay, per region and in total."""
    today = as_of_date(df, as_of, "notified_date")
    age = F.datediff(today, F.col("notified_date"))
    is_open = F.col("closed_date").isNull()
    late_inv = F.col("lag_notif_invest").isNull() | (F.col("lag_notif_invest") > 2)
    pending = F.col("class_group").isin(*K.PROPHYLAXIS_CLASSES) & ~prophylaxis_done(df)
    counts = {
        "open_cases": is_open,
        "late_investigation": is_open & late_inv & (age >= 2),
        "closing_d45_d60": is_open & age.between(45, 60),
        "closing_gt60": is_open & (age > 60),
        "prophylaxis_pending": is_open & pending,
        "dm_without_prophylaxis": pending & (F.col("class_group") == K.MENINGOCOCCAL),
        "hib_without_prophylaxis": pending & (F.col("class_group") == K.HIB),
    }
    return S.by_scope(df, counts, scopes=S.SCOPES_NO_YEAR)


def linkage_kpis(df: DataFrame) -> DataFrame:
    """AG44: match rates and discordance by scope."""
    is1 = lambda c: F.coalesce(F.col(c), F.lit(0)) == 1
    bact = F.col("class_group").isin(*K.BACTERIAL) & is1("confirmed")
    out = S.by_scope(df, {"cases_total": F.lit(1), "lab_match_n": is1("lab_match"), "bact_n": bact,
                          "bact_lab_match": bact & is1("lab_match"), "deaths_linked": is1("death_linked"),
                          "deaths_union": is1("death_union"), "discordant": is1("death_linked") & ~is1("death")},
                     scopes=S.SCOPES_NO_YEAR)
    return add_ratios(out, {"pct_lab_match": ("lab_match_n", "cases_total"), "pct_bact_lab_match": ("bact_lab_match", "bact_n"),
                            "pct_linked_of_union": ("deaths_linked", "deaths_union"), "pct_discordant": ("discordant", "cases_total")})


def severity_week(df: DataFrame, as_of: Column | str | None = None, death: str = "death") -> DataFrame:
    """AG42: severity by class in the week of as_of, else in the last week with cases; TOTAL row."""
    weeks = df.select(D.iso_monday("event_date").alias("_m"))
    wanted = D.iso_monday(as_of_date(df, as_of))
    pick = weeks.agg(F.coalesce(F.max(F.when(F.col("_m") == wanted, F.col("_m"))), F.max("_m"))).scalar()
    dead, hosp = F.coalesce(F.col(death), F.lit(0)) == 1, F.col("hospitalised") == 1
    early = dead & (F.datediff("event_date", "onset_date") <= 7)
    cur = df.withColumn("_m", D.iso_monday("event_date")).filter(F.col("_m") == pick)
    counts = {"cases": F.lit(1), "confirmed_n": F.col("confirmed"), "deaths": dead, "hospitalised_n": hosp,
              "deaths_le_7d": early, "severe": dead | hosp}
    out = S.by_scope(cur, counts, scopes={"TOTAL": (), "CLASS": ("_m", "class_group")})
    base = F.when(F.col("confirmed_n") > 0, F.col("confirmed_n")).otherwise(F.col("cases"))
    cls = F.when(F.col("scope") == "TOTAL", "TOTAL").otherwise(F.regexp_replace("slice", "^[^|]* \\| ", ""))
    return out.select(
        F.extract(F.lit("YEAROFWEEK"), pick).alias("iso_year"), F.weekofyear(pick).alias("iso_week"),
        cls.alias("class_group"), "cases", "confirmed_n", "deaths", "hospitalised_n", "deaths_le_7d",
        N.pct("deaths", base).alias("pct_fatality"), N.pct("hospitalised_n", "cases").alias("pct_hospitalised"),
        N.pct("severe", "cases").alias("pct_severe"))


def lp_vaccine_kpis(df: DataFrame, lab_cols: Sequence[str] = ("lab_pcr", "lab_culture", "lab_latex")) -> DataFrame:
    """AG41: lumbar puncture, pending laboratory and vaccination among eligible cases."""
    cls, lag = F.col("class_group"), F.col("lag_onset_lp")
    target = cls.isin(*K.BACTERIAL)
    tap = target & X.lp_done("lp_date", "lp_raw")
    ok = D.valid_lag(lag)
    vac = lambda c, g: (cls == g) & (F.col(c) == 1)
    counts = {
        "target": target, "tap": tap, "pending": target & X.lab_pending(lab_cols), "with_lag": ok,
        "dm": cls == K.MENINGOCOCCAL, "dm_vac": vac("vaccine_menc_bin", K.MENINGOCOCCAL),
        "hib": cls == K.HIB, "hib_vac": vac("vaccine_hib_bin", K.HIB),
        "pneumo": cls == K.PNEUMOCOCCAL, "pneumo_vac": vac("vaccine_pneumo_bin", K.PNEUMOCOCCAL),
    }
    w = S.by_scope(df, counts, F.when(ok, lag), {"p50": 0.5, "p90": 0.9}, S.STATE)
    row = lambda name, num, den, v: F.struct(
        F.lit(name).alias("indicator"), F.col(num).alias("numerator"), F.col(den).alias("denominator"), v.alias("value"))
    return w.select(F.inline(F.array(
        row("pct_lp_done", "tap", "target", N.pct("tap", "target")),
        row("pct_lab_pending", "pending", "target", N.pct("pending", "target")),
        row("p50_onset_lp_days", "with_lag", "with_lag", F.col("p50")),
        row("p90_onset_lp_days", "with_lag", "with_lag", F.col("p90")),
        row("pct_menc_in_dm", "dm_vac", "dm", N.pct("dm_vac", "dm")),
        row("pct_hib_in_hib", "hib_vac", "hib", N.pct("hib_vac", "hib")),
        row("pct_pneumo_in_pneumo", "pneumo_vac", "pneumo", N.pct("pneumo_vac", "pneumo")))))


def risk_score(df: DataFrame, population: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """AG56: 0-100 score per municipality from the last 90 days."""
    from .joins import latest_population

    day = as_of_date(df, as_of)
    near = F.col("event_date") >= F.date_sub(day, 90)
    dm = (F.col("class_group") == K.MENINGOCOCCAL) & near
    keys = ["code6", "municipality", "region"]
    g = df.groupBy(*keys).agg(
        F.count_if(dm & (F.col("confirmed") == 1)).alias("dm_lab_90d"), F.count_if(dm).alias("dm_90d"),
        F.count_if(dm & flag(df, "serogroup_known", X.serogroup_informed("serogroup_raw"))).alias("_s"),
        F.count_if(dm & prophylaxis_done(df)).alias("_p"))
    pop = latest_population(population).select(F.col("code6").alias("_pc"), "population")
    g = g.join(pop, F.col("code6") == F.col("_pc"), "left").withColumns({
        "pct_serogroup_90d": N.pct("_s", "dm_90d"), "pct_prophylaxis_90d": N.pct("_p", "dm_90d"),
        "incidence_90d": N.ratio("dm_lab_90d", "population", 100000.0)})
    gap = lambda c, goal: F.coalesce(F.greatest(F.lit(0.0), (goal - F.col(c)) / goal * 20.0), F.lit(0.0))
    raw = (F.least(F.col("dm_lab_90d") * 15.0, F.lit(45.0)) + gap("pct_serogroup_90d", 70.0)
           + gap("pct_prophylaxis_90d", 80.0) + F.coalesce(F.least(F.col("incidence_90d") * 2.0, F.lit(15.0)), F.lit(0.0)))
    g = g.withColumn("_raw", raw)
    return g.select(
        *keys, "dm_lab_90d", "dm_90d", "pct_serogroup_90d", "pct_prophylaxis_90d", "incidence_90d",
        F.round(F.least("_raw", F.lit(100.0)), 1).alias("score"),
        F.when(F.col("_raw") >= 50, "Alta").when(F.col("_raw") >= 25, "Média").otherwise("Baixa").alias("priority"))


def serogroup_trend(df: DataFrame, keys: Sequence[str] = ("event_year", "iso_week")) -> DataFrame:
    """AG39: meningococcal cases by period and serogroup with the share inside the period."""
    from pyspark.sql import Window as W

    dm = df.filter(F.col("class_group") == K.MENINGOCOCCAL)
    g = dm.groupBy(*keys, X.serogroup("serogroup_raw").alias("serogroup")).agg(F.count(F.lit(1)).alias("cases"))
    return g.withColumn("pct", N.pct("cases", F.sum("cases").over(W.partitionBy(*keys))))


def share_shift(df: DataFrame, category: str, period: str, ignore: Sequence[str] = ("Não informado",),
                threshold_pp: float = 10.0) -> DataFrame:
    """AG40: categories whose share moved by the threshold between the last two periods."""
    pre = df.filter(F.col(period).isNotNull()).groupBy(F.col(period).alias("_p"), F.col(category).alias("category")).agg(
        F.count(F.lit(1)).alias("_n"))
    last = pre.agg(F.max("_p")).scalar()
    prev = pre.agg(F.max(F.when(F.col("_p") < last, F.col("_p")))).scalar()
    two = pre.groupBy("category").agg(
        F.sum(F.when(F.col("_p") == last, F.col("_n")).otherwise(0)).alias("_a"),
        F.sum(F.when(F.col("_p") == prev, F.col("_n")).otherwise(0)).alias("_b"))
    ta = pre.agg(F.sum(F.when(F.col("_p") == last, F.col("_n")))).scalar()
    tb = pre.agg(F.sum(F.when(F.col("_p") == prev, F.col("_n")))).scalar()
    out = two.select("category", last.alias("period_now"), prev.alias("period_before"),
                     N.pct("_a", ta).alias("pct_now"), N.pct("_b", tb).alias("pct_before"))
    out = out.withColumn("delta_pp", F.col("pct_now") - F.col("pct_before"))
    return out.filter(~F.col("category").isin(*ignore) & (F.abs("delta_pp") >= threshold_pp))
