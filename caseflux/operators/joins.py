"""Joins (JN1-JN7, JN13, JN14, JN16-JN22) and id sets (ST3).

No broadcast hints: the reference tables usually are small, and then Spark's own size threshold
and AQE broadcast them; where one is not, the same plan shuffles instead.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .ordering import first_per_key


def null_safe(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & a[k].eqNullSafe(b[k])
    return cond


def null_safe_left(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join whose NULL keys match each other."""
    right = b.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return a.join(right, cond, "left").drop(*[f"_r_{k}" for k in keys])


def with_population(df: DataFrame, pop: DataFrame, code: str = "code6", year: str = "event_year") -> DataFrame:
    """JN1: exact (territory, year) denominator, never carried forward."""
    p = pop.groupBy(F.col("code6").alias("_pc"), F.col("year").alias("_py")).agg(
        F.max("population").alias("population")
    )
    out = df.drop("population", "has_denominator").join(
        p, (F.col(code) == F.col("_pc")) & (F.col(year) == F.col("_py")), "left"
    )
    return out.drop("_pc", "_py").withColumn("has_denominator", F.col("population").isNotNull())


def attach_outcomes(cases: DataFrame, outcomes: DataFrame | None, key: str = "case_id") -> DataFrame:
    """JN2: mortality flags of a second registry by case id (first row per id), unions recomputed."""
    own = F.coalesce(F.col("death"), F.lit(0))
    if outcomes is None:
        return cases.withColumns({"death_linked": F.lit(0), "death_union": own, "death_only_linked": F.lit(0)})
    o = outcomes.groupBy(F.trim(F.col(key).cast("string")).alias("_k")).agg(
        F.max(F.coalesce(F.col("death_linked").cast("int"), F.lit(0))).alias("death_linked")
    )
    j = cases.drop("death_linked").join(o, F.trim(F.col(key).cast("string")) == F.col("_k"), "left").drop("_k")
    linked = F.coalesce(F.col("death_linked"), F.lit(0))
    return j.withColumns(
        {
            "death_linked": linked,
            "death_union": ((own == 1) | (linked == 1)).cast("int"),
            "death_only_linked": ((linked == 1) & (own == 0)).cast("int"),
        }
    )


def left_fill(left: DataFrame, right: DataFrame, keys: Sequence[str], fills: Mapping[str, object]) -> DataFrame:
    """JN4/JN5: left join with missing measures filled."""
    j = left.join(right, list(keys), "left")
    return j.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items()})


def with_environment(df: DataFrame, env: DataFrame, date: str = "event_date", code: str = "code6",
                     env_date: str = "date", env_code: str = "code") -> DataFrame:
    """JN6: environment of the case's day and place."""
    e = env.withColumnsRenamed({env_date: "_ed", env_code: "_ec"})
    return df.join(e, (F.col(date) == F.col("_ed")) & (F.col(code) == F.col("_ec")), "left").drop("_ed", "_ec")


def audit_sources(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """JN7: rows, distinct ids, overlap and gain of two sources, one shuffle of the ids."""
    def ids(df: DataFrame, side: str) -> DataFrame:
        k = F.trim(F.col(key).cast("string"))
        return df.select(k.alias("_id"), F.lit(side).alias("_side")).groupBy("_id").pivot("_side", [side]).count()

    both = ids(a, "left").join(ids(b, "right"), "_id", "full")
    known = F.col("_id").isNotNull()
    in_a, in_b = known & F.col("left").isNotNull(), known & F.col("right").isNotNull()
    return both.agg(
        F.coalesce(F.sum("left"), F.lit(0)).alias("left_rows"), F.count_if(in_a).alias("left_ids"),
        F.coalesce(F.sum("right"), F.lit(0)).alias("right_rows"), F.count_if(in_b).alias("right_ids"),
        F.count_if(in_a & in_b).alias("overlap"),
        F.count_if(in_a & ~in_b).alias("only_left"),
        F.count_if(in_b & ~in_a).alias("only_right"),
        (F.count_if(in_b & ~in_a) - F.count_if(in_a & ~in_b)).alias("gain_right"),
    )


def id_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """ST3: ids of one side only, labelled; anti joins instead of collected sets."""
    da = a.select(key).filter(F.col(key).isNotNull()).distinct()
    db = b.select(key).filter(F.col(key).isNotNull()).distinct()
    return (
        da.join(db, key, "left_anti").withColumn("side", F.lit("left"))
        .unionByName(db.join(da, key, "left_anti").withColumn("side", F.lit("right")))
    )


def with_facility(df: DataFrame, registry: DataFrame, code: str = "facility_raw") -> DataFrame:
    """JN13: facility registry by normalised key; level of care and match flag."""
    reg = registry.select(
        X.facility_key("registry_code").alias("_fk"), "facility_name", "facility_type"
    ).filter(F.col("_fk").isNotNull())
    reg = first_per_key(reg, ["_fk"], [F.col("facility_name")])
    j = df.withColumn("facility_key", X.facility_key(code)).join(reg, F.col("facility_key") == F.col("_fk"), "left")
    hit = F.col("_fk").isNotNull()
    return j.withColumns(
        {
            "facility_match": hit.cast("int"),
            "facility_level": F.when(hit, X.facility_level("facility_type")).otherwise("Sem match"),
        }
    ).drop("_fk")


def with_births(df: DataFrame, births: DataFrame, code: str = "code6", year: str = "event_year") -> DataFrame:
    """JN14: live births of the place and year."""
    b = births.select(F.col("code6").alias("_bc"), F.col("year").alias("_by"), "live_births")
    return df.join(b, (F.col(code) == F.col("_bc")) & (F.col(year) == F.col("_by")), "left").drop("_bc", "_by")


def territory_layer(units: DataFrame, indicators: DataFrame, key: str, counts: Sequence[str]) -> DataFrame:
    """JN16: every unit, counts 0 where nothing was reported, flag for silent units; rates stay NULL."""
    j = units.join(indicators, key, "left")
    j = j.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})
    return j.withColumn("silent", F.col(counts[0]) == 0)


def silent_units(units: DataFrame, cases: DataFrame, key: str) -> DataFrame:
    return units.join(cases.select(key), key, "left_anti")


def with_coordinates(df: DataFrame, coords: DataFrame, code: str = "code6", name: str = "municipality") -> DataFrame:
    """JN17: coordinates by code, else by accent-free name; one row per key."""
    by_code = coords.filter(F.col("code").isNotNull()).groupBy(F.col("code").alias("_cc")).agg(
        F.min(F.struct("lat", "lon")).alias("_c1"))
    by_name = coords.groupBy(X.text_key("name").alias("_cn")).agg(F.min(F.struct("lat", "lon")).alias("_c2"))
    j = df.join(by_code, F.col(code) == F.col("_cc"), "left").join(by_name, X.text_key(name) == F.col("_cn"), "left")
    best = F.coalesce("_c1", "_c2")
    return j.withColumns({"lat": best["lat"], "lon": best["lon"]}).drop("_cc", "_cn", "_c1", "_c2")


def region_from_text(df: DataFrame, places: DataFrame, text: str, key: str, gram: int = 4, salts: int = 8) -> DataFrame:
    """JN18: region of the longest place name that occurs in a text, inside words too.

    Texts give one row per word with the words that follow it, as many as the longest name has. First words of names are
    looked for once in every distinct word, letter by letter, not in every text. A word that holds one is then looked up
    as a trie level: all words of a name but the last are a key, with the first letters of the last one, so names with
    a common beginning are not compared one by one. Common words are salted. Of equally long names the last in order wins.
    """
    p = places.select(F.upper(F.trim("place")).alias("_p"), F.col("region").alias("_reg")).filter(F.length("_p") > 0)
    p = p.groupBy("_p").agg(F.min("_reg").alias("_reg"))
    words = F.split("_p", " ", -1)
    n = F.size(words)
    end = F.when(n > 1, F.element_at(words, -1)).otherwise("")
    names = p.select("_p", "_reg", words[0].alias("_f"), n.alias("_n"), F.array_join(F.slice(words, F.lit(2), F.greatest(n - 2, F.lit(0))), " ").alias("_mid"),
                     end.alias("_end"), F.substring(end, 1, gram).alias("_g"))
    span = names.agg(F.max("_n")).scalar()

    # rows carry neither the whole text nor, at every letter, the whole word: both may be very long. Words go by their 64-bit hash
    t = df.select(F.col(key).alias("_k"), F.split(F.upper(F.col(text)), " ", -1).alias("_ws"), (F.coalesce(span, F.lit(1)) - 1).alias("_m")).filter(F.col("_ws").isNotNull())
    rows = t.select("_k", F.inline(F.transform("_ws", lambda w, i: F.struct(w.alias("_w"), F.slice("_ws", i + 2, F.col("_m")).alias("_next"))))).filter(F.col("_w") != "")
    rows = rows.withColumn("_id", F.xxhash64("_w"))

    first = names.select("_f", F.substring("_f", 1, gram).alias("_s")).distinct()
    longest = F.coalesce(first.agg(F.max(F.length("_f"))).scalar(), F.lit(1))
    # what stands at every letter of a word, in one pass over the word
    at = F.regexp_extract_all("_w", F.concat(F.lit("(?s)(?=(.{1,"), longest.cast("string"), F.lit("}))")), F.lit(1))
    at = rows.groupBy("_id").agg(F.min("_w").alias("_w")).select("_id", F.explode(at).alias("_at"))
    begin = lambda c: F.array_distinct(F.array(*[F.substring(c, 1, i) for i in range(1, gram + 1)]))
    holds = at.select("_id", "_at", F.explode(begin("_at")).alias("_s")).join(first, "_s").filter(F.col("_at").startswith(F.col("_f"))).select("_id", "_f").distinct()

    salted = holds.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = rows.withColumn("_salt", F.pmod(F.xxhash64("_k"), F.lit(salts)).cast("int")).join(salted, ["_id", "_salt"]).filter(F.col("_w").contains(F.col("_f")))
    level = lambda n, mid, end: F.struct(F.lit(n).alias("_n") if isinstance(n, int) else n.alias("_n"), mid.alias("_mid"), end.alias("_last"))
    one = F.array(level(1, F.lit(""), F.lit("")))
    more = F.transform(F.sequence(F.lit(1), F.size("_next")), lambda i: level(i + 1, F.array_join(F.slice("_next", F.lit(1), i - 1), " "), F.element_at("_next", i)))
    levels = F.when(F.col("_w").endswith(F.col("_f")) & (F.size("_next") > 0), F.concat(one, more)).otherwise(one)
    asked = met.select("_k", "_f", F.inline(levels)).select("*", F.explode(begin("_last")).alias("_g"))
    hits = (
        asked.join(names, ["_f", "_n", "_mid", "_g"]).filter(F.col("_last").startswith(F.col("_end")))
        .groupBy("_k").agg(F.max(F.struct(F.length("_p").alias("n"), "_p", "_reg")).alias("_b"))
        .select("_k", F.col("_b._p").alias("place"), F.col("_b._reg").alias("region_found"))
    )
    return df.join(hits, F.col(key) == F.col("_k"), "left").drop("_k")


def scorecard(base: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """JN20: one row per unit out of several one-row-per-unit tables."""
    out = base
    for t in tables:
        out = out.join(t, key, "left")
    return out


def refresh_flags(df: DataFrame, enriched: DataFrame, key: str, flags: Sequence[str]) -> DataFrame:
    """JN21: replace flag columns by those of an enrichment table (one row per id)."""
    e = enriched.groupBy(F.col(key).alias("_k")).agg(*[F.max(c).alias(c) for c in flags])
    return df.drop(*flags).join(e, F.col(key) == F.col("_k"), "left").drop("_k")


def latest_population(pop: DataFrame) -> DataFrame:
    """JN22: population of the newest year per territory."""
    return pop.groupBy("code6").agg(F.max("year").alias("year"), F.max_by("population", "year").alias("population"))
