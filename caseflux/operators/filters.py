"""Filters, column plumbing and annotations (SC3-SC5, SC13, SC43, FL1-FL8)."""
from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions import fixed as K
from ..functions import text as X


def normalize_strings(df: DataFrame) -> DataFrame:
    """SC3: trim and collapse white space in every string column."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: X.squeeze(c) for c in strings})


def clean_names(df: DataFrame) -> DataFrame:
    """SC4: lower-case names without byte-order mark, dots and spaces."""
    plain = lambda c: re.sub(r"[^0-9a-z]+", "_", c.replace("﻿", "").strip().lower()).strip("_")
    return df.toDF(*[plain(c) for c in df.columns])


def _name_key(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", "", name.lower())


def map_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]] = K.LINK_ALIASES) -> DataFrame:
    """SC5: add canonical columns for the first alias the table carries."""
    have = {_name_key(c): c for c in df.columns}
    found = {}
    for canon, names in aliases.items():
        hit = next((have[_name_key(n)] for n in names if _name_key(n) in have), None)
        if hit is not None:
            found[canon] = F.col(f"`{hit}`")
    return df.withColumns(found)


def latest(df: DataFrame, date: str = "event_date") -> Column:
    """Newest date of a table as a scalar subquery: computed by Spark inside the same job."""
    return df.agg(F.max(date)).scalar()


def as_of_date(df: DataFrame, as_of: Column | str | None, date: str = "event_date") -> Column:
    """S9: an explicit reference day, else the newest date of the table; never the wall clock."""
    if as_of is None:
        return latest(df, date)
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def closed_week(df: DataFrame, date: str = "event_date") -> DataFrame:
    """SC13: last closed ISO week (newest date minus 7 days) and the week before it."""
    m = df.agg(F.max(date).alias("_m")).select(
        F.date_sub("_m", 7).alias("_c"), F.date_sub("_m", 14).alias("_p"))
    return m.select(
        D.iso_year("_c").alias("closed_year"), D.iso_week("_c").alias("closed_week"),
        D.iso_year("_p").alias("previous_year"), D.iso_week("_p").alias("previous_week"))


def closed_parts(df: DataFrame, date: str = "event_date") -> dict[str, Column]:
    """SC13 as columns: all four numbers come out of one scalar subquery, which Spark runs once."""
    m = latest(df, date)
    closed, before = F.date_sub(m, 7), F.date_sub(m, 14)
    return {"closed_year": D.iso_year(closed), "closed_week": D.iso_week(closed),
            "previous_year": D.iso_year(before), "previous_week": D.iso_week(before)}


def local_folder(sc) -> str:
    """A folder of this machine, for local masters only: on a cluster the other machines could not see it."""
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("name a shared folder in spark.checkpoint.dir")
    return tempfile.mkdtemp(prefix="caseflux-")


def fold(df: DataFrame) -> DataFrame:
    """Write a folded table (territory x calendar, not cases) once for the several steps that read it.

    A checkpoint in the shared folder the session names: it survives lost executors, and the plans
    built on it stay short. Where the session names none, only a local master may use a folder of its own.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint()


def shared_folder(spark) -> str:
    """The folder that all machines see: the one the session names, else one of a local master's own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or local_folder(sc))
    return sc.getCheckpointDir()


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame) -> DataFrame:
    """Write a table of many rows once for the several steps that read it: as columns, which take less disk than the
    rows of `fold` and are read one by one. The shuffle files that made it go as soon as it is written."""
    spark = df.sparkSession
    path, before = f"{shared_folder(spark)}/{uuid.uuid4().hex}", spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    kept = spark.read.schema(df.schema).parquet(path)
    kept._stored = True
    return kept


def is_stored(df: DataFrame) -> bool:
    """The table is one that `store` gave back: reading it again derives nothing anew."""
    return getattr(df, "_stored", False) is True


def discard(df: DataFrame) -> None:
    """Delete a stored table that no later step reads, and let the driver collect what the steps before left on its heap:
    plans, tables sent to every task and their copies stay there until it does, and a long chain of jobs adds them up."""
    sc = df.sparkSession.sparkContext
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    sc._jvm.System.gc()


def resident(df: DataFrame, state: str, column: str = "residence_state") -> DataFrame:
    """FL1: residents of one state."""
    return df.filter(F.upper(F.trim(column)) == state.upper())


def filter_dims(df: DataFrame, **selections: Sequence) -> DataFrame:
    """FL2: keep the selected values of every dimension; an empty selection keeps all."""
    for col, values in selections.items():
        if values:
            df = df.filter(F.col(col).isin(*values))
    return df


def significant(tables: Mapping[str, DataFrame], p: float = 0.005, n: int | None = None) -> DataFrame:
    """FL4: per result table the findings below p (the n most significant ones, where n is given), with a readable label."""
    from .ordering import union_all

    parts = []
    for name, t in tables.items():
        label = [c for c in ("variable", "exposure", "class_group", "outcome", "category") if c in t.columns]
        parts.append(t.filter(F.col("p_value") < p).select(
            F.lit(name).alias("source"), F.concat_ws(" | ", *label).alias("finding"), "p_value",
            *[c for c in ("odds_ratio", "ci_low", "ci_high") if c in t.columns]))
    u = union_all(*parts)
    if n is None:
        return u
    w = W.partitionBy("source").orderBy("p_value", "finding")
    return u.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def search_case(df: DataFrame, text: str, case_id: str = "case_id", n: int | None = None) -> DataFrame:
    """FL5: cases whose id contains the text, the first n of them where n is given."""
    hits = df.filter(F.col(case_id).cast("string").contains(text)) if text else df
    return hits if n is None else hits.orderBy(case_id).limit(n)


def since_year(df: DataFrame, year: int = 2007, column: str = "event_year") -> DataFrame:
    """FL6: rows of the usable history."""
    return df.filter(F.col(column) >= year)


def suspicious_year(column: str = "event_year", year: int = 2007) -> Column:
    return F.col(column).isNotNull() & (F.col(column) < year)


def in_last_days(as_of: Column, days: int, date: str = "event_date") -> Column:
    """The `days` days that end with as_of."""
    return (F.col(date) > F.date_sub(as_of, days)) & (F.col(date) <= as_of)


def recent(df: DataFrame, days: int, as_of: Column | str | None = None, date: str = "event_date") -> DataFrame:
    """FL7: rows of the last days."""
    return df.filter(in_last_days(as_of_date(df, as_of, date), days, date))


def enough(df: DataFrame, keys: Sequence[str], level: str, n_min: int = 10, levels_min: int = 2) -> DataFrame:
    """FL8: groups with enough rows and at least two levels. Distinct levels come out of a
    pre-aggregated (group, level) table, so no group is collected."""
    pre = df.groupBy(*keys, level).agg(F.count(F.lit(1)).alias("_n"))
    return pre.groupBy(*keys).agg(F.sum("_n").alias("n"), F.count(level).alias("levels")).filter(
        (F.col("n") >= n_min) & (F.col("levels") >= levels_min))


def annotate_reference(df: DataFrame) -> DataFrame:
    """SC43: year and period of the national reference beside every light."""
    return df.withColumns({"reference_year": F.lit(K.REFERENCE_YEAR), "reference_period": F.lit(K.REFERENCE_PERIOD)})


def annotate_provenance(df: DataFrame, module: str, generated_at: str | None = None) -> DataFrame:
    out = df.withColumn("module", F.lit(module))
    return out if generated_at is None else out.withColumn("generated_at", F.lit(generated_at).cast("timestamp"))
