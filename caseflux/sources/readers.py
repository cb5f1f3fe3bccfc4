"""Readers, catalog lookup, extracts and sinks (SRC1-SRC10, SRC16-SRC19)."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates as D
from ..functions import fixed as K
from ..functions import text as X

SEPARATORS = (",", ";", "\t", "|")


def scratch_dir(spark: SparkSession) -> str:
    """Folder all executors see, under the checkpoint folder the session names; only a local master may go without one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if base:
        import uuid

        return f"{base.rstrip('/')}/caseflux-{uuid.uuid4().hex}"
    from ..operators.filters import local_folder

    return local_folder(spark.sparkContext)


def read_delimited(spark: SparkSession, path: str, min_cols: int = 2) -> DataFrame:
    """SRC1: text table of unknown separator and encoding.

    One pass over every byte decides the encoding; the separator is the one the header line has most of.
    """
    raw = spark.read.text(path)  # bytes as they are: nothing is decoded here
    encoding = "UTF-8" if raw.agg(F.bool_and(F.is_valid_utf8("value"))).first()[0] in (True, None) else "ISO-8859-1"
    head = spark.read.option("encoding", encoding).csv(path, sep="\u0001", header=False).first()
    first = head[0] or "" if head else ""
    best = max(SEPARATORS, key=first.count)
    sep = best if first.count(best) + 1 >= min_cols else ","
    df = spark.read.csv(path, sep=sep, header=True, encoding=encoding, quote='"', escape='"')
    return df.toDF(*[c.replace("﻿", "") for c in df.columns])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A freshly read table, dealt out by its keys where its files have fewer splits than the session has cores.

    For heavy work on the rows of a small file. A table of many splits is returned as it is, so what is
    shuffled is never more than a split for each core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *keys) if df.rdd.getNumPartitions() < cores else df


def read_base(spark: SparkSession, parquet: str | None, csv: str | None = None, date: str = "event_date") -> DataFrame:
    """SRC2: base table, Parquet first, delimited text as the fallback; the reference date is typed again."""
    if parquet is not None and path_exists(spark, parquet):
        df = spark.read.parquet(parquet)
    elif csv is not None:
        df = read_delimited(spark, csv)
    else:
        raise FileNotFoundError(f"no base table at {parquet} or {csv}")
    kind = dict(df.dtypes).get(date)
    return df.withColumn(date, F.to_date(date) if kind in ("timestamp", "date") else D.parse_date(date)) if kind else df


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def resolve_source(spark: SparkSession, candidates: Sequence[tuple[str, str]], mode: str = "auto", exclude: str | None = None) -> tuple[str, str]:
    """SRC3: first existing (label, path) by priority; mode 'warehouse' or 'local' restricts the label."""
    for label, path in candidates:
        name = path.rstrip("/").rsplit("/", 1)[-1]
        if mode != "auto" and label != mode or exclude and re.search(exclude, name, re.I):
            continue
        if path_exists(spark, path):
            return label, path
    raise FileNotFoundError(f"no source for mode {mode}")


def discover_tables(spark: SparkSession, patterns: Sequence[str], schema: str | None = None) -> DataFrame:
    """SRC5: catalog objects whose name is LIKE one of the patterns."""
    rows = [(t.name, t.tableType) for t in spark.catalog.listTables(schema)]
    df = spark.createDataFrame(rows, "name string, table_type string")
    cond = F.lit(False)
    for p in patterns:
        cond = cond | F.upper("name").like(p.upper())
    return df.filter(cond)


_TABLE_FILE = r"([^/]+)\.parquet(?:/(?:[^/]+/)*[^/]+)?$"


def discover_files(spark: SparkSession, folder: str, patterns: Sequence[str]) -> DataFrame:
    """SRC5 without a warehouse: the Parquet tables under a folder whose name is LIKE one of the patterns.

    A table is a file or a folder of part files. Only the listing is read, through Spark's own reader, so any
    store Spark can open will do. Case does not matter; of several patterns the first that fits is reported.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folder)
    named = files.select(F.regexp_extract("path", _TABLE_FILE, 1).alias("name"), "length")
    fits = F.coalesce(*[F.when(F.lower("name").like(p.lower()), F.lit(p)) for p in patterns])
    return named.withColumn("pattern", fits).filter("pattern is not null and name != ''").groupBy("name", "pattern").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))


_KIND = {"bigint": "integer", "int": "integer", "smallint": "integer", "tinyint": "integer", "double": "number", "float": "number", "string": "text", "timestamp": "time", "timestamp_ntz": "time", "date": "time", "boolean": "flag"}


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """Per column of a table: place, kind, rows, nulls, smallest and largest value as text; one pass, one row of partial results per task."""
    kinds = [(c, _KIND.get(t.split("(")[0], "number" if t.startswith("decimal") else "other")) for c, t in df.dtypes]
    simple = [(i, c, k) for i, (c, k) in enumerate(kinds)]
    q = lambda c: F.col(f"`{c}`")
    g = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(q(c)).alias(f"n{i}") for i, c, _ in simple], *[f(q(c)).cast("string").alias(f"{n}{i}") for i, c, k in simple if k != "other" for n, f in (("lo", F.min), ("hi", F.max))])
    none = F.lit(None).cast("string")
    rows = [F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.lit(k).alias("kind"), F.col("rows"), (F.col("rows") - F.col(f"n{i}")).alias("nulls"),
                     (F.col(f"lo{i}") if k != "other" else none).alias("low"), (F.col(f"hi{i}") if k != "other" else none).alias("high")) for i, c, k in simple]
    return g.select(F.lit(name).alias("name"), F.inline(F.array(*rows)))


def profile_files(spark: SparkSession, folder: str, patterns: Sequence[str]) -> DataFrame:
    """SRC5: what the discovered tables hold, column by column. The driver learns the names of tables only."""
    from ..operators.ordering import union_all

    names = sorted(r["name"] for r in discover_files(spark, folder, patterns).select("name").distinct().collect())
    parts = [profile_table(spark.read.parquet(f"{folder}/{n}.parquet"), n) for n in names]
    if parts:
        return union_all(*parts)
    return spark.createDataFrame([], "name string, position int, column string, kind string, rows long, nulls long, low string, high string")


def pick_view(names: DataFrame, preferred: Sequence[str]) -> DataFrame:
    """SRC4: canonical view by order of preference, else the first name, else none."""
    plain = F.regexp_replace(F.upper(F.element_at(F.split(F.trim("name"), "\\."), -1)), "[^A-Z0-9_]", "")
    n = names.filter(F.trim("name") != "").withColumns({
        "_r": F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(p) for p in preferred]), plain), F.lit(0)), F.lit(len(preferred) + 1))})
    g = n.agg(F.min(F.struct("_r", "name")).alias("_b"), F.count(F.lit(1)).alias("candidates"))
    method = F.when(F.col("_b").isNull(), "nenhuma").when(F.col("_b._r") <= len(preferred), "canonico").otherwise("heuristica")
    return g.select(F.col("_b.name").alias("view"), method.alias("method"), "candidates")


def extract_lab(df: DataFrame, likes: dict[str, Sequence[str]], dates: Sequence[str], as_of: Column, years: int = 5) -> DataFrame:
    """SRC6: rows that match one LIKE of one column and whose first known date lies in the last years."""
    cond = F.lit(False)
    for c, patterns in likes.items():
        for p in patterns:
            cond = cond | F.col(c).like(p)
    return df.filter(cond & (F.coalesce(*[F.col(c) for c in dates]) >= F.add_months(as_of, -12 * years)))


def extract_deaths(df: DataFrame, cause: str, lines: Sequence[str], year: str, as_of: Column, years: int = 5,
                   prefixes: Sequence[str] = K.ICD_EXTRACT_PREFIXES) -> DataFrame:
    """SRC7: deaths with a listed ICD prefix as underlying cause or in one of the cause lines."""
    fields = F.array(*[F.col(c) for c in (cause, *lines)])
    hit = F.exists(fields, lambda x: F.coalesce(X.starts_any(x, prefixes), F.lit(False)))
    return df.filter((F.col(year).try_cast("double") >= F.year(as_of) - years) & hit) if dict(df.dtypes)[year] == "string" else df.filter((F.col(year) >= F.year(as_of) - years) & hit)


def latest_snapshot(df: DataFrame, year: str, month: str) -> DataFrame:
    """SRC8: rows of the newest year and month."""
    period = F.concat(F.col(year).cast("string"), F.lpad(F.col(month).cast("string"), 2, "0"))
    return df.filter(period == df.agg(F.max(period)).scalar())


def extract_births(df: DataFrame, year: str | None, as_of: Column, years: int = 3) -> DataFrame:
    """SRC9: births of the last years where the table has a year."""
    return df if year is None else df.filter(F.col(year) >= F.year(as_of) - years)


def write_extract(df: DataFrame, path: str) -> DataFrame:
    """SRC10: Parquet extract plus a one-row description with its schema; counts come from what was written."""
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(path).alias("path"), "rows", F.lit(len(df.columns)).alias("columns"), F.lit(",".join(df.columns)).alias("names"))


def write_result(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """SRC19: result sink; an empty result still gets its columns."""
    w = df.write.mode("overwrite")
    w.option("header", True).csv(path) if fmt == "csv" else w.parquet(path)


def read_corpus(spark: SparkSession, path: str, catalog: DataFrame | None = None) -> DataFrame:
    """SRC16: whole text files with their catalog entry (by relative file name)."""
    t = spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).withColumn("path", F.input_file_name())
    t = t.select(F.col("value").alias("text"), "path", F.element_at(F.split("path", "/"), -1).alias("file"))
    return t if catalog is None else t.join(catalog, "file", "left")


def file_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """SRC17: files with size and modification time; the content column is not read."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
    return f.select("path", F.element_at(F.split("path", "/"), -1).alias("file"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def line_counts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """SRC17: lines per text file."""
    t = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
    return t.groupBy(F.input_file_name().alias("path")).agg(F.count(F.lit(1)).alias("lines"))


RUN_LOG = T.StructType([
    T.StructField("inicio", T.StringType()), T.StructField("fim", T.StringType()),
    T.StructField("passos", T.ArrayType(T.StructType([
        T.StructField("modulo", T.StringType()), T.StructField("status", T.StringType()), T.StructField("duracao_s", T.DoubleType()),
        T.StructField("obrigatorio", T.BooleanType()), T.StructField("erro", T.StringType())])))])


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """SRC18: one row per step of the nested run log."""
    j = spark.read.schema(RUN_LOG).json(path, multiLine=True)
    return j.select("inicio", F.inline("passos"))
