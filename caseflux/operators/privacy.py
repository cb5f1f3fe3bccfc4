"""Privacy-safe extracts (TX7-TX10)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fixed as K
from ..functions.text import as_col


def is_pii(name: str) -> bool:
    """Columns that leave the extract."""
    if name in K.PII_DROP:
        return True
    low = name.lower()
    return not low.startswith(K.PII_KEEP_STARTS) and any(p in low for p in K.PII_DROP_PARTS)


def pii_policy(columns: Sequence[str]) -> dict[str, str]:
    """TX7: drop / pseudonym / keep per column."""
    return {c: "drop" if is_pii(c) else "pseudonym" if c in K.PII_PSEUDONYM else "keep" for c in columns}


def _code(c: Column, salt: str) -> Column:
    """The whole digest: a shorter code would merge persons in large tables."""
    return F.concat(F.lit("CASO-"), F.upper(F.sha2(F.concat(F.lit(salt + "|"), c), 256)))


def pseudonym(c: Column | str, salt: str) -> Column:
    """TX8: the same id gets the same pseudonym in every table of one salt; the id cannot be read back."""
    s = F.trim(as_col(c).cast("string"))
    code = _code(s, salt)
    return F.when(s.isNull() | F.lower(s).isin("", "nan", "none", "<na>", "nat"), "").otherwise(code)


def drop_pii(df: DataFrame, salt: str, policy: Mapping[str, str] | None = None) -> DataFrame:
    """TX7: apply the policy."""
    policy = policy or pii_policy(df.columns)
    return df.select(*[pseudonym(f"`{c}`", salt).alias(c) if p == "pseudonym" else F.col(f"`{c}`") for c, p in policy.items() if p != "drop"])


def redact_ids(c: Column | str, salt: str, drop_lines: bool = False) -> Column:
    """TX9: case numbers in free text become the pseudonym of the id column. The text is split at the
    numbers and put together again, so nothing else in it can change."""
    t = as_col(c)
    if drop_lines:
        t = F.array_join(F.filter(F.split(t, "\n", -1), lambda line: ~line.rlike(K.NOMINAL_LINE_PATTERN)), "\n")
    parts = F.split(t, K.CASE_NUMBER_PATTERN, -1)
    ids = F.regexp_extract_all(t, F.lit(K.CASE_NUMBER_PATTERN), F.lit(2))
    codes = F.transform(ids, lambda i: _code(i, salt))
    glued = F.zip_with(parts, codes, lambda p, k: F.concat(p, F.coalesce(k, F.lit(""))))
    return F.when(t.isNull(), None).otherwise(F.array_join(glued, ""))


def sanitize(df: DataFrame, salt: str) -> DataFrame:
    """TX7-TX9 on every column: drop, pseudonymise, redact the remaining text."""
    out = drop_pii(df, salt)
    text = [f.name for f in out.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in K.PII_PSEUDONYM]
    return out.withColumns({c: redact_ids(f"`{c}`", salt) for c in text})


def residual_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """TX10: rows per text column that still hold a case number or a nominal line."""
    cols = list(columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)])
    hit = lambda c, p: F.count_if(F.coalesce(F.col(f"`{c}`").rlike(p), F.lit(False)))
    one = df.agg(F.count(F.lit(1)).alias("_n"), *[x for i, c in enumerate(cols) for x in (
        hit(c, K.CASE_NUMBER_PATTERN).alias(f"_a{i}"), hit(c, K.NOMINAL_LINE_PATTERN).alias(f"_b{i}"))])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_a{i}").alias("case_numbers"), F.col(f"_b{i}").alias("nominal_lines")) for i, c in enumerate(cols)])
    return one.select(F.col("_n").alias("rows"), F.inline(rows))


def accounting(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """TX10: what the policy did: action per column, and rows whose text changed."""
    policy = pii_policy(before.columns)
    rows = [(c, p) for c, p in policy.items()]
    table = before.sparkSession.createDataFrame(rows, "column string, action string")
    text = [c for c, p in policy.items() if p == "keep" and dict(before.dtypes)[c] == "string" and c in after.columns]
    a = before.select(F.col(key).alias("_k"), *[F.xxhash64(f"`{c}`").alias(f"a_{c}") for c in text])
    b = after.select(F.col(key).alias("_k"), *[F.xxhash64(f"`{c}`").alias(f"b_{c}") for c in text])
    one = a.join(b, "_k").agg(*[F.count_if(F.col(f"a_{c}") != F.col(f"b_{c}")).alias(c) for c in text])
    long = one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("_c"), F.col(c).alias("rows_changed")) for c in text])))
    return table.join(long, F.col("column") == F.col("_c"), "left").select("column", "action", F.coalesce("rows_changed", F.lit(0)).alias("rows_changed"))
