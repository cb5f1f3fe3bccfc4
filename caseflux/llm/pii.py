"""Information-theoretic sanitising of personal data, in DataFrame functions only.

Base spans are e-mail addresses, IP addresses, card numbers and phone numbers by fixed patterns. Each value
found is a protected entity e. The corpus tells how strongly a term t reveals it: over documents,

    PMI(e, t) = log2(N df(e, t) / (df(e) df(t))),    IC(e) = log2(N / df(e)),

where df(e, t) counts documents with t at most REACH characters from e. PMI / IC is the share of e's
information that t discloses; 1 means that t occurs only beside e. Terms at or above GENERALISE, seen
beside e in at least MIN_SUPPORT documents, are replaced by a general word wherever they stand beside e, and
removed at or above REMOVE. All counts cover all documents, with partial sums before each shuffle.

Positions are code points, ends exclusive. The patterns are written without backtracking over repeated
groups (possessive quantifiers, starts only at the edge of a run), so very long runs neither overflow the
matcher's stack nor take quadratic time; they match what the plain patterns match.

Defined cases: null counts as the empty text and has no spans; documents are told apart by id and text, so
repeated rows get the same spans; an entity in every document has no information to disclose; extra
columns are ignored by `find` and carried along by `sanitise`.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, text_key

REACH, MIN_SUPPORT, GENERALISE, REMOVE = 80, 3, 0.9, 0.97
KINDS = ("email", "ip", "card", "phone", "term")
_LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[ -][0-9]++)*+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_HINT = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][ -]?){12}", "phone": r"\+[0-9]"}
_BYTE = "(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
TERM = r"(?<!\S)\p{L}{4,}+(?=[.,;:!?]?(?!\S))"


def _luhn(digits: Column) -> Column:
    """Luhn's checksum holds."""
    back = F.reverse(digits)

    def add(acc, i):
        d = F.substring(back, i, F.lit(1)).cast("int")
        return acc + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0


def _valid(kind: str, v: Column) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    if kind == "ip":
        return v.rlike(rf"^0*{_BYTE}(?:\.0*{_BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _placed(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their starts and ends: the gaps between matches carry the position along."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zipped = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("m")))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.length(x["m"])
        one = F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    return F.aggregate(zipped, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda acc: acc["out"])


def _holds(kind: str):
    return lambda x: _valid(kind, x["value"])


def _tagged(k: int):
    return lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("kind"), x["end"].alias("end"), x["value"].alias("value"))


def _is_kind(k: int):
    return lambda x: x["kind"] == k


_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, value), sorted; kind is the place in KINDS."""
    found = []
    for k, kind in enumerate(KINDS[:4]):
        hits = F.filter(_placed(text, PATTERNS[kind]), _holds(kind))
        found.append(F.when(text.rlike(_HINT[kind]), F.transform(hits, _tagged(k))).otherwise(F.array().cast(_SPAN)))
    return F.array_sort(F.concat(*found))


def _beside(whole: Column, low: Column, start: Column, end: Column) -> Column:
    """Terms at most REACH characters from a span, with their positions in the text; cut words do not count."""
    shown = F.concat(F.when(low > 0, F.lit("0")).otherwise(F.lit(" ")), F.substring(whole, F.lit(1), start - low), F.lit("0"))  # a 0 keeps cut words from counting
    after = F.concat(F.lit("0"), F.substring(whole, end - low + 1, F.lit(REACH)), F.when(F.length(whole) < end - low + REACH, F.lit(" ")).otherwise(F.lit("0")))

    def placed(x, shift):
        return F.struct((x["start"] - 1 + shift).alias("start"), (x["end"] - 1 + shift).alias("end"), F.lower(x["value"]).alias("term"))

    left = F.transform(_placed(shown, TERM), lambda x: placed(x, low))
    right = F.transform(_placed(after, TERM), lambda x: placed(x, end))
    return F.concat(left, right)


def spans(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE) -> DataFrame:
    """Per distinct (id, text): keys _kid, _kh, doc_id, base spans, and spans of disclosing terms (start, end, ratio)."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t")).withColumns(dict(zip(("_kid", "_kh"), text_key(F.col("doc_id"), F.col("t")), strict=True)))
    # exploding a one-element array keeps the optimizer from copying the search into every later filter
    found = d.select("doc_id", "_kid", "_kh", "t", F.explode(F.array(base_spans(F.col("t")))).alias("base"))
    low = F.greatest(F.col("s.start") - REACH, F.lit(0))
    one = found.select("_kid", "_kh", "t", F.explode("base").alias("s"))
    one = one.select("_kid", "_kh", "s", low.alias("low"), F.substring("t", low + 1, F.col("s.end") - low + REACH).alias("whole"))  # both sides and the span itself
    beside = settle(one.select("_kid", "_kh", F.sha2(F.concat_ws(":", F.col("s.kind"), F.lower("s.value")), 256).alias("e"), _beside(F.col("whole"), F.col("low"), F.col("s.start"), F.col("s.end")).alias("near")))
    n = d.agg(F.count("*").alias("n"))
    df_e = beside.select("e", "_kid", "_kh").distinct().groupBy("e").agg(F.count("*").alias("df_e"))
    occur = beside.select("_kid", "_kh", "e", F.explode("near").alias("x")).select("_kid", "_kh", "e", F.col("x.term").alias("term"), F.col("x.start").alias("start"), F.col("x.end").alias("end"))
    both = occur.select("e", "term", "_kid", "_kh").distinct().groupBy("e", "term").agg(F.count("*").alias("df_et")).where(F.col("df_et") >= MIN_SUPPORT)
    df_t = d.select(F.explode(F.array_distinct(F.split(F.lower(F.array_join(F.regexp_extract_all("t", F.lit(TERM), F.lit(0)), " ")), " "))).alias("term")).groupBy("term").agg(F.count("*").alias("df_t"))
    total = F.lit(n.collect()[0]["n"]).cast("double")
    told = both.join(df_e, "e").join(df_t, "term").withColumn("ic", F.log2(total / F.col("df_e")))
    told = told.withColumn("ratio", F.log2(total * F.col("df_et") / (F.col("df_e") * F.greatest("df_t", "df_et"))) / F.col("ic"))
    told = told.where((F.col("ic") > 0) & (F.col("ratio") >= generalise)).select("e", "term", "ratio")
    extra = occur.join(told, ["e", "term"]).groupBy("_kid", "_kh", "start", "end").agg(F.max("ratio").alias("ratio"))
    extra = extra.groupBy("_kid", "_kh").agg(F.array_sort(F.collect_list(F.struct("start", "end", "ratio"))).alias("terms"))
    return found.join(extra, ["_kid", "_kh"], "left").drop("t")


def _joined(s: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(s, lambda x: F.concat_ws(":", names[x["kind"]], x["start"], x["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, counts per kind, digest of the base spans, all spans, number of disclosing terms."""
    s = spans(docs)
    every = F.array_sort(F.concat(
        F.transform("base", lambda x: F.struct(x["start"].alias("start"), x["kind"].alias("kind"), x["end"].alias("end"))),
        F.transform(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,ratio:double>>")), lambda x: F.struct(x["start"].alias("start"), F.lit(4).alias("kind"), x["end"].alias("end")))))
    counts = [F.size(F.filter("base", _is_kind(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])]
    return s.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"), F.size(F.coalesce("terms", F.array().cast("array<struct<start:int,end:int,ratio:double>>"))).cast("long").alias("n_term"))


def sanitise(docs: DataFrame, remove: float = REMOVE) -> DataFrame:
    """The documents with base spans replaced by [KIND] and disclosing terms generalised or removed; n_chars follows the text."""
    hit = spans(docs).where((F.size("base") > 0) | F.col("terms").isNotNull()).dropDuplicates(["_kid", "_kh"]).select(F.col("_kid").alias("_hid"), F.col("_kh").alias("_hh"), F.col("base").alias("_base"), F.col("terms").alias("_terms"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    marks = F.array_sort(F.concat(
        F.transform("_base", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), names[x["kind"]].alias("to"))),
        F.transform(F.coalesce("_terms", F.array().cast("array<struct<start:int,end:int,ratio:double>>")),
                    lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.when(x["ratio"] >= remove, "").otherwise("[TERM]").alias("to")))))

    def step(acc, x):
        # a span that begins inside the one before only lengthens what is replaced
        gap = F.when(x["start"] > acc["at"], F.substring(acc["text"], acc["at"] + 1, x["start"] - acc["at"])).otherwise(F.lit(""))
        to = F.when(x["start"] >= acc["at"], x["to"]).otherwise(F.lit(""))
        return F.struct(acc["text"].alias("text"), F.greatest(acc["at"], x["end"]).alias("at"), F.concat(acc["out"], F.array(gap, to)).alias("out"))

    text = F.coalesce("text", F.lit(""))
    first = F.struct(text.alias("text"), F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    clean = F.aggregate("_marks", first, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substring(a["text"], a["at"] + 1, F.length(a["text"]))))
    keys = text_key(F.col("doc_id"), F.col("text"))
    out = docs.withColumns({"_kid": keys[0], "_kh": keys[1]}).join(hit.withColumn("_marks", marks), (F.col("_kid") == F.col("_hid")) & (F.col("_kh") == F.col("_hh")), "left")
    out = out.withColumn("text", F.when(F.col("_marks").isNotNull(), clean).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("_marks").isNotNull(), F.length("text").cast(dict(docs.dtypes)["n_chars"])).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
