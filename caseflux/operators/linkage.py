"""Record linkage (JN8-JN12, AG45, AG46).

The score of a pair is a sum of few parts: birth date equal 45 (one day off 30), sex 15,
municipality 25, event near a date of the partner 15 (<= 15 days) or 8 (<= 45 days); a shared
notification number is 100. Candidates share sex and either the birth year or the municipality.
A partner has any of the dates of DATES; the first of them within 45 days of the event counts.

Only the best partner of a case is wanted, so pairs of a crowded block are never listed. What two
records have in common besides dates is one of four *kinds* of key (birth and place, birth, place,
birth year). Per kind the partners are reduced to one row per key and day (the smallest id), sliding
minima over the days answer "within 15 days" and "within 45 days" at once, and a case looks up its own
keys and day. A sliding window holds one row per calendar day, whatever share of the table its key has.
Ids are ranked once, so that the minima are over numbers, and a key is one number: of its kind, of the sex and
place among those of the cases, and of its birth day or year. The strongest key is looked up first, the others
only for cases that can still do as well by them.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from .filters import discard, is_stored, store

BIRTH, BIRTH_NEAR, SEX, PLACE, NEAR, FAR, CAP = 45, 30, 15, 25, 15, 8, 99
NEAR_DAYS, FAR_DAYS = 15, 45
DATES = ("collected_date", "released_date", "death_date")


def _known(c: Column | str) -> Column:
    s = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.when(s.isNotNull() & ~s.isin("", "nan", "None"), s)


def link_exact(cases: DataFrame, exams: DataFrame, key: str = "notification") -> DataFrame:
    """JN8: pairs that share the notification number."""
    a = cases.withColumn("_n", _known(key)).filter(F.col("_n").isNotNull())
    b = exams.select(_known(key).alias("_n"), F.col("exam_id")).filter(F.col("_n").isNotNull())
    return a.join(b, "_n").select("case_id", "exam_id", F.col("_n").alias("notification"), F.lit(1.0).alias("score"),
                                  F.lit("notification").alias("reasons"))


def _proximity(event: Column, dates: Sequence[Column]) -> tuple[Column, Column]:
    """Points and label of the first date of the partner that lies near the event."""
    pts, label = F.lit(0), F.lit(None).cast("string")
    for name, d in reversed(list(zip(DATES, dates))):
        gap = F.abs(F.datediff(event, d))
        pts = F.when(gap <= NEAR_DAYS, NEAR).when(gap <= FAR_DAYS, FAR).otherwise(pts)
        label = F.when(gap <= NEAR_DAYS, f"{name}_15d").when(gap <= FAR_DAYS, f"{name}_45d").otherwise(label)
    return pts, label


def pair_score(pairs: DataFrame, left: str = "a_", right: str = "b_") -> DataFrame:
    """JN10: score (0-1) and reasons of candidate pairs; columns carry a side prefix."""
    a, b = (lambda c: F.col(left + c)), (lambda c: F.col(right + c))
    same_number = F.coalesce(_known(a("notification")) == _known(b("notification")), F.lit(False))
    gap = F.abs(F.datediff(a("birth_date"), b("birth_date")))
    birth = F.when(gap == 0, BIRTH).when(gap == 1, BIRTH_NEAR).otherwise(0)
    sex = F.when((a("sex") == b("sex")) & (a("sex") != ""), SEX).otherwise(0)
    place = F.when(a("code6") == b("code6"), PLACE).otherwise(0)
    near, near_label = _proximity(a("event_date"), [b(d) if right + d in pairs.columns else F.lit(None).cast("date") for d in DATES])
    points = F.least(birth + sex + place + near, F.lit(CAP))
    why = F.concat_ws(";", F.when(gap == 0, "birth_date").when(gap == 1, "birth_date_near"), F.when(sex > 0, "sex"),
                      F.when(place > 0, "municipality"), near_label)
    return pairs.withColumns({"score": F.when(same_number, 1.0).otherwise(points / 100.0),
                              "reasons": F.when(same_number, "notification").otherwise(why)})


# kind of key: points of its place, and points of the birth relations it can show
KINDS = {"full": (PLACE, {"same": BIRTH, "near": BIRTH_NEAR}), "birth": (0, {"same": BIRTH, "near": BIRTH_NEAR}), "place": (PLACE, {"any": 0}), "year": (0, {"any": 0})}
_NO_DAY = -10_000_000  # stands for a missing day; no window reaches it
_SPAN = 1 << 23  # days or years a key can tell apart; beyond 13,000 years none is looked up
_FEW_KEYS = 200_000  # so many keys of later rounds, or sexes and places, are sent to every task; above, none are
_SLICE_ROWS, _SLICES = 2_000_000, 4  # partners per slice of the keys looked up at a time, and the most slices


def _codes(cases: DataFrame) -> DataFrame:
    """Numbers of the sexes (without place) and of the pairs of sex and place that cases have; others find no case."""
    place = cases.schema["code6"].dataType
    pairs = cases.filter("code6 is not null").select("sex", "code6").union(cases.select("sex", F.lit(None).cast(place)))
    return store(pairs.distinct().coalesce(1).withColumn("code", F.monotonically_increasing_id()))


def _coded(df: DataFrame, codes: DataFrame) -> DataFrame:
    """Records with the number of their sex (`s`) and of their sex and place (`sp`), null where no case has it."""
    send = F.broadcast if codes.count() <= _FEW_KEYS else (lambda x: x)
    s = codes.filter("code6 is null").select(F.col("sex").alias("_sex"), F.col("code").alias("s"))
    sp = codes.filter("code6 is not null").select(F.col("sex").alias("_sex"), F.col("code6").alias("_place"), F.col("code").alias("sp"))
    out = df.join(send(s), F.col("sex") == F.col("_sex"), "left").drop("_sex")
    return out.join(send(sp), (F.col("sex") == F.col("_sex")) & (F.col("code6") == F.col("_place")), "left").drop("_sex", "_place")


def _key(kind: str, birth: Column) -> Column:
    """Key of a record for a kind, null where a part of it is missing."""
    b = F.year(F.date_from_unix_date(birth)) if kind == "year" else F.lit(0) if kind == "place" else birth
    who = F.col("sp") if kind in ("full", "place") else F.col("s")
    key = (who * len(KINDS) + list(KINDS).index(kind)) * _SPAN + b + _SPAN // 2
    return F.when(who.isNotNull() & (b >= -_SPAN // 2) & (b < _SPAN // 2), key)


def _kinds(points: int) -> dict[str, dict[str, int]]:
    """Kinds and birth relations that reach the points, with what they give before sex and dates."""
    out = {k: {r: place + x for r, x in rel.items() if place + x + SEX + NEAR >= points} for k, (place, rel) in KINDS.items()}
    return {k: v for k, v in out.items() if v}


def _rounds(kinds: dict[str, dict[str, int]]) -> list[dict[str, dict[str, int]]]:
    """The strongest relation first and alone; the others are asked only for cases it leaves open."""
    if not kinds:
        return []
    top = max(((k, r) for k, rel in kinds.items() for r in rel), key=lambda x: kinds[x[0]][x[1]])
    rest = {k: {r: x for r, x in rel.items() if (k, r) != top} for k, rel in kinds.items()}
    return [{top[0]: {top[1]: kinds[top[0]][top[1]]}}, {k: v for k, v in rest.items() if v}]


def _ranked(partners: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Partners with `rank`, a number that orders them as their ids do: minima over numbers need no sort.
    One id has one rank, as the rows of an id lie in one range and its first row (`head`) gives the number, and the
    smallest of what its rows carry (`own`)."""
    s = partners.repartitionByRange("partner").sortWithinPartitions("partner").withColumn("_i", F.monotonically_increasing_id())
    own = W.partitionBy("partner")
    more = {"own": F.min(F.struct(*carry)).over(own)} if carry else {}
    return s.withColumns({"rank": F.min("_i").over(own), **more, "named": F.col("partner").isNotNull()}).withColumn("head", F.col("_i") == F.col("rank")).drop("_i", *carry)


def _partner_rows(partners: DataFrame, dates: Sequence[str], kinds: Sequence[str], asked: DataFrame | None = None) -> DataFrame:
    """Key rows of a partner, one per date it has. `wide` and `first` are spread by the window later: a day is
    far from a partner where any date is within FAR_DAYS, and near where the first such date is within NEAR_DAYS.
    So a later date more than NEAR_DAYS + FAR_DAYS off the earlier ones is as good as a first one, one as close as
    their difference gives no near day, and one between is listed day by day (`exact`). A hit is rank and date."""
    partners = partners if "sp" in partners.columns else _coded(partners, _codes(partners))
    keys = F.explode(F.array(*[_key(k, F.unix_date("birth_date")) for k in kinds])).alias("key")
    e = partners.select("rank", "named", *[F.unix_date(d).alias(f"d{i}") for i, d in enumerate(dates)], keys).filter("key is not null")
    if asked is not None:
        e = e.join(F.broadcast(asked), "key", "left_semi")
    none, some = F.lit(None).cast("bigint"), F.when(F.col("named"), F.col("rank"))
    day = [F.col(f"d{i}") for i in range(len(dates))]
    hit = [F.col("rank") * len(DATES) + i for i in range(len(dates))]

    def beyond(i: int, days: int, x: Column | None = None) -> Column:
        """Day i (or x) is more than so many days off every earlier date."""
        out = F.lit(True)
        for y in day[:i]:
            out = out & F.coalesce(F.abs((day[i] if x is None else x) - y) > days, F.lit(True))
        return out

    def row(at: Column, first: Column, wide: Column, s: Column) -> Column:
        return F.struct(at.alias("day"), first.alias("first"), wide.alias("wide"), none.alias("exact"), s.alias("some"))

    rows, listed = [row(F.coalesce(*day, F.lit(_NO_DAY)), F.coalesce(*[F.when(d.isNotNull(), h) for d, h in zip(day, hit)], none), F.coalesce(*[F.when(d.isNotNull(), h) for d, h in zip(day, hit)], none), some)], []
    for i in range(1, len(dates)):
        before = F.coalesce(*day[:i]).isNotNull()
        rows.append(F.when(before & beyond(i, 0) & day[i].isNotNull(), row(day[i], F.when(beyond(i, FAR_DAYS + NEAR_DAYS), hit[i]), hit[i], none)))
        between = before & day[i].isNotNull() & beyond(i, FAR_DAYS - NEAR_DAYS) & ~beyond(i, FAR_DAYS + NEAR_DAYS)
        span = e.filter(between).withColumn("day", F.explode(F.sequence(day[i] - NEAR_DAYS, day[i] + NEAR_DAYS)))
        listed.append(span.filter(beyond(i, FAR_DAYS, F.col("day"))).select("key", "day", none.alias("first"), none.alias("wide"), hit[i].alias("exact"), none.alias("some")))
    out = e.select("key", F.inline(F.array(*rows))).filter("day is not null")
    for x in listed:
        out = out.unionByName(x)
    return out


def _probe(cases: DataFrame, kinds: dict[str, dict[str, int]], floor: Column) -> DataFrame:
    """Keys a case looks up, with the points they give besides the date, where they can reach the floor."""
    birth, rows = F.unix_date("birth_date"), []
    sex = F.when(F.col("sex") != "", SEX).otherwise(0)
    for kind, relations in kinds.items():
        for rel, base in relations.items():
            for shift in {"near": (-1, 1)}.get(rel, (0,)):
                b = birth + shift
                if kind == "birth" and shift:  # without a common place the birth years have to agree
                    b = F.when(F.year(F.date_from_unix_date(b)) == F.year("birth_date"), b)
                key = _key(kind, b)
                rows.append(F.when(key.isNotNull() & (F.lit(base + NEAR) + sex >= floor), F.struct(
                    F.lit(kind).alias("kind"), key.alias("key"), F.lit(rel).alias("rel"), (F.lit(base) + sex).alias("base"))))
    day = F.coalesce(F.unix_date("event_date"), F.lit(_NO_DAY))
    return cases.select("case_id", "sex", day.alias("day"), F.inline(F.array(*rows))).filter("kind is not null")


def _lookup(rows: DataFrame, probe: DataFrame) -> DataFrame:
    """Smallest partner of every probed key: near its day, less near, on any day."""
    asked = probe.select("key", "day", F.lit(1).alias("q"))
    u = rows.withColumn("q", F.lit(0)).unionByName(asked, allowMissingColumns=True)
    g = u.groupBy("key", "day").agg(*[F.min(c).alias(c) for c in ("first", "wide", "exact", "some")], F.max("q").alias("q"))
    key = W.partitionBy("key")
    within = lambda c, r: F.min(c).over(key.orderBy("day").rangeBetween(-r, r))
    hits = g.select("key", "day", "q", F.least(within("first", NEAR_DAYS), "exact").alias("near"), within("wide", FAR_DAYS).alias("far"), F.min("some").over(key).alias("some"))
    return hits.filter((F.col("q") == 1) & F.col("some").isNotNull()).drop("q")


def _outcome(points: int, dates: Sequence[str]) -> Column:
    """The best a probed key gives: points, rank of the partner and reasons, or null."""
    shared = [F.when(F.col("rel") == "same", "birth_date").when(F.col("rel") == "near", "birth_date_near"), F.when(F.col("sex") != "", "sex"),
              F.when(F.col("kind").isin("full", "place"), "municipality")]

    def step(add: int, hit: str, days: int | None) -> Column:
        total = F.least(F.col("base") + add, F.lit(CAP))
        rank = F.col(hit) if days is None else F.expr(f"{hit} div {len(DATES)}")
        label = F.lit(None).cast("string")
        if days is not None and dates:
            label = F.concat(F.get(F.array(*[F.lit(d) for d in dates]), (F.col(hit) % len(DATES)).cast("int")), F.lit(f"_{days}d"))
        return F.when(F.col(hit).isNotNull() & (total >= points), F.struct(total.alias("points"), rank.alias("rank"), F.concat_ws(";", *shared, label).alias("reasons")))

    return F.coalesce(step(NEAR, "near", NEAR_DAYS), step(FAR, "far", FAR_DAYS), step(0, "some", None))


def _best(found: DataFrame) -> DataFrame:
    """One outcome per case: most points, then the smallest rank."""
    b = found.groupBy("case_id").agg(F.min(F.struct((-F.col("best.points")).alias("less"), "best.rank", "best.reasons")).alias("_b"))
    return b.select("case_id", F.struct((-F.col("_b.less")).alias("points"), "_b.rank", "_b.reasons").alias("best"))


def link_best(cases: DataFrame, partners: DataFrame, min_score: float = 0.55, key: str = "exam_id", carry: Sequence[str] = ()) -> DataFrame:
    """JN9 + JN11: the best partner of every case with at least min_score.

    Order: score, then the smallest partner id. cases: case_id, notification, birth_date, sex, code6,
    event_date; partners: the key column, notification, birth_date, sex, code6 and any of the dates of DATES.
    carry: columns of the partner that a link shows as well, the smallest where rows share the id; links to a
    partner without id are left out then.
    """
    cols = ["notification", "birth_date", "sex", "code6"]
    dates = [d for d in DATES if d in partners.columns]
    blank = F.coalesce("sex", F.lit(""))
    # each side is derived once; what made a table is off the disk before the next one is made
    own_cases, own_partners = not is_stored(cases), not is_stored(partners)
    plain = cases.select("case_id", *cols, "event_date")
    plain = store(plain) if own_cases else plain
    codes = _codes(plain.withColumn("sex", blank))
    c = store(_coded(plain.withColumn("sex", blank), codes).drop("code6"))
    if own_cases:
        discard(plain)
    shown = partners.select(F.col(key).alias("partner"), *cols, *dates, *[F.col(x).alias(f"_c{i}") for i, x in enumerate(carry)])
    plain = _coded(shown.withColumn("sex", blank), codes).drop("sex", "code6")
    plain = store(plain) if own_partners else plain
    e = store(_ranked(plain, [f"_c{i}" for i in range(len(carry))]))
    if own_partners:
        discard(plain)
    slices = min(_SLICES, e.count() // _SLICE_ROWS + 1)

    # shared number: one partner per number
    num = e.select(_known("notification").alias("_n"), F.when(F.col("named"), F.col("rank")).alias("rank")).filter(F.col("_n").isNotNull()).groupBy("_n").agg(F.min("rank").alias("rank"))
    exact = c.select("case_id", _known("notification").alias("_n")).join(num, "_n").select(
        "case_id", F.struct(F.lit(100).alias("points"), "rank", F.lit("notification").alias("reasons")).alias("best"))

    points = round(min_score * 100)
    found = exact
    for i, kinds in enumerate(_rounds(_kinds(points))):
        if i == 0:
            probe, few = _probe(c, kinds, F.lit(points)), None
        elif kinds:
            found = store(_best(found))
            open_ = c.join(found.select("case_id", F.col("best.points").alias("_have")), "case_id", "left")
            probe = store(_probe(open_, kinds, F.greatest(F.lit(points), "_have")))
            asked = probe.select("key").distinct()
            few = asked if asked.limit(_FEW_KEYS + 1).count() <= _FEW_KEYS else None
        else:
            break
        rows = _partner_rows(e, dates, list(kinds), few)
        for j in range(slices):
            own = (lambda df: df) if slices == 1 else (lambda df: df.filter(F.pmod(F.xxhash64("key"), F.lit(slices)) == j))
            asks = own(probe)
            hits = asks.join(_lookup(own(rows), asks), ["key", "day"]).select("case_id", _outcome(points, dates).alias("best")).filter("best is not null")
            found = found.unionByName(hits if slices == 1 else store(hits))
    best = store(_best(found)).select("case_id", "best.*")
    ids = e.filter("head").select("rank", F.col("partner").alias(key), *[F.col(f"own._c{i}").alias(x) for i, x in enumerate(carry)])
    links = best.join(ids, "rank", "left").select("case_id", key, (F.col("points") / 100.0).alias("score"), "reasons", *carry)
    links = store(links.filter(F.col(key).isNotNull()) if carry else links)
    discard(e)
    return links


def link_deaths(cases: DataFrame, deaths: DataFrame, min_score: float = 0.55) -> DataFrame:
    """JN9 for the mortality register: the best death record per case with its evidence (cause and date).

    deaths: death_id, notification, birth_date, sex, code6, death_date, cause. A link without a death date
    and without a compatible cause is kept here; `death_union` decides what counts.
    """
    return link_best(cases, deaths, min_score, "death_id", ["death_date", "cause"]).select("case_id", "death_id", "score", "reasons", "death_date", "cause")


def best_match(links: DataFrame, key: str = "exam_id") -> DataFrame:
    """JN11: one partner per case: highest score, then smallest id (merged before the shuffle)."""
    b = links.groupBy("case_id").agg(F.min(F.struct((-F.col("score")).alias("s"), key, "reasons")).alias("_b"))
    return b.select("case_id", F.col("_b")[key].alias(key), (-F.col("_b.s")).alias("score"), F.col("_b.reasons").alias("reasons"))


def enrich(cases: DataFrame, links: DataFrame, min_score: float = 0.75, prefix: str = "lab", fields: Sequence[str] = ("method", "result")) -> DataFrame:
    """JN12: link fields on the case, by notification number first, else by case id."""
    good = links.filter(F.col("score") >= min_score)
    pick = F.min(F.struct((-F.col("score")).alias("s"), "exam_id", *fields))
    kept = lambda best, c: best.select(c, F.struct("_b.s", *[f"_b.{f}" for f in fields]).alias("_b1" if c == "_no" else "_b2"))  # the exam id goes no further
    by_no = kept(good.select(_known("notification").alias("_no"), "score", "exam_id", *fields).filter(F.col("_no").isNotNull()).groupBy("_no").agg(pick.alias("_b")), "_no")
    by_id = kept(good.groupBy(F.col("case_id").alias("_id")).agg(pick.alias("_b")), "_id")
    j = cases.join(by_no, _known("notification") == F.col("_no"), "left").join(by_id, F.col("case_id") == F.col("_id"), "left")
    best = F.coalesce("_b1", "_b2")
    return j.withColumns({
        f"{prefix}_match": best.isNotNull().cast("int"), f"{prefix}_score": -best["s"],
        **{f"{prefix}_{f}": best[f] for f in fields}}).drop("_no", "_id", "_b1", "_b2")


def attach_deaths(cases: DataFrame, links: DataFrame, min_score: float = 0.75) -> DataFrame:
    """JN12 for deaths: match flag, score, cause and date of the linked death record on the case, then AG46."""
    good = links.filter(F.col("score") >= min_score).select(F.col("case_id").alias("_id"), F.col("score").alias("sim_score"), F.col("cause").alias("sim_icd"), F.col("death_date").alias("sim_death_date"))
    j = cases.join(good, F.col("case_id") == F.col("_id"), "left").withColumn("sim_match", F.col("_id").isNotNull().cast("int")).drop("_id")
    return death_union(j)


def death_union(df: DataFrame, match: str = "sim_match", date: str = "sim_death_date", icd: str = "sim_icd") -> DataFrame:
    """AG46: a matched death counts only with evidence: a death date or a compatible cause."""
    m = F.coalesce(F.col(match), F.lit(0)) == 1
    d, c = F.col(date).isNotNull(), X.icd_match(icd)
    own = F.coalesce(F.col("death"), F.lit(0)) == 1
    why = (F.when(~m, "sem_match_sim").when(d & c, "data_obito+cid_meningite").when(d, "data_obito").when(c, "cid_meningite")
           .otherwise("match_sem_evidencia_obito"))
    linked = m & (d | c)
    return df.withColumns({"death_linked": linked.cast("int"), "death_reason": why, "death_union": (own | linked).cast("int"),
                           "death_only_linked": (linked & ~own).cast("int")})


def death_summary(df: DataFrame, match: str = "sim_match") -> DataFrame:
    """AG46: totals of the union and of the matches without evidence."""
    s = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return df.agg(s("death").alias("deaths_own"), s("death_linked").alias("deaths_linked"), s("death_union").alias("deaths_union"),
                  s("death_only_linked").alias("only_linked"), s(match).alias("matches"), (s(match) - s("death_linked")).alias("matches_without_evidence"))


def linkage_status(sources: dict[str, tuple[DataFrame | None, DataFrame | None]], spark) -> DataFrame:
    """AG45: readiness per source: rows, matches, status."""
    from .ordering import union_all

    parts = []
    for name, (table, links) in sources.items():
        if table is None:
            parts.append(spark.range(1).select(F.lit(name).alias("source"), F.lit("AUSENTE").alias("status"),
                                               F.lit(0).cast("bigint").alias("rows"), F.lit(0).cast("bigint").alias("matches")))
        else:
            n = table.agg(F.count(F.lit(1)).alias("rows"))
            m = links.agg(F.count(F.lit(1))).scalar() if links is not None else F.lit(0).cast("bigint")
            parts.append(n.select(F.lit(name).alias("source"), F.lit("OK").alias("status"), "rows", m.alias("matches")))
    return union_all(*parts)


def internal_proxy(df: DataFrame) -> DataFrame:
    """AG45: laboratory proxy out of the case fields and cases to look up."""
    from .lab import any_lab

    pos = any_lab()["lab_any_positive"]
    return df.withColumns({"proxy_lab_positive": pos, "review": ((F.col("confirmed") == 1) & (pos == 0)).cast("int")})


def proxy_summary(df: DataFrame) -> DataFrame:
    p = internal_proxy(df)
    return p.agg(F.count(F.lit(1)).alias("cases"), F.sum("proxy_lab_positive").alias("proxy_positive"),
                 (100.0 * F.avg("proxy_lab_positive")).alias("pct_proxy_positive"), F.sum("death").alias("deaths_own"), F.sum("review").alias("to_review"))


def review_queue(df: DataFrame, n: int | None = None) -> DataFrame:
    """AG45: confirmed cases without a positive result, newest first (the first n, where n is given)."""
    out = internal_proxy(df).filter(F.col("review") == 1).orderBy(F.col("event_date").desc(), "case_id")
    return out if n is None else out.limit(n)
