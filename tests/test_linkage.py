"""Best partner against brute force over all pairs, with crowded groups."""
import datetime as dt
import random

import pytest

from caseflux.operators import linkage as L

BASE = dt.date(2020, 1, 1)


def day(n):
    return None if n is None else BASE + dt.timedelta(days=n)


def fixture(seed, hot):
    r = random.Random(seed)
    birth = lambda: dt.date(1990, 1, 1) if r.random() < hot else (None if r.random() < 0.1 else dt.date(1989, 12, 28) + dt.timedelta(days=r.randrange(9)))
    sex, place = (lambda: r.choice(["M", "F", ""])), (lambda: r.choice(["510001", "510002", None]))
    cases = [(i, r.choice([None, "", str(i % 7), f"n{i}"]), birth(), sex(), place(), day(r.randrange(200))) for i in range(60)]
    exams = []
    for j in range(90):
        d1 = None if r.random() < 0.15 else r.randrange(200)
        d2 = None if r.random() < 0.2 else (d1 if d1 is not None else r.randrange(200)) + r.randrange(-10, 120)
        exams.append((f"e{j:03d}", r.choice([None, "nan", str(j % 9), None, None]), birth(), sex(), place(), day(d1), day(d2)))
    return cases, exams


def brute(cases, exams, floor):
    out = {}
    for cid, num, b, s, p, ev in cases:
        best = None
        for eid, en, eb, es, ep, d1, d2 in exams:
            if num and num not in ("nan", "None") and num == en:
                pts = 100
            else:
                if s != es or not ((b and eb and b.year == eb.year) or (p and ep and p == ep)):
                    continue
                pts = 0
                if b and eb:
                    pts += 45 if b == eb else 30 if abs((b - eb).days) == 1 else 0
                pts += 15 if s else 0
                pts += 25 if p and p == ep else 0
                for d in (d1, d2):
                    if d is not None:
                        gap = abs((ev - d).days)
                        if gap <= 45:
                            pts += 15 if gap <= 15 else 8
                            break
                pts = min(pts, 99)
            if pts >= floor and (best is None or (-pts, eid) < best):
                best = (-pts, eid)
        if best:
            out[cid] = (best[1], -best[0] / 100)
    return out


@pytest.mark.parametrize("seed,hot,floor", [(1, 0.4, 0.55), (2, 0.4, 0.55), (3, 0.0, 0.55), (4, 0.7, 0.75), (5, 0.3, 0.40)])
def test_best_partner(spark, seed, hot, floor):
    cases, exams = fixture(seed, hot)
    c = spark.createDataFrame(cases, "case_id int, notification string, birth_date date, sex string, code6 string, event_date date")
    e = spark.createDataFrame(exams, "exam_id string, notification string, birth_date date, sex string, code6 string, collected_date date, released_date date")
    got = {r["case_id"]: (r["exam_id"], round(r["score"], 2)) for r in L.link_best(c, e, floor).collect()}
    assert got == brute(cases, exams, round(floor * 100))


def test_third_date_counts_where_the_first_two_are_far(spark):
    """Any number of dates: the first one within 45 days gives the points and its name."""
    r = random.Random(9)
    cases = [(i, None, BASE, "M", "510001", day(r.randrange(200))) for i in range(40)]
    pool = [(f"e{j:03d}", None, r.choice([BASE, day(1), day(40)]), r.choice(["M", "F"]), r.choice(["510001", "510002", None]), *[day(r.choice([None, r.randrange(200)])) for _ in range(3)]) for j in range(60)]
    want = {}
    for cid, _, b, s, p, ev in cases:
        best = None
        for eid, _, eb, es, ep, *dates in pool:
            if s != es or not (b.year == eb.year or p == ep):
                continue
            pts, label = 15 + (45 if b == eb else 30 if abs((b - eb).days) == 1 else 0) + (25 if p == ep else 0), None
            for name, d in zip(L.DATES, dates):
                gap = abs((ev - d).days) if d else 99
                if gap <= 45:
                    pts, label = pts + (15 if gap <= 15 else 8), f"{name}_{15 if gap <= 15 else 45}d"
                    break
            pts = min(pts, 99)
            if pts >= 55 and (best is None or (-pts, eid) < best[:2]):
                best = (-pts, eid, label)
        if best:
            want[cid] = (best[1], -best[0] / 100, best[2])
    cols = "notification string, birth_date date, sex string, code6 string"
    c = spark.createDataFrame(cases, f"case_id int, {cols}, event_date date")
    e = spark.createDataFrame(pool, f"exam_id string, {cols}, collected_date date, released_date date, death_date date")
    got = {x["case_id"]: (x["exam_id"], round(x["score"], 2), next((w for w in x["reasons"].split(";") if w.endswith("5d")), None)) for x in L.link_best(c, e).collect()}
    assert got == want and any(v[2] and v[2].startswith("death_date") for v in want.values())


def test_deaths_count_with_evidence_only(spark):
    cols = "notification string, birth_date date, sex string, code6 string"
    born = [dt.date(1950 + i, 3, 1) for i in range(6)]
    c = spark.createDataFrame([(i, str(i), born[i], "F", "510001", day(50), 0) for i in range(6)], f"case_id int, {cols}, event_date date, death int")
    deaths = [("d0", None, born[0], "F", "510001", day(60), "A39.0"), ("d1", None, born[1], "F", "510001", day(60), None), ("d2", "2", None, "", None, None, "I21.0"),
              ("d3", None, born[3], "F", "510001", None, "G00.9"), ("d4", None, born[4], "M", None, day(50), "A39.0"), ("d5a", None, born[5], "F", "510001", day(300), None), ("d5b", None, born[5], "F", "510001", day(60), None)]
    d = spark.createDataFrame(deaths, f"death_id string, {cols}, death_date date, cause string")
    links = L.link_deaths(c, d)
    got = {x["case_id"]: (x["death_id"], round(x["score"], 2), x["death_date"], x["cause"]) for x in links.collect()}
    assert got == {0: ("d0", 0.99, day(60), "A39.0"), 1: ("d1", 0.99, day(60), None), 2: ("d2", 1.0, None, "I21.0"), 3: ("d3", 0.85, None, "G00.9"), 4: ("d0", 0.55, day(60), "A39.0"), 5: ("d5b", 0.99, day(60), None)}
    u = {x["case_id"]: (x["sim_match"], x["death_linked"], x["death_reason"]) for x in L.attach_deaths(c, links).collect()}
    assert u == {0: (1, 1, "data_obito+cid_meningite"), 1: (1, 1, "data_obito"), 2: (1, 0, "match_sem_evidencia_obito"), 3: (1, 1, "cid_meningite"), 4: (0, 0, "sem_match_sim"), 5: (1, 1, "data_obito")}
    s = L.death_summary(L.attach_deaths(c, links)).first()
    assert (s["matches"], s["deaths_linked"], s["matches_without_evidence"], s["deaths_union"]) == (5, 4, 1, 4)
    assert L.link_deaths(c, d.limit(0)).count() == 0 and L.link_deaths(c.limit(0), d).count() == 0


def test_key_rows_grow_with_dates_not_with_days(spark):
    """Dates a few days apart give a row each; before, every day at which only the later one is near was a row."""
    cols = "exam_id string, notification string, birth_date date, sex string, code6 string, collected_date date, released_date date"
    pool = [(f"e{j % 40:03d}", None, BASE, "M", "510001", day(j), day(j + j % 9)) for j in range(50)]
    e = L._ranked(spark.createDataFrame(pool, cols).withColumnRenamed("exam_id", "partner"))
    assert L._partner_rows(e, ["collected_date", "released_date"], ["full"]).count() <= 2 * len(pool)
    ranks = {(r["partner"], r["rank"]) for r in e.collect()}
    assert len(ranks) == 40 and [p for p, _ in sorted(ranks, key=lambda x: x[1])] == sorted(p for p, _ in ranks)
    assert sorted(r["partner"] for r in e.filter("head").collect()) == sorted({p for p, _ in ranks})


def test_weak_keys_are_asked_only_for_open_cases(spark, monkeypatch):
    """A case linked by birth and place within 15 days needs no other key; one that is not still gets its best, by either path."""
    cols = "notification string, birth_date date, sex string, code6 string"
    c = spark.createDataFrame([(1, None, BASE, "M", "510001", day(5)), (2, None, day(1), "M", "510002", day(5)), (3, None, None, "M", "510001", day(5))], f"case_id int, {cols}, event_date date")
    e = spark.createDataFrame([("a", None, BASE, "M", "510001", day(4)), ("b", None, BASE, "M", "510003", day(4))], f"exam_id string, {cols}, collected_date date")
    seen, probe = [], L._probe
    monkeypatch.setattr(L, "_probe", lambda *a: seen.append(probe(*a)) or seen[-1])
    for few in (L._FEW_KEYS, 0):
        monkeypatch.setattr(L, "_FEW_KEYS", few)
        got = {r["case_id"]: (r["exam_id"], round(r["score"], 2), r["reasons"]) for r in L.link_best(c, e).collect()}
        assert got == {1: ("a", 0.99, "birth_date;sex;municipality;collected_date_15d"), 2: ("a", 0.6, "birth_date_near;sex;collected_date_15d"), 3: ("a", 0.55, "sex;municipality;collected_date_15d")}
        assert {r["case_id"] for r in seen[-1].collect()} == {2, 3}


def test_links_leave_neither_partners_nor_shuffles(spark, tmp_path, monkeypatch):
    """Links are stored and the partners of all keys are off the disk; slices of keys give the same links. Before, the
    rows of both sides stayed as they are in memory and every later step carried the shuffles of the whole linkage."""
    import glob

    cases, exams = fixture(7, 0.4)
    c = spark.createDataFrame(cases, "case_id int, notification string, birth_date date, sex string, code6 string, event_date date")
    e = spark.createDataFrame(exams, "exam_id string, notification string, birth_date date, sex string, code6 string, collected_date date, released_date date")
    monkeypatch.setattr("caseflux.operators.filters.shared_folder", lambda _: str(tmp_path))
    for rows in (L._SLICE_ROWS, 30):
        monkeypatch.setattr(L, "_SLICE_ROWS", rows)
        links = L.link_best(c, e)
        assert "Exchange" not in links._jdf.queryExecution().executedPlan().toString()
        assert not any("partner" in spark.read.parquet(f).columns for f in glob.glob(f"{tmp_path}/*"))
        assert {r["case_id"]: (r["exam_id"], round(r["score"], 2)) for r in links.collect()} == brute(cases, exams, 55)


def test_store_keeps_rows_and_settings(spark):
    from caseflux.operators import filters as T

    df = spark.createDataFrame([(1, "a", day(3), None), (None, None, None, 0.5), (1, "a", day(3), None)], "a long, b string, c date, d double")
    before = spark.conf.get(T._DROP_SHUFFLES)
    kept = T.store(df.repartition(3, "a"))
    key = lambda r: tuple(str(x) for x in r)
    assert kept.dtypes == df.dtypes and sorted(kept.collect(), key=key) == sorted(df.collect(), key=key) and spark.conf.get(T._DROP_SHUFFLES) == before
    assert T.store(df.limit(0)).count() == 0
    files = kept.inputFiles()
    T.discard(kept)
    import os
    assert files and not any(os.path.exists(f.replace("file://", "")) for f in files)


def test_a_key_is_one_number_and_links_carry_partner_columns(spark):
    """Keys sent to the tasks are numbers, not four columns; what no case has is still found by its number. A link shows
    the smallest of what the rows of its id carry, without another look at the partners."""
    cols = "notification string, birth_date date, sex string, code6 string"
    c = spark.createDataFrame([(1, None, BASE, "M", "510001", day(5)), (2, "n2", day(400), "F", None, None), (3, None, BASE, None, "510001", day(5)), (4, None, None, "F", "510009", day(5))], f"case_id int, {cols}, event_date date")
    e = spark.createDataFrame([("b", None, BASE, "M", "510001", day(4), "y", None), ("b", None, None, "M", "510001", day(90), "x", "r"), ("c", "n2", BASE, "X", "990000", None, "z", None), ("d", None, day(1), "X", "510001", day(5), "w", None),
                               (None, None, BASE, None, "510001", day(5), "v", None)], f"exam_id string, {cols}, collected_date date, method string, result string")
    plain = c.fillna({"sex": ""})
    probe = L._probe(L._coded(plain, L._codes(plain)), L._kinds(55), L.F.lit(55))
    assert dict(probe.dtypes)["key"] == "bigint" and probe.select("case_id", "key").distinct().count() == probe.count()
    got = {r["case_id"]: (r["exam_id"], round(r["score"], 2), r["method"], r["result"]) for r in L.link_best(c, e, carry=["method", "result"]).collect()}
    assert got == {1: ("b", 0.99, "x", "r"), 2: ("c", 1.0, "z", None)}
    assert {r["case_id"]: r["exam_id"] for r in L.link_best(c, e).collect()} == {1: "b", 2: "c"}


def test_linked_cases_keep_what_is_read(spark, monkeypatch):
    """The case build of a query holds the columns its steps read; before, all of them were derived and stored, and exams a
    second time for method and result."""
    from caseflux.catalog import q_alerts as A
    from caseflux.catalog import q_linkage as Q
    from caseflux.operators import filters as T

    kept, built = [], []
    for m in (A, Q, L):
        monkeypatch.setattr(m, "store", lambda df: kept.append(df.columns) or T.store(df))
    monkeypatch.setattr(Q.V, "exams", lambda s, d, f=Q.V.exams: built.append(1) or f(s, d))
    d = "/root/testdata/sf0.001"
    want = {(r["case_id"], r["lab_match"], r["lab_method"], r["lab_result"]) for r in Q.enriched(spark, d, Q.C.cases(spark, d)).select("case_id", "lab_match", "lab_method", "lab_result").collect()}
    kept.clear()
    got = Q.linked_cases(spark, d)
    assert {(r["case_id"], r["lab_match"], r["lab_method"], r["lab_result"]) for r in got.select("case_id", "lab_match", "lab_method", "lab_result").collect()} == want
    assert all(len(x) <= 12 for x in kept) and set(kept[0]) == set(Q.SIDE)
    kept.clear()
    assert A.queue(spark, d).count() and set(kept[0]) == set(A.QUEUED) and {"symptom_fever_bin", "population"}.isdisjoint(kept[0])


def test_queue_read_by_another_step_is_not_sorted(spark):
    """The day queue and the digest order or count the queue anew: it reaches them whole, without a sort of all rows before.
    Rows of a key are told apart by the key, nulls too, whatever number leads them."""
    from caseflux.operators import alerts as A
    from caseflux.operators.ordering import first_per_key

    cols = "case_id int, municipality string, region string, class_group string, kind string, severity string, evidence string"
    rows = [(1, "a", "ASIA", "x", "k", "Alto", None), (1, "a", "ASIA", "x", "k", "Crítico", None), (2, "b", None, "x", "k", "Atenção", "e"), (2, "b", None, "x", "k", "Atenção", "")]
    t = spark.createDataFrame(rows, cols)
    both = [A.unified_queue(t.limit(0), t, t.limit(0), t, ordered=o) for o in (True, False)]
    plans = [q._jdf.queryExecution().optimizedPlan().toString() for q in both]
    assert "Sort [" in plans[0] and "Sort [" not in plans[1]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(both[0].collect(), key=key) == sorted(both[1].collect(), key=key)
    assert [(r["priority"], r["origin"], r["evidence"]) for r in both[0].collect()] == [("Crítico", "linkage", None), ("Atenção", "linkage", ""), ("Atenção", "linkage", "e")]
    p = spark.createDataFrame([("a", None, 2), ("a", None, 1), (None, "b", 3), (None, "b", 4), ("a", "b", 5)], "x string, y string, z int")
    assert sorted(first_per_key(p, ["x", "y"], [L.F.col("z")]).collect(), key=key) == sorted([("a", None, 1), (None, "b", 3), ("a", "b", 5)], key=key)


def test_status_links_stored_tables(spark, monkeypatch):
    """Rows are counted and linked over the same stored tables; before, cases were derived for each source and the partners
    once to link and once to count them."""
    from caseflux.catalog import load
    from caseflux.catalog import q_linkage as Q
    from caseflux.operators.filters import is_stored

    seen, best = [], L.link_best
    monkeypatch.setattr(L, "link_best", lambda c, e, *a, **k: seen.append((is_stored(c), is_stored(e))) or best(c, e, *a, **k))
    d = "/root/testdata/sf0.001"
    got = {r["source"]: (r["status"], r["rows"], r["matches"]) for r in load()[0]["ag45_linkage_status"](spark, d).collect()}
    assert seen == [(True, True)] * 2 and got["lacen"] == ("AUSENTE", 0, 0)
    assert (got["gal"][1], got["sim"][1]) == (Q.V.exams(spark, d).count(), Q.V.deaths(spark, d).count())
