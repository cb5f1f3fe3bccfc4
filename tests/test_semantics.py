"""NULL keys, calendar edges, determinism, text operators and statistics."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseflux.operators import alerts as A
from caseflux.operators import corpus as C
from caseflux.operators import forecast as P
from caseflux.operators import joins as J
from caseflux.operators import nowcast as N
from caseflux.operators import ordering as O
from caseflux.operators import rates as R
from caseflux.operators import series as T
from caseflux.operators import spatial as G
from caseflux.operators import stats as S


def test_null_keys_match_in_baseline_join(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, v int")
    b = spark.createDataFrame([(None, 10), ("y", 20)], "k string, w int")
    assert sorted(J.null_safe_left(a, b, ["k"]).collect(), key=str) == sorted([(None, 1, 10), ("x", 2, None)], key=str)


def test_null_keys_are_dropped_from_rates(spark):
    df = spark.createDataFrame([("a", 1, 1, 0, 0, 10), (None, 1, 1, 0, 0, 10)], "code6 string, case_n int, confirmed int, hospitalised int, death int, population int")
    assert [r["code6"] for r in R.rates(df, ["code6"]).collect()] == ["a"]


def test_fill_stays_inside_the_key(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, None), ("b", 1, None)], "k string, t int, v int")
    got = {(r["k"], r["t"]): r["v"] for r in T.fill_gaps(df, ["k"], "t", "v").collect()}
    assert got == {("a", 1): 5, ("a", 2): 5, ("a", 3): 5, ("b", 1): None}


def test_week_53_is_kept(spark):
    days = [dt.date(2020, 12, 21), dt.date(2020, 12, 31), dt.date(2021, 1, 12)]
    df = spark.createDataFrame([(d,) for d in days], "event_date date")
    w = T.fill_weeks(T.weekly_counts(df))
    assert [(r["period"], r["y"]) for r in w.orderBy("monday").collect()] == [("2020-S52", 1), ("2020-S53", 1), ("2021-S01", 0), ("2021-S02", 1)]


def test_average_rank(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (4.0,)], "v double")
    assert sorted(r[0] for r in df.select(T.pct_rank("v")).collect()) == [0.25, 0.625, 0.625, 1.0]


def test_first_per_key_is_ordered(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z")], "k string, o int, v string")
    got = sorted(tuple(r) for r in O.first_per_key(df, ["k"], [F.col("o")]).collect())
    assert got == [("a", 1, "y"), ("b", 3, "z")]


def test_region_from_text_prefers_the_longest_name(spark):
    p = spark.createDataFrame([("Porto", "R1"), ("Porto Alegre do Norte", "R2"), ("Rio", "R3")], "place string, region string")
    t = spark.createDataFrame([(1, "fila PORTO ALEGRE DO NORTE | caso 1"), (2, "xportoy"), (3, "nada"), (4, "Rio")], "id int, t string")
    got = {r["id"]: r["region_found"] for r in J.region_from_text(t, p, "t", "id").collect()}
    assert got == {1: "R2", 2: "R1", 3: None, 4: "R3"}


def test_fisher_and_chi_square_textbook_values(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] * 1 + [(0, 1)] * 1 + [(0, 0)] * 3
    df = spark.createDataFrame(rows, "x int, y int")
    r = S.odds_ratio(S.two_by_two(df, ["x"], ["y"], n_min=1)).first()
    assert r["odds_ratio"] == 9.0 and round(r["p_value"], 6) == 0.485714
    big = spark.createDataFrame([(1, 1, 10), (1, 0, 20), (0, 1, 30), (0, 0, 40)], "x int, y int, n int").select("x", "y", F.explode(F.sequence(F.lit(1), "n")))
    c = S.chi2(big, ["x"], ["y"]).first()
    assert round(c["chi2"], 6) == 0.446429 and round(c["p_value"], 4) == 0.5040 and c["dof"] == 1


def test_zero_cell_gets_half(spark):
    t = spark.createDataFrame([(5, 0, 3, 4)], "a long, b long, c long, d long")
    r = S.odds_ratio(t, p_value=False).first()
    assert round(r["odds_ratio"], 6) == round((5.5 * 4.5) / (0.5 * 3.5), 6)


def grid(spark, n=5):
    pts = [(f"u{i}{j}", float(i + a), float(j + b)) for i in range(n) for j in range(n) for a, b in ((0, 0), (1, 0), (1, 1), (0, 1))]
    return spark.createDataFrame(pts, "code string, x double, y double")


def test_moran_sign_and_independence_of_partitioning(spark):
    edges = G.contiguity(grid(spark))
    v = spark.createDataFrame([(f"u{i}{j}", float(i)) for i in range(5) for j in range(5)], "unit string, y double")
    a = G.morans_i(v, edges, 99).first()
    b = G.morans_i(v.repartition(7), edges.repartition(3), 99).first()
    assert a["moran_i"] > 0.5 and a["p_value"] <= 0.02
    assert round(a["moran_i"], 12) == round(b["moran_i"], 12) and a["p_value"] == b["p_value"]


def test_delay_fallback_and_band(spark):
    h = spark.createDataFrame([("a", d, n) for d, n in ((0, 60), (1, 30), (2, 10))], "stratum string, delay int, n long")
    strata = spark.createDataFrame([("a",), ("b",)], "stratum string")
    cdf = {(r["stratum"], r["delay"]): round(r["cdf"], 4) for r in N.delay_cdf(h, strata, ["stratum"], max_delay=2).collect()}
    assert cdf[("a", 0)] == 0.6 and cdf[("a", 2)] == 1.0 and cdf[("b", 0)] == 0.35
    nc = spark.createDataFrame([("a", dt.date(2024, 1, 1), 12.0, 0, 0.6, 20.0)], "stratum string, monday date, observed double, delay int, p_reported double, nowcast double")
    r = N.nowcast_band(nc, h, ["stratum"]).first()
    # a resampled share is close to Binomial(100, 0.6) / 100: sd 0.049, P10 0.537, P90 0.663
    assert abs(12 / r["nowcast_p90"] - 0.537) < 0.02 and abs(12 / r["nowcast_p10"] - 0.663) < 0.02
    few = N.nowcast_band(nc, h.filter("delay = 2"), ["stratum"]).first()
    assert (few["nowcast_p10"], few["nowcast_p90"]) == (17.0, 25.0)


def test_forecast_of_a_constant_series(spark):
    w = spark.createDataFrame([("s", dt.date(2024, 1, 1) + dt.timedelta(days=7 * i), 4.0) for i in range(60)], "stratum string, monday date, y double")
    f = P.forecast_weekly(w, 3).orderBy("horizon").collect()
    assert [round(r["pred"], 9) for r in f] == [4.0] * 3 and all(abs(r["upper_80"] - 4) < 1e-6 for r in f)
    assert P.backtest_summary(P.backtest(w)).first()["quality"] == "publicavel"


def test_sections_and_chunks_cover_the_text(spark):
    body = " ".join(f"palavra{i}" for i in range(1500))
    d = spark.createDataFrame([(1, f"antes\n# Um Título\n{body}\n3.1. DEFINIÇÃO DE CASO\nfim\n")], "doc_id int, text string")
    s = C.sections(d).orderBy("section_no").collect()
    assert [(r["section"]) for r in s] == ["intro", "Um Título", "3.1. DEFINIÇÃO DE CASO"]
    ch = C.chunks(C.sections(d)).filter("section = 'Um Título'").orderBy("chunk_no").collect()
    assert all(len(r["chunk"]) <= 900 for r in ch)
    words = set()
    for r in ch:
        words |= set(r["chunk"].split())
    assert {f"palavra{i}" for i in range(1500)} <= words


def test_tokens(spark):
    got = set(spark.createDataFrame([("A quimioprofilaxia da NT 154 e os casos",)], "t string").select(C.tokens("t")).first()[0])
    assert {"quimioprofilaxia", "quimioprofilaxias", "nt154", "154", "casos", "caso"} == got


def test_retrieve_falls_back_to_priority(spark):
    docs = spark.createDataFrame([("a", "vacina", "", "", "contatos", True, 50, "docs"), ("b", "outra", "", "", "nada", True, 90, "docs")],
                                 "id string, title string, tags string, theme string, text string, in_force boolean, priority int, origin string")
    q = C.faq_batch(["vacina dos contatos"], spark)
    got = [(r["id"], round(r["score"], 4)) for r in C.retrieve(q, docs, 2).orderBy(F.col("score").desc()).collect()]
    assert got[0][0] == "a" and got[1] == ("b", 0.09)


def test_timeline_statuses(spark):
    d = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(1, "Doença meningocócica", d, d, None, d, d, d, 1, None, -1, 5, 70)],
                               "case_id int, class_group string, onset_date date, notified_date date, investigated_date date, lp_date date, prophylaxis_date date, closed_date date, "
                               "lag_onset_notif int, lag_notif_invest int, lag_onset_lp int, lag_notif_proph int, lag_notif_close int")
    got = [r["status"] for r in A.case_timeline(df).orderBy("step").collect()]
    assert got == ["Registrado", "No prazo", "Sem registro", "Data inconsistente", "Fora do prazo", "Fora do prazo"]


@pytest.mark.parametrize("now,light", [(10, "Vermelho"), (0, "Amarelo")])
def test_change_of_zero(spark, now, light):
    from caseflux.functions import numbers as Nn

    r = spark.createDataFrame([(now, 5 if now else 0)], "a int, b int").select(Nn.light_change(Nn.pct_change("a", "b"))).first()[0]
    assert r == light


def test_chunks_of_a_very_long_text(spark):
    """Ten million characters without and with breaks, beyond the basic plane too, in seconds; ends where it should."""
    long = ("x" * 700 + " ") * 14_000
    rows = [(1, long), (2, "y" * 2_000), (3, "😀 " * 1_000), (4, None), (5, " \n "), (6, "a" * 500 + "\n\n" + "b" * 300 + " " + "c" * 400)]
    got = {}
    for r in C.chunks(spark.createDataFrame(rows, "id int, body string"), "body").orderBy("id", "chunk_no").collect():
        got.setdefault(r["id"], []).append(r["chunk"])
    assert set(got) == {1, 2, 3, 6}
    assert len(got[1]) == 14_000 and all(len(c) <= 900 for c in got[1]) and got[1][0] == "x" * 700
    assert [len(c) for c in got[2]] == [900, 900, 440]
    assert all(set(c) <= {"😀", " "} for c in got[3])
    assert got[6][0] == "a" * 500 and got[6][1].startswith("a" * 120 + "\n\n" + "b" * 300)


def test_spread_only_where_there_are_few_splits(spark, tmp_path):
    from caseflux.sources.readers import spread

    spark.range(100).coalesce(1).write.parquet(str(tmp_path / "one"))
    spark.range(100).repartition(8).write.parquet(str(tmp_path / "many"))
    one, many = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "many"))
    assert sorted(r["id"] for r in spread(one, "id").collect()) == list(range(100))
    plan = lambda df: df._jdf.queryExecution().toString()
    assert "Repartition" in plan(spread(one, "id"))
    spark.conf.set("spark.sql.files.openCostInBytes", "200000000")
    try:
        assert "Repartition" not in plan(spread(many, "id"))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_region_from_text_equals_brute_force(spark):
    """Names of one to four words that share beginnings and stand inside words; empty, null and very long texts, hot words."""
    import random

    r = random.Random(11)
    word = lambda: "".join(r.choice("AB") for _ in range(r.randint(1, 3)))
    names = sorted({" ".join(word() for _ in range(r.randint(1, 4))) for _ in range(40)} | {"SÃO JOSÉ", "SÃO JOSÉ DO RIO", "C  A", "😀X"})
    texts = [" ".join(word() for _ in range(r.randint(1, 7))).lower() for _ in range(120)] + ["", None, "  ", "vila são josé do riozinho", "c  ab", "b😀x", "c\na"]
    texts += ["z" * 200_000 + "são josé", "q " * 20_000 + "ab", *["fila c d"] * 50]
    p = spark.createDataFrame([(n.lower() + " ", f"R{i}") for i, n in enumerate(names)] + [("", "none"), (None, "none")], "place string, region string")
    got = {x["id"]: x["place"] for x in J.region_from_text(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), p, "t", "id").collect()}
    want = {i: max(((len(n), n) for n in names if n in (t or "").upper()), default=(0, None))[1] for i, t in enumerate(texts)}
    assert got == want


def test_region_from_text_without_places(spark):
    p = spark.createDataFrame([], "place string, region string")
    assert [x["region_found"] for x in J.region_from_text(spark.createDataFrame([(1, "Rio")], "id int, t string"), p, "t", "id").collect()] == [None]
