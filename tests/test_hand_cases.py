"""Hand-computed cases on tiny frames."""
import datetime as dt

from pyspark.sql import functions as F

from caseflux.functions import dates as D
from caseflux.functions import fixed as K
from caseflux.functions import numbers as N
from caseflux.functions import text as X
from caseflux.operators import kpis as P
from caseflux.operators import linkage as L
from caseflux.operators import privacy as V
from caseflux.operators import scope as S

DM, HIB, VIRAL = K.MENINGOCOCCAL, K.HIB, K.VIRAL


def one(df):
    return df.first().asDict()


def vals(spark, expr, values, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


def test_safe_percentage(spark):
    df = spark.createDataFrame([(3, 0), (3, None), (1, 4)], "n int, d int")
    assert [r[0] for r in df.select(N.pct("n", "d")).collect()] == [None, None, 25.0]


def test_csf_timeliness(spark):
    day = dt.date(2024, 1, 1)
    rows = [(x, day) for x in (1, 2, 4, 9)] + [(3, None)]
    df = spark.createDataFrame(rows, "lag_onset_lp int, lp_date date")
    r = one(P.csf_timeliness(df, S.STATE))
    assert (r["with_lag"], r["le_1d"], r["le_2d"], r["p50_days"], round(r["p90_days"], 9)) == (4, 1, 2, 3.0, 7.5)
    none = one(P.csf_timeliness(df.filter("lp_date is null"), S.STATE))
    assert none["with_lag"] == 0 and none["pct_le_1d"] is None


def test_prophylaxis_time(spark):
    df = spark.createDataFrame([(DM, 1), (DM, 5), (HIB, 2), (VIRAL, 1)], "class_group string, lag_notif_proph int")
    r = one(P.prophylaxis_time(df, S.STATE))
    assert (r["eligible"], r["le_2d"], r["p50_days"]) == (3, 2, 2.0)
    assert round(r["pct_le_2d_eligible"], 2) == 66.67


def test_serogroup_coverage(spark):
    df = spark.createDataFrame([(DM, 1, "C"), (DM, 1, "Ignorado"), (DM, 0, "B")], "class_group string, confirmed int, serogroup_raw string")
    r = one(P.serogroup_coverage(df, S.STATE))
    assert (r["dm_confirmed"], r["serogroup_known"], r["pct_serogroup"]) == (2, 1, 50.0)


def test_contacts(spark):
    df = spark.createDataFrame([(DM, 0), (DM, 5), (DM, 9), (DM, None), (VIRAL, 40)], "class_group string, contacts int")
    r = one(P.contacts_per_case(df, S.STATE))
    assert (r["pct_zero_or_unknown"], r["p50_contacts"]) == (50.0, 5.0)


def test_denominator(spark):
    df = spark.createDataFrame([(True,), (False,), (False,), (False,)], "has_denominator boolean")
    assert one(P.no_denominator(df, S.STATE))["pct_without"] == 75.0
    y = spark.createDataFrame([(2019, False)] * 2 + [(2024, True)] * 3, "event_year int, has_denominator boolean")
    got = {r["event_year"]: r["status"] for r in P.denominator_by_year(y).collect()}
    assert got == {2019: "sem_denominador", 2024: "denominador_real_ibge"}


def test_detection(spark):
    df = spark.createDataFrame([(x,) for x in (0, 1, 4, 10, -3, None)], "lag_onset_notif int")
    r = one(P.detection_time(df, S.STATE))
    assert (r["with_lag"], r["pct_le_1d"], r["p50_days"]) == (4, 50.0, 2.5)


def test_completeness(spark):
    df = spark.createDataFrame([("a", "x"), ("ignorado", "y")], "half string, full string")
    r = one(P.completeness(df, ["full", "half"], S.STATE))
    assert (r["pct_mean"], r["worst_field"], r["pct_worst"]) == (75.0, "half", 50.0)


def test_standardised_fatality(spark):
    rows = [("M", "young", 1, 1 if i < 5 else 0) for i in range(10)] + [("M", "old", 1, 0) for _ in range(10)]
    df = spark.createDataFrame(rows, "municipality string, age_band string, confirmed int, death int").withColumn("region", F.lit("R"))
    w = spark.createDataFrame([("young", 0.2), ("old", 0.8)], "age_band string, weight double")
    r = one(P.standardized_fatality(df, weights=w, scopes=S.STATE))
    assert (round(r["pct_crude"], 6), round(r["pct_standardized"], 6), round(r["pct_weight_covered"], 6)) == (25.0, 10.0, 100.0)
    part = spark.createDataFrame([("young", 0.5)], "age_band string, weight double")
    r = one(P.standardized_fatality(df, weights=part, scopes=S.STATE))
    assert (round(r["pct_standardized"], 6), round(r["pct_weight_covered"], 6), r["strata_with_cases"]) == (50.0, 50.0, 1)


def test_scope_rollup_rows(spark):
    df = spark.createDataFrame([("A", 2020), ("A", 2021), ("B", 2020)], "region string, event_year int")
    got = {(r["scope"], r["slice"]): r["n"] for r in S.by_scope(df, {"n": F.lit(1)}).collect()}
    assert got == {("STATE", "ALL"): 3, ("REGION", "A"): 2, ("REGION", "B"): 1, ("YEAR", "2020"): 2, ("YEAR", "2021"): 1}


def test_icd(spark):
    yes = ["A39.0", "G00.9 Meningite bacteriana", "A87", "G03.9", "A17.0", "b37.5"]
    no = ["", None, "I21.0", "C34.9", "ignorado", "J18.9"]
    assert vals(spark, X.icd_match, yes) == [True] * 6 and vals(spark, X.icd_match, no) == [False] * 6


def test_death_evidence(spark):
    rows = [(1, "A39.0", "2024-03-10"), (1, "", "2024-05-02"), (1, "I21.0", None), (1, "G00.9", None), (0, "A39.0", "2024-01-01")]
    df = spark.createDataFrame([(i, *r, 0) for i, r in enumerate(rows)], "i int, sim_match int, sim_icd string, d string, death int").withColumn("sim_death_date", F.to_date("d"))
    got = L.death_union(df).orderBy("i").collect()
    assert [r["death_linked"] for r in got] == [1, 1, 0, 1, 0]
    assert [r["death_reason"] for r in got] == ["data_obito+cid_meningite", "data_obito", "match_sem_evidencia_obito", "cid_meningite", "sem_match_sim"]


def test_lab_text(spark):
    t = spark.createDataFrame([("Grupo – Neisseria meningitidis: B | Neisseria meningitidis: Detectável",),
                               ("Neisseria meningitidis: Não Detectável | Haemophilus influenzae: Não Detectável",)], "t string")
    a, b = t.select(*[c.alias(n) for n, c in X.parse_lab_text("t").items()]).collect()
    assert (a["lab_serogroup"], a["nm_detected"], a["lab_positive"]) == ("B", 1, 1)
    assert (b["nm_not_detected"], b["nm_detected"], b["lab_positive"]) == (1, 0, 0)


def test_lab_code_negatives_first(spark):
    assert vals(spark, X.lab_code, ["NAO DETECTADO", "Detectado", "2 - Negativo", "3", "9", None, "Inconclusivo"]) == [0, 1, 0, 2, None, None, 2]


def test_facility_level(spark):
    assert vals(spark, X.facility_level, ["CENTRO DE SAUDE/UNIDADE BASICA", "HOSPITAL GERAL", "FARMACIA", None]) == [
        "Atenção básica", "Alta complexidade / hospitalar", "Outros / intermediário", "Sem informação"]


def test_pii_policy():
    p = V.pii_policy(["NomePaciente", "NumeroCartaoSUS", "DataNascimento", "municipio_v17", "ContatoComCasoSuspeitoOuConfirmadoDeMeningite", "id_caso"])
    assert list(p.values()) == ["drop", "drop", "drop", "keep", "keep", "pseudonym"]


def test_pseudonym_and_redaction(spark):
    df = spark.createDataFrame([(382408, "JACIARA | caso 2365377", "Caso aberto há 6915 dia(s) (meta =60)", "x caso 23653779 y caso 2365377abc")],
                               "id_caso int, territorio string, evidencia string, nota string")
    r = V.sanitize(df, "s").first()
    code = df.select(V.pseudonym(F.lit("2365377"), "s")).first()[0]
    assert len(r["id_caso"]) == 69 and "382408" not in r["id_caso"]
    assert r["territorio"] == f"JACIARA | {code}" and "6915" in r["evidencia"]
    assert r["nota"].endswith("caso 2365377abc") and "23653779" not in r["nota"]
    assert df.select(V.pseudonym(F.lit(None), "s")).first()[0] == ""


def test_dates(spark):
    got = vals(spark, D.parse_date, ["2026-06-12", "12/06/2026", "2026-06-12 10:00:00", "31/02/2024", "ignorado", None])
    assert got == [dt.date(2026, 6, 12)] * 3 + [None] * 3
    day = spark.createDataFrame([("2021-01-03",)], "d string").select(F.to_date("d").alias("d"))
    assert day.select(D.iso_year("d"), D.iso_week("d"), D.period_label(D.iso_year("d"), D.iso_week("d"))).first() == (2020, 53, "2020-S53")


def test_codes(spark):
    assert vals(spark, X.code6, ["5103403", "510340", "51034", None, "MT-5103403"]) == ["510340", "510340", None, None, "510340"]
    assert vals(spark, lambda c: X.class_group(c), ["01", "1.0", "10,0", "viral", "xyz", None, "Ignorado"]) == [
        DM, DM, K.PNEUMOCOCCAL, VIRAL, K.OTHER, K.BLANK_LABEL, K.BLANK_LABEL]
    assert vals(spark, X.serogroup, ["W135", "Neisseria B", "ignorado", None, "x"]) == ["W", "B", "Não informado", "Não informado", "X"]
    assert vals(spark, X.age_years, ["010a", "006m", "073d", "x"]) == [10.0, 0.5, 0.2, None]
    assert vals(spark, lambda c: X.fmt_num(c), [1234567.0, 2.25, None], "double")[0::2] == ["1.234.567", "NA"]


def test_string_and_column_arguments_agree(spark):
    df = spark.createDataFrame([(" Não ",), ("Ignorado",), ("1.0",), (None,), ("São João - 5103403",)], "v string")
    for f in (X.text_key, X.is_missing, X.yesno, X.code6, X.plain_code):
        a, b = df.select(f("v")).collect(), df.select(f(F.col("v"))).collect()
        assert a == b, f.__name__


def test_one_field_does_not_hide_another(spark):
    t = spark.createDataFrame([("Neisseria meningitidis: Não Detectável | Haemophilus influenzae: Detectável",), ("Microrganismo isolado: Streptococcus | Não detectável",),
                               ("Microrganismo isolado: não isolado",), ("Houve crescimento de microbiota habitual",), (None,)], "t string")
    got = [(r["nm_not_detected"], r["hi_detected"], r["lab_positive"]) for r in t.select(*[c.alias(n) for n, c in X.parse_lab_text("t").items()]).collect()]
    assert got == [(1, 1, 1), (0, 0, 1), (0, 0, 0), (0, 0, 0), (0, 0, 0)]


def test_late_byte_decides_the_encoding(spark, tmp_path):
    from caseflux.sources import readers as R

    (tmp_path / "a.csv").write_bytes(b"id;nome\n" + b"1;ana\n" * 30 + "2;São João\n".encode("latin-1"))
    got = R.read_delimited(spark, str(tmp_path / "a.csv")).filter("id = '2'").first()
    assert got["nome"] == "São João"


def test_codes_of_many_ids_stay_apart(spark):
    assert spark.range(200000).select(V.pseudonym("id", "s").alias("c")).distinct().count() == 200000


def test_chi_square_tail_at_large_degrees_of_freedom(spark):
    from caseflux.operators.stats import _chi2_udf

    t = spark.createDataFrame([(float(k), k) for k in (1480, 1500, 5569)] + [(3.841459, 1), (9.487729, 4), (0.0, 3)], "x double, k int")
    got = [r[0] for r in t.select(_chi2_udf()("x", "k")).collect()]
    assert all(0.49 < p < 0.51 for p in got[:3]) and abs(got[3] - 0.05) < 1e-6 and abs(got[4] - 0.05) < 1e-6 and got[5] == 1.0


def test_equal_headings_keep_their_chunks(spark):
    from caseflux.operators import corpus as C

    d = spark.createDataFrame([(1, "Doc", "guia/x.md", "# Nota\nprimeiro texto\n# Nota\nsegundo texto")], "doc_id int, doc_title string, path string, text string")
    m = C.chunk_meta(C.chunks(C.sections(d)))
    assert C.kb_union(m.withColumn("origin", F.lit("docs"))).count() == m.count() == 2


def test_digest_counts_the_whole_queue(spark):
    from caseflux.operators import alerts as A
    from caseflux.operators import digest as G

    case = "case_id long, municipality string, region string, class_group string, kind string, severity string, evidence string, action string, deadline string, norm string"
    many = spark.range(900).selectExpr("id as case_id", "'m' as municipality", "'r' as region", "'c' as class_group", "concat('k', id) as kind", "'Alto' as severity", "'e' as evidence", "'a' as action", "'d' as deadline", "'n' as norm")
    none = spark.createDataFrame([], case)
    r = G.digest_index(A.unified_queue(none, many, none, none)).filter("profile = 'regional'").first()
    assert r["items"] == r["critical_items"] == 900 and len(r["lines"].split("\n")) == 15


def test_fields_of_a_result_are_cut_once_per_row(spark):
    """Before, every flag cut and normalised the whole text again."""
    from caseflux.operators import lab as LB

    rows = [("e1", "1", "Neisseria PCR", "RT-PCR", "Resultado Liberado", "Neisseria meningitidis: Detectável", "Grupo – Neisseria meningitidis: B"), ("e2", None, "Neisseria PCR", "Látex", None, "Neisseria meningitidis: Não detectável", None),
            ("e3", "3", "LCR - cultura", "Cultura", "Em análise", "Germe isolado: Haemophilus influenzae; Microbiota habitual", None)]
    e = spark.createDataFrame(rows, "exam_id string, notification string, exam string, method string, exam_status string, f1 string, f2 string").selectExpr("*", "DATE'2020-01-01' AS collected_date", "DATE'2020-01-03' AS released_date")
    got = LB.prepare_exams(e, ["f1", "f2"])
    flags = {r["exam_id"]: (r["nm_detected"], r["nm_not_detected"], r["lab_serogroup"], r["lab_positive"]) for r in got.collect()}
    assert flags == {"e1": (1, 0, "B", 1), "e2": (0, 1, "", 0), "e3": (0, 0, "", 1)}
    plan = got.groupBy("nm_detected", "nm_not_detected", "hi_detected", "lab_serogroup", "lab_positive").count()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_plain_text_and_words_without_a_replacement_per_gap(spark):
    """The same text as by replacing every gap; the words of a chunk come from one pass without replacements."""
    from caseflux.operators import corpus as T

    texts = ["", None, "Ação: Vírus—isolado!", "  \tÉ a b\n\nabcd  efgh, 12345;", "...", "x...", "...abcd\n", "ﬁm ßtraße Σίσυφος été", "a b abcd efgh", "\x0babcd\x0c.efgh"]
    t = spark.createDataFrame([(x,) for x in texts], "t string")
    old = F.trim(F.regexp_replace(T.folded("t"), "[^a-z0-9\\s]+", " "))
    got = t.select(T.plain("t").alias("new"), old.alias("old"), F.regexp_extract_all(T.folded("t"), F.lit("[a-z0-9]{4,}"), F.lit(0)).alias("w"), F.filter(F.split(old, "\\s+"), lambda w: F.length(w) > 3).alias("ow")).collect()
    assert all(r["new"] == r["old"] and r["w"] == r["ow"] for r in got)
    c = spark.createDataFrame([(1, 0, "intro", 1, "Vacina: vacina, dose única", "Guia", "guia/x.md")], "doc_id int, section_no int, section string, chunk_no int, chunk string, doc_title string, path string")
    m = T.chunk_meta(c)
    assert m.first()["tags"] == "guia vacina dose unica"
    assert "regexp_replace" not in m.select("tags")._jdf.queryExecution().optimizedPlan().toString().split("\\p{M}")[-1]
