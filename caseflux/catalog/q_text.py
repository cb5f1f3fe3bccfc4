"""Corpus, privacy, sources and sinks (TX1-TX11, SRC1-SRC21)."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.fixed import STOP_WORDS
from ..operators import corpus as T
from ..operators import digest as G
from ..operators import kpis as KP
from ..operators import privacy as V
from ..operators import scope as S
from ..plans import cases as C
from ..sources import readers as R
from ..sources import reference as Z
from .q_expressions import CASES
from .q_indicators import _DET, scope_sql
from .registry import query

# ---- text ------------------------------------------------------------------------------------

_HEADED = "concat('Preâmbulo ', source, chr(10), '# Fonte ', source, chr(10), text, chr(10), '2.1. Conclusão do texto', chr(10), text, chr(10), 'DADOS GERAIS DA FICHA', chr(10), lang)"
SECT = f"""WITH t AS (SELECT doc_id, regexp_replace({_HEADED}, '\\r\\n', chr(10), 'g') AS t FROM documents),
m1 AS (SELECT doc_id, regexp_replace(t, '(?m)^[ \\t]*#+[ \\t]+(\\S[^\\n]*)$', chr(1) || '\\1' || chr(2), 'g') AS t FROM t),
m2 AS (SELECT doc_id, regexp_replace(t, '(?m)^[ \\t]*([0-9]+(?:\\.[0-9]+)*\\.?)[ \\t]+(\\p{{Lu}}[^\\n]{{2,{T.TITLE_MAX}}})$', chr(1) || '\\1 \\2' || chr(2), 'g') AS t FROM m1),
m3 AS (SELECT doc_id, regexp_replace(t, '(?m)^[ \\t]*(\\p{{Lu}}[\\p{{Lu}}0-9 \\t/-]{{{T.CAPS_MIN - 1},}})$', chr(1) || chr(3) || '\\1' || chr(2), 'g') AS t FROM m2),
p AS (SELECT doc_id, unnest(string_split(t, chr(1))) AS p, generate_subscripts(string_split(t, chr(1)), 1) AS i FROM m3),
q AS (SELECT doc_id, i, CASE WHEN contains(p, chr(2)) THEN string_split(p, chr(2))[1] ELSE 'intro' END AS title, regexp_replace(CASE WHEN contains(p, chr(2)) THEN substr(p, instr(p, chr(2)) + 1) ELSE p END, '^\\s+|\\s+$', '', 'g') AS body FROM p),
s AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS section_no, title, body FROM q WHERE body <> '')"""


def documents(s, d):
    return R.spread(C.table(s, d, "documents"), "doc_id")


def headed(s, d):
    nl = F.lit("\n")
    return documents(s, d).select("doc_id", "source", "lang", F.concat(
        F.lit("Preâmbulo "), "source", nl, F.lit("# Fonte "), "source", nl, "text", nl, F.lit("2.1. Conclusão do texto"), nl, "text", nl, F.lit("DADOS GERAIS DA FICHA"), nl, "lang").alias("text"))


@query("tx01_sections", SECT + """ SELECT doc_id, CAST(section_no AS INTEGER) AS section_no, lower(replace(title, chr(3), '')) AS section, md5(body) AS body_md5 FROM s""")
def _(s, d):
    return T.sections(headed(s, d)).select("doc_id", "section_no", F.lower("section").alias("section"), F.md5("body").alias("body_md5"))


_CHUNK = r"""ct AS (SELECT k, regexp_replace(regexp_replace(body, '\n{3,}', chr(10) || chr(10), 'g'), '^\s+|\s+$', '', 'g') AS t FROM (SOURCE)),
c AS (SELECT k, 0 AS a, CAST(0 AS BIGINT) AS e, 0 AS r, false AS f FROM ct WHERE t <> '' UNION ALL
  SELECT k, CAST(i AS INTEGER), CAST(CASE WHEN n <= 900 THEN n ELSE e2 END AS BIGINT), r + 1, CASE WHEN n <= 900 THEN true ELSE e2 >= n END FROM (
    SELECT *, CASE WHEN hard < n THEN CASE WHEN pa > i THEN pa WHEN spc > i THEN spc ELSE hard END ELSE hard END AS e2 FROM (
      SELECT *, CASE WHEN instr(rw, chr(10) || chr(10)) > 0 THEN i + 900 - instr(rw, chr(10) || chr(10)) - 1 ELSE -1 END AS pa, CASE WHEN instr(rw, ' ') > 0 THEN i + 900 - instr(rw, ' ') ELSE -1 END AS spc FROM (
        SELECT *, least(n, i + 900) AS hard, reverse(substr(t, CAST(i AS BIGINT) + 451, 450)) AS rw FROM (
          SELECT c.k, ct.t, length(ct.t) AS n, CASE WHEN r = 0 THEN 0 ELSE greatest(e - 120, a + 1) END AS i, r, f FROM c JOIN ct ON ct.k = c.k WHERE NOT f))))),
o AS (SELECT c.k, r, regexp_replace(substr(t, a + 1, e - a), '^\s+|\s+$', '', 'g') AS chunk FROM c JOIN ct ON ct.k = c.k WHERE r > 0),
ch AS (SELECT k, CAST(row_number() OVER (PARTITION BY k ORDER BY r) AS INTEGER) AS chunk_no, chunk FROM o WHERE chunk <> '')"""


def chunk_ctes(source: str) -> str:
    """CTEs up to ch(k, chunk_no, chunk) for rows (k, body)."""
    return _CHUNK.replace("SOURCE", source)


@query("tx02_chunks", "WITH RECURSIVE " + chunk_ctes("SELECT doc_id AS k, text AS body FROM documents") + " SELECT k AS doc_id, chunk_no, md5(chunk) AS chunk_md5, length(chunk) AS n FROM ch")
def _(s, d):
    return T.chunks(documents(s, d).select("doc_id", "text"), "text").select("doc_id", "chunk_no", F.md5("chunk").alias("chunk_md5"), F.length("chunk").alias("n"))


THEMES = (("guia", "vigilancia"), ("caderno", "notificacao"))


def chunk_rows(s, d):
    c = T.chunks(T.sections(headed(s, d)))
    return T.chunk_meta(c.withColumns({"doc_title": F.col("source"), "path": F.concat(F.when(F.col("lang") == "fr", "historico/").otherwise("guia/"), "source", F.lit(".md"))}), themes=THEMES)


def plain_sql(c: str) -> str:
    return f"trim(regexp_replace(lower(strip_accents({c})), '[^a-z0-9\\s]+', ' ', 'g'))"


_INITCAP = "array_to_string(list_transform(string_split(lower(x), ' '), lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')"


@query("tx03_chunk_meta", SECT.replace("WITH t AS", "WITH RECURSIVE t AS", 1) + ", sk AS (SELECT doc_id * 1000000 + section_no AS k, doc_id, section_no, CASE WHEN starts_with(title, chr(3)) THEN "
       + _INITCAP.replace("(x)", "(trim(substr(title, 2)))") + " ELSE trim(title) END AS section, body FROM s), " + chunk_ctes("SELECT k, body FROM sk") + f""",
j AS (SELECT ch.*, sk.doc_id, section_no, section, lang = 'fr' AS old, CASE WHEN section IN ('intro', 'documento') THEN source ELSE source || ' — ' || section END AS title FROM ch JOIN sk USING (k) JOIN documents d ON d.doc_id = sk.doc_id),
w AS (SELECT *, array_to_string(list_filter(string_split_regex({plain_sql("title || ' ' || chunk")}, '\\s+'), lambda w: length(w) > 3), ' ') AS raw FROM j),
u AS (SELECT *, CASE WHEN raw = '' THEN '' ELSE array_to_string(list_transform(list_sort(list_transform(list_distinct(string_split(raw, ' ')), lambda w: {{'i': list_position(string_split(raw, ' '), w), 'w': w}})), lambda x: x.w), ' ') END AS words FROM w)
SELECT 'doc_' || doc_id || '__' || section_no || '__' || regexp_replace(CASE WHEN {plain_sql('section')} = '' THEN 'sec' ELSE regexp_replace({plain_sql('section')}, '\\s+', '_', 'g') END, '^_+|_+$', '', 'g') || '__' || chunk_no AS id,
  title, CASE WHEN old THEN 'docs' ELSE 'vigilancia' END AS theme, NOT old AS in_force, CASE WHEN old THEN 10 ELSE 50 END AS priority, md5(trim(CASE WHEN old THEN 'historico ' ELSE '' END || words)) AS tags_md5, md5(chunk) AS text_md5 FROM u""")
def _(s, d):
    return chunk_rows(s, d).select("id", "title", "theme", "in_force", "priority", F.md5("tags").alias("tags_md5"), F.md5("text").alias("text_md5"))


_STOP = "['" + "', '".join(STOP_WORDS) + "']"


def tok_sql(c: str) -> str:
    p = f"trim(regexp_replace(lower(strip_accents({c})), '[^a-z0-9\\s]+', ' ', 'g'))"
    w = f"list_filter(string_split_regex({p}, '\\s+'), lambda w: NOT list_contains({_STOP}, w) AND w <> '' AND (length(w) > 2 OR regexp_matches(w, '^\\d+$')))"
    f = f"flatten(list_transform({w}, lambda w: CASE WHEN right(w, 1) = 's' AND length(w) > 4 THEN [w, left(w, length(w) - 1)] WHEN regexp_matches(w, '^\\d+$') THEN [w] ELSE [w, w || 's'] END))"
    return f"list_distinct({f})"


@query("tx04_tokens", f"SELECT conv_id, turn, CAST(len(k) AS INTEGER) AS n, md5(array_to_string(list_sort(k), ' ')) AS tokens_md5 FROM (SELECT conv_id, turn, {tok_sql('text')} AS k FROM conversations)")
def _(s, d):
    k = T.tokens("text")
    return R.spread(C.table(s, d, "conversations"), "conv_id", "turn").select("conv_id", "turn", F.size(k).alias("n"), F.md5(F.array_join(F.sort_array(k), " ")).alias("tokens_md5"))


def kb(s, d):
    doc = documents(s, d)
    return doc.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), F.col("source").alias("title"), F.col("lang").alias("tags"), F.lit("docs").alias("theme"),
                      "text", (F.col("n_chars") > 300).alias("in_force"), F.lit(50).alias("priority"), F.lit("docs").alias("origin"))


@query("tx05_retrieve", f"""WITH q AS (SELECT item_id AS query_id, {tok_sql('text')} AS k FROM benchmark), dd AS (SELECT 'd' || doc_id AS id, {tok_sql('source')} AS ti, {tok_sql('lang')} AS ta, {tok_sql("'docs'")} AS te, {tok_sql('text')} AS tx, 0.05 - CASE WHEN n_chars > 300 THEN 0 ELSE 0.35 END AS prior FROM documents),
b AS (SELECT id, prior, ti, ta, te, list_distinct(list_concat(list_concat(ti, ta), list_concat(te, tx))) AS blob FROM dd),
qt AS (SELECT query_id, len(k) AS nq, unnest(k) AS w FROM q), dt AS (SELECT id, prior, len(blob) AS nb, ti, ta, te, unnest(blob) AS w FROM b),
h AS (SELECT query_id, id, any_value(nq) AS nq, any_value(nb) AS nb, any_value(prior) AS prior, count(*) AS n, sum(list_contains(ti, dt.w)::INT) AS a, sum(list_contains(ta, dt.w)::INT) AS g, sum(list_contains(te, dt.w)::INT) AS e FROM dt JOIN qt ON qt.w = dt.w GROUP BY 1, 2),
s AS (SELECT query_id, id, greatest(0, least(1, 0.3e0 * n / (nq + nb - n) + 0.45e0 * n / nq + 0.25e0 * a / nq + 0.2e0 * g / nq + 0.15e0 * e / nq + prior)) AS score FROM h)
SELECT query_id, id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 12) DESC, id) AS rn FROM s WHERE score > 0) WHERE rn <= 5""", "score")
def _(s, d):
    q = C.table(s, d, "benchmark").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return T.retrieve(q, kb(s, d), 5)


@query("tx06_kb_union", """SELECT 'd' || doc_id AS id, CASE WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 'curado' ELSE 'docs' END AS origin FROM documents""")
def _(s, d):
    good = C.table(s, d, "labels").filter("quality = 1").select("doc_id").distinct()
    base = kb(s, d)
    cur = base.join(good.select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id")), "id", "left_semi").withColumn("origin", F.lit("curado"))
    return T.kb_union(cur.select(*base.columns), base).select("id", "origin")


@query("tx11_summary_lines", CASES + f""", w AS ({scope_sql(_DET, {"STATE": (), "REGION": ("region",)})})
SELECT 'Detection' AS title, scope, slice, 0 AS line_no, 'with_lag: ' || replace(format('{{:,}}', with_lag), ',', '.') AS line FROM w UNION ALL SELECT 'Detection', scope, slice, 1, 'le_1d: ' || replace(format('{{:,}}', le_1d), ',', '.') FROM w""")
def _(s, d):
    return G.summary_lines(KP.detection_time(C.cases(s, d), S.SCOPES_NO_YEAR), "Detection", ["with_lag", "le_1d"])


SALT = "round-salt"
_PS = "'CASO-' || upper(sha256('" + SALT + "|' || {}))"


def person_rows(s, d):
    c = C.table(s, d, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("case_id"), F.col("c_name").alias("NomePaciente"), F.col("c_mktsegment").alias("municipio"), F.lit("1930-01-01").alias("DataNascimento"),
                    F.concat(F.lit("Fila | caso "), (k + 100000).cast("string"), F.lit("; caso aberto há 6915 dia(s); Notificação nº "), (k + 2000000).cast("string"), F.lit(".\nNome do paciente: X\nfim")).alias("nota"))


@query("tx07_drop_pii", f"SELECT {_PS.format('c_custkey')} AS case_id, c_mktsegment AS municipio FROM customer")
def _(s, d):
    return V.drop_pii(person_rows(s, d).drop("nota"), SALT)


@query("tx08_pseudonym", f"SELECT o_orderkey, {_PS.format('o_custkey')} AS code FROM orders")
def _(s, d):
    return C.table(s, d, "orders").select("o_orderkey", V.pseudonym("o_custkey", SALT).alias("code"))


@query("tx09_redact_ids", f"SELECT c_custkey AS case_id, 'Fila | ' || {_PS.format('(c_custkey + 100000)')} || '; caso aberto há 6915 dia(s); ' || {_PS.format('(c_custkey + 2000000)')} || '.' || chr(10) || 'fim' AS nota FROM customer")
def _(s, d):
    return person_rows(s, d).select("case_id", V.redact_ids("nota", SALT, drop_lines=True).alias("nota"))


@query("tx09_redact_documents", f"""SELECT doc_id, md5(CASE WHEN doc_id % 2 = 0 THEN 'Segue ' || {_PS.format('(doc_id + 100000)')} || '; ' || text || ' ' || {_PS.format('(doc_id + 700000)')} || '.' ELSE text END) AS text_md5, doc_id % 2 = 0 AS changed FROM documents""")
def _(s, d):
    """Every document; every second one has two case numbers written into it."""
    k = F.col("doc_id")
    noted = F.concat(F.lit("Segue caso nº "), (k + 100000).cast("string"), F.lit("; "), F.col("text"), F.lit(" Notificação: "), (k + 700000).cast("string"), F.lit("."))
    x = documents(s, d).withColumn("given", F.when(k % 2 == 0, noted).otherwise(F.col("text"))).withColumn("redacted", V.redact_ids("given", SALT))
    return x.select("doc_id", F.md5("redacted").alias("text_md5"), (F.col("redacted") != F.col("given")).alias("changed"))


@query("tx10_residual_report", "SELECT count(*) AS rows, 'nota' AS \"column\", count(*) AS case_numbers, count(*) AS nominal_lines FROM customer UNION ALL SELECT count(*), 'municipio', 0, 0 FROM customer")
def _(s, d):
    return V.residual_report(person_rows(s, d), ["nota", "municipio"])


@query("tx10_accounting", """SELECT 'case_id' AS "column", 'pseudonym' AS action, 0::BIGINT AS rows_changed UNION ALL SELECT 'NomePaciente', 'drop', 0 UNION ALL SELECT 'DataNascimento', 'drop', 0 UNION ALL SELECT 'municipio', 'keep', 0
UNION ALL SELECT 'nota', 'keep', count(*) FROM customer UNION ALL SELECT 'row', 'keep', 0""")
def _(s, d):
    b = person_rows(s, d).withColumn("row", F.col("case_id"))
    return V.accounting(b, V.sanitize(b, SALT), "row")


# ---- sources and sinks -----------------------------------------------------------------------

@query("src01_read_delimited", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment FROM customer")
def _(s, d):
    p = R.scratch_dir(s)
    C.table(s, d, "customer").select("c_custkey", "c_name", "c_mktsegment").write.csv(f"{p}/t", sep=";", header=True)
    return R.read_delimited(s, f"{p}/t")


@query("src02_read_base", "SELECT o_orderkey, CAST(o_orderdate AS DATE)::VARCHAR AS event_date FROM orders")
def _(s, d):
    p = R.scratch_dir(s)
    C.table(s, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("event_date")).write.parquet(f"{p}/base")
    return R.read_base(s, f"{p}/base", f"{p}/base.csv")


@query("src03_resolve_source", "SELECT count(*) AS n, 'local' AS label FROM orders")
def _(s, d):
    label, path = R.resolve_source(s, [("warehouse", f"{d}/absent.parquet"), ("local", f"{d}/orders.parquet")])
    return s.read.parquet(path).agg(F.count(F.lit(1)).alias("n")).withColumn("label", F.lit(label))


@query("src04_pick_view", "SELECT 'main.CASE_VIEW' AS view, 'canonico' AS method, count(*) AS candidates FROM nation")
def _(s, d):
    n = C.table(s, d, "nation")
    return R.pick_view(n.select(F.when(F.col("n_nationkey") == 7, "main.CASE_VIEW").when(F.col("n_nationkey") == 3, "CASES").otherwise(F.col("n_name")).alias("name")), ["CASE_VIEW", "CASES"])


@query("src05_discover_tables", "SELECT 'v_orders' AS name UNION ALL SELECT 'v_customer'")
def _(s, d):
    for t in ("orders", "customer", "region"):
        C.table(s, d, t).createOrReplaceTempView(f"v_{t}")
    return R.discover_tables(s, ["V_ORD%", "V_CUST%"]).select("name")


_FOUND = ("nation", "region", "part", "customer", "orders", "lineitem")
_PROFILE = " UNION ALL ".join(f"""SELECT '{t}' AS name, CAST(row_number() OVER () - 1 AS INTEGER) AS position, column_name AS column, CASE WHEN column_type IN ('BIGINT', 'INTEGER') THEN 'integer' WHEN column_type = 'DOUBLE' THEN 'number'
  WHEN column_type = 'VARCHAR' THEN 'text' ELSE 'time' END AS kind, count AS rows, min AS low, max AS high FROM (SUMMARIZE {t})""" for t in _FOUND)


@query("src05_profile_files", f"SELECT name, position, \"column\", kind, rows, low, high FROM ({_PROFILE})")
def _(s, d):
    return R.profile_files(s, d, ["%ation", "regi%", "part", "cust%", "orders", "%item"]).drop("nulls")


@query("src06_extract_lab", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE (p_name LIKE '%ring%' OR p_type LIKE 'SMALL%') AND l_shipdate >= (SELECT max(l_shipdate) FROM lineitem) - INTERVAL 2 YEAR""")
def _(s, d):
    j = C.table(s, d, "lineitem").join(C.table(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    last = C.table(s, d, "lineitem").agg(F.max("l_shipdate")).scalar()
    return R.extract_lab(j, {"p_name": ["%ring%"], "p_type": ["SMALL%"]}, ["l_shipdate"], last, 2).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("src07_extract_deaths", CASES + """ SELECT case_id FROM (SELECT *, CASE contacts WHEN 0 THEN 'A39.0' WHEN 1 THEN 'I21' END AS cause, CASE WHEN lag_onset_lp = 1 THEN 'G00.9' END AS la FROM cases) WHERE event_year >= 2001 - 3 AND (cause LIKE 'A39%' OR la LIKE 'G00%')""")
def _(s, d):
    c = C.cases(s, d).withColumns({"cause": F.when(F.col("contacts") == 0, "A39.0").when(F.col("contacts") == 1, "I21"), "la": F.when(F.col("lag_onset_lp") == 1, "G00.9")})
    return R.extract_deaths(c, "cause", ["la"], "event_year", F.lit("2001-06-30").cast("date"), 3).select("case_id")


@query("src08_latest_snapshot", """SELECT o_orderkey FROM orders WHERE strftime(o_orderdate, '%Y%m') = (SELECT max(strftime(o_orderdate, '%Y%m')) FROM orders)""")
def _(s, d):
    o = C.table(s, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"))
    return R.latest_snapshot(o, "y", "m").select("o_orderkey")


@query("src09_extract_births", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders WHERE year(o_orderdate) >= 2001 - 3")
def _(s, d):
    o = C.table(s, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("y"))
    return R.extract_births(o, "y", F.lit("2001-06-30").cast("date"))


@query("src10_write_extract", "SELECT count(*) AS rows, 4 AS columns, 's_suppkey,s_name,s_nationkey,s_acctbal' AS names FROM supplier")
def _(s, d):
    return R.write_extract(C.table(s, d, "supplier"), f"{R.scratch_dir(s)}/x").select("rows", "columns", "names")


_PW = "SELECT '51' || lpad(CAST(c_nationkey AS VARCHAR), 4, '0') AS code6, CAST(year(o_orderdate) AS INTEGER) AS year, count(*)::DOUBLE AS population FROM orders JOIN customer ON o_custkey = c_custkey WHERE year(o_orderdate) BETWEEN {} AND {} GROUP BY 1, 2"


def pop_wide(s, d, lo, hi):
    o, c = C.table(s, d, "orders"), C.table(s, d, "customer")
    code = F.concat(F.lit("51"), F.lpad(F.col("c_nationkey").cast("string"), 4, "0"), F.lit("0")).alias("cod_ibge")
    g = o.join(c, o.o_custkey == c.c_custkey).withColumn("year", F.year("o_orderdate")).groupBy(code).pivot("year", list(range(lo, hi + 1))).count()
    return g.withColumn("uf", F.lit("mt"))


@query("src11_population_long", _PW.format(1998, 2000), "population")
def _(s, d):
    w = pop_wide(s, d, 1998, 2000)
    return Z.population_long(w.withColumns({str(y): F.format_number(F.col(f"`{y}`"), 0) for y in (1998, 1999)}).withColumns(
        {str(y): F.translate(F.col(f"`{y}`"), ",", ".") for y in (1998, 1999)}), "cod_ibge", "uf", "MT")


@query("src12_population_std", _PW.format(1998, 2000), "population")
def _(s, d):
    long = Z.population_long(pop_wide(s, d, 1998, 2000), "cod_ibge")
    return Z.population_std(long.select(F.concat("code6", F.lit("-1")).alias("Cod_Municipio"), F.col("year").cast("string").alias("Ano"), F.col("population").cast("string").alias("Populacao")))


@query("src13_extend_population", _PW.format(1997, 2001), "population")
def _(s, d):
    return Z.extend_population(Z.population_long(pop_wide(s, d, 1998, 2000), "cod_ibge"), Z.population_long(pop_wide(s, d, 1997, 2001), "cod_ibge"))


@query("src14_read_coordinates", "SELECT n_name AS name, '51' || lpad(CAST(n_nationkey AS VARCHAR), 4, '0') AS code, -(8.0 + n_nationkey / 4.0) AS lat, -(51.0 + n_nationkey / 4.0) AS lon FROM nation", "lat lon")
def _(s, d):
    n = C.table(s, d, "nation")
    k = F.col("n_nationkey")
    raw = n.select(F.col("n_name").alias("Municipio"), F.concat(F.lit("51"), F.lpad(k.cast("string"), 4, "0"), F.lit("9")).alias("COD_IBGE"),
                   F.regexp_replace((-(8.0 + k / 4.0) * 100).cast("string"), "\\.", ",").alias("Latitude"), (-(51.0 + k / 4.0) * 10000).cast("bigint").cast("string").alias("Longitude"))
    return Z.read_coordinates(raw, (-19, -7), (-63, -50))


@query("src15_climate_daily", "SELECT CAST(ts AS DATE)::VARCHAR AS date, avg(CASE WHEN value BETWEEN 1 AND 20 THEN value END) AS temperature_mean, avg(value / 2) AS humidity FROM events GROUP BY 1", "temperature_mean humidity")
def _(s, d):
    from ..plans.sources_view import climate

    return Z.climate_daily(climate(s, d), {"temperature_mean": (1, 20), "humidity": (-1e9, 1e9)})


@query("src16_read_corpus", "SELECT doc_id, md5(text) AS text_md5, lang FROM documents")
def _(s, d):
    """Every document, a hundred to a file; a line of its own names each."""
    doc = C.table(s, d, "documents")
    p = R.scratch_dir(s)
    body = doc.select(F.concat(F.col("doc_id").cast("string"), F.lit("\u0005"), F.col("text")).alias("value"), F.floor(F.col("doc_id") / 100).alias("part"))
    body.repartition("part").write.partitionBy("part").option("lineSep", "\u0004").text(p)
    one = R.read_corpus(s, p).select(F.explode(F.split("text", "\u0004", -1)).alias("t")).filter(F.col("t") != "")
    got = one.select(F.substring_index("t", "\u0005", 1).cast("bigint").alias("doc_id"), F.md5(F.expr("substring(t, instr(t, '\u0005') + 1)")).alias("text_md5"))
    return got.join(doc.select("doc_id", "lang"), "doc_id", "left")


@query("src17_file_inventory", "SELECT count(*) AS rows, 1 AS files_with_size FROM region")
def _(s, d):
    p = R.scratch_dir(s)
    C.table(s, d, "region").coalesce(1).write.csv(f"{p}/t")
    n = R.line_counts(s, f"{p}/t", "*.csv").agg(F.sum("lines").alias("rows"))
    return n.withColumn("files_with_size", R.file_inventory(s, f"{p}/t", "*.csv").agg(F.count_if(F.col("bytes") > 0)).scalar().cast("int"))


@query("src18_read_run_log", "SELECT n_name AS modulo, CASE WHEN n_regionkey = 1 THEN 'falhou' ELSE 'ok' END AS status, n_nationkey / 2.0 AS duracao_s FROM nation", "duracao_s")
def _(s, d):
    n = C.table(s, d, "nation")
    step = F.struct(F.col("n_name").alias("modulo"), F.when(F.col("n_regionkey") == 1, "falhou").otherwise("ok").alias("status"), (F.col("n_nationkey") / 2).alias("duracao_s"),
                    F.lit(True).alias("obrigatorio"), F.lit("").alias("erro"))
    p = R.scratch_dir(s)
    n.groupBy(F.col("n_regionkey").alias("_r")).agg(F.collect_list(step).alias("passos")).select(F.lit("2026-01-01").alias("inicio"), F.lit("2026-01-01").alias("fim"), "passos").repartition("inicio").write.json(f"{p}/log")
    return s.read.schema(R.RUN_LOG).json(f"{p}/log").select(F.inline("passos")).select("modulo", "status", "duracao_s")


@query("src19_write_result", "SELECT r_regionkey, r_name FROM region")
def _(s, d):
    p = R.scratch_dir(s)
    R.write_result(C.table(s, d, "region"), f"{p}/r")
    return s.read.parquet(f"{p}/r")


@query("src20_class_dictionary", CASES + " SELECT class_group, count(*) AS n FROM cases WHERE class_code IS NOT NULL GROUP BY 1")
def _(s, d):
    dic = Z.class_dictionary(s).withColumnRenamed("class_group", "dict_group")
    c = C.cases(s, d).withColumn("_c", X.plain_code("class_code")).join(dic, F.col("_c") == F.col("code"))
    return c.groupBy(F.col("dict_group").alias("class_group")).agg(F.count(F.lit(1)).alias("n"))


@query("src21_slice_years", CASES + " SELECT event_year AS slice_year, count(*) AS n FROM cases WHERE event_year BETWEEN 1997 AND 1999 GROUP BY 1")
def _(s, d):
    return Z.slice_years(C.cases(s, d), 1997, 1999, ["onset_date", "notified_date"], ["event_year"]).groupBy("slice_year").agg(F.count(F.lit(1)).alias("n"))
