"""Registered queries opN_<name>: each operator over its whole table with production parameters."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, decontamination, html_wrappers, licenses, near_dups, packing, pii, quality_rules, quality_trees, repeats, source_audit, token_alignment, toxicity

ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A public vocabulary the contracts name; the operators take any path."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = html_wrappers.extract(table(spark, sf_dir, "pages"))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_classes(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_digest(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = quality_rules.measure(docs, quality_rules.train(docs, table(spark, sf_dir, "labels")))
    return got.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", F.round("p_good", 6).alias("p_good"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op8_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op10_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_trees.score(docs, quality_trees.train(docs, table(spark, sf_dir, "labels")))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.encode_digest(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


ORACLES["op13_source_audit"] = r"""WITH d AS (SELECT row_number() OVER () AS i, coalesce(text, '') AS t, coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
w AS (SELECT i, lang, source, translate(unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM w GROUP BY ALL HAVING count(DISTINCT i) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (SELECT m.lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (m.total + 5 * v) AS p FROM m JOIN l USING (lang)),
q AS (SELECT k.lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (total + 5 * v) AS q FROM k JOIN l USING (lang)),
b AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y USING (lang, term) WHERE x.source <> y.source GROUP BY ALL),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(b.value, 0) AS value FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN b ON b.lang = x.lang AND b.source = x.source AND b.item = y.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM a)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= 50"""


def _license_sql() -> str:
    """The licence scan in SQL; every passage meets every template, without the size bounds."""
    rows = ", ".join(f"('{name}', [{', '.join(chr(39) + g + chr(39) for g in licenses.plain_bigrams(text))}])" for name, text in licenses.TEMPLATES.items())
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
b AS (SELECT doc_id, string_split(t, chr(10)) AS l, string_split_regex(t, '\\n[ \\t\\r]*\\n') AS b FROM d),
u AS (SELECT doc_id, 'line' AS unit, generate_subscripts(l, 1) - 1 AS place, unnest(l) AS p FROM b UNION ALL
  SELECT * FROM (SELECT doc_id, 'paragraph' AS unit, generate_subscripts(b, 1) - 1 AS place, unnest(b) AS p FROM b) WHERE contains(p, chr(10)) UNION ALL
  SELECT doc_id, 'text', 0, array_to_string(b, chr(10) || chr(10)) FROM b WHERE len(b) > 1),
w AS (SELECT doc_id, unit, place, list_filter(string_split_regex(lower(p), '[^a-z0-9]+'), lambda x: x <> '') AS w FROM u),
g AS (SELECT doc_id, unit, place, CASE WHEN len(w) > 1 THEN list_distinct(list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1])) ELSE w END AS g FROM w WHERE len(w) > 0),
t(license, k) AS (VALUES {rows}),
s AS (SELECT doc_id, unit, place, license, 2e0 * len(list_intersect(g, k)) / (len(g) + len(k)) AS dice FROM g, t)
SELECT doc_id, unit, CAST(place AS BIGINT) AS place, license, round(dice, 6) AS dice FROM s WHERE dice >= {licenses.DICE}"""


ORACLES["op9_licenses"] = _license_sql()


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (op1_pii, op2_decontamination, op3_html_text, op4_near_dups, op5_packing, op6_quality_rules, op7_toxicity, op8_repeats, op9_licenses, op10_quality_trees, op11_byte_bpe, op12_token_alignment, op13_source_audit, pipeline)}
