"""PII, decontamination, HTML, licences and the classifiers against plain versions, with their edge cases."""
import hashlib
import random
import re

import numpy as np
import pytest

from caseflux.llm import decontamination as D
from caseflux.llm import html_wrappers as H
from caseflux.llm import licenses as L
from caseflux.llm import pii
from caseflux.llm import quality_rules as Q
from caseflux.llm import quality_trees as G
from caseflux.llm import toxicity as X

SCHEMA = "doc_id long, text string, lang string, start long, kind string, base string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", 1, "x", "y", len(t or "")) for i, t in rows], SCHEMA)


# ---- personal data ------------------------------------------------------------------------------

PLAIN = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
KINDS = ["email", "ip", "card", "phone"]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(digits))) % 10 == 0


def plain_spans(text):
    out = []
    for k, p in enumerate(PLAIN):
        for m in re.finditer(p, text):
            g = re.sub("[^0-9]", "", m.group())
            if [True, k == 1 and all(int(x) <= 255 for x in m.group().split(".")), 12 <= len(g) <= 19 and luhn(g), 9 <= len(g) <= 15][k]:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_like_plain_patterns(spark):
    rng = random.Random(4)
    bits = ["a@b.c", "x.y%z@m-1.org.", "@", ".", "-", "+", " ", "1.2.3.4", "256.1.1.1", "4539578763621486", "4539 5787-6362 1486", "+1 (017) 555-7713", "é", "7", "00", "word", "+49.89", "a@b.c-%x@d.e", "\n", "1.2.3.4.5.6.7.8"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(200)] + [(900, None), (901, ""), (902, "1" * 50000 + "x@" + "a" * 50000), (903, "a." * 20000), (904, "1.1.1." * 5000)]
    got = {r.doc_id: r for r in pii.find(docs_of(spark, rows)).collect()}
    for i, t in rows:
        want = plain_spans(t or "")
        text = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert got[i].base_sha256 == hashlib.sha256(text.encode()).hexdigest(), (i, t)
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(x[1] == j for x in want) for j in range(4)]


def test_disclosing_terms_and_sanitising(spark):
    filler = "every common word stands here "
    rows = [(i, f"{filler}the gardener Zaphod reached me@home.org then left {filler}") for i in range(5)] + [(10 + i, filler + "nothing to hide") for i in range(60)]
    rows += [(80, "gardener met me@home.org alone"), (81, None)]
    df = docs_of(spark, rows)
    found = {r.doc_id: r for r in pii.find(df).collect()}
    text = rows[0][1]
    at = text.index("Zaphod")
    assert f"term:{at}:{at + 6}" in found[0].spans.split(",") and found[0].n_email == 1
    assert all(not found[10 + i].spans for i in range(60))
    clean = pii.sanitise(df)
    assert clean.columns == df.columns
    out = {r.doc_id: r for r in clean.collect()}
    assert "Zaphod" not in out[0].text and "me@home.org" not in out[0].text and "[EMAIL]" in out[0].text and out[0].n_chars == len(out[0].text)
    assert out[10].text == rows[5][1] and out[81].text is None
    assert pii.find(df.limit(0)).count() == 0
    twice = pii.sanitise(df.where("doc_id = 0").union(df.where("doc_id = 0")))
    assert twice.count() == 2


# ---- decontamination -----------------------------------------------------------------------------

def test_leaks(spark):
    q = "A train leaves Paris at 9 and travels 120 km in 2 hours; how far does it get in 7 hours if Anna waits?"
    other = "Name the capital of the country whose flag shows a cedar between two red bars."
    bench = spark.createDataFrame([(1, q), (2, other), (3, None), (4, ""), (5, "two words"), (1, q)], "item_id long, text string")
    again = q.replace("120", "300").replace("Anna", "Bert").replace("2 hours", "3 hours")
    mixed = again.replace("7 hours", "7 hours").replace("travels 300", "travels 300")
    filler = "nothing of note happened on the road that day and nobody spoke. "
    rows = [(1, filler + q + " " + filler), (2, filler + again), (3, filler), (4, None), (5, ""), (6, (filler * 300) + other.upper()), (7, "here are two words only"), (8, " ".join(str(i) for i in range(400))), (9, mixed)]
    got = {(r.doc_id, r.item_id): r.kind for r in D.leaks(docs_of(spark, rows), bench).collect()}
    assert got[1, 1] == "verbatim" and got[2, 1] == "new parameters" and got[6, 2] == "verbatim"
    assert {k[0] for k in got} == {1, 2, 6, 7, 9}
    assert got == {(r.doc_id, r.item_id): r.kind for r in D.leaks(docs_of(spark, rows), bench, block_size=7).collect()}  # several passes
    kept = D.clean(docs_of(spark, rows), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 8] and kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert D.leaks(docs_of(spark, rows).limit(0), bench).count() == 0 and D.leaks(docs_of(spark, rows), bench.limit(0)).count() == 0


def test_leaks_with_missing_shared_and_text_ids(spark):
    """Rows without an id, two texts under one id, two items under one item id, repeated rows, ids that are texts."""
    one = "the quick brown fox jumps over the lazy dog while seven sleepy cats watch quietly"
    two = "every morning an old baker carries warm bread along the narrow street toward a silent harbour"
    other = "nothing in this short passage has been taken from any of the stored questions at all"
    rows = [(None, one), ("a", one), ("a", other), ("b", two), ("b", two), ("c", other), (None, other), ("d", None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    bench = spark.createDataFrame([("q", one), ("q", two), ("q", one), (None, other)], "item_id string, text string")
    assert sorted((r.doc_id, r.item_id, r.kind) for r in D.leaks(docs, bench).collect()) == [("a", "q", "verbatim"), ("b", "q", "verbatim")]
    kept = [(r.doc_id, r.text) for r in D.clean(docs, bench).collect()]
    assert sorted(kept, key=str) == sorted([("a", other), ("c", other), (None, other), ("d", None)], key=str)


def test_slots_must_agree(spark):
    bench = spark.createDataFrame([(1, "take 5 apples from the blue box then put 5 apples into the red box again please")], "item_id long, text string")
    rows = [(1, "take 8 apples from the blue box then put 8 apples into the red box again please"), (2, "take 8 apples from the blue box then put 9 apples into the red box again please")]
    got = {r.doc_id for r in D.leaks(docs_of(spark, rows), bench, min_cover=0.9).collect()}
    assert got == {1}


def test_values_of_any_length_are_one_slot(spark):
    weng = "Weng earns $12 an hour for babysitting. Yesterday, she just did 50 minutes of babysitting. How much did she earn?"
    long = "Every morning the baker carries fresh bread and sweet rolls to the small shop where 12 people wait outside the door and talk about the weather until it opens"
    york = "Tom has walked from New York to the old harbour with nine friends and Tom sings. Tom then rests near New York until dark"
    bench = spark.createDataFrame([(1, weng), (2, long), (3, york)], "item_id long, text string")
    rows = [(1, weng.replace("50", "1,050")), (2, weng.replace("12", "12.5").replace("50", "52.5")), (3, long.replace("12", "1,200")), (4, york.replace("New York", "Rome").replace("Tom", "Anna Maria")),
            (5, long.replace("12", "more than a dozen")), (6, weng)]
    got = {(r.doc_id, r.item_id): r.kind for r in D.leaks(docs_of(spark, rows), bench).collect()}
    assert got == {(1, 1): "new parameters", (2, 1): "new parameters", (3, 2): "new parameters", (4, 3): "new parameters", (5, 2): "verbatim", (6, 1): "verbatim"}


def test_items_of_numbers_are_found(spark):
    total, few = "Compute 12 + 7 * 3 - 4 * 5 + 9 * 8 - 6", "12 + 7"
    mixed = "Add the first of all these many numbers to the last: 3 5 8 13 21 34 55 89 144 233 377 610 987 1597"
    bench = spark.createDataFrame([(1, total), (2, few), (3, mixed)], "item_id long, text string")
    rows = [(1, "Please do this. " + total + " and tell me."), (2, total.replace("7", "6")), (3, "so 12 + 7 it is"), (4, "we had 3 and 4 of them"), (5, mixed), (6, mixed.replace(" last", " sum").split(":")[0])]
    got = {(r.doc_id, r.item_id): r.kind for r in D.leaks(docs_of(spark, rows), bench).collect()}
    assert {k for k in got if k[1] == 1} == {(1, 1)} and got[1, 1] == "verbatim"
    assert {k for k in got if k[1] == 2} == {(1, 2), (3, 2)}
    assert got[5, 3] == "verbatim" and (4, 3) not in got


# ---- pages -------------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body><header>Site</header><nav><ul><li><a href=/>{n}</a></li></ul></nav>
<div class="cookie-notice">We use {n}</div><!-- ad <p>no</p> --><div class="ad">{n}</div><article><h1>Head {n}</h1><p><b>One &amp; two {n}<br>three<p>Next
 part&nbsp;{n}</p><script>x()</script><form>Send {n}</form><ul><li>first {n}<li>second</ul><div class="comments"><p>me {n} too</p></div></article><aside>side {n}</aside><footer>&copy; {n}"""
TEXT = "Head {n}\n\nOne & two {n} three\n\nNext part {n}\n\nfirst {n}\n\nsecond"


def test_main_text(spark):
    rows = [(i, f"https://h{i % 3}.example.org/{i}", PAGE.format(n=f"w{i}"), "x") for i in range(60)]
    rows += [(100, None, None, "x"), (101, "u", "", "x"), (102, "http://p.example.com", "plain <b>te</b>xt  only &lt;x&gt;", "x"), (103, "http://p.example.com/1", "<p" * 5000, "x"),
             (104, "http://q.example.com", "<body><div class=main>" + "<p>long paragraph of text</p>" * 5 + "</div><div class=sidebar><p>links</p></div></body>", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r.page_id: r.text for r in H.extract(df).collect()}
    assert all(got[i] == TEXT.format(n=f"w{i}") for i in range(60))
    assert got[100] == got[101] == "" and got[102] == "plain text only <x>" and got[104] == "\n\n".join(["long paragraph of text"] * 5)
    assert got == {r.page_id: r.text for r in H.extract(df, max_hosts=0).collect()}  # joined by host
    assert H.extract(df.limit(0)).count() == 0


def test_wrappers_find_optional_and_repeated_parts():
    a, b = (H.new_wrapper(H.blocks(x)) for x in ("<body><div><h1>x</h1><p>a</p><p>b</p></div></body>", "<body><div><p>c</p></div></body>"))
    w = H.align(a, b)
    tokens = {t[1]: t for t in w["tokens"]}
    assert tokens["h1"][4] and not tokens["p"][4] and tokens["p"][3] and tokens["p"][2] == ""
    back = H.align(b, a)
    assert w["n"] == back["n"] == 2 and w["size"] == back["size"]


# ---- licences ----------------------------------------------------------------------------------

def test_licences_like_brute_force(spark):
    rng = random.Random(1)
    names = list(L.TEMPLATES)
    rows = [(500, None), (501, ""), (502, "word " * 30000), (503, "\n\n\n")]
    for i in range(120):
        w = L.TEMPLATES[rng.choice(names)].split()
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = "other"
        cut = rng.randrange(len(w))
        rows.append((i, "Some text.\n" + " ".join(w[:cut]) + rng.choice([" ", "\n"]) + " ".join(w[cut:]) + rng.choice(["", "\n\nmore text here"])))
    got = sorted((r.doc_id, r.unit, r.place, r.license, r.dice) for r in L.scan(docs_of(spark, rows)).collect())
    want = []
    for i, t in rows:
        t = t or ""
        units = [("line", k, x) for k, x in enumerate(t.split("\n"))]
        blocks = re.split(r"\n[ \t\r]*\n", t)
        units += [("paragraph", k, x) for k, x in enumerate(blocks) if "\n" in x]
        units += [("text", 0, "\n\n".join(blocks))] if len(blocks) > 1 else []
        for unit, k, x in units:
            g = set(L.plain_bigrams(x))
            for name, template in L.TEMPLATES.items():
                b = set(L.plain_bigrams(template))
                d = 2 * len(g & b) / (len(g) + len(b)) if g else 0
                if d >= L.DICE:
                    want.append((i, unit, k, name, round(d, 6)))
    assert got == sorted(want) and len(want) > 60
    assert L.scan(docs_of(spark, rows).limit(0)).count() == 0


# ---- classifiers ---------------------------------------------------------------------------------

def labelled(spark, n=300):
    rng = random.Random(6)
    vocab = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(60, 200))]
        good, bad = i % 3 != 0, i % 5 == 0
        if bad:
            for x in rng.sample(["idiot", "moron", "stupid", "trash", "pathetic"], 3):
                w[rng.randrange(len(w))] = x
        docs.append((i, " ".join(w) if good else " ".join(x.upper() + "!!%%" for x in w)))
        labels.append((i, int(good), int(bad)))
    docs += [(900, None), (901, ""), (902, "x" * 100000), (903, docs[1][1]), (903, docs[1][1])]
    return docs_of(spark, docs), spark.createDataFrame([*labels, (1, 1, 0), (None, 1, 0), (5000, None, 1)], "doc_id long, quality int, toxic int")


def brute_counts(t):
    w, seen, dup = re.findall(r"[^\x20\x09-\x0D]+", t), set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    three = list(zip(w, w[1:], w[2:], strict=False))
    many = {x for x in three if three.count(x) > 1}
    covered = {i + k for i, x in enumerate(three) if x in many for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def test_counts_like_brute_force():
    rng = random.Random(9)
    texts = ["".join(rng.choice(["ab ", "é", " ", "\n", "x y z ", "#", "\t", "\x0b", " ", "line\n", "a b c "]) for _ in range(rng.randint(0, 80))) for _ in range(300)] + ["", "\n", "a", "a\na\n a\na"]
    got = Q.counts_of(texts)
    assert [tuple(int(got[k][i]) for k in Q.COUNTS) for i in range(len(texts))] == [brute_counts(t) for t in texts]


def test_quality_rules(spark):
    docs, labels = labelled(spark)
    model = Q.train(docs, labels)
    rows = {r.doc_id: r for r in Q.measure(docs, model).collect()}
    right = sum(rows[i].kept == (i % 3 != 0) for i in range(300))
    assert right >= 290 and rows[900].base_failed and rows[901].n_words == 0 and not rows[900].kept
    kept = Q.keep(docs, model)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in Q.measure(docs, model).where("kept").collect())
    assert Q.train(docs, labels.limit(0)) is None and Q.measure(docs, None).where("kept").count() > 290
    assert Q.measure(docs.limit(0), model).count() == 0


def test_quality_trees(spark):
    docs, labels = labelled(spark)
    model = G.train(docs, labels)
    rows = [r for r in G.score(docs, model).collect() if r.doc_id < 300]
    out = [r for r in rows if r.held_out]
    assert len(out) > 30 and np.mean([r.predicted == (r.doc_id % 3 != 0) for r in out]) >= 0.95
    flipped = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 5 = 0 then 1 - quality else quality end as quality", "toxic")
    again = G.train(docs, flipped)
    assert np.array_equal(model.leaf, again.leaf) and np.array_equal(model.threshold, again.threshold)  # held-out labels are never seen
    flat = {r.doc_id: r for r in G.score(docs, G.train(docs, labels.limit(0))).collect()}
    assert flat[900].score == 0.5 and G.score(docs.limit(0), model).count() == 0


def test_flat_trees_walk_like_nested_ones():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    m = G.fit(x, y)
    total = np.full(len(x), m.start)
    for f, t, leaf in zip(m.feature, m.threshold, m.leaf, strict=True):
        for i, row in enumerate(x):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + int(row[f[k]] > t[k])
            total[i] += leaf[k - len(f)]
    assert np.allclose(m.score(x), 1 / (1 + np.exp(-total))) and np.mean((m.score(x) > 0.5) == y) > 0.95


def test_toxicity_chain(spark):
    docs, labels = labelled(spark)
    rows = {r.doc_id: r for r in X.score(docs, X.train(docs, labels)).collect()}
    assert np.mean([rows[i].toxic == (i % 5 == 0) for i in range(300)]) >= 0.98
    assert rows[900].toxic == 0 and rows[901].p_toxic == rows[900].p_toxic
    assert all(0 <= rows[i][f"p_{n}"] <= 1 for i in range(300) for n in X.CHAIN)
    none = X.score(docs, X.train(docs, labels.limit(0)))
    assert none.where("toxic = 1").count() == 0 and X.score(docs.limit(0), X.train(docs, labels)).count() == 0


# ---- registered queries and the pipeline -----------------------------------------------------------

def test_every_operator_is_registered():
    import __spark_entry__ as E

    names = [n for n in E.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in E.queries()


def test_pipeline_keeps_columns_and_order(spark, tmp_path):
    pytest.importorskip("public_tokenizers")
    import corpus_pipeline as C

    docs, labels = labelled(spark)
    q = "Take the seven smallest primes and add them up before you divide the sum by two please"
    more = docs_of(spark, [(1000, docs.where("doc_id = 2").first().text + " " + q), (1001, docs.where("doc_id = 4").first().text + " write me@home.org soon")])
    docs.union(more).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, q)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    at = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in C.STAGES:
        stage(spark, at, str(tmp_path)).write.parquet(f"{tmp_path}/out/{name}")
        at = spark.read.parquet(f"{tmp_path}/out/{name}")
        seen[name] = at
        assert name == "packing" or at.columns == docs.columns
    ids = {n: {r.doc_id for r in t.select("doc_id").collect()} for n, t in seen.items()}
    assert 900 not in ids["quality_rules"] and 903 in ids["quality_rules"] and 903 not in ids["near_dedup"]
    assert 1000 in ids["quality_rules"] and 1000 not in ids["decontamination"]
    assert ids["packing"] == ids["pii"] == ids["decontamination"]
    assert seen["pii"].where("text like '%me@home%'").count() == 0
    assert C.run(spark, str(tmp_path)).count() == seen["packing"].count()
