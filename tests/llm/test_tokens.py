"""Byte-level BPE, tokenizer alignment and the source audit against plain versions, with their edge cases."""
import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from caseflux.llm import byte_bpe as B
from caseflux.llm import chunk_memo as C

P = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, ids string, start long, item string, term string, block long, n long"


def docs_of(spark, rows):
    """Rows of (doc_id, text[, lang, source]) with extra columns whose names clash with those the operators use."""
    return spark.createDataFrame([(r[0], r[1], *(r[2:] or ("en", "s")), "x", 1, "y", "z", 2, 3) for r in rows], SCHEMA)


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


BITS = ["a", "the", " the", "  ", " ", "\n", "\t ", "\r\n", "  ", "é", "日本語", "😀", "'s", "don't", "12", "3.5", "--", "====", "_", "▁", "<|endoftext|>", "<0x0A>", "\x00", "\x01", " \x01.", "end.", "naïve,", "x.", "\x1c ", "\u0085", "Zwölf", "banana", "анана", "ที่", "é", "�", "."]


def mixed(rng, n):
    return "".join(rng.choice(BITS) + rng.choice(["", "", " "]) for _ in range(rng.randint(0, n)))


def edge_rows():
    rng = random.Random(11)
    rows = [(i, mixed(rng, 30)) for i in range(150)]
    rows += [(500, None), (501, ""), (502, " "), (503, "   "), (504, "x "), (505, " x"), (506, "\n x \n"), (None, "lone row"), (507, "same"), (507, "same"), (507, "other text")]
    return [*rows, (508, "ab " * 400_000 + "é" * 1000), (509, "a" * 60_000), (510, "long" + mixed(rng, 20_000))]


# ---- byte-level BPE -------------------------------------------------------------------------------

def test_chunks_are_exact_and_spell_the_text():
    rng = random.Random(3)
    for _ in range(500):
        t = mixed(rng, 40)
        assert "".join(C.spelled(c) for c in C.chunks(t)) == t
        for size in (1, 7, 10**6):
            for stops in (False, True):
                assert "".join(C.spelled(c) for _, held in C.parts([t], size, stops) for x in held for c in x) == t


@pytest.fixture(scope="module")
def plain_encode():
    import tiktoken

    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=B.read_ranks(P.path("byte_bpe_multi_50k.tiktoken")), special_tokens={}).encode_ordinary


def test_encoding_like_the_rank_library(spark, plain_encode):
    rows = edge_rows()
    got = B.encode_digest(docs_of(spark, rows).repartition(3), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    want = Counter()
    for i, t in rows:
        ids = plain_encode(t or "")
        want[(i, len(ids), sha(",".join(map(str, ids))), sha((t or "").encode()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    empty = B.encode_digest(docs_of(spark, rows).where("false"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_repeated_stretches_like_the_rank_library(plain_encode):
    """Two splits of one token side by side: the model's merge order must give what ranks give."""
    bpe = B.loaded(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    rng = random.Random(5)
    for _ in range(3000):
        letters = rng.choice(["ab", "a", "-=", "aeio", " a", "éa", "日本", "_-", " \n", "01", "аб"])
        t = "".join(rng.choice(letters) for _ in range(rng.randint(1, 30))) * rng.randint(1, 4)
        assert [i for _, ids, _ in bpe.encode([t]) for i in ids.tolist()] == plain_encode(t), t


def test_offsets_and_split_characters(spark):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    rows = [(1, "naïve 😀𐍈 日本"), (2, None), (3, "plain words"), (4, "𐍈" * 5), (5, "w " * 700_000 + "𐍈")]
    enc = B.encode(docs_of(spark, rows), path, P.PATTERN)
    spans = {r.doc_id: r for r in enc.collect()}
    ranks = {i: t for t, i in B.read_ranks(path).items()}
    for i, t in rows:
        r, raw, at = spans[i], (t or "").encode(), 0
        chars = [k for k, c in enumerate(t or "") for _ in c.encode()]
        for tok, first, past in zip(r.ids, r.first, r.past, strict=True):
            assert raw[at:at + len(ranks[tok])] == ranks[tok]
            assert (first, past) == (chars[at], chars[at + len(ranks[tok]) - 1] + 1)
            at += len(ranks[tok])
        assert at == len(raw)
    back = {r.doc_id: r for r in B.decode(enc, path, P.PATTERN).collect()}
    for i, t in rows:
        assert back[i].text == (t or "") and bytes(back[i].raw) == (t or "").encode() and "".join(back[i].pieces) == (t or "")
    assert back[4].n_split > 0 and "" in back[4].pieces and back[3].n_split == 0
    half = B.decode(spark.createDataFrame([(7, spans[4].ids[:1])], "doc_id long, ids array<int>"), path, P.PATTERN).first()
    assert half.text == "�" and half.pieces == ["�"]
    with pytest.raises(KeyError):
        B.loaded(path, P.PATTERN).decode(np.array([10**6]))


# ---- alignment of two tokenizers -------------------------------------------------------------------

from caseflux.llm import token_alignment as T  # noqa: E402

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain_tokens():
    import sentencepiece
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(x): x for x in printable} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printable)}

    def of(text):
        """(id, start, end) of the tokens of A and B, whole texts at once; empty where bytes differ."""
        if not text:
            return [], []
        ia = a.encode(" " + text, add_special_tokens=False).ids
        ib = b.encode(text)
        ra = [bytes(byte[c] for c in a.id_to_token(i)) for i in ia]
        rb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ib]
        want = (" " + text).encode()
        if b"".join(ra) != want or b"".join(rb) != want:
            return [], []
        out = []
        for ids, raw in ((ia, ra), (ib, rb)):
            at, spans = 0, []
            for i, r in zip(ids, raw, strict=True):
                spans.append((i, at, at + len(r)))
                at += len(r)
            out.append(spans)
        return tuple(out)

    return of


def plain_alignment(tokens):
    links, shared, said = [], 0, []
    a, b = tokens
    j = 0
    for i, s, e in a:
        while j < len(b) and b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    lo = 0
    for end in sorted({x[2] for x in a} & {x[2] for x in b}):
        ga, gb = ([x[0] for x in t if lo <= x[1] and x[2] <= end] for t in (a, b))
        shared += len(ga) * len(gb)
        said.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
        lo = end
    return links, shared, said


@pytest.mark.parametrize("block", [1, 500, T.BLOCK])
def test_alignment_like_brute_force(spark, plain_tokens, block):
    rng = random.Random(17)
    rows = edge_rows()[:161] + [(600, "ab c" * 3), (601, "ab c" * 3), (602, "x▁y"), (603, "".join(rng.choice("日本語中文😀é") for _ in range(300)))]
    rows += [(700 + k, " ".join(rng.choice(["to", "ken", "token", "Tokenizer", "aligned", "naïve", "x1"]) for _ in range(30))) for k in range(40)]
    if block == T.BLOCK:
        rows.append((508, "ab\t\n " * 250_000 + "end"))
    plain = [(i, plain_alignment(plain_tokens(t or "")) if len(t or "") < 10**6 else None) for i, t in rows]
    plain = [(i, p) for i, p in plain if p is not None]
    held = rows if block != T.BLOCK else rows[:-1]
    count = Counter(p for _, (links, _, _) in plain for p in set(links))
    most = {}
    for (a, _), n in count.items():
        most[a] = max(most.get(a, 0), n)
    want = Counter()
    for (i, t), (_, (links, shared, said)) in zip(held, plain, strict=True):
        a, b = plain_tokens(t or "")
        want[(i, len(a), len(b), len(said), len(links), sum(count[p] == most[p[0]] for p in links), sum(count[p] for p in links), sha(";".join(said)) if said else "", shared)] += 1
    got = T.align(docs_of(spark, held).repartition(3), A_PATH, B_PATH, block).collect()
    assert Counter(tuple(r[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared")) for r in got) == want
    if block == T.BLOCK:  # a text handled in parts has what its halves have
        whole = T.align(docs_of(spark, [rows[-1], (1, rows[-1][1][: 5 * 125_000 - 1])]), A_PATH, B_PATH).collect()
        by = {r.doc_id: r for r in whole}
        assert by[508].n_links > 1.9 * by[1].n_links and by[508].n_groups > 0 and by[508].count_sum >= by[508].n_links


def test_link_rows_and_products(spark, plain_tokens):
    t = "Tokenizers naïvely align 日本語 words"
    got = sorted((r.a_index, r.b_index, r.a, r.b, r.bytes) for r in T.link_rows(docs_of(spark, [(1, t), (2, None), (3, "x▁y")]), A_PATH, B_PATH).collect())
    a, b = plain_tokens(t)
    assert got == sorted((i, j, x[0], y[0], min(x[2], y[2]) - max(x[1], y[1])) for i, x in enumerate(a) for j, y in enumerate(b) if min(x[2], y[2]) > max(x[1], y[1]))
    rng = np.random.default_rng(2)
    x, y = (rng.integers(0, 3, (5, 7)), rng.integers(0, 3, (7, 4)))

    def sparse(m):
        r, c = np.nonzero(m)
        return T.CSR(np.searchsorted(r, np.arange(len(m) + 1)), c, m[r, c], m.shape[1])

    def dense(m, n):
        out = np.zeros((n, m.width), int)
        out[m.rows, m.col] = m.val
        return out

    assert (dense(T.product(sparse(x), sparse(y)), 5) == x @ y).all()
    assert (dense(T.transpose(sparse(x)), 7) == x.T).all()
    assert T.align(docs_of(spark, [(1, "a")]).where("false"), A_PATH, B_PATH).count() == 0


# ---- divergence of sources -------------------------------------------------------------------------

import re  # noqa: E402

from caseflux.llm import source_audit as S  # noqa: E402

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_audit(rows, least, top):
    count, docs, groups = Counter(), Counter(), {}
    for r in rows:
        text, lang, source = (x or "" for x in (r[1], *r[2:]))
        terms = [t.translate(LOWER) for t in TERM.findall(text)]
        groups.setdefault(lang, set()).add(source)
        count.update((lang, source, t) for t in terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for (x, t), n in docs.items() if x == lang and n >= least]

        def shares(of, kept=kept, lang=lang):
            n = {t: sum(count[lang, s, t] for s in of) for t in kept}
            return {t: 1 + 10**9 * (n[t] + 5) // (sum(n.values()) + 5 * len(kept)) for t in kept}

        p, q = {s: shares([s]) for s in sources}, shares(sources)
        for s in sources:
            pair = sorted((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            term = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if count[lang, s, t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, i, -v, k + 1) for part, x in (("pair", pair), ("term", term)) for k, (v, _, i) in enumerate(x)]
    return sorted(out)


@pytest.mark.parametrize(("tile", "shard"), [(2, 300), (128, S.SHARD)])
def test_audit_like_brute_force(spark, monkeypatch, tile, shard):
    monkeypatch.setattr(S, "SHARD", shard)
    rng = random.Random(23)
    stem = ["Zebra", "zebra", "internationalisation", "internationalise", "internation", "é", "ÉCOLE", "école", "日本", "a", "abcdefgh", "abcdefghi", "abcdefgH", "x'y", "don't", "q1w"]
    rows = [(i, " ".join(rng.choice(stem) for _ in range(rng.randint(0, 12))), rng.choice(["en", "fr", None]), f"s{rng.choice([0, 0, 0, 1, 2, 3, 4])}") for i in range(150)]
    rows += [(900, None, "en", "empty"), (901, "", "en", None), (902, "12 -- !", "en", "empty2"), (903, "zebra", "xx", "only"), (904, "", "xx", "other"), (905, "", "yy", "lone"), (None, "zebra", "en", "s1"), (7, "zebra", "en", "s1"), (7, "zebra", "en", "s1")]
    rows += [(906, "zebra abcdefgh " * 20_000, "en", "s0")]
    got = S.audit(docs_of(spark, rows).repartition(3), least=6, top=4, tile=tile, block=5 if tile == 2 else S.BLOCK).collect()
    assert sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in got) == plain_audit(rows, 6, 4)


def test_audit_of_nothing_and_pointer_sort(spark):
    assert S.audit(docs_of(spark, [(1, "a")]).where("false")).count() == 0
    rng = random.Random(4)
    texts = ["".join(rng.choice("abAB éx,") for _ in range(rng.randint(0, 80))) for _ in range(60)] + ["abababababababababab" * 3, "abababababababababab" * 3 + "a"]
    raw = [t.encode() for t in texts]
    buf, at = np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw])))
    start, length = S.word_starts(buf, at)
    words = [bytes(buf[s:s + n]) for s, n in zip(start, length, strict=True)]
    assert words == [w.encode() for t in texts for w in TERM.findall(t)]
    order, head = S.sort_pointers(buf, start, length)
    assert order.tolist() == sorted(range(len(words)), key=lambda k: (words[k], k))
    assert [k for k, h in enumerate(head) if h] == [k for k in range(len(words)) if k == 0 or words[order[k]] != words[order[k - 1]]]
