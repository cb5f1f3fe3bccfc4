"""Near-duplicate classes, repeated strings and packing against brute force, with the edge cases of each."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from caseflux.llm import near_dups as N
from caseflux.llm import packing as P
from caseflux.llm import repeats as R
from caseflux.llm.common import components

SCHEMA = "doc_id long, text string, lang string, start long, kind string, g long"  # extra columns with clashing names


def table(spark, texts):
    return spark.createDataFrame([(i, t, "en", 1, "x", 2) for i, t in texts], SCHEMA).repartition(3)


def invented(rng, n):
    return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))


def bag(text):
    w = re.findall(r"[A-Za-z0-9\u0080-\U0010ffff]+", text.lower())
    return collections.Counter(zip(*[w[i:] for i in range(5)], strict=False)) if len(w) >= 5 else collections.Counter([tuple(w)] if w else [])


def classes(texts):
    first, root = {}, {}
    for i, t in texts:
        first.setdefault(t or "", i)
    for i in first.values():
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    bags = {i: bag(t) for t, i in first.items()}
    ids = sorted(bags)
    for a in ids:
        for b in ids:
            if a < b and bags[a] and bags[b]:
                both = sum((bags[a] & bags[b]).values())
                if both >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: find(first[t or ""]) for i, t in texts}


def near_texts():
    rng = random.Random(5)
    base = [invented(rng, 120) for _ in range(6)]
    out = []
    for i in range(140):
        w = rng.choice(base).split()
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = invented(rng, 1)
        out.append((i, " ".join(w) if i % 7 else invented(rng, rng.randint(1, 60))))
    out += [(200, ""), (201, None), (202, "only four words here"), (203, "Only four, words here!"), (204, "!!!"), (205, "???"), (206, "a b " * 3000), (207, "a b " * 3010)]
    return out


def test_near_classes_like_brute_force(spark):
    texts = near_texts()
    got = {r.doc_id: r.class_id for r in N.near_classes(table(spark, texts)).collect()}
    assert got == classes(texts)


def test_near_repeated_rows_and_empty_table(spark):
    df = table(spark, [(3, "x y z a b c d"), (3, "x y z a b c d"), (None, "x y z a b c d"), (5, "other text of its own kind")])
    rows = N.near_classes(df).collect()
    assert len(rows) == 4 and {r.class_id for r in rows} == {3, 5} and max(r.n_copies for r in rows) == 3
    kept = N.drop_near(df)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [3, 5]
    assert N.near_classes(df.limit(0)).count() == 0


def test_near_null_ids_and_shared_ids(spark):
    rng = random.Random(5)
    long = [invented(rng, 60) for _ in range(24)]
    rows = [(None, t) for t in long[:8]]  # alone: the hash is negative for about half of them
    for i, t in enumerate(long[8:20]):  # near copies, one of each pair without an id, in both roles
        rows += [(100 + i, t), (None, t + " more")] if i % 2 else [(None, t), (100 + i, t + " more")]
    rows += [(50, long[20]), (50, long[21]), (None, long[22]), (None, long[22] + " more")]
    df = table(spark, rows)
    got = [(r.doc_id, r.class_id) for r in N.near_classes(df).collect()]
    assert len(got) == len(rows) and {c for _, c in got} == {None, 50, *range(100, 112)}
    assert sorted(c for d, c in got if d is None and c is not None) == list(range(100, 112))
    kept = [(r.doc_id, r.text) for r in N.drop_near(df).collect()]
    ids = [d for d, _ in kept if d is not None]
    assert sorted(ids) == [50, 50, *range(100, 112)] and {t for d, t in kept if d == 50} == {long[20], long[21]}
    assert {t for d, t in kept if d is None} >= set(long[:8]) and sum(d is None for d, _ in kept) == 9


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    off = []
    for _ in range(40):
        ids, wa = rng.integers(0, 2 ** 63, 200).astype(np.uint64), rng.integers(0, 9, 200)
        wb = np.maximum(0, wa + rng.integers(-2, 3, 200))
        a, b = wa > 0, wb > 0
        s = N.signatures(np.concatenate([ids[a], ids[b]]), np.concatenate([np.zeros(a.sum(), int), np.ones(b.sum(), int)]), np.concatenate([wa[a], wb[b]]), 2, 256)
        off.append((s[0] == s[1]).mean() - np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum())
    assert abs(np.mean(off)) < 0.015


def test_components_of_a_long_chain(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101), (102, 102)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert all(got[i] == 0 for i in range(n + 1)) and got[101] == 100


def strings(texts, length=400):
    seen = collections.Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(bytes(c for c, f in zip(t, gone, strict=True) if not f)).hexdigest()))
    return out


@pytest.mark.parametrize("seed", [3, 8])
def test_repeats_like_brute_force(spark, seed):
    rng = random.Random(seed)
    base = [invented(rng, 300) for _ in range(3)]
    texts = []
    for _ in range(45):
        x = rng.random()
        if x < 0.2:
            t = invented(rng, rng.randint(0, 150))
        elif x < 0.5:  # passages at any place, with other surroundings
            b = rng.choice(base)
            a = rng.randint(0, len(b) - 200)
            t = invented(rng, rng.randint(0, 20)) + b[a:a + rng.randint(200, 1200)] + invented(rng, rng.randint(0, 20))
        elif x < 0.75:  # edited copies
            b = list(rng.choice(base))
            for _ in range(rng.randint(1, 6)):
                b[rng.randrange(len(b))] = "X"
            t = "".join(b)
        elif x < 0.9:  # periods
            t = rng.choice(["ab ", "For ", "a", "xyzé "]) * rng.randint(100, 300) + invented(rng, 4)
        else:
            t = texts[-1] if texts else ""
        texts.append(t)
    df = table(spark, [*enumerate(texts), (900, None), (901, "")])
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in R.remove_repeats(df).collect()}
    assert [got[i] for i in range(len(texts))] == strings([t.encode() for t in texts])
    assert got[900] == got[901] == (0, 0, 0, hashlib.sha256(b"").hexdigest())


def test_repeats_in_repeated_rows_and_empty_table(spark):
    t = invented(random.Random(1), 120)
    rows = R.remove_repeats(table(spark, [(1, t), (1, t), (None, "short")])).collect()
    assert sorted((r.n_removed, r.n_bytes) for r in rows) == [(0, 5), (len(t.encode()), len(t.encode()))] + [(len(t.encode()), len(t.encode()))]
    assert R.remove_repeats(table(spark, [(1, t)]).limit(0)).count() == 0


def test_packing_round_trip(spark):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = str(public.path("word_bpe_49k.json"))
    whole = tokenizers.Tokenizer.from_file(path)
    rng = random.Random(2)
    texts = {1: invented(rng, 900), 2: "", 3: None, 4: "It's 12,345.67 A.B. don't\tÉCOLE x\r\nİstanbul ΣΑΣ <|endoftext|> ́ a", 5: "a " * 5000, 6: "x" * 3000}
    df = table(spark, [*texts.items(), (6, texts[6])])
    got = P.pack(df, path).collect()
    assert len({r.sequence_id for r in got}) == len(got) and {r.sequence_id for r in got} == set(range(len(got)))
    assert all(r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 2048 and len(r.ids) == 4 * r.length for r in got)
    longest = sorted(got, key=lambda r: r.sequence_id)
    assert [r.length for r in longest] == sorted((r.length for r in got), reverse=True)
    for i, t in texts.items():
        want = whole.encode(t or "", add_special_tokens=False).ids + [1]
        rows = sorted((r for r in got if r.doc_id == i), key=lambda r: r.start)
        have = np.concatenate([np.frombuffer(r.ids, "<u4") for r in rows[:: 2 if i == 6 else 1]])
        assert have.tolist() == want and all(r.doc_tokens == len(want) for r in rows)
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in P.pack_digest(df, path).collect()}
    assert all(digest[r.doc_id, r.start] == zlib.crc32(bytes(r.ids)) for r in got)
    assert P.pack(df.limit(0), path).count() == 0


def test_packing_learns_a_word_once_whatever_mark_follows():
    pytest.importorskip("tokenizers")
    path = str(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))
    words = sorted(set(invented(random.Random(7), 400).split()))
    marks = ["", ".", ",", "***", "!!", ",&&&", ")", "'s", ":"]
    learned = []
    chunks = P.ChunkTable(path)
    learn = chunks.memo.learn
    chunks.memo.learn = lambda new: (learned.extend(new), learn(new))
    text = " ".join(w + m for w in words for m in marks)
    ids, n = chunks.encode([text, "", text])
    want = chunks.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want * 2 and n.tolist() == [len(want), 0, len(want)]
    assert len(learned) == len(set(learned)) <= len(words) + len(marks)


def test_packing_ids_of_odd_texts():
    pytest.importorskip("tokenizers")
    path = str(pytest.importorskip("public_tokenizers").path("word_bpe_49k.json"))
    chunks, rng = P.ChunkTable(path), random.Random(5)
    letters = [*"aAzZéÉßñ059'\".,;:-_*&%$#@()[]<>|/\\^`~ \n\t\r", "  ", "’", "—", "²", "½", "Ⅳ", "中", "한", "é", "́", "̸", "Я", " ", "　", "​", "\x0b", "\x1c", "\x01", "ﬁ", "ǅ", "ſ", "K", "'s", "'re", "'LL", "<|endoftext|>", "<|", "Σ", "İ", "٣", "ʼ"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(3000)]
    ids, n = chunks.encode(texts)
    at = 0
    for t, k in zip(texts, n.tolist(), strict=True):
        assert ids[at:at + k].tolist() == chunks.tokenizer.encode(t, add_special_tokens=False).ids
        at += k


def test_a_worker_holds_one_slice_of_a_batch():
    import tracemalloc

    import pyarrow as pa

    from caseflux.llm.common import slices

    rng = random.Random(5)
    texts = [None if i % 50 == 7 else " ".join(str(rng.randrange(10**5)) for _ in range(400)) for i in range(2500)]
    for some in (texts, texts[:3], [None], []):
        column = pa.array(some, pa.string())
        for kind in ({}, {"lower": True, "limit": 9000}, {"most": 7}):
            want, got = list(slices(some, **kind)), list(slices(column, **kind))
            assert [(s.lo, s.n, s.buf.tobytes(), s.at.tolist()) for s in got] == [(s.lo, s.n, s.buf.tobytes(), s.at.tolist()) for s in want]
    batch = pa.RecordBatch.from_arrays([pa.array(range(2500)), pa.array(range(2500)), pa.array(texts, pa.string())], ["_id", "_h", "_t"])
    tracemalloc.start()
    rows = sum(b.num_rows for b in N._sign([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2500 and peak < 70_000_000, peak


def test_checking_pairs_in_pieces_loses_none():
    import pyarrow as pa

    a = [f"one two three four five six seven w{i % 9}" for i in range(2 * N.PAIRS + 3)]
    b = [f"one two three four five six seven w{i % 7}" for i in range(len(a))]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(a))), pa.array(range(len(a))), pa.array(a), pa.array(b)], ["a", "b", "ta", "tb"])
    out = list(N._verify([batch, batch.slice(0, 0)]))
    assert max(x.num_rows for x in out) <= N.PAIRS
    assert [x for o in out for x in o.column("a").to_pylist()] == list(range(len(a)))
    assert np.allclose(np.concatenate([o.column("sim").to_numpy() for o in out]), N.overlap(a, b))
