"""Near-duplicate classes by BagMinHash signatures of word shingles, banding and exact verification.

A text is the multiset of its five-word shingles. Register values come from Poisson processes: a shingle
with weight (count) w owns the integer levels 0..w-1, cut into dyadic blocks [0,1), [1,2), [2,4) ...;
each block has one process of points in time whose rate is its width, every point falls on a register and,
by halving the block bit by bit, on a level, and counts if that level is below w. A register keeps the
earliest point it sees. So two signatures agree in a register with exactly the weighted Jaccard similarity
as probability, and a weight of w costs log w blocks. Points later than any register's value are never
made: a time limit per text is tried and doubled until all registers are filled.

Signatures are banded. Identical texts, and texts with the same bag of shingles, are one node first. In
each bucket the member that shares most buckets overall is the pivot, and every other member is verified
against it by exact multiset overlap. Members of different classes that still meet in a bucket are then
verified against each other, unless the shingles that only one of them has, or a longer signature of one bit
a register, rule the similarity out; a pair is made in the first bucket it shares only. Pairs inside a class are
never listed, and nothing is capped. What remains can still grow with the square of a group of texts that are all
about as similar as the threshold and yet unlinked, as no bound tells such pairs apart. A pair at
the similarity is missed with a probability of about 3e-5, by the bands (20 of 4) and the sketch together.

Defined cases: null counts as the empty text; texts with under five words have one shingle of all their
words; texts without words are near only to identical texts; texts are told apart by their own 64-bit hash, never
by doc_id, so a null doc_id joins classes like any other row and one id may have several texts; a class
without any id has a null class_id, and an id whose texts lie in several classes may name each of them;
repeated rows give repeated result rows; extra columns are ignored.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, U, components, mix, prefix_sums, release, settle, slices, windows, words

SHINGLE = 5
SIMILARITY = 0.8
ROWS, BANDS = 4, 20  # a pair at similarity 0.8 is missed with probability 3e-5
REGISTERS = ROWS * BANDS
SKETCH = 1024
PAIRS = 250  # pairs whose texts a worker takes out of a batch at once
_ODD = U(0x9E3779B97F4A7C15)
_UNIT = 2.0 ** -64


def _odd(k: int) -> np.uint64:
    return U(k * int(_ODD) & 0xFFFFFFFFFFFFFFFF)


def bags(s) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text of a slice: hash, owning text, count."""
    _, _, h, own = words(s, ALNUM, prefix_sums(s.buf))
    w, first = windows(h, own, SHINGLE)
    o = own[first]
    n = np.bincount(own, minlength=s.n)
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        on = np.isin(own, short)
        begin = np.flatnonzero(np.concatenate(([True], own[on][1:] != own[on][:-1])))
        rank = np.arange(on.sum()) - np.repeat(begin, np.diff(np.append(begin, on.sum())))
        part = mix(h[on] + rank.astype(U) * _ODD)
        w, o = np.concatenate([w, np.add.reduceat(part, begin)]), np.concatenate([o, own[on][begin]])
    order = np.lexsort((w, o)) if len(short) else np.argsort(mix(w + o.astype(U) * _ODD), kind="stable")
    w, o = w[order], o[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (o[1:] != o[:-1])
    at = np.flatnonzero(new)
    return w[at], o[at], np.diff(np.append(at, len(w)))


def signatures(h: np.ndarray, own: np.ndarray, count: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash registers (point hashes; 0 rows for texts without shingles) of n weighted sets."""
    value = np.full((n, registers), np.inf)
    name = np.zeros((n, registers), U)
    weight = np.bincount(own, weights=count, minlength=n)
    todo = weight > 0
    limit = np.where(todo, 1.5 * np.log(registers) / np.maximum(weight, 1), 0.0)
    top = np.ceil(np.log2(np.maximum(count, 1))).astype(int)
    while todo.any():
        live = todo[own]
        e, o, c, t = h[live], own[live], count[live], top[live]
        where, when, what = [], [], []
        for k in range(int(t.max(initial=0)) + 1):
            on = t >= k
            be, bo, bc = e[on], o[on], c[on]
            low, width = (0, 1) if k == 0 else (1 << (k - 1), 1 << (k - 1))
            seed = mix(be + _odd(k + 1))
            x = np.zeros(len(be))
            step = 0
            while len(be):
                u = mix(seed + _odd(3 * step + 1))
                x = x - np.log((u.astype(np.float64) + 1.0) * _UNIT) / (registers * width)
                on = x <= limit[bo]
                be, bo, bc, seed, x = be[on], bo[on], bc[on], seed[on], x[on]
                place = mix(seed + _odd(3 * step + 2))
                level = np.full(len(be), low, np.int64)
                half = width >> 1
                bit = 63
                while half:  # which half of the block, down to one level
                    level += half * ((place >> U(bit)) & U(1)).astype(np.int64)
                    half >>= 1
                    bit -= 1
                hit = level < bc
                reg = (mix(place) % U(registers)).astype(np.int64)
                where.append(bo[hit] * registers + reg[hit])
                when.append(x[hit])
                what.append(mix(seed[hit] + _odd(3 * step + 3)))
                step += 1
        if where:
            where, when, what = np.concatenate(where), np.concatenate(when), np.concatenate(what)
            np.minimum.at(value.reshape(-1), where, when)
            first = when == value.reshape(-1)[where]
            name.reshape(-1)[where[first]] = what[first]
        todo &= ~np.isfinite(value).all(axis=1)
        limit = np.where(todo, limit * 2, limit)
        value[todo], name[todo] = np.inf, 0
    return name


def _sign(batches):
    """Per row: bag hash, number of shingles and band keys."""
    for b in batches:
        bag, size, keys = [], [], []
        for s in slices(b.column("_t"), lower=True):
            h, own, count = bags(s)
            sig = signatures(h, own, count, s.n)
            total = np.zeros(s.n, U)
            np.add.at(total, own, mix(h + count.astype(U) * _ODD))
            band = np.zeros((s.n, BANDS), U)
            for r in range(ROWS):
                band = mix(band * _ODD + sig[:, r::ROWS])
            band = mix(band + np.arange(1, BANDS + 1, dtype=U) * _ODD)
            some = np.bincount(own, minlength=s.n) > 0
            bag += [int(x) if y else None for x, y in zip(total.view(np.int64), some, strict=True)]
            size += np.bincount(own, weights=count, minlength=s.n).astype(np.int64).tolist()
            keys += [x.tolist() if y else [] for x, y in zip(band.view(np.int64), some, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("_h"), pa.array(bag, pa.int64()), pa.array(size, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["id", "h", "bag", "size", "keys"])


def overlap(a: list, b: list) -> np.ndarray:
    """Multiset Jaccard similarity of the shingles of pairs of texts."""
    out = np.zeros(len(a))
    lo = 0
    while lo < len(a):
        hi, size = lo, 0
        while hi < len(a) and (hi == lo or size < 1_000_000):
            size += len(a[hi]) + len(b[hi])
            hi += 1
        n = hi - lo
        s = next(slices(a[lo:hi] + b[lo:hi], lower=True, limit=1 << 62, most=1 << 62))
        h, own, count = bags(s)
        total = np.bincount(own, weights=count, minlength=2 * n)
        key = mix(h + (own % n).astype(U) * _ODD)
        o = np.argsort(key, kind="stable")
        same = key[o][1:] == key[o][:-1]
        both = np.bincount(own[o[1:]][same] % n, weights=np.minimum(count[o[1:]], count[o[:-1]])[same], minlength=n)
        out[lo:hi] = both / np.maximum(total[:n] + total[n:] - both, 1)
        lo = hi
    return out


def _verify(batches):
    for b in (x.slice(lo, PAIRS) for x in batches for lo in range(0, x.num_rows, PAIRS)):
        sim = overlap([x or "" for x in b.column("ta").to_pylist()], [x or "" for x in b.column("tb").to_pylist()])
        yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(sim)], ["a", "b", "sim"])


def _shingle_rows(batches):
    for b in batches:
        ids = b.column("node").to_numpy()
        at = 0
        for s in slices(b.column("t"), lower=True):
            h, own, count = bags(s)
            yield pa.RecordBatch.from_arrays([pa.array(ids[at + own]), pa.array(h.view(np.int64)), pa.array(count)], ["node", "shingle", "n"])
            at += s.n


_BITS = [f"s{i}" for i in range(SKETCH // 64)]


def _sketches(batches):
    """One bit of each of SKETCH registers per text."""
    for b in batches:
        ids = b.column("node")
        rows = np.zeros((b.num_rows, len(_BITS)), np.int64)
        for s in slices(b.column("t"), lower=True, most=100):  # some 10,000 points a text
            bit = (signatures(*bags(s), s.n, SKETCH) & U(1)).astype(np.uint8)
            rows[s.lo:s.lo + s.n] = np.packbits(bit, axis=1).view(np.int64)
        yield pa.RecordBatch.from_arrays([ids, *(pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(_BITS)))], ["m", *_BITS])


def most_bits(similarity: float, sigmas: float = 4.5) -> int:
    """Sketch bits that texts at the similarity differ in at most, but for a chance of 3 in a million."""
    p = (1 - similarity) / 2
    return int(SKETCH * p + sigmas * (SKETCH * p * (1 - p)) ** 0.5)


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _classes(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """Rows (id, h), and texts (h, id, n_copies, lead): lead is the first of (without id, id, h) in the text's class."""
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.coalesce("text", F.lit("")).alias("_t"))
    rows = rows.withColumn("_h", _hash(F.col("_t")))
    signed = settle(rows.mapInArrow(_sign, "id long, h binary, bag long, size long, keys array<long>"))
    # one node per text, named by its hash: ids may be missing, or be given to several texts
    texts = settle(signed.groupBy("h").agg(F.min("id").alias("id"), F.count("*").alias("n_copies"), F.min("bag").alias("bag"), F.min("size").alias("size"), F.min("keys").alias("keys"))
                   .withColumn("node", F.xxhash64("h")))
    release(docs.sparkSession)
    # texts with one and the same bag of shingles are linked to the smallest of them
    heads = texts.where("bag is not null").groupBy("bag").agg(F.min("node").alias("head"), F.min("size").alias("size"), F.first("keys").alias("keys"))
    same = texts.join(heads.select("bag", "head"), "bag").where("node != head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    buckets = heads.select(F.col("head").alias("m"), "size", F.explode("keys").alias("key"))
    crowd = buckets.groupBy("key").agg(F.count("*").alias("crowd")).where("crowd > 1")
    members = settle(buckets.join(crowd, "key"))
    degree = members.groupBy("m").agg(F.sum("crowd").alias("degree"))
    pivots = members.join(degree, "m").groupBy("key").agg(F.max_by("m", F.struct("degree", F.bitwise_not("m"))).alias("p"))
    star = members.join(pivots, "key").where("m != p").select(F.least("m", "p").alias("a"), F.greatest("m", "p").alias("b")).distinct()
    want = texts.join(members.select(F.col("m").alias("node")).distinct(), "node").select(F.col("h").alias("wh"), F.col("id").alias("wid"), "node")
    body = rows.join(want, (F.col("_h") == F.col("wh")) & F.col("_id").eqNullSafe(F.col("wid"))).groupBy("node").agg(F.first("_t").alias("t"))
    body = settle(body)  # the texts that share a bucket, once each
    release(docs.sparkSession)
    links = settle(_check(star, body, similarity).unionByName(same))
    roots = components(links)
    # buckets that still hold members of several classes
    placed = members.select("key", "m", "size").join(roots.withColumnRenamed("node", "m"), "m", "left").withColumn("root", F.coalesce("root", "m"))
    mixed = placed.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi").select("key", "lo")
    open_ = settle(placed.join(mixed, "key"))
    release(docs.sparkSession)
    # what a text has of shingles that no other open text has can overlap with none of them
    shingles = body.join(open_.select(F.col("m").alias("node")).distinct(), "node").mapInArrow(_shingle_rows, "node long, shingle long, n long")
    own = shingles.groupBy("shingle").agg(F.count("*").alias("k"), F.min("node").alias("m"), F.min("n").alias("n")).where("k = 1").groupBy("m").agg(F.sum("n").alias("own"))
    open_ = open_.join(own, "m", "left").withColumn("free", F.col("size") - F.coalesce("own", F.lit(0)))
    open_ = settle(open_.where(F.col("free") >= similarity * F.col("size")))
    # and texts whose longer signatures, one bit a register, differ too much are not near
    names = open_.groupBy(F.col("m").alias("node")).agg(F.array_sort(F.collect_set("key")).alias("all_keys"))  # at most BANDS keys
    open_ = open_.join(names.withColumnRenamed("node", "m"), "m")
    open_ = open_.join(body.join(names.select("node"), "node").mapInArrow(_sketches, f"m long, {', '.join(f'{x} long' for x in _BITS)}"), "m")
    other = open_.where("root != lo").select("key", F.col("m").alias("p"), F.col("size").alias("psize"), F.col("free").alias("pfree"), F.col("root").alias("proot"), F.col("all_keys").alias("pkeys"), *[F.col(x).alias(f"p{x}") for x in _BITS])
    most = F.least("free", "pfree")
    apart = F.expr(" + ".join(f"bit_count({x} ^ p{x})" for x in _BITS))
    near = (F.col("root") != F.col("proot")) & (most >= similarity * (F.col("size") + F.col("psize") - most)) & (apart <= most_bits(similarity))
    once = F.array_min(F.array_intersect("all_keys", "pkeys")) == F.col("key")  # a pair is made in the first bucket it shares
    pairs = open_.join(other, "key").where(near & once)
    pairs = pairs.select(F.least("m", "p").alias("a"), F.greatest("m", "p").alias("b")).distinct().join(star, ["a", "b"], "left_anti")
    more = settle(_check(pairs, body, similarity))
    release(docs.sparkSession)
    roots = components(links.unionByName(more))
    lead = F.struct(F.col("id").isNull().alias("no_id"), "id", "h")
    placed = settle(texts.select("h", "id", "node", "n_copies").join(roots, "node", "left"))
    linked = placed.where("root is not null")
    leads = settle(linked.groupBy("root").agg(F.min(lead).alias("lead")))
    nodes = linked.join(leads, "root").select("h", "id", "n_copies", "lead").unionByName(placed.where("root is null").select("h", "id", "n_copies", lead.alias("lead")))
    return signed.select("id", "h"), nodes


def near_classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class), n_copies (documents with its very text)."""
    rows, nodes = _classes(docs, similarity)
    return rows.join(nodes.drop("id"), "h").select(F.col("id").alias("doc_id"), F.col("lead.id").alias("class_id"), "n_copies")


def _check(pairs: DataFrame, body: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts reach the similarity."""
    both = pairs.join(body.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a").join(body.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b")
    return both.mapInArrow(_verify, "a long, b long, sim double").where(F.col("sim") >= similarity).select("a", "b")


def drop_near(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class stays: the one with the smallest id, any id before none (of repeated rows, one)."""
    _, nodes = _classes(docs, similarity)
    first = nodes.where(F.col("h") == F.col("lead.h")).select(F.col("id").alias("_keep"), F.col("h").alias("_kh"))
    marked = docs.withColumn("_near_h", _hash(F.col("text")))
    kept = marked.join(first, F.col("_near_h").eqNullSafe(F.col("_kh")) & docs["doc_id"].cast("long").eqNullSafe(F.col("_keep")), "left_semi")
    return kept.dropDuplicates(["doc_id", "_near_h"]).select(*docs.columns)
