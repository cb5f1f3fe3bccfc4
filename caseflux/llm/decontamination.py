"""Benchmark decontamination by templates: typed placeholders, window look-ups and consistent slots.

Words are lower-cased. A number with its separators becomes one placeholder, a unit that follows a number
another, and (in a second reading of the same text) a run of capitalised words inside a sentence, taken as a
name, a third; a third reading takes those that begin a sentence, too. Every window of WINDOW tokens with at
least MIN_LITERAL ordinary words is hashed, in the benchmark and in the documents; windows found in both are
hits. Hits of one document and item are gathered per alignment, counted in tokens of the third reading, and
also over alignments at most NEAR apart (then each place of the item takes its hits of the commonest one). A
document re-uses an item if some such group covers at least MIN_COVER of the item's windows and its slots
agree, with or without the third reading: each value of the item stands for one and the same value of the
document (the same value: a verbatim copy; another: the question with new parameters). An item too short for
a window is looked up as one window of all its words.

Places of an item without a window of enough ordinary words (sums, lists of numbers) are looked up as windows
of the tokens themselves, whose values make them specific; so is a short item without an ordinary word. The
coverage of an item is the better one of that by its template windows and that by all its windows.

The benchmark's windows are few and are broadcast in blocks of at most BLOCK windows; a larger benchmark
takes more passes over the documents, with the same result.

Defined cases: null and empty texts and items have no windows and match nothing; documents are judged by their
text, items by id and text, so texts that share an id are judged one by one and every item under a repeated
item_id is looked for; `leaks` gives one row per doc_id and item_id (the closest pair) and none for a null id,
`clean` judges rows with a null doc_id like the others; items with a null id are left out; ids may be of any
type; extra columns are ignored by `leaks` and carried along by `clean`.
"""
from __future__ import annotations

from collections import namedtuple
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM, U, byte_set, mix, prefix_sums, shared, slices, span_hashes, windows, words

WINDOW, MIN_LITERAL, MIN_COVER, NEAR = 8, 5, 0.5, 8
RAW = 3  # the reading whose tokens are not replaced
BLOCK = 500_000
# Unit words, taken as units after a number.
UNITS = ("mm", "cm", "m", "km", "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "mg", "g", "kg", "gram", "grams", "ton", "tons", "pound", "pounds",
         "lb", "lbs", "ounce", "ounces", "oz", "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons", "second", "seconds", "sec", "minute", "minutes", "min",
         "hour", "hours", "h", "day", "days", "week", "weeks", "month", "months", "year", "years", "percent", "dollar", "dollars", "usd", "cent", "cents", "euro", "euros",
         "eur", "mph", "kmh", "degree", "degrees", "celsius", "fahrenheit", "volt", "volts", "watt", "watts", "hz", "joule", "joules", "newton", "newtons")
DIGITS = byte_set(range(48, 58))
UPPER = byte_set(range(65, 91))
ENDS = byte_set(b".!?:;\n\"")
INSIDE_NUMBER, INSIDE_NAME = byte_set(b".,':/"), byte_set(b" -'")
_NUM, _UNIT, _NAME = (mix(np.array([k], U))[0] for k in (101, 102, 103))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _unit_hashes() -> np.ndarray:
    out = []
    for u in UNITS:
        b = np.frombuffer(u.encode(), np.uint8)
        out.append(span_hashes(prefix_sums(b), np.array([0]), np.array([len(b)]))[0])
    return np.sort(np.array(out, U))


_UNITS = _unit_hashes()


#: One reading of a slice: tokens of the template, their own hashes, owners, places in the first reading, and tokens that tell it from the readings before.
Reading = namedtuple("Reading", "kind tpl raw own place new")


def readings(s) -> tuple[list[Reading], np.ndarray]:
    """The readings of a slice (0: numbers and units, 1: names inside sentences, 2: all capitalised words), and each token's place in reading 2."""
    buf = _LOWER[s.buf]
    c = prefix_sums(buf)
    start, end, _, own = words(type(s)(s.lo, s.n, buf, s.at), ALNUM, c)
    digit = np.concatenate(([0], np.cumsum(DIGITS[s.buf])))
    num = digit[end] - digit[start] == end - start
    head = np.ones(len(num), bool)
    head[1:] = ~(num[1:] & num[:-1] & (own[1:] == own[:-1]) & (start[1:] - end[:-1] == 1) & INSIDE_NUMBER[s.buf[end[:-1]]])
    at = np.flatnonzero(head)
    end = end[np.append(at[1:], len(head))[:len(at)] - 1]
    start, num, own = start[at], num[at], own[at]
    raw = span_hashes(c, start, end)
    after = np.zeros(len(num), bool)
    after[1:] = num[:-1] & (own[1:] == own[:-1])
    unit = after & np.isin(raw, _UNITS)
    plain = np.where(num, _NUM, np.where(unit, _UNIT, raw))
    ends = np.concatenate(([0], np.cumsum(ENDS[s.buf])))
    inside, close = np.zeros(len(num), bool), np.zeros(len(num), bool)
    inside[1:] = (ends[start[1:]] == ends[end[:-1]]) & (own[1:] == own[:-1])
    close[1:] = inside[1:] & (start[1:] - end[:-1] == 1) & INSIDE_NAME[s.buf[end[:-1]]]
    capital = UPPER[s.buf[start]] & ~num
    out = [Reading(0, plain, raw, own, np.arange(len(raw)), np.ones(len(raw), bool))]
    for kind, name, new in ((1, capital & inside, inside), (2, capital, ~inside)):
        head = np.ones(len(name), bool)
        head[1:] = ~(name[1:] & name[:-1] & close[1:])
        at = np.flatnonzero(head)
        whole = raw[at]
        if len(at) < len(raw):  # a run of names is one token
            rank = np.arange(len(raw)) - at[np.cumsum(head) - 1]
            run = np.diff(np.append(at, len(raw))) > 1
            whole = np.where(run, np.add.reduceat(mix(raw + rank.astype(U) * _NAME), at), whole)
        out.append(Reading(kind, np.where(name, _NAME, plain)[at], whole, own[at], at, (name & new)[at]))
    return out, np.cumsum(head) - 1


def _window_rows(got: list[Reading], n: int):
    """Per reading: hash and first token of every window with enough ordinary words that no reading before has."""
    out = []
    for r in got:
        h, first = windows(r.tpl, r.own, n)
        literal, new = (np.concatenate(([0], np.cumsum(x))) for x in (r.tpl == r.raw, r.new))
        ok = (literal[first + n] - literal[first] >= min(MIN_LITERAL, n)) & (new[first + n] > new[first])
        out.append((mix(h[ok] + U(r.kind)), first[ok], r))
    return out


def _raw_windows(got: list[Reading], n: int):
    """Hash and first token of every window of n tokens as they stand, values included."""
    r = got[0]._replace(kind=RAW, tpl=got[0].raw)
    h, first = windows(r.tpl, r.own, n)
    return mix(h + U(RAW if n == WINDOW else 32 + n)), first, r


def _item_windows(batches):
    """One row per window of an item: hash, item, position in the item, and its slots."""
    for b in batches:
        ids = b.column("item_id").to_pylist()
        for s in slices(b.column("text")):
            got, coarse = readings(s)
            plain = got[0]
            n = np.bincount(plain.own, minlength=s.n)
            begin = np.concatenate(([0], np.cumsum(n)))
            rows = [(int(h), int(f), WINDOW, r) for hs, firsts, r in _window_rows(got, WINDOW) for h, f in zip(hs.view(np.int64), firsts, strict=True)]
            told = {int(r.place[f]) for _, f, _, r in rows}
            h, first, r = _raw_windows(got, WINDOW)
            rows += [(int(x), int(f), WINDOW, r) for x, f in zip(h.view(np.int64), first, strict=True) if int(f) not in told]
            for i in np.flatnonzero((n > 0) & (n < WINDOW)):
                f, k = int(begin[i]), int(n[i])
                if (plain.tpl[f:f + k] != plain.raw[f:f + k]).all():
                    h, first, r = _raw_windows(got, k)
                    rows.append((int(h.view(np.int64)[np.searchsorted(first, f)]), f, k, r))
                    continue
                w, _ = windows(plain.tpl[f:f + k], np.zeros(k, np.int64), k)
                rows.append((int(mix(w + U(16 + k)).view(np.int64)[0]), f, k, plain))
            if rows:
                item = np.array([r.own[f] for _, f, _, r in rows])
                place = np.array([r.place[f] for _, f, _, r in rows])
                slots = [[int(x) for x in r.raw[f:f + k].view(np.int64)] for _, f, k, r in rows]
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([ids[s.lo + i] for i in item], pa.int64()), pa.array(place - begin[item], pa.int32()),
                                                  pa.array(coarse[place] - coarse[begin[item]], pa.int32()), pa.array([r[3].kind for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int32()),
                                                  pa.array(slots, pa.list_(pa.int64()))], ["hash", "item_id", "pos", "coarse", "kind", "width", "slots"])


_ITEM_SCHEMA = "hash long, item_id long, pos int, coarse int, kind int, width int, slots array<long>"


def _node():
    """Documents are told apart by their text: rows without an id count too, and rows that share one are judged alone."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def _item_node():
    return F.xxhash64("item_id", "text")


def item_windows(benchmark: DataFrame) -> DataFrame:
    """Windows of every distinct (id, text) of the benchmark; their item_id is the node of that pair."""
    items = benchmark.where("item_id is not null and text is not null").select(_item_node().alias("item_id"), "text").dropDuplicates(["item_id"])
    return items.mapInArrow(_item_windows, _ITEM_SCHEMA)


class _Block:
    """Some windows of the benchmark, sorted by hash, with a bit table in front of the search."""

    def __init__(self, rows):
        self.rows = sorted(((r["hash"] & 0xFFFFFFFFFFFFFFFF, r["item_id"], r["pos"], r["kind"], r["width"], r["slots"], r["coarse"]) for r in rows), key=lambda r: r[:5])
        self.hash = np.array([r[0] for r in self.rows], U)
        self.bits = np.zeros(1 << 22, bool)
        self.bits[(self.hash >> U(42)).astype(np.int64)] = True
        self.short = sorted({r[4] for r in self.rows if r[4] != WINDOW})

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Indices of h that occur, and the range of rows with that hash."""
        near = np.flatnonzero(self.bits[(h >> U(42)).astype(np.int64)])
        lo = np.searchsorted(self.hash, h[near], side="left")
        hi = np.searchsorted(self.hash, h[near], side="right")
        on = hi > lo
        return near[on], lo[on], hi[on]


def _find(block):
    def run(batches):
        b_ = block.value
        for b in batches:
            ids = b.column("doc_id").to_pylist()
            out = [[] for _ in range(7)]
            for s in slices(b.column("text")):
                got, coarse = readings(s)
                found = [*_window_rows(got, WINDOW), _raw_windows(got, WINDOW)]
                begin = np.searchsorted(got[0].own, np.arange(s.n))
                for n in b_.short:
                    w, first = windows(got[0].tpl, got[0].own, n)
                    found += [(mix(w + U(16 + n)), first, got[0]), _raw_windows(got, n)]
                for hs, firsts, t in found:
                    at, lo, hi = b_.hits(hs)
                    for f, x, y in zip(firsts[at].tolist(), lo.tolist(), hi.tolist(), strict=True):
                        doc = int(t.own[f])
                        place = int(coarse[t.place[f]] - coarse[begin[doc]])
                        for r in b_.rows[x:y]:
                            mine = t.raw[f:f + r[4]].view(np.int64)
                            slot = np.flatnonzero(t.tpl[f:f + r[4]] != t.raw[f:f + r[4]])
                            out[0].append(ids[s.lo + doc])
                            out[1].append(r[1])
                            out[2].append(place - r[6])
                            out[3].append(r[2])
                            out[4].append(t.kind)
                            out[5].append([r[5][k] for k in slot])
                            out[6].append([int(mine[k]) for k in slot])
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int32()), pa.array(out[4], pa.int32()),
                                              pa.array(out[5], pa.list_(pa.int64())), pa.array(out[6], pa.list_(pa.int64()))], ["doc_id", "item_id", "shift", "pos", "kind", "theirs", "ours"])

    return run


def _groups(hits: DataFrame) -> DataFrame:
    """Hits by alignment (columns near, shift), with and without sentence-start names (column starts): one row per hit and group."""
    one = Window.partitionBy("doc_id", "item_id")
    far = F.col("shift") - F.lag("shift").over(one.orderBy("shift")) > NEAR
    marked = hits.withColumn("new", F.coalesce(far.cast("int"), F.lit(1))).withColumn("chain", F.sum("new").over(one.orderBy("shift")))
    marked = marked.withColumn("votes", F.count("*").over(Window.partitionBy("doc_id", "item_id", "shift")))
    vote = F.struct("votes", -F.col("shift"))
    marked = marked.withColumn("first", vote == F.max(vote).over(Window.partitionBy("doc_id", "item_id", "chain", "pos")))
    both = F.array(F.struct(F.lit(False).alias("near"), F.col("shift").alias("place")), F.struct(F.lit(True).alias("near"), F.col("chain").alias("place")))
    out = marked.withColumn("g", F.explode(both)).where("first or not g.near").withColumn("starts", F.explode(F.array(F.lit(False), F.lit(True)))).where("starts or kind != 2")
    return out.select("doc_id", "item_id", F.struct("g", "starts").alias("g"), "pos", "kind", "theirs", "ours")


def _leaks(docs: DataFrame, benchmark: DataFrame, min_cover: float, block_size: int) -> DataFrame:
    """Nodes of documents and items that share enough: doc_id, item_id (both nodes), n_windows, coverage, same."""
    spark = docs.sparkSession
    shared(spark)
    items = item_windows(benchmark)
    total = items.groupBy("item_id").agg(F.countDistinct(F.when(F.col("kind") != RAW, F.col("pos"))).alias("n_told"), F.countDistinct("pos").alias("n_item"))
    blocks = max(1, -(-items.count() // block_size))
    text = docs.where("text is not null").select(_node().alias("doc_id"), "text")
    found = []
    for k in range(blocks):
        rows = items.where(F.pmod("hash", F.lit(blocks)) == k).collect()  # about block_size rows, checked by the count above
        found.append(text.mapInArrow(_find(spark.sparkContext.broadcast(_Block(rows))), "doc_id long, item_id long, shift long, pos int, kind int, theirs array<long>, ours array<long>"))
    hits = _groups(reduce(DataFrame.unionByName, found).distinct())  # copies of a text are one node
    pairs = F.explode(F.arrays_zip(F.concat(F.array(F.lit(0).cast("long")), "theirs").alias("t"), F.concat(F.array(F.lit(0).cast("long")), "ours").alias("o")))
    slots = hits.select("doc_id", "item_id", "g", "pos", "kind", pairs.alias("s")).select("doc_id", "item_id", "g", "pos", "kind", F.col("s.t").alias("t"), F.col("s.o").alias("o"))
    # every hit carries one neutral pair, so hits without slots stay
    value = slots.groupBy("doc_id", "item_id", "g", "t").agg(F.min("o").alias("lo"), F.max("o").alias("hi"), F.collect_set("pos").alias("at"),
                                                                 F.collect_set(F.when(F.col("kind") != RAW, F.col("pos"))).alias("told"))
    alike = value.groupBy("doc_id", "item_id", "g").agg(
        F.bool_and(F.col("lo") == F.col("hi")).alias("ok"), F.bool_and(F.col("t") == F.col("lo")).alias("same"), F.max(F.when(F.col("t") == 0, F.size("at"))).alias("n_at"),
        F.max(F.when(F.col("t") == 0, F.size("told"))).alias("n_told_at"))
    told = F.struct((F.col("n_told_at") / F.col("n_told")).alias("cover"), "same", F.col("n_told_at").alias("n"))
    every = F.struct((F.col("n_at") / F.col("n_item")).alias("cover"), "same", F.col("n_at").alias("n"))
    best = alike.where("ok").join(total, "item_id").groupBy("doc_id", "item_id").agg(F.max(F.when(F.col("n_told") > 0, F.greatest(told, every)).otherwise(every)).alias("b"))
    return best.where(F.col("b.cover") >= min_cover).select("doc_id", "item_id", F.col("b.n").cast("long").alias("n_windows"), F.col("b.cover").alias("coverage"), "b.same")


def leaks(docs: DataFrame, benchmark: DataFrame, min_cover: float = MIN_COVER, block_size: int = BLOCK) -> DataFrame:
    """Documents that re-use an item: doc_id, item_id, n_windows, coverage, kind ('verbatim' or 'new parameters').

    One row per id and item: of several texts under one id, or items under one item id, the closest pair. Documents
    without an id have no row here; `clean` judges them like the others. Ids keep their type; integers become long.
    """
    found = _leaks(docs, benchmark, min_cover, block_size).withColumnsRenamed({"doc_id": "_node", "item_id": "_item"})
    wide = lambda df, c: F.col(c).cast("long") if df.schema[c].dataType.simpleString() in ("tinyint", "smallint", "int") else F.col(c)
    ids = docs.where("doc_id is not null and text is not null").select(wide(docs, "doc_id").alias("doc_id"), _node().alias("_node"))
    names = benchmark.where("item_id is not null and text is not null").select(wide(benchmark, "item_id").alias("item_id"), _item_node().alias("_item")).distinct()
    rows = found.join(names, "_item").join(ids, "_node")
    best = rows.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "same", "n_windows")).alias("b"))
    return best.select("doc_id", "item_id", "b.n_windows", F.round("b.coverage", 6).alias("coverage"), F.when(F.col("b.same"), "verbatim").otherwise("new parameters").alias("kind"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that re-use no item, with all their columns; each row is judged by its own text."""
    bad = _leaks(docs, benchmark, MIN_COVER, BLOCK).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, _node() == F.col("_bad"), "left_anti")
