"""Bijections, distributed numbering and permutation tests against plain versions."""
import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caseflux.operators import ordering as O
from caseflux.operators import spatial as G


def plain_bijection(x, key, n):
    a, b = G.sides(n)
    h = hashlib.md5(key.encode()).hexdigest()
    k = [int(h[5 * i:5 * i + 5], 16) for i in range(G.ROUNDS)]
    f = lambda v, i: ((v + k[i]) * 1103515245 + 12345) % 2**31 // 1024
    while True:
        l, r = divmod(x, b)
        for i in range(G.ROUNDS):
            if i % 2 == 0:
                l = (l + f(r, i)) % a
            else:
                r = (r + f(l, i)) % b
        x = l * b + r
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 7, 24, 25, 26, 101, 997])
def test_bijection(spark, n):
    a, b = G.sides(n)
    assert n <= a * b < n + max(a, 2)
    rows = spark.range(n).withColumn("key", F.explode(F.array(F.lit("1|9"), F.lit("2|9")))).select("id", "key", G.bijection(F.col("id"), F.col("key"), n).alias("to")).collect()
    for key in ("1|9", "2|9"):
        got = {r["id"]: r["to"] for r in rows if r["key"] == key}
        assert sorted(got.values()) == list(range(n))
        assert got == {i: plain_bijection(i, key, n) for i in range(n)}


def test_permutations_are_even(spark):
    n, reps = 30, 3000
    got = Counter(r["to"] for r in spark.range(reps).select(G.bijection(F.lit(7), F.concat(F.lit("r"), F.col("id").cast("string")), n).alias("to")).collect())
    assert all(55 <= got[i] <= 150 for i in range(n))  # 100 each, 4.5 standard deviations


def test_local_moran_like_brute_force(spark):
    r = random.Random(6)
    units = [f"u{i:02d}" for i in range(23)]
    y = {u: r.choice([None, 0.0, 1.0, r.random() * 9]) for u in units}
    edges = sorted({(a, b) for i, a in enumerate(units) for b in (units[(i + 1) % 23], units[(i + 2) % 23]) for a, b in ((a, b), (b, a))})
    perms, seed = 49, 5
    got = {x["unit"]: x for x in G.local_moran(spark.createDataFrame(list(y.items()), "unit string, y double"), spark.createDataFrame(edges, "unit string, neighbor string"), perms, seed).collect()}
    mean = sum(v or 0.0 for v in y.values()) / 23
    z = [(y[u] or 0.0) - mean for u in units]
    near = {u: [units.index(b) for a, b in edges if a == u] for u in units}
    for i, u in enumerate(units):
        lag = sum(z[j] for j in near[u]) / len(near[u])
        larger = 0
        for rep in range(1, perms + 1):
            draw = [plain_bijection(s, f"{u}|{rep}|{seed}", 22) for s in range(len(near[u]))]
            assert len(set(draw)) == len(draw)
            mean_drawn = sum(z[d + (d >= i)] for d in draw) / len(draw)
            larger += round(z[i] * mean_drawn, 12) >= round(z[i] * lag, 12)
        assert abs(got[u]["local_i"] - 22 * z[i] * lag / sum(v * v for v in z)) < 1e-9
        assert got[u]["p_value"] == (min(larger, perms - larger) + 1) / (perms + 1)


def test_global_moran_like_brute_force(spark):
    units = [f"u{i:02d}" for i in range(11)]
    y = {u: float(i * i % 7) for i, u in enumerate(units)}
    edges = [(units[i], units[(i + d) % 11]) for i in range(11) for d in (-1, 1, 2)]
    got = G.morans_i(spark.createDataFrame(list(y.items()), "unit string, y double"), spark.createDataFrame(edges, "unit string, neighbor string"), 29, 3).first()
    mean = sum(y.values()) / 11
    z = [y[u] - mean for u in units]
    moran = lambda v: 11 / 11 * sum(v[units.index(a)] * v[units.index(b)] / 3 for a, b in edges) / sum(x * x for x in z)
    sims = [moran([z[plain_bijection(i, f"{rep}|3", 11)] for i in range(11)]) for rep in range(1, 30)]
    larger = sum(round(s, 12) >= round(moran(z), 12) for s in sims)
    assert abs(got["moran_i"] - moran(z)) < 1e-9 and got["p_value"] == (min(larger, 29 - larger) + 1) / 30


def test_numbering_and_ranks_over_ranges(spark):
    r = random.Random(2)
    rows = [(i, r.choice([None, float("nan"), 1.0, 1.0, 2.5, r.random()])) for i in range(300)]
    d = spark.createDataFrame(rows, "id int, v double").repartition(5)
    assert [x["pos"] for x in O.numbered(d, ["id"]).orderBy("id").collect()] == list(range(1, 301))
    known = [v for _, v in rows if v is not None and v == v]
    got = {x["id"]: x["rank"] for x in O.competition_rank(d, "v").collect()}
    assert got == {i: None if v is None or v != v else 1 + sum(w > v for w in known) for i, v in rows}
    total = {x["id"]: x["t"] for x in O.running_total(d, ["id"], F.col("id").cast("long"), "t", 7).collect()}
    assert total == {i: i * (i + 1) // 2 for i in range(300)}
    assert O.numbered(d.limit(0), ["id"]).count() == 0 and O.competition_rank(d.limit(0), "v").count() == 0
