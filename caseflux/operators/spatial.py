"""Spatial autocorrelation on unit tables (MD10-MD12).

Permutations are computed, not sorted: a seeded bijection of the unit numbers 0..n-1 tells, for each unit and
replicate, whose value it gets. Nothing is ordered per replicate, and values are looked up by unit number, where
each number is asked for equally often.
"""
from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import fold
from .ordering import numbered


def contiguity(vertices: DataFrame, digits: int = 6) -> DataFrame:
    """MD12: queen neighbours: units that share a vertex. Repeated vertices of a ring are folded first."""
    v = vertices.select("code", F.round("x", digits).alias("_x"), F.round("y", digits).alias("_y")).distinct()
    o = v.withColumnRenamed("code", "neighbor")
    return v.join(o, ["_x", "_y"]).filter(F.col("code") != F.col("neighbor")).select(F.col("code").alias("unit"), "neighbor").distinct()


def _centred(values: DataFrame) -> DataFrame:
    mean = values.agg(F.avg(F.coalesce("y", F.lit(0.0)))).scalar()
    return numbered(values.select("unit", (F.coalesce("y", F.lit(0.0)) - mean).alias("z")), ["unit"]).withColumn("pos", F.col("pos") - 1)


def sides(n: int) -> tuple[int, int]:
    """Sides of the smallest near-square grid of at least n cells."""
    root = max(isqrt(n), 1)
    a = min(range(root, max(root // 2, 1) - 1, -1), key=lambda a: a * -(-n // a))
    return a, -(-n // a)


ROUNDS = 6


def bijection(x: Column, key: Column, n: int) -> Column:
    """Another number below n for every x below n, by the key (text): an alternating network on the cells of a grid.

    A number is a cell (l, r); each round moves one coordinate by a hash of the other. Cells beyond n are sent on
    until one below n comes, after at most as many steps as there are such cells.
    """
    a, b = sides(n)
    word = lambda i: F.conv(F.substring(F.md5(key), 5 * i + 1, 5), 16, 10).cast("long")
    keys = F.array(*[word(i) for i in range(ROUNDS)])

    def mixed(v: Column, i: int, k: Column) -> Column:
        return F.call_function("div", ((v + k[i]) * 1103515245 + 12345) % 2147483648, F.lit(1024).cast("long"))

    def once(v: Column, k: Column) -> Column:
        cell = F.struct(F.call_function("div", v, F.lit(b).cast("long")).alias("l"), (v % b).alias("r"))
        for i in range(ROUNDS):  # an element of an array is computed once
            move = (lambda i: lambda c: F.struct(((c["l"] + mixed(c["r"], i, k)) % a).alias("l"), c["r"].alias("r")) if i % 2 == 0 else
                    F.struct(c["l"].alias("l"), ((c["r"] + mixed(c["l"], i, k)) % b).alias("r")))(i)
            cell = F.transform(F.array(cell), move)[0]
        return F.transform(F.array(cell), lambda c: c["l"] * b + c["r"])[0]

    def walk(k: Column) -> Column:
        out = once(x.cast("long"), k)
        for_ever = a * b - n
        return out if not for_ever else F.aggregate(F.sequence(F.lit(1), F.lit(for_ever)), out, lambda v, _: F.when(v < n, v).otherwise(once(v, k)))

    return F.transform(F.array(keys), walk)[0]


def _shuffled(z: DataFrame, n: int, perms: int, seed: int) -> DataFrame:
    """Replicates of the values in the order of a bijection by (replicate, seed): the same on any cluster."""
    r = z.select("unit", "pos", F.explode(F.sequence(F.lit(1), F.lit(perms))).alias("rep"))
    r = r.withColumn("_from", bijection(F.col("pos"), F.concat_ws("|", F.col("rep").cast("string"), F.lit(str(seed))), n))
    return r.join(z.select(F.col("pos").alias("_from"), "z"), "_from")


def _p(larger, perms: int):
    return (F.least(larger, perms - larger) + 1) / F.lit(float(perms + 1))


def morans_i(values: DataFrame, edges: DataFrame, perms: int = 999, seed: int = 12345) -> DataFrame:
    """MD10: Moran's I with row-standardised weights and a permutation p value. values: unit, y."""
    z, edges = fold(_centred(fold(values))), fold(edges)  # one row per unit and per neighbour, read many times below
    deg = edges.groupBy("unit").agg(F.count(F.lit(1)).alias("k"))
    e = edges.join(deg, "unit")
    n = z.count()
    base = z.select("unit", F.lit(0).alias("rep"), "z")
    allz = base.unionByName(_shuffled(z, n, perms, seed).select("unit", "rep", "z")) if n else base
    near = allz.select(F.col("unit").alias("neighbor"), "rep", F.col("z").alias("zn"))
    cross = allz.join(e, "unit").join(near, ["neighbor", "rep"]).groupBy("rep").agg(F.sum(F.col("z") * F.col("zn") / F.col("k")).alias("num"))
    tot = z.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("z") * F.col("z")).alias("ss"))
    s0 = deg.agg(F.count(F.lit(1))).scalar()
    i = F.col("num") * tot.select("n").scalar() / s0 / tot.select("ss").scalar()
    sims = cross.select("rep", i.alias("i"))
    obs = sims.filter("rep = 0").agg(F.max("i")).scalar()
    out = sims.agg(F.max(F.when(F.col("rep") == 0, F.col("i"))).alias("moran_i"),
                   F.count_if((F.col("rep") > 0) & (F.round("i", 12) >= F.round(obs, 12))).alias("larger"))
    return out.select("moran_i", F.lit(perms).alias("permutations"), _p(F.col("larger"), perms).alias("p_value"))


def local_moran(values: DataFrame, edges: DataFrame, perms: int = 999, seed: int = 12345, alpha: float = 0.05) -> DataFrame:
    """MD11: local Moran with quadrant; the value of a unit is held, its neighbours are drawn from all others.

    A unit with k neighbours gets, per replicate, the first k places of its own bijection of the other units."""
    z, edges = fold(_centred(fold(values))), fold(edges)  # one row per unit and per neighbour, read many times below
    deg = edges.groupBy("unit").agg(F.count(F.lit(1)).alias("k"))
    lag = edges.join(z.select(F.col("unit").alias("neighbor"), F.col("z").alias("zn")), "neighbor").groupBy("unit").agg(F.avg("zn").alias("lag"))
    n = z.count()
    ss = z.agg(F.sum(F.col("z") * F.col("z"))).scalar()
    u = z.join(deg, "unit").join(lag, "unit").select("unit", "pos", "z", "k", "lag", ((n - 1) * F.col("z") * F.col("lag") / ss).alias("local_i"))
    slots = u.select(F.col("unit").alias("u"), "pos", "k", F.explode(F.sequence(F.lit(1), F.lit(perms))).alias("rep"))
    slots = slots.select("u", "rep", "pos", F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.col("k"), F.lit(n - 1)) - 1)).alias("slot"))
    key = F.concat_ws("|", F.col("u").cast("string"), F.col("rep").cast("string"), F.lit(str(seed)))
    at = bijection(F.col("slot"), key, max(n - 1, 1))
    d = slots.select("u", "rep", (at + F.when(at >= F.col("pos"), 1).otherwise(0)).alias("donor")).join(z.select(F.col("pos").alias("donor"), F.col("z").alias("dz")), "donor")
    sim = d.groupBy(F.col("u").alias("unit"), "rep").agg(F.avg("dz").alias("slag"))
    j = sim.join(u, "unit")
    larger = F.count_if(F.round(F.col("z") * F.col("slag"), 12) >= F.round(F.col("z") * F.col("lag"), 12))
    p = j.groupBy("unit").agg(larger.alias("larger"))
    out = u.join(p, "unit").withColumn("p_value", _p(F.col("larger"), perms))
    quad = (F.when((F.col("z") > 0) & (F.col("lag") > 0), "Alto-Alto").when((F.col("z") <= 0) & (F.col("lag") > 0), "Baixo-Alto")
            .when((F.col("z") <= 0) & (F.col("lag") <= 0), "Baixo-Baixo").otherwise("Alto-Baixo"))
    return out.select("unit", "local_i", "p_value", F.when(F.col("p_value") < alpha, quad).otherwise("Não significativo").alias("cluster"))
