"""Association statistics (MD1-MD9, MD26, AG55, MD13).

Counting is done by Spark over the case rows; the closed forms run on the few aggregated rows. Two
tail probabilities that Spark SQL lacks are small Arrow functions on those rows.
"""
from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import numbers as N
from .filters import fold
from .series import pct_rank


def _fisher_udf():
    """Arrow function on result rows. Defined inside, so that executors need no copy of this package."""

    def fisher(a: int, b: int, c: int, d: int) -> float:
        # Mass of all tables no likelier than the observed one. Log masses are cumulated over 40
        # standard deviations around the mean, beyond which a double holds nothing.
        r1, c1, n = a + b, a + c, a + b + c + d
        lo, hi = max(0, r1 + c1 - n), min(r1, c1)
        if lo == hi:
            return 1.0
        mean = r1 * c1 / n
        sd = math.sqrt(max(mean * (n - r1) / n * (n - c1) / max(n - 1, 1), 1.0))
        k0, k1 = max(lo, int(mean - 40 * sd) - 50), min(hi, int(mean + 40 * sd) + 50)
        if not k0 <= a <= k1:
            return 0.0
        k = np.arange(k0, k1, dtype=float)
        step = np.log(r1 - k) + np.log(c1 - k) - np.log(k + 1) - np.log(n - r1 - c1 + k + 1)
        logs = np.concatenate([[0.0], np.cumsum(step)])
        p = np.exp(logs - logs.max())
        return float(min(1.0, p[p <= p[a - k0] * (1 + 1e-7)].sum() / p.sum()))

    def tails(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series([fisher(int(w), int(x), int(y), int(z)) for w, x, y, z in zip(a, b, c, d)], dtype=float)

    return F.pandas_udf(tails, DoubleType())


def _chi2_udf():
    def tail(x: float, dof: int) -> float:
        # P(X > x) for an integer number of degrees of freedom: the terms exp(-h) h^s / s! are added as
        # exponentials of their logarithms, so no term underflows before it grows.
        h = x / 2.0
        if h <= 0:
            return 1.0
        odd = dof % 2
        s = np.arange(dof // 2, dtype=float) + 0.5 * odd
        base = math.erfc(math.sqrt(h)) if odd else 0.0
        if not len(s):
            return min(1.0, base)
        log_gamma = math.lgamma(s[0] + 1) + np.concatenate([[0.0], np.cumsum(np.log(s[1:]))])
        return float(min(1.0, base + np.exp(s * math.log(h) - h - log_gamma).sum()))

    def tails(x: pd.Series, dof: pd.Series) -> pd.Series:
        return pd.Series([tail(float(v), int(k)) if pd.notna(v) and k >= 1 else float("nan") for v, k in zip(x, dof)], dtype=float)

    return F.pandas_udf(tails, DoubleType())


def two_by_two(df: DataFrame, exposures: Sequence[str], outcomes: Sequence[str], keys: Sequence[str] = (), n_min: int = 10) -> DataFrame:
    """MD1: cells of every exposure x outcome in one pass; pairs with too few rows or one level drop out.

    a exposed events, b exposed non-events, c unexposed events, d unexposed non-events.
    """
    rows = F.array(*[F.struct(F.lit(e).alias("exposure"), F.col(e).cast("int").alias("_x")) for e in exposures])
    flat = df.select(*keys, *outcomes, F.inline(rows)).filter(F.col("_x").isin(0, 1))
    cell = lambda o, x, y: F.count_if((F.col("_x") == x) & (F.col(o) == y))
    g = flat.groupBy(*keys, "exposure").agg(*[
        F.struct(cell(o, 1, 1).alias("a"), cell(o, 1, 0).alias("b"), cell(o, 0, 1).alias("c"), cell(o, 0, 0).alias("d")).alias(f"_o{i}")
        for i, o in enumerate(outcomes)])
    pairs = F.array(*[F.struct(F.lit(o).alias("outcome"), *[F.col(f"_o{i}")[x].alias(x) for x in "abcd"]) for i, o in enumerate(outcomes)])
    return _enough(g.select(*keys, "exposure", F.inline(pairs)), n_min)


def _enough(t: DataFrame, n_min: int) -> DataFrame:
    a, b, c, d = (F.col(x) for x in "abcd")
    return t.withColumn("n", a + b + c + d).filter(
        (F.col("n") >= n_min) & (a + b > 0) & (c + d > 0) & (a + c > 0) & (b + d > 0))


def one_vs_rest(df: DataFrame, columns: Sequence[str], outcomes: Sequence[str], n_min: int = 10, top: int | None = None, min_count: int = 1) -> DataFrame:
    """MD4: every category of a column against all other rows; the rest is total minus category."""
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("category")) for c in columns])
    cell = lambda o, y: F.count_if(F.col(o) == y)
    g = df.select(*outcomes, F.inline(rows)).filter(F.col("category").isNotNull()).groupBy("variable", "category").agg(
        F.count(F.lit(1)).alias("_n"), *[F.struct(cell(o, 1).alias("a"), cell(o, 0).alias("b")).alias(f"_o{i}") for i, o in enumerate(outcomes)])
    pairs = F.array(*[F.struct(F.lit(o).alias("outcome"), F.col(f"_o{i}")["a"].alias("a"), F.col(f"_o{i}")["b"].alias("b")) for i, o in enumerate(outcomes)])
    t = g.select("variable", "category", "_n", F.inline(pairs))
    w = W.partitionBy("variable", "outcome")
    t = t.withColumns({"c": F.sum("a").over(w) - F.col("a"), "d": F.sum("b").over(w) - F.col("b"),
                       "_rk": F.row_number().over(w.orderBy(F.col("_n").desc(), "category"))})
    t = t.filter(F.col("_n") >= min_count)
    if top is not None:
        t = t.filter(F.col("_rk") <= top)
    return _enough(t.drop("_n", "_rk"), n_min)


def odds_ratio(tab: DataFrame, p_value: bool = True) -> DataFrame:
    """MD2/MD3: odds ratio with Wald interval (half added to all cells when one is 0) and Fisher's p of the raw cells."""
    zero = F.least("a", "b", "c", "d") == 0
    a, b, c, d = (F.col(x) + F.when(zero, 0.5).otherwise(0.0) for x in "abcd")
    se = F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    out = tab.withColumn("odds_ratio", (a * d) / (b * c)).withColumns({
        "ci_low": F.exp(F.log("odds_ratio") - 1.96 * se), "ci_high": F.exp(F.log("odds_ratio") + 1.96 * se)})
    out = out.withColumn("magnitude", N.or_magnitude("odds_ratio"))
    return out.withColumn("p_value", _fisher_udf()("a", "b", "c", "d")) if p_value else out


def chi2(df: DataFrame, variables: Sequence[str], outcomes: Sequence[str], p_value: bool = True, n_min: int = 10) -> DataFrame:
    """MD5: independence of a categorical variable and a 0/1 outcome; Yates on 2x2 tables; Cramér's V."""
    rows = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("category")) for v in variables])
    g = df.select(*outcomes, F.inline(rows)).filter(F.col("category").isNotNull()).groupBy("variable", "category").agg(*[
        F.struct(F.count_if(F.col(o) == 1).alias("y1"), F.count_if(F.col(o) == 0).alias("y0")).alias(f"_o{i}") for i, o in enumerate(outcomes)])
    t = g.select("variable", "category", F.inline(F.array(*[
        F.struct(F.lit(o).alias("outcome"), F.col(f"_o{i}")["y1"].alias("y1"), F.col(f"_o{i}")["y0"].alias("y0")) for i, o in enumerate(outcomes)])))
    t = t.filter(F.col("y1") + F.col("y0") > 0)
    w = W.partitionBy("variable", "outcome")
    t = t.withColumns({"_r": F.col("y1") + F.col("y0"), "_t1": F.sum("y1").over(w), "_t0": F.sum("y0").over(w), "_k": F.count(F.lit(1)).over(w)})
    n = F.col("_t1") + F.col("_t0")
    part = lambda y, tot: _chi_cell(F.col(y), F.col("_r") * F.col(tot) / n, F.col("_k") == 2)
    g = t.withColumn("_c", part("y1", "_t1") + part("y0", "_t0")).groupBy("variable", "outcome").agg(
        F.sum("_r").alias("n"), F.max("_k").alias("categories"), F.sum("_c").alias("chi2"),
        F.max("_t1").alias("_t1"), F.max("_t0").alias("_t0"), F.min(F.least(F.col("_r") * F.col("_t1") / n, F.col("_r") * F.col("_t0") / n)).alias("min_expected"))
    g = g.filter((F.col("n") >= n_min) & (F.col("categories") >= 2) & (F.col("_t1") > 0) & (F.col("_t0") > 0))
    out = g.select("variable", "outcome", "n", "categories", (F.col("categories") - 1).alias("dof"), "chi2", "min_expected",
                   F.sqrt(F.col("chi2") / F.col("n")).alias("cramers_v"))
    out = out.withColumn("effect", N.cramer_band("cramers_v"))
    return out.withColumn("p_value", _chi2_udf()("chi2", "dof")) if p_value else out


def _chi_cell(obs: Column, exp: Column, yates: Column) -> Column:
    gap = F.abs(obs - exp)
    gap = F.when(yates, gap - F.least(gap, F.lit(0.5))).otherwise(gap)
    return gap * gap / exp


def cross_detail(df: DataFrame, exposures: Sequence[str], outcomes: Sequence[str]) -> DataFrame:
    """MD6: share with the outcome among exposed and unexposed, per exposure and outcome level."""
    t = two_by_two(df, exposures, outcomes)
    lev = F.array(F.struct(F.lit(1).alias("level"), F.col("a").alias("exposed_events"), F.col("c").alias("unexposed_events")),
                  F.struct(F.lit(0).alias("level"), F.col("b").alias("exposed_events"), F.col("d").alias("unexposed_events")))
    out = t.select("exposure", "outcome", (F.col("a") + F.col("b")).alias("exposed_n"), (F.col("c") + F.col("d")).alias("unexposed_n"), F.inline(lev))
    return out.withColumns({"pct_exposed": N.pct("exposed_events", "exposed_n"), "pct_unexposed": N.pct("unexposed_events", "unexposed_n")})


def vaccine_effect(df: DataFrame, targets: Mapping[str, Sequence[str]], outcomes: Sequence[str], p_value: bool = True, n_min: int = 20) -> DataFrame:
    """MD7: effectiveness (1 - OR) by region for coherent vaccine-class pairs only."""
    own = {v: [F.when(F.col("class_group").isin(*cls), F.col(f"{v}_bin")).alias(v)] for v, cls in targets.items() if cls}
    narrowed = df.select("region", "class_group", *outcomes, *[c[0] for c in own.values()])
    t = odds_ratio(two_by_two(narrowed, list(own), outcomes, ["region", "class_group"], n_min), p_value)
    prot = F.col("odds_ratio") < 1
    return t.withColumns({
        "effect_pct": F.when(prot, (1 - F.col("odds_ratio")) * 100).otherwise(0.0),
        "effect_low": F.when(prot, (1 - F.col("ci_high")) * 100), "effect_high": F.when(prot, (1 - F.col("ci_low")) * 100)})


def vaccine_inapplicable(df: DataFrame, targets: Mapping[str, Sequence[str]]) -> DataFrame:
    """MD7: region x class x vaccine pairs without a target, with the rows that carry the field."""
    rows = F.array(*[F.struct(F.lit(v).alias("vaccine"), F.col(f"{v}_bin").isNotNull().cast("int").alias("_f"),
                              (F.col("class_group").isin(*cls) if cls else F.lit(False)).alias("_ok")) for v, cls in targets.items()])
    flat = df.select("region", "class_group", F.inline(rows)).filter(~F.coalesce(F.col("_ok"), F.lit(False)))
    return flat.groupBy("region", "class_group", "vaccine").agg(F.count(F.lit(1)).alias("n"), F.sum("_f").alias("with_field"))


def corr_pair(df: DataFrame, x: str, ys: Sequence[str], n_min: int = 3) -> DataFrame:
    """MD9: Pearson and Spearman of one column with several others (aggregated units)."""
    flat = df.select(F.col(x).cast("double").alias("_x"), F.inline(F.array(*[
        F.struct(F.lit(y).alias("variable"), F.col(y).cast("double").alias("_y")) for y in ys]))).filter(F.col("_x").isNotNull() & F.col("_y").isNotNull())
    r = flat.withColumns({"_rx": pct_rank("_x", ["variable"]), "_ry": pct_rank("_y", ["variable"])})
    g = r.groupBy("variable").agg(F.count(F.lit(1)).alias("n"), F.corr("_x", "_y").alias("_p"), F.corr("_rx", "_ry").alias("_s"))
    ok = lambda c: F.when(F.col("n") >= n_min, F.col(c))
    return g.select("variable", "n", ok("_p").alias("pearson"), ok("_s").alias("spearman"))


def ols_line(df: DataFrame, x: str, y: str, keys: Sequence[str] = ()) -> DataFrame:
    """MD26: least-squares line of y on x."""
    cx, cy = F.col(x), F.col(y)
    return df.groupBy(*keys).agg(F.regr_count(cy, cx).alias("n"), F.regr_slope(cy, cx).alias("slope"),
                                 F.regr_intercept(cy, cx).alias("intercept"), F.regr_r2(cy, cx).alias("r2"))


# ---- logistic regression with one factor of any size ---------------------------------------------

NARROW = 500  # levels a factor may have besides the largest one


class _Fit:
    """Fisher scoring for numeric columns, factors of few levels and one factor of any number of levels (the wide one).

    The information matrix has the shape of an arrow: levels of the wide factor only meet themselves and the few other
    features. So each round sums, per level, its weight d, score g and products h with the other features; the small
    Schur complement of all levels is solved on the driver, and each level then gets its own step. What the driver
    holds grows with the few other features, never with the levels. Rows are counted by distinct pattern first.
    """

    def __init__(self, df: DataFrame, outcome: str, numeric: Sequence[str], categorical: Sequence[str], rounds: int = 25):
        d = df.filter(F.col(outcome).isNotNull())
        number = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric}
        spread = d.agg(F.lit(0).alias("_"), *[F.var_pop(v).alias(f"v{i}") for i, v in enumerate(number.values())], *[F.count_distinct(c).alias(f"k{i}") for i, c in enumerate(categorical)]).first()
        self.numeric = [c for i, c in enumerate(numeric) if (spread[f"v{i}"] or 0) > 0]
        sizes = {c: spread[f"k{i}"] for i, c in enumerate(categorical)}
        self.wide = max(sizes, key=sizes.get) if sizes else None
        few = [c for c in categorical if c != self.wide]
        if any(sizes[c] > NARROW for c in few):
            raise ValueError(f"only one factor may have more than {NARROW} levels")
        level = F.col(self.wide).cast("string") if self.wide else F.lit("")
        pattern = d.groupBy(level.alias("level"), *[number[c].alias(f"x{i}") for i, c in enumerate(self.numeric)], *[F.col(c).cast("string").alias(f"c{i}") for i, c in enumerate(few)]).agg(
            F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(outcome).cast("double")).alias("y"))
        pattern = fold(pattern)
        self.names, columns = list(self.numeric), [F.col(f"x{i}") for i in range(len(self.numeric))]
        for i, c in enumerate(few):
            labels = sorted(r[0] for r in pattern.filter(F.col(f"c{i}").isNotNull()).select(f"c{i}").distinct().collect())  # at most NARROW
            known = labels[1:] + ([None] if labels and pattern.filter(F.col(f"c{i}").isNull()).limit(1).count() else [])
            self.names += [f"{c}={'other' if v is None else v}" for v in known]
            columns += [F.col(f"c{i}").eqNullSafe(F.lit(v)).cast("double") for v in known]
        self.rows = pattern.select("level", "n", "y", F.array(*columns).cast("array<double>").alias("x"))
        self.k = len(self.names)
        self.beta = np.zeros(self.k)
        odds = F.log((F.sum("y") + 0.5) / (F.sum("n") - F.sum("y") + 0.5))
        # a level all of whose rows agree has no finite estimate: it starts, and stays, at 30
        start = F.when(F.sum("y") == 0, -30.0).when(F.sum("y") == F.sum("n"), 30.0).otherwise(odds)
        self.alpha = fold(self.rows.groupBy("level").agg(start.alias("alpha")))
        before, last = None, None
        for _ in range(rounds):
            levels, whole = self._sums()
            likelihood, score, info = whole[0], whole[1:1 + self.k], whole[1 + self.k:].reshape(self.k, self.k)
            schur, rest = self._complement(levels, info, score)
            self.inverse = np.linalg.pinv(schur) if self.k else schur
            step = self.inverse @ rest
            self.levels = levels
            if before is not None and likelihood - before <= 1e-10 * (abs(likelihood) + 1):
                if likelihood < before:  # no finite maximum, or the last digits: the better round counts
                    self.beta, self.alpha, self.levels, self.inverse = last
                break
            before, last = likelihood, (self.beta, self.alpha, levels, self.inverse)
            self.beta = self.beta + step
            move = (F.col("g") - _dot("h", step)) / F.greatest("d", F.lit(1e-9))
            self.alpha = fold(levels.select("level", F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("alpha") + F.greatest(F.lit(-5.0), F.least(F.lit(5.0), move)))).alias("alpha")))

    def fitted(self) -> DataFrame:
        """Patterns with their counts and the fitted number of events."""
        eta = F.col("alpha") + _dot("x", self.beta)
        return self.rows.join(self.alpha.withColumnRenamed("level", "_l"), F.col("level").eqNullSafe(F.col("_l"))).drop("_l").withColumn("p", 1 / (1 + F.exp(-eta)))

    def _sums(self) -> tuple[DataFrame, np.ndarray]:
        """Per level alpha, d, g, h; and over all rows the likelihood, the score and the information of the other features."""
        k = self.k

        def batch(frames):
            for f in frames:
                x = np.array(f["x"].tolist(), float).reshape(len(f), k)
                n, y, p = f["n"].to_numpy(), f["y"].to_numpy(), np.clip(f["p"].to_numpy(), 1e-15, 1 - 1e-15)
                w, r = n * p * (1 - p), y - n * p
                code, names = pd.factorize(f["level"], use_na_sentinel=False)
                parts = np.zeros((len(names), 2 + k))
                np.add.at(parts, code, np.column_stack((w, r, x * w[:, None])))
                whole = np.concatenate(([np.sum(y * np.log(p) + (n - y) * np.log1p(-p))], x.T @ r, ((x * w[:, None]).T @ x).ravel()))
                names = [None if pd.isna(v) else v for v in names]
                yield pd.DataFrame({"level": [*names, None], "whole": [False] * len(names) + [True], "v": [*parts.tolist(), whole.tolist()]})

        parts = self.fitted().select("level", "n", "y", "x", "p").mapInPandas(batch, "level string, whole boolean, v array<double>")
        sums = parts.select("level", "whole", F.posexplode("v").alias("i", "s")).groupBy("level", "whole", "i").agg(F.sum("s").alias("s"))
        sums = fold(sums.groupBy("level", "whole").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "s"))), lambda t: t["s"]).alias("v")))
        whole = sums.filter("whole").first()
        alpha = self.alpha.withColumnRenamed("level", "_l")
        levels = sums.filter("not whole").join(alpha, F.col("level").eqNullSafe(F.col("_l"))).select("level", "alpha", F.col("v")[0].alias("d"), F.col("v")[1].alias("g"), F.slice("v", 3, max(k, 1)).alias("h"))
        return levels, np.array(whole["v"]) if whole else np.zeros(1 + k + k * k)

    def _complement(self, levels: DataFrame, info: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = self.k
        if not k:
            return np.zeros((0, 0)), np.zeros(0)

        def batch(frames):
            for f in frames:
                h, d, g = np.array(f["h"].tolist(), float).reshape(len(f), k), np.maximum(f["d"].to_numpy(), 1e-9), f["g"].to_numpy()
                yield pd.DataFrame({"v": [np.concatenate(((h / d[:, None]).T @ g, ((h / d[:, None]).T @ h).ravel())).tolist()]})

        rows = levels.select("h", "d", "g").mapInPandas(batch, "v array<double>").select(F.posexplode("v").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).collect()  # k + k * k numbers
        v = np.zeros(k + k * k)
        for r in rows:
            v[r["i"]] = r["s"]
        return info - v[k:].reshape(k, k), score - v[:k]


def _dot(array: str, values: np.ndarray) -> Column:
    if not len(values):
        return F.lit(0.0)
    return F.aggregate(F.zip_with(array, F.array(*[F.lit(float(v)) for v in values]), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def logistic_or(df: DataFrame, outcome: str, numeric: Sequence[str], categorical: Sequence[str], top: int | None = None, max_features: int | None = None) -> DataFrame:
    """MD8: multivariable logistic regression by Fisher scoring: variable, coef, odds_ratio, ci_low, ci_high, p_value.

    Constant columns are dropped; the first label of a factor is its reference; rows without a label are `other`. The
    factor with the most levels may have any number of them, the others at most NARROW. `top` and `max_features`
    select features, where asked for.
    """
    if top is not None or max_features is not None:
        return _logistic_selected(df, outcome, numeric, categorical, top, max_features)
    fit = _Fit(df, outcome, numeric, categorical)
    spark = df.sparkSession
    se = np.sqrt(np.maximum(np.diag(fit.inverse), 0)) if fit.k else np.zeros(0)
    out = spark.createDataFrame([(n, float(b), float(s)) for n, b, s in zip(fit.names, fit.beta, se)], "variable string, coef double, se double")
    if fit.wide:
        first = fit.levels.filter("level is not null").agg(F.min("level")).first()[0]
        now = fit.levels.drop("alpha").join(fit.alpha.withColumnRenamed("level", "_l"), F.col("level").eqNullSafe(F.col("_l")))
        now = now.withColumn("u", F.transform("h", lambda v: v / F.greatest(F.col("d"), F.lit(1e-9))))
        ref = now.filter(F.col("level").eqNullSafe(F.lit(first))).select("alpha", "d", "u").first()  # one level
        gap = F.zip_with("u", F.array(*[F.lit(float(v)) for v in ref["u"][:fit.k]]).cast("array<double>"), lambda a, b: a - b)
        inverse = F.array(*[F.array(*[F.lit(float(v)) for v in row]) for row in fit.inverse]) if fit.k else F.array().cast("array<array<double>>")
        quad = F.aggregate(F.zip_with(gap, F.transform(inverse, lambda row: F.aggregate(F.zip_with(row, gap, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)), lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v) if fit.k else F.lit(0.0)
        var = 1 / F.greatest("d", F.lit(1e-9)) + 1 / max(ref["d"], 1e-9) + quad
        name = F.concat(F.lit(f"{fit.wide}="), F.coalesce("level", F.lit("other")))
        out = out.unionByName(now.filter(~F.col("level").eqNullSafe(F.lit(first))).select(name.alias("variable"), (F.col("alpha") - ref["alpha"]).alias("coef"), F.sqrt(var).alias("se")))
    z = F.abs(F.col("coef") / F.col("se"))
    return out.select("variable", "coef", F.exp("coef").alias("odds_ratio"), F.exp(F.col("coef") - 1.96 * F.col("se")).alias("ci_low"), F.exp(F.col("coef") + 1.96 * F.col("se")).alias("ci_high"), _tail_udf()(z).alias("p_value"))


def _tail_udf():
    """Two-sided normal tail of result rows."""

    def tail(z: pd.Series) -> pd.Series:
        return z.map(lambda v: math.erfc(v / math.sqrt(2)) if v == v else None)

    return F.pandas_udf(tail, DoubleType())


def logistic_score(df: DataFrame, outcome: str, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """MD8 checked: per feature the observed and the fitted sum; they agree exactly at the maximum of the likelihood."""
    fit = _Fit(df, outcome, numeric, categorical)
    rows = fit.fitted().withColumn("e", F.col("n") * F.col("p"))
    feature = rows.select("y", "e", F.posexplode("x").alias("i", "v"))
    name = F.array(*[F.lit(n) for n in fit.names])[F.col("i")] if fit.k else F.lit("")
    parts = feature.groupBy(name.alias("variable")).agg(F.sum(F.col("v") * F.col("y")).alias("observed"), F.sum(F.col("v") * F.col("e")).alias("fitted"))
    if fit.wide:
        level = F.concat(F.lit(f"{fit.wide}="), F.coalesce("level", F.lit("other")))
        parts = parts.unionByName(rows.groupBy(level.alias("variable")).agg(F.sum("y").alias("observed"), F.sum("e").alias("fitted")))
    return parts


def _logistic_selected(df: DataFrame, outcome: str, numeric: Sequence[str], categorical: Sequence[str], top: int | None, max_features: int | None) -> DataFrame:
    """MD8 with a selection of features: `top` folds the rarer categories, `max_features` keeps the strongest features."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    from .ordering import top_categories

    feats: dict[str, Column] = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in numeric}
    for c in categorical:
        known = df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("category")).count() if top is None else top_categories(df, c, top, 1)
        labels = sorted(r["category"] for r in known.collect())
        for v in labels[1:]:
            feats[f"{c}={v}"] = F.coalesce((F.col(c) == v).cast("double"), F.lit(0.0))
        feats[f"{c}=other"] = (F.col(c).isNull() | ~F.col(c).isin(*labels)).cast("double")
    names = list(feats)
    d = df.filter(F.col(outcome).isNotNull()).select(F.col(outcome).cast("double").alias("label"), *[feats[n].alias(f"f{i}") for i, n in enumerate(names)])
    spread = d.agg(*[F.var_pop(f"f{i}").alias(f"v{i}") for i in range(len(names))]).first()
    keep = [i for i in range(len(names)) if (spread[f"v{i}"] or 0) > 0]
    if max_features is not None and len(keep) > max_features:
        r = d.agg(*[F.abs(F.corr(f"f{i}", "label")).alias(f"c{i}") for i in keep]).first()
        keep = sorted(keep, key=lambda i: -(r[f"c{i}"] or 0))[:max_features]
    data = VectorAssembler(inputCols=[f"f{i}" for i in keep], outputCol="features").transform(d).select("label", "features")
    model = GeneralizedLinearRegression(family="binomial", link="logit", regParam=0.0, maxIter=50).fit(data)
    se, p = list(model.summary.coefficientStandardErrors), list(model.summary.pValues)
    rows = [(names[i], float(b), math.exp(b), math.exp(b - 1.96 * s) if s == s else None, math.exp(b + 1.96 * s) if s == s else None, q if q == q else None)
            for i, b, s, q in zip(keep, model.coefficients, se, p)]
    return df.sparkSession.createDataFrame(rows, "variable string, coef double, odds_ratio double, ci_low double, ci_high double, p_value double")


def survival_strata(df: DataFrame, strata: Sequence[str], time: str = "lag_onset_outcome", event: str = "death") -> DataFrame:
    """AG55: n, deaths, median and P75 time by stratum, out of a day histogram."""
    ok = df.filter(F.col(time).isNotNull() & (F.col(time) >= 0))
    rows = F.array(*[F.struct(F.lit(s).alias("stratum"), F.col(s).cast("string").alias("category")) for s in strata])
    h = ok.select(F.col(time).alias("_t"), F.col(event).alias("_e"), F.inline(rows)).groupBy("stratum", "category", "_t").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_e").alias("_d"))
    q = lambda p, n: F.percentile("_t", F.lit(p), F.col("_n")).alias(n)
    return h.groupBy("stratum", "category").agg(F.sum("_n").alias("n"), F.sum("_d").alias("deaths"), q(0.5, "median_time"), q(0.75, "p75_time"))


class _Survival:
    """Weibull regression of times: log t = x'b + scale * e, from Spark's fit to the exact maximum by Newton steps.

    The steps run on counts of distinct (time, event, covariates), and a step is one aggregation to a matrix of the size
    of the covariates. Times of 0 or less and unknown times or events are left out, unknown covariates count as 0. Without
    an event, or where the covariates are collinear, there is no single maximum and Spark's fit stays.
    """

    def __init__(self, df: DataFrame, features: Sequence[str], time: str, event: str):
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.regression import AFTSurvivalRegression

        self.features = list(features)
        d = df.filter((F.col(time) > 0) & F.col(event).isNotNull()).select(
            F.col(time).cast("double").alias("label"), F.col(event).cast("double").alias("censor"),
            *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, c in enumerate(self.features)])
        xs = [f"x{i}" for i in range(len(self.features))]
        model = AFTSurvivalRegression(maxIter=50).fit(VectorAssembler(inputCols=xs, outputCol="features").transform(d))
        self.rows = fold(d.groupBy("label", "censor", *xs).agg(F.count(F.lit(1)).alias("n")))
        self.x = [F.lit(1.0), *[F.col(c) for c in xs]]
        self.theta = np.array([model.intercept, *model.coefficients, math.log(model.scale)])
        self._newton()

    def eps(self, theta: np.ndarray) -> Column:
        return (F.log("label") - sum((float(b) * x for b, x in zip(theta, self.x)), F.lit(0.0))) / math.exp(theta[-1])

    def _at(self, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood, gradient and Hessian."""
        k, scale, n, d = len(self.x), math.exp(theta[-1]), F.col("n"), F.col("censor")
        r = self.rows.withColumn("e", self.eps(theta)).withColumn("h", F.exp("e"))
        e, h, over = F.col("e"), F.col("h"), F.col("h") - d
        terms = [d * (e - float(theta[-1])) - h, *[over * x / scale for x in self.x], over * e - d]
        terms += [-h * self.x[i] * self.x[j] / scale ** 2 for i in range(k) for j in range(i + 1)]
        terms += [-(h * e + over) * x / scale for x in self.x] + [-h * e * e - over * e]
        got = [float("nan") if v is None else v for v in r.agg(*[F.sum(n * t) for t in terms]).first()]
        hess, rest = np.zeros((k + 1, k + 1)), iter(got[k + 2:])
        for i in range(k + 1):
            for j in range(i + 1):
                hess[i, j] = hess[j, i] = next(rest)
        return got[0], np.array(got[1:k + 2]), hess

    def _newton(self, rounds: int = 25, tol: float = 1e-12) -> None:
        theta = self.theta
        ll, grad, hess = self._at(theta)
        for _ in range(rounds):
            if not np.isfinite(hess).all() or np.linalg.matrix_rank(hess) < len(hess):
                return
            step = np.linalg.solve(hess, grad)
            for _ in range(rounds):
                now = self._at(theta - step)
                if now[0] >= ll - 1e-9 * abs(ll):
                    break
                step = step / 2
            else:
                return
            theta, (ll, grad, hess) = theta - step, now
            self.theta = theta
            if np.max(np.abs(step)) < tol * (1 + np.max(np.abs(theta))):
                return


def survival_model(df: DataFrame, features: Sequence[str], time: str = "lag_onset_outcome", event: str = "death") -> DataFrame:
    """MD13: accelerated-failure-time regression, a stated substitute for a proportional-hazards fit."""
    fit = _Survival(df, features, time, event)
    rows = list(zip(["(intercept)", *fit.features, "(scale)"], [*fit.theta[:-1], math.exp(fit.theta[-1])]))
    return df.sparkSession.createDataFrame([(n, float(b), math.exp(b)) for n, b in rows], "variable string, coef double, time_ratio double")


def survival_score(df: DataFrame, features: Sequence[str], time: str = "lag_onset_outcome", event: str = "death") -> DataFrame:
    """MD13 checked: per parameter the observed events, weighted by the covariate, and the fitted ones; equal at the maximum."""
    fit = _Survival(df, features, time, event)
    e, n, d = fit.eps(fit.theta), F.col("n"), F.col("censor")
    parts = [(v, d * x, F.exp(e) * x) for v, x in zip(["(intercept)", *fit.features], fit.x)] + [("(scale)", d, (F.exp(e) - d) * e)]
    one = fit.rows.agg(*[F.sum(n * c).alias(f"{side}{i}") for i, (_, o, f) in enumerate(parts) for side, c in (("o", o), ("f", f))])
    return one.select(F.inline(F.array(*[F.struct(F.lit(v).alias("variable"), F.col(f"o{i}").alias("observed"), F.col(f"f{i}").alias("fitted")) for i, (v, _, _) in enumerate(parts)])))
