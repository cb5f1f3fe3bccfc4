"""Fisher scoring with a wide factor against dense Newton steps on the rows, and with many levels."""
import math
import random

import numpy as np

from caseflux.operators import stats as S


def dense(rows, numeric, factors, outcome):
    """Coefficients and standard errors by Newton steps on the full design matrix."""
    names, cols = ["(intercept)"], [np.ones(len(rows))]
    for c in numeric:
        names.append(c)
        cols.append(np.array([float(r[c] or 0) for r in rows]))
    for c in factors:
        labels = sorted({r[c] for r in rows if r[c] is not None})
        for v in labels[1:] + ([None] if any(r[c] is None for r in rows) else []):
            names.append(f"{c}={'other' if v is None else v}")
            cols.append(np.array([float(r[c] == v) for r in rows]))
    x, y = np.column_stack(cols), np.array([float(r[outcome]) for r in rows])
    b = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-x @ b))
        h = (x * (p * (1 - p))[:, None]).T @ x
        b = b + np.linalg.solve(h, x.T @ (y - p))
    return {n: (v, s) for n, v, s in zip(names, b, np.sqrt(np.diag(np.linalg.inv(h))))}


def table(seed, n=900):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        row = {"age": r.choice([None, *range(0, 90, 7)]), "flag": r.choice([0, 1]), "same": 3, "kind": r.choice("abc"), "place": r.choice([None, *[f"p{i}" for i in range(8)]])}
        eta = -0.5 + 0.02 * (row["age"] or 0) - 0.7 * row["flag"] + {"a": 0, "b": 0.6, "c": -0.4}[row["kind"]] + (0.3 * int(row["place"][1:]) - 1 if row["place"] else 0)
        row["y"] = int(r.random() < 1 / (1 + math.exp(-eta)))
        rows.append(row)
    return rows


def test_like_dense_newton(spark):
    rows = table(3)
    df = spark.createDataFrame(rows, "age int, flag int, same int, kind string, place string, y int")
    want = dense(rows, ["age", "flag"], ["kind", "place"], "y")
    got = {r["variable"]: r for r in S.logistic_or(df, "y", ["age", "flag", "same"], ["kind", "place"]).collect()}
    assert set(got) == set(want) - {"(intercept)"}
    for n, g in got.items():
        b, se = want[n]
        assert abs(g["coef"] - b) < 1e-6 and abs(g["odds_ratio"] - math.exp(b)) < 1e-5
        assert abs(math.log(g["ci_high"]) - (b + 1.96 * se)) < 1e-5 and abs(math.log(g["ci_low"]) - (b - 1.96 * se)) < 1e-5
        assert abs(g["p_value"] - math.erfc(abs(b / se) / math.sqrt(2))) < 1e-6
    for r in S.logistic_score(df, "y", ["age", "flag"], ["kind", "place"]).collect():
        assert abs(r["observed"] - r["fitted"]) < 1e-6, r


def test_without_factors_and_without_numbers(spark):
    rows = table(4, 300)
    df = spark.createDataFrame(rows, "age int, flag int, same int, kind string, place string, y int")
    for numeric, factors in ((["age", "flag"], []), ([], ["kind"])):
        want = dense(rows, numeric, factors, "y")
        got = {r["variable"]: r["coef"] for r in S.logistic_or(df, "y", numeric, factors).collect()}
        assert set(got) == set(want) - {"(intercept)"} and all(abs(v - want[n][0]) < 1e-6 for n, v in got.items())


def test_ten_thousand_levels(spark):
    d = spark.sql("""select concat('level', id % 10000) as place, cast(id % 3 = 0 as int) as flag, cast(pmod(hash(id), 1000) < 200 + (id % 10000) / 20 + if(id % 3 = 0, 150, 0) as int) as y from range(100000)""")
    got = S.logistic_or(d, "y", ["flag"], ["place"])
    assert got.count() == 10000
    flag = got.filter("variable = 'flag'").first()
    assert 0.4 < flag["coef"] < 1.2 and flag["p_value"] < 1e-6


def test_survival_reaches_the_maximum(spark):
    """Newton steps end where every score equation holds; ties, unknown covariates, zero times and repeated rows included."""
    import math
    import random

    from caseflux.operators import stats as A

    r = random.Random(5)
    rows = []
    for i in range(600):
        x = r.choice([0, 1, None])
        t = int(math.ceil(math.exp(2.0 + 0.7 * (x or 0)) * r.expovariate(1.0) ** 0.6)) if i % 50 else 0
        rows.append((t, int(r.random() < 0.7), x, r.random()))
    rows += rows[:40] + [(None, 1, 1, 0.5), (5, None, 1, 0.5)]
    d = spark.createDataFrame(rows, "lag_onset_outcome int, death int, x int, z double")
    for s in A.survival_score(d, ["x", "z"]).collect():
        assert abs(s["observed"] - s["fitted"]) < 1e-6 * max(1.0, abs(s["observed"]))
    got = {m["variable"]: m["coef"] for m in A.survival_model(d, ["x", "z"]).collect()}
    assert set(got) == {"(intercept)", "x", "z", "(scale)"} and 0.5 < got["x"] < 0.9 and 0.4 < got["(scale)"] < 0.8


def test_survival_with_collinear_covariates_keeps_the_first_fit(spark):
    from caseflux.operators import stats as A

    d = spark.createDataFrame([(t, t % 2, t % 3, t % 3) for t in range(1, 40)], "lag_onset_outcome int, death int, a int, b int")
    assert A.survival_model(d, ["a", "b"]).count() == 4
