"""Direct multi-step forecasts: lags are known on the day of the forecast, members enter the ensemble, bands come from held-out days."""
import datetime as dt
import math

from pyspark.sql import functions as F

from caseflux.operators import forecast as P

START = dt.date(2021, 1, 4)


def series(spark, n=420):
    rows = []
    for k in range(n):
        d = START + dt.timedelta(days=k)
        rows.append(("a", d, float(20 + 10 * (d.weekday() < 5) + 5 * math.sin(k / 30))))
        rows.append(("b", d, float(2 + (k % 7 == 0))))
    return spark.createDataFrame(rows, "outcome string, date date, y double"), {(o, d): y for o, d, y in rows}


def test_lags_are_known_on_the_day_of_the_forecast(spark):
    d, y = series(spark, 120)
    rows = P.direct_rows(d).collect()
    for r in rows:
        for i in range(P.LAGS):
            assert r[f"lag{i}"] == y[(r["outcome"], r["date"] - dt.timedelta(days=int(r["step"]) + i))]
        assert r["y"] == y[(r["outcome"], r["date"])] and abs(r["mean7"] - sum(r[f"lag{i}"] for i in range(7)) / 7) < 1e-9
    want = {(o, START + dt.timedelta(days=k), float(h)) for o in "ab" for k in range(120) for h in P.STEPS if k >= h + P.LAGS - 1}
    assert {(r["outcome"], r["date"], r["step"]) for r in rows} == want
    last = START + dt.timedelta(days=119)
    ahead = P.future_rows(d, 60).collect()
    assert len(ahead) == 120 and all(r["date"] == last + dt.timedelta(days=r["horizon"]) and r["step"] == r["horizon"] for r in ahead)
    assert all(r[f"lag{i}"] == y[(r["outcome"], last - dt.timedelta(days=i))] for r in ahead for i in range(P.LAGS))
    short = d.filter(F.col("date") < START + dt.timedelta(days=10))
    assert P.direct_rows(short).count() == 0 and P.future_rows(short, 60).count() == 0


def test_ensemble_of_all_members_with_held_out_band(spark):
    d, y = series(spark)
    members = P.all_members(d, 30, trees=15).cache()
    names = {r["member"] for r in members.select("member").distinct().collect()}
    assert names == {"naive", "seasonal_7", "ma7", "ma14", "ar1", "random_forest", "gradient_boosting", "poisson"}
    last = START + dt.timedelta(days=419)
    miss = {}
    for r in members.filter("outcome = 'a'").collect():
        k = (r["date"] - START).days
        true = 20 + 10 * (r["date"].weekday() < 5) + 5 * math.sin(k / 30)
        miss.setdefault(r["member"], []).append(abs(r["pred"] - true))
        assert r["date"] == last + dt.timedelta(days=r["horizon"]) and r["pred"] >= 0
    mae = {m: sum(x) / len(x) for m, x in miss.items()}
    assert mae["random_forest"] < mae["ma7"] and mae["gradient_boosting"] < mae["ma7"]
    # errors: the mean of the members forecast from the days before, against the held-out days
    seen = d.filter(F.col("date") <= last - dt.timedelta(days=30))
    mean = {}
    for r in P.all_members(seen, 30, trees=15).collect():
        mean.setdefault((r["outcome"], r["horizon"], r["date"]), []).append(r["pred"])
    err = {(r["outcome"], r["upto"]): (r["rmse"], r["days"]) for r in P.holdout_error(d, 30, trees=15).collect()}
    assert set(err) == {(o, h) for o in "ab" for h in (7, 15, 30)}
    for (o, upto), (rmse, days) in err.items():
        e = [(sum(p) / len(p) - y[(o, day)]) ** 2 for (x, h, day), p in mean.items() if x == o and h <= upto]
        assert days == len(e) == upto and abs(rmse - math.sqrt(sum(e) / len(e))) < 1e-6
    ens = P.ensemble_with_holdout(members, P.holdout_error(d, 30, trees=15)).collect()
    assert len(ens) == 60 and all(r["members"] == 8 and r["lower_95"] <= r["pred"] <= r["upper_95"] for r in ens)
    r = next(r for r in ens if r["outcome"] == "b" and r["horizon"] == 8)
    p = [m["pred"] for m in members.filter("outcome = 'b' and horizon = 8").collect()]
    sd = math.sqrt(sum((x - sum(p) / 8) ** 2 for x in p) / 8 + err[("b", 15)][0] ** 2)
    assert abs(r["upper_95"] - (sum(p) / 8 + 1.96 * sd)) < 1e-6
