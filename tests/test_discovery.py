"""Tables found under a folder and what they hold."""
import datetime as dt

from caseflux.sources import readers as R


def test_discovered_files_and_profiles(spark, tmp_path):
    rows = [(1, "b", 2.5, dt.date(2024, 1, 2), True, [1]), (None, "a", None, None, False, None), (3, None, 1.0, dt.date(2023, 5, 6), None, [2])]
    one = spark.createDataFrame(rows, "k int, t string, v double, d date, f boolean, odd array<int>")
    one.repartition(3).write.parquet(f"{tmp_path}/SIM_deaths.parquet")
    one.write.partitionBy("k").parquet(f"{tmp_path}/sim_split.parquet")
    one.select("t").write.parquet(f"{tmp_path}/other.parquet")
    found = {r["name"]: (r["pattern"], r["files"]) for r in R.discover_files(spark, str(tmp_path), ["%gal%", "SIM%"]).collect()}
    assert set(found) == {"SIM_deaths", "sim_split"} and found["sim_split"] == ("SIM%", 3) and found["SIM_deaths"][0] == "SIM%"
    got = {r["column"]: tuple(r)[1:2] + tuple(r)[3:] for r in R.profile_table(spark.read.parquet(f"{tmp_path}/SIM_deaths.parquet"), "x").collect()}
    assert got == {"k": (0, "integer", 3, 1, "1", "3"), "t": (1, "text", 3, 1, "a", "b"), "v": (2, "number", 3, 1, "1.0", "2.5"), "d": (3, "time", 3, 1, "2023-05-06", "2024-01-02"),
                   "f": (4, "flag", 3, 1, "false", "true"), "odd": (5, "other", 3, 1, None, None)}
    whole = R.profile_files(spark, str(tmp_path), ["oth%", "%SPLIT", "sim_d%"]).collect()
    assert {(r["name"], r["column"]) for r in whole} == {("other", "t"), *[(n, c) for n in ("sim_split", "SIM_deaths") for c in ("k", "t", "v", "d", "f", "odd")]}
    assert R.profile_files(spark, str(tmp_path), ["nothing%"]).count() == 0
    empty = R.profile_table(one.limit(0), "none").filter("column = 'k'").first()
    assert (empty["rows"], empty["nulls"], empty["low"]) == (0, 0, None)
