import datetime as dt

import pytest

from kinloom.operators.skew import balanced_group_stats, heavy_keys, spread_rank

T0 = dt.datetime(2024, 1, 1)


def _rows():
    rows = [("hot", f"i{k % 40}", T0 + dt.timedelta(hours=k)) for k in range(400)]
    rows += [("warm", f"i{k}", None) for k in range(60)]
    rows += [(f"cold{k}", f"i{k}", T0) for k in range(300)]
    rows += [(None, None, T0)] * 50 + [("", "e", T0)] * 3 + [("hot", None, None)] * 5
    return rows


def test_against_python(spark):
    rows = _rows()
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], "addr string, id string, at timestamp, n_rows string, k int")
    got = {r["addr"]: tuple(r)[1:] for r in balanced_group_stats(df, "addr", "id", "at", 0.05).collect()}
    want = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        times = [r[2] for r in own if r[2] is not None]
        want[key] = (len(own), len({r[1] for r in own} - {None}), min(times, default=None), max(times, default=None))
    assert got == want


def test_no_heavy_key_is_missed(spark):
    df = spark.createDataFrame([(r[0],) for r in _rows()], "addr string").repartition(7)
    found = {r[0] for r in heavy_keys(df, "addr", 0.05).collect()}
    assert found == {"hot", "warm"}
    with pytest.raises(ValueError):
        heavy_keys(df, "addr", 0)


def test_heavy_keys_are_exactly_those(spark):
    uniform = spark.range(100_000).selectExpr("concat('k', id % 5000) as addr")
    assert heavy_keys(uniform, "addr", 0.002).count() == 0
    skewed = uniform.where("addr < 'k4'").unionAll(spark.range(400).selectExpr("concat('h', id % 2) as addr")).unionAll(spark.range(90).selectExpr("'near' as addr"))
    n = skewed.count()
    assert {r[0] for r in heavy_keys(skewed.repartition(9), "addr", 200 / n).collect()} == {"h0", "h1"}
    assert {r[0] for r in heavy_keys(skewed.repartition(2), "addr", 90 / n).collect()} == {"h0", "h1", "near"}
    nulls = spark.createDataFrame([(None,), (None,), ("a",)], "addr string")
    assert [r[0] for r in heavy_keys(nulls, "addr", 0.3).collect()] == ["a"] and heavy_keys(nulls, "addr", 0.4).count() == 0


def test_empty(spark):
    df = spark.createDataFrame([], "addr string, id string, at timestamp")
    assert balanced_group_stats(df, "addr", "id", "at").columns == ["addr", "n_rows", "n_ids", "first_at", "last_at"]
    assert balanced_group_stats(df, "addr", "id", "at").count() == 0


def test_spread_rank_against_sort(spark):
    import random

    rng = random.Random(3)
    rows = [(rng.choice(["hot"] * 8 + ["a", "b", None]), rng.choice([None, 0.5, 0.5, round(rng.random(), 2)]), f"c{k:04d}") for k in range(2000)]
    df = spark.createDataFrame(rows, "g string, s double, c string").repartition(5)
    got = {r["c"]: r["r"] for r in spread_rank(df, ["g"], "s", "c", "r", pieces=8).collect()}
    for g in ("hot", "a", "b", None):
        own = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        assert [got[r[2]] for r in own] == list(range(1, len(own) + 1))
