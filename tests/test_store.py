"""Versioned tables of periods, bucketed tables, sketches stored per period."""
import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulae.operators import sketches as SK
from tabulae.operators.quantiles import exact_quantiles
from tabulae.plans.store_queries import stored_records
from tabulae.plans.tables import load
from tabulae.sources import store as ST
from tests.conftest import SF_SMALL


def _rows(spark, *rows):
    return spark.createDataFrame(list(rows), "n int, period string")


def _held(df):
    return sorted((r.n, r.period) for r in df.collect())


def test_a_commit_replaces_its_periods_and_keeps_the_others(spark, scratch):
    t = f"{scratch}/t"
    assert ST.versions(spark, t) == []
    assert ST.commit(_rows(spark, (1, "2024"), (2, "a/b c"), (3, "a/b c"), (4, "é%=")), t) == 1
    assert ST.commit(_rows(spark, (9, "a/b c"), (8, "new")), t) == 2
    assert _held(ST.read_version(spark, t)) == [(1, "2024"), (4, "é%="), (8, "new"), (9, "a/b c")]
    assert _held(ST.read_version(spark, t, version=1)) == [(1, "2024"), (2, "a/b c"), (3, "a/b c"), (4, "é%=")]
    assert ST.read_version(spark, t).dtypes == [("n", "int"), ("period", "string")]
    assert ST.unpublished(spark, t) == []


def test_what_broke_off_or_came_second_does_not_show(spark, scratch):
    t = f"{scratch}/t"
    ST.commit(_rows(spark, (1, "a")), t)
    ST.stage(_rows(spark, (7, "a")), t)
    assert _held(ST.read_version(spark, t)) == [(1, "a")]
    late = ST.stage(_rows(spark, (5, "a")), t)
    ST.commit(_rows(spark, (2, "b")), t)
    with pytest.raises(ST.Conflict):
        ST.publish(spark, t, late)
    assert _held(ST.read_version(spark, t)) == [(1, "a"), (2, "b")] and ST.versions(spark, t) == [1, 2]
    assert len(ST.unpublished(spark, t)) == 2
    assert sorted(n for n in os.listdir(f"{t}/manifests") if not n.startswith(".")) == ["1.json", "2.json"]


def test_only_the_folders_of_the_wanted_periods_are_read(spark, scratch):
    t = f"{scratch}/t"
    ST.commit(_rows(spark, (1, "a"), (2, "b")), t)
    ST.commit(_rows(spark, (3, "c")), t)
    some = ST.read_version(spark, t, ["b", "c"])
    assert _held(some) == [(2, "b"), (3, "c")] and all("period=a" not in f for f in some.inputFiles())
    with pytest.raises(KeyError, match="lacks"):
        ST.read_version(spark, t, ["z"])


def test_refused_and_empty_deliveries(spark, scratch):
    t = f"{scratch}/t"
    with pytest.raises(FileNotFoundError):
        ST.read_version(spark, t)
    assert ST.commit(_rows(spark, (1, "a")).filter("false"), t) == 1
    assert ST.read_version(spark, t).collect() == []
    ST.commit(_rows(spark, (1, "a")), t)
    for bad in (_rows(spark, (1, None)), _rows(spark, (1, ""))):
        with pytest.raises(Exception, match="a row has no period"):
            ST.commit(bad, t)
    with pytest.raises(ValueError, match="differ"):
        ST.commit(_rows(spark, (1, "b")).withColumn("more", F.lit(1)), t)
    with pytest.raises(KeyError):
        ST.read_version(spark, t, version=9)
    assert _held(ST.read_version(spark, t)) == [(1, "a")] and ST.versions(spark, t) == [1, 2]


def test_stored_records_join_and_group_without_an_exchange(spark):
    joined = stored_records(spark, SF_SMALL)
    plan = joined.groupBy("l_orderkey").count()._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    plain = load(spark, SF_SMALL, "lineitem").join(load(spark, SF_SMALL, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    assert joined.count() == plain.count()
    assert joined.agg(F.sum("l_orderkey")).first() == plain.agg(F.sum("l_orderkey")).first()


def test_stored_quantiles_are_exact_and_a_new_period_reads_itself(spark, scratch):
    df = spark.range(60_000).select(F.concat(F.lit("p"), (F.col("id") % 5)).alias("period"), (F.col("id") % 3).alias("g"),
                                    (F.pow(F.rand(3), 4) * 1000).alias("x"), F.when(F.col("id") % 7 > 0, F.round(F.rand(4) * 9)).alias("y"))
    df = ST.read_version(spark, f"{scratch}/r") if ST.commit(df, f"{scratch}/r") else None
    for p in ("p0", "p1", "p2", "p3", "p4"):
        new = ST.read_version(spark, f"{scratch}/r", [p])
        assert all(f"period={p}" in f for f in new.inputFiles())
        ST.commit(SK.period_sketches(new, ["x", "y"], ["g"]), f"{scratch}/s")
    kept, ps = ST.read_version(spark, f"{scratch}/s"), [0.0, 0.01, 0.5, 0.99, 1.0]
    for interpolate in (False, True):
        got = {(r.g, r.variable, r.p): r.value for r in SK.stored_quantiles(df, kept, ["x", "y"], ps, ["g"], interpolate).collect()}
        for c in ("x", "y"):
            for r in exact_quantiles(df, c, ps, ["g"], interpolate).collect():
                assert got.pop((r.g, c, r.p)) == pytest.approx(r.value, abs=1e-12)
        assert not got
    near = {(r.g, r.p): r.value for r in SK.approximate_quantiles(kept, ["x", "y"], ps, ["g"]).filter("variable = 'x'").collect()}
    for g in range(3):
        values = sorted(r.x for r in df.filter(F.col("g") == g).collect())
        for p in ps:
            below = sum(v < near[g, p] for v in values) / len(values)
            assert abs(below - p) <= 2 * SK.MARGIN


odd = st.one_of(st.none(), st.sampled_from([float("nan"), float("inf"), float("-inf"), 0.0, -1.5, 3.0]))


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.sampled_from([None, "g"]), odd), max_size=12))
def test_stored_quantiles_of_odd_values(spark, rows):
    df = spark.createDataFrame(rows, "period string, g string, x double")
    kept = SK.period_sketches(df, ["x"], ["g"])
    got = {(r.g, r.p): repr(r.value) for r in SK.stored_quantiles(df, kept, ["x"], [0.25, 0.5], ["g"]).collect()}
    assert got == {(r.g, r.p): repr(r.value) for r in exact_quantiles(df, "x", [0.25, 0.5], ["g"]).collect()}
