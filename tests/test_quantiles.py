"""Distributed exact quantiles equal Spark's exact aggregates (random data, ties, NULLs, tiny groups)."""
import random

import pytest
from pyspark.sql import functions as F

from tabulae.operators.quantiles import exact_arrays, exact_quantiles, quantile_table

PS = [0.0, 0.01, 0.1, 0.31, 0.5, 0.75, 0.9, 0.999, 1.0]


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    rows = []
    for g, n in enumerate([1, 2, 37, 500, 4000]):
        for _ in range(n):
            kind = rnd.random()
            if kind < 0.1:
                x = None
            elif kind < 0.4:
                x = float(rnd.randint(0, 5))            # heavy ties
            else:
                x = rnd.gauss(0, 1) * rnd.choice([1, 1000])
            rows.append((g, x))
    return spark.createDataFrame(rows, "g int, x double")


@pytest.mark.parametrize("interpolate", [False, True])
@pytest.mark.parametrize("accuracy", [50, 10000])
def test_matches_builtin(data, interpolate, accuracy):
    got = {(r.g, r.j): r.value for r in exact_quantiles(data, "x", PS, ["g"], interpolate, accuracy).collect()}
    ref = quantile_table(data, "x", PS, ["g"], interpolate, method="exact", name="q")
    for r in ref.collect():
        for j in range(len(PS)):
            assert got[(r.g, j)] == r.q[j], (r.g, PS[j])


def test_ungrouped_and_table_shape(data):
    t = quantile_table(data, "x", [0.5, 0.9], method="distributed").first()["_q"]
    ref = data.agg(F.expr("percentile_disc(array(0.5, 0.9)) WITHIN GROUP (ORDER BY x)")).first()[0]
    assert list(t) == list(ref)
    assert quantile_table(data, "x", [0.5], ["g"], method="approx").count() == 5


def test_element_rank_is_exact_decimal(spark):
    """rank = ceil(p * n) on p as written: Spark's double product drifts above integer ranks
    (0.28 * 25 = 7.000000000000001); both methods must still pick rank 7."""
    import math
    from fractions import Fraction
    ps = [k / 100 for k in range(1, 100)]
    for n in (25, 175, 1250):
        vals = [float(i) for i in range(1, n + 1)]
        random.Random(n).shuffle(vals)
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        want = [float(max(1, math.ceil(Fraction(repr(p)) * n))) for p in ps]
        for method in ("exact", "distributed"):
            assert list(quantile_table(df, "x", ps, method=method).first()[0]) == want, (n, method)


def test_many_columns_null_groups_and_no_exchange_reuse(spark):
    """Several columns in one run equal Spark's built-in aggregates, whatever the plan reuses and into however many parts it shuffles."""
    rnd = random.Random(11)
    rows = [(rnd.choice(["a", "b", None]), rnd.gauss(0, 1) if rnd.random() < 0.9 else None, float(rnd.randint(0, 50))) for _ in range(6000)]
    rows += [("none", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(5)
    ps = [0.01, 0.25, 0.5, 0.99]
    want = {}
    for r in df.groupBy("g").agg(F.percentile("x", ps).alias("x"), F.percentile("y", ps).alias("y")).collect():
        want[r.g] = (r.x, r.y)
    before = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.shuffle.partitions")}
    try:
        for reuse, parts in (("true", "8"), ("false", "8"), ("false", "200")):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for accuracy in (60, 10000):
                got = exact_arrays(df, {"x": "x", "y": "y"}, ps, ["g"], True, accuracy).collect()
                assert {r.g: (r.x, r.y) for r in got} == want
                one = exact_arrays(df, {"x": "x"}, ps, (), False, accuracy).first().x
                assert one == df.agg(F.expr(f"percentile_disc(array({','.join(map(str, ps))})) WITHIN GROUP (ORDER BY x)")).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
