"""Property tests: operators against small pure-Python references on random inputs."""
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulae.functions import canonical_code, is_finite
from tabulae.operators import quality as Q
from tabulae.spec import TableSpec

FLOATS = st.one_of(st.none(), st.sampled_from([float("nan"), float("inf"), float("-inf"), 0.0, -1.0]),
                   st.floats(min_value=-50, max_value=200, allow_nan=False))
ROWS = st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), FLOATS, FLOATS, st.sampled_from(["x", "y", "z", None])),
                min_size=0, max_size=40)
SETTINGS = settings(max_examples=20, deadline=None, suppress_health_check=list(HealthCheck))


def _fin(x):
    return x is not None and not math.isnan(x) and not math.isinf(x)


@SETTINGS
@given(rows=ROWS)
def test_funnel_matches_python(spark, rows):
    spec = TableSpec(steps=(("a finite", is_finite("a")), ("a > 0", F.col("a") > 0), ("b <= a", F.col("b") <= F.col("a")),
                            ("code", F.col("c").isin("x", "y"))))
    # applied in order to the surviving rows only, so ``a`` is finite from step 2 on;
    # Spark orders NaN above every number, hence a NaN ``b`` fails ``b <= a``
    checks = [lambda r: _fin(r[1]), lambda r: r[1] > 0,
              lambda r: r[2] is not None and not math.isnan(r[2]) and r[2] <= r[1],
              lambda r: r[3] in ("x", "y")]
    df = spark.createDataFrame(rows, "g string, a double, b double, c string")
    got = {(r.g, r.step_no): (r.remaining, r.excluded) for r in Q.funnel(df, spec, "g").collect()}
    groups = sorted({r[0] for r in rows})
    for g in groups + ["TOTAL"]:
        sub = [r for r in rows if g == "TOTAL" or r[0] == g]
        alive = list(sub)
        assert got[(g, 0)] == (len(sub), 0)
        for i, chk in enumerate(checks, start=1):
            nxt = [r for r in alive if chk(r)]
            assert got[(g, i)] == (len(nxt), len(alive) - len(nxt)), (g, i)
            alive = nxt


TEXT = st.one_of(st.none(), st.sampled_from(["", " ", "1", "1.0", " 7 ", "007", "-3", "2.5", "1e3", "abc", "NaN",
                                             "inf", "1e30", " x1 "]),
                 st.integers(-1000, 1000).map(str), st.floats(-1e6, 1e6, allow_nan=False).map(repr))


def _canon(s):
    if s is None:
        return None
    t = s.strip(" ")
    if t == "":
        return None
    try:
        x = float(t)
    except ValueError:
        return t
    if math.isfinite(x) and abs(x) < 9.0e18 and x == math.floor(x):
        return str(int(x))
    return t


@SETTINGS
@given(values=st.lists(TEXT, min_size=1, max_size=30))
def test_canonical_code_matches_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = [r[0] for r in df.select(canonical_code("x")).collect()]
    assert got == [_canon(v) for v in values]
