"""Ingest: text scans, required columns by normalised name, typing, provenance, stacking,
convert-once store, header drift and the streaming ingest."""
import os

import pytest
from pyspark.sql import functions as F

from tabulae.operators import harmonise as H
from tabulae.sources import delivery_path, load_delivery, read_text, typed_table, write_results, chosen_parameters, read_results
from tabulae.streaming import read_typed, stream_deliveries

REQUIRED = ["SALARY", "AGE", "LEVEL", "HH", "PERIOD_RAW"]


def _csv(path, header, rows):
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


@pytest.fixture()
def deliveries(scratch):
    d = os.path.join(scratch, "raw")
    os.makedirs(d)
    _csv(f"{d}/d1.csv", [" salary", "Age ", "level", "hh", "period_raw", "extra"],
         [["3000", "30", "2", "10", "2", "x"], ["", "45", "2.0", " 11 ", "2", "y"]])
    _csv(f"{d}/d2.csv", ["period_raw", "hh", "level", "AGE", "SALARY"],  # reversed order, no extra
         [["3", "12", "abc", "50", "1d"], ["3", "13", "1", "x", "2500.5"]])
    return d


def test_select_required_any_position(spark, deliveries):
    a = H.select_required(read_text(spark, f"{deliveries}/d1.csv"), REQUIRED)
    b = H.select_required(read_text(spark, f"{deliveries}/d2.csv"), REQUIRED)
    assert a.columns == b.columns == REQUIRED
    assert all(t == "string" for _, t in a.dtypes)
    with pytest.raises(ValueError, match="MISSING"):
        H.select_required(a, REQUIRED + ["MISSING"])


def test_load_delivery_types_and_provenance(spark, deliveries):
    df = load_delivery(spark, f"{deliveries}/d1.csv", "2025Q1", REQUIRED, {"SALARY": "salary", "AGE": "age"},
                       doubles=["salary", "age"], ints=["PERIOD_RAW"], codes=["LEVEL", "HH"], year=2025, quarter=1)
    rows = df.orderBy("HH").collect()
    assert [r.salary for r in rows] == [3000.0, None] and [r.LEVEL for r in rows] == ["2", "2"]
    assert [r.HH for r in rows] == ["10", "11"] and rows[0].period == "2025Q1" and rows[0].source == "d1.csv"
    assert dict(df.dtypes)["PERIOD_RAW"] == "int" and rows[0].year == 2025


def test_unparseable_text_is_null_not_error(spark, deliveries):
    df = load_delivery(spark, f"{deliveries}/d2.csv", "P2", REQUIRED, doubles=["SALARY", "AGE"], codes=["LEVEL"])
    rows = {r.HH: r for r in df.collect()}
    assert rows["13"].AGE is None and rows["12"].LEVEL == "abc" and rows["13"].SALARY == 2500.5


def test_stack_by_name_is_strict(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2)], "b string, a int")
    assert sorted(r.a for r in H.stack_by_name([a, b]).collect()) == [1, 2]
    with pytest.raises(Exception):
        H.stack_by_name([a, spark.createDataFrame([(3,)], "a int")]).collect()


def test_delivery_path_lists_available(spark, deliveries):
    assert delivery_path(spark, deliveries, {"P1": "d1.csv"}, "P1").endswith("d1.csv")
    with pytest.raises(FileNotFoundError, match="d2.csv"):
        delivery_path(spark, deliveries, {"P9": "nope.csv"}, "P9")


def test_typed_table_converts_once(spark, deliveries, scratch):
    calls = []

    def build(period):
        calls.append(period)
        return load_delivery(spark, f"{deliveries}/{period}.csv", period, REQUIRED, doubles=["SALARY"])

    target = os.path.join(scratch, "typed")
    t = typed_table(spark, target, ["d1", "d2"], build)
    assert t.count() == 4 and calls == ["d1", "d2"]
    t2 = typed_table(spark, target, ["d1", "d2"], build)
    assert t2.count() == 4 and calls == ["d1", "d2"]  # reused, not rewritten


def test_results_round_trip(spark, scratch):
    t = spark.createDataFrame([("a", 1.5), ("b", 2.5)], "config string, rmse double")
    path = write_results(t, os.path.join(scratch, "res"), ("selected", "config", "b"))
    back = read_results(spark, path, "config string, rmse double, selected boolean")
    assert {r.config: r.selected for r in back.collect()} == {"a": False, "b": True}


def test_grid_tables_keep_their_parameters(spark, scratch):
    """Maps, arrays and structs, odd text and a NULL configuration come back as they were written."""
    schema = "position int, config string, params map<string,double>, sizes array<bigint>, best struct<a:int,b:string>"
    rows = [(0, 'a "b", c', {"reg_param": 0.1, "elastic_net": 0.0}, [1, 2], (1, 'x "y"')), (1, None, {}, [], (None, "z, \\ w")), (2, "c", None, None, None)]
    t = spark.createDataFrame(rows, schema)
    path = write_results(t, os.path.join(scratch, "grid"), ("selected", "config", 'a "b", c'))
    back = read_results(spark, path, schema + ", selected boolean").orderBy("position").collect()
    assert [tuple(r[:3]) for r in back] == [tuple(r[:3]) for r in rows] and [r.sizes for r in back] == [r[3] for r in rows]
    assert back[0].best == (1, 'x "y"') and back[1].best.b == "z, \\ w" and back[2].best is None
    assert [r.selected for r in back] == [True, False, False]
    assert chosen_parameters(spark, path, schema + ", selected boolean") == {"reg_param": 0.1, "elastic_net": 0.0}
    nobody = write_results(t, os.path.join(scratch, "none"), ("selected", "config", "absent"))
    with pytest.raises(ValueError):
        chosen_parameters(spark, nobody, schema + ", selected boolean")


def test_header_drift(spark):
    t = H.header_drift(spark, {"d1": ["a", "b", "c"], "d2": ["c", "b", "a", "z"]}, ["A", "B", "C"], "d1")
    r = {x.delivery: x for x in t.collect()}
    assert r["d2"].moved_required == 2 and r["d2"].all_required and r["d2"].extra == ["Z"] and r["d1"].extra == []


def test_streaming_ingest_processes_each_file_once(spark, deliveries, scratch):
    src = os.path.join(scratch, "incoming")
    os.makedirs(src)
    _csv(f"{src}/p1.csv", REQUIRED, [["100", "20", "1", "1", "1"], ["200", "30", "2", "2", "1"]])
    sink, ckpt = os.path.join(scratch, "typed_stream"), os.path.join(scratch, "ckpt_stream")
    kw = dict(doubles=["SALARY", "AGE"], codes=["LEVEL", "HH"])
    q = stream_deliveries(spark, src, REQUIRED, sink, ckpt, {"p1.csv": "2025Q1", "p2.csv": "2025Q2"}, **kw)
    q.awaitTermination(120)
    assert read_typed(spark, sink).count() == 2
    _csv(f"{src}/p2.csv", REQUIRED, [["300", "40", "3", "3", "2"]])
    q = stream_deliveries(spark, src, REQUIRED, sink, ckpt, {"p1.csv": "2025Q1", "p2.csv": "2025Q2"}, **kw)
    q.awaitTermination(120)
    t = read_typed(spark, sink)
    assert t.count() == 3 and {r.period for r in t.select("period").distinct().collect()} == {"2025Q1", "2025Q2"}


def test_cut_lineage_uses_shared_checkpoint_dir(spark):
    from tabulae.sources import checkpoint_dir, cut_lineage
    assert checkpoint_dir(spark)  # set by the test session only because it was unset
    df = spark.range(100).withColumn("x", F.col("id") * 2).filter("x > 10")
    cut = cut_lineage(df)
    assert cut.count() == df.count() == 94
    assert "Filter" not in cut._jdf.queryExecution().optimizedPlan().toString()


def test_bucketed_tables_join_without_shuffle(spark, scratch):
    from tabulae.sources import write_bucketed
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_extendedprice")
    od = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"),
                                                                          "o_orderpriority")
    write_bucketed(li, "li_b", ["l_orderkey"], 8, os.path.join(scratch, "li_b"))
    write_bucketed(od, "od_b", ["l_orderkey"], 8, os.path.join(scratch, "od_b"))
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the sort-merge path a big join takes
    try:
        j = spark.table("li_b").join(spark.table("od_b"), "l_orderkey").groupBy("l_orderkey").count()
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and j.count() == li.select("l_orderkey").distinct().count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_typed_table_converts_a_half_written_period_again(spark, scratch):
    target = os.path.join(scratch, "typed")
    os.makedirs(os.path.join(target, "period=p1"))  # what a lost job leaves: a folder without its commit marker
    t = typed_table(spark, target, ["p1", "2024"], lambda p: spark.createDataFrame([(p, 1)], "who string, n int"))
    assert sorted((r.who, r.period) for r in t.collect()) == [("2024", "2024"), ("p1", "p1")]
    assert dict(t.dtypes)["period"] == "string"


def test_typed_table_refuses_a_missing_column(spark, scratch):
    frames = {"a": spark.createDataFrame([(1, 2)], "x int, y int"), "b": spark.createDataFrame([(3,)], "x int")}
    with pytest.raises(Exception):
        typed_table(spark, os.path.join(scratch, "typed"), ["a", "b"], frames.__getitem__).collect()


def test_stream_stops_at_a_file_with_moved_columns(spark, scratch):
    src = os.path.join(scratch, "incoming")
    os.makedirs(src)
    _csv(f"{src}/p1.csv", list(reversed(REQUIRED)), [["100", "20", "1", "1", "1"]])
    q = stream_deliveries(spark, src, REQUIRED, os.path.join(scratch, "out"), os.path.join(scratch, "ck"), {"p1.csv": "P1"})
    with pytest.raises(Exception):
        q.awaitTermination(120)


def test_guard_names_offenders_and_their_number(spark):
    from tabulae.operators.sets import guard_periods
    df = spark.range(100).selectExpr("CONCAT('p', id) AS period")
    with pytest.raises(ValueError, match="found also 97.*and 77 more"):
        guard_periods(df, "period", ["p1", "p2", "p3"])
