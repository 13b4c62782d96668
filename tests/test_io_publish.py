"""Sources/sinks (S) and publication checks (V) on small written tables."""

import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopwright.operators import publish as V
from shopwright.sources import files as S


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="shopwright-io-")


def test_csv_roundtrip_discover_and_verify(spark, workdir):
    df = spark.createDataFrame([(1, "a", "2020-01-02"), (2, "b", "bad")], "id int, name string, d string")
    for i in range(3):
        S.write_table(df, f"{workdir}/src{i}", fmt="csv")
    files = S.discover(spark, [f"{workdir}/src0", f"{workdir}/src1"], "*.csv", expected=None)
    assert len(files) >= 2 and files == sorted(files)
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType()),
                           T.StructField("d", T.DateType())])
    back = S.read_csv(spark, f"{workdir}/src0", schema, corrupt_column="_bad").cache()
    assert back.count() == 2
    assert back.filter(F.col("_bad").isNotNull()).count() == 1   # PERMISSIVE keeps the bad row
    with pytest.raises(FileNotFoundError):
        S.source_registry(spark, {f"{workdir}/nope.csv": "x"})
    loaded = S.load_raw(spark, {"t": df}, f"{workdir}/raw")
    report = S.verify_load(loaded)
    assert [r.row_count_match for r in S.verify_load({"t": loaded["t"]._replace(rows=3)}).collect()] == [False]
    assert report.first().row_count_match
    S.assert_loaded(report)
    assert S.write_outputs({"o": df}, f"{workdir}/out") == [("o", 2)]
    assert S.write_report(df, f"{workdir}/rep", "r") == 2


def test_table_inventory_and_type_map(spark):
    inv = dict((t, s) for t, s in V.check_table_inventory(["a", "b", "x"], ["a", "b", "c"]))
    assert inv == {"a": "found", "b": "found", "c": "missing", "x": "unexpected"}
    assert V.map_type(T.DecimalType(38, 2)) == "NUMBER(38,2)"
    assert V.map_type(T.TimestampNTZType()) == "TIMESTAMP_NTZ"
    with pytest.raises(TypeError):
        V.map_type(T.CalendarIntervalType())


def test_schema_compare_nulls_and_totals(spark, workdir):
    a = spark.createDataFrame([(1, 2.5, None), (2, None, "x")], "id int, v double, s string")
    b = spark.createDataFrame([(1, 2.5, None), (2, 1.0, "x")], "id long, v double, s string")
    ok, issues = V.compare_schemas(a.schema, b.schema)
    assert ok, issues
    ok, issues = V.compare_schemas(a.schema, b.select("id", "s", "v").schema)
    assert not ok
    nulls = {r.column_name: r.match for r in V.compare_nulls(a, b, "t").collect()}
    assert nulls == {"id": True, "v": False, "s": True}
    m = {"rows": "count(*)", "total": "sum(v)"}
    off = spark.createDataFrame([(1, 2.5, None), (2, 0.02, "x")], "id int, v double, s string")
    res = {r.metric: r.passed for r in V.compare_totals(V.control_totals(a, m, "t"),
                                                          V.control_totals(off, m, "t")).collect()}
    assert res == {"rows": True, "total": False}   # off by 0.02 > 0.01
    near = spark.createDataFrame([(1, 2.51, None), (2, None, "x")], "id int, v double, s string")
    res = V.compare_totals(V.control_totals(a, m, "t"), V.control_totals(near, m, "t"))
    V.verdict(res)                                  # off by 0.01 passes
    d = V.describe_schema(spark, a, "t").collect()
    assert [r.column_name for r in d] == ["id", "v", "s"] and d[0].ordinal == 1


def test_normalize_upper_cases_and_coerces(spark):
    df = spark.createDataFrame([("2020-01-01 10:00:00", 1), ("junk", 2)], "order_date string, n int")
    out = V.normalize(df)
    assert out.columns == ["ORDER_DATE", "N"]
    vals = [r.ORDER_DATE for r in out.collect()]
    assert vals[1] is None and vals[0] is not None


def test_two_phase_publish_keeps_the_old_copy(spark, workdir, monkeypatch):
    root = f"{workdir}/serving"
    a = spark.range(10).selectExpr("id", "CAST(id AS DECIMAL(12,2)) AS price", "'2020-01-0' || (1 + id % 3) AS sold_date", "array(id) AS parts")
    b = spark.range(5).selectExpr("id", "id * 2 AS x")

    def report(**tables):
        return {r.table_name: tuple(r)[1:] for r in V.publish_all(tables, root).collect()}
    assert V.current(spark, root) == {}
    assert report(a=a, b=b) == {"a": (10, 10, 10, "PASS"), "b": (5, 5, 5, "PASS")}
    first = V.current(spark, root)
    copy = spark.read.parquet(first["a"])
    assert [f.simpleString() for f in copy.schema.fields] == ["ID:bigint", "PRICE:decimal(12,2)", "SOLD_DATE:timestamp", "PARTS:string"]
    # an empty table is refused, and the good one beside it is not switched either
    assert report(a=a.where("id < 0"), b=b) == {"a": (0, 0, 0, "EMPTY"), "b": (5, 5, 5, "PASS")}
    assert V.current(spark, root) == first and spark.read.parquet(first["a"]).count() == 10
    # rows lost between the writer and the files
    real = V.write_table
    monkeypatch.setattr(V, "write_table", lambda df, path: (real(df.where("ID <> 3"), path), 10)[1])
    assert report(a=a)["a"] == (10, 10, 9, "FAIL") and V.current(spark, root) == first
    monkeypatch.setattr(V, "write_table", real)
    # rows lost before the writer
    lost = V.publish_all({"a": a}, root, prepare=lambda df: V.typed_target(df.limit(4))).first()
    assert (lost.loaded_rows, lost.target_rows, lost.status) == (4, 4, "FAIL") and V.current(spark, root) == first
    # a later good run of one table switches that table and keeps the other
    assert report(a=a.where("id < 7")) == {"a": (7, 7, 7, "PASS")}
    now = V.current(spark, root)
    assert now["b"] == first["b"] and spark.read.parquet(now["a"]).count() == 7


def test_null_counts_come_from_the_footers(spark, workdir):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 4 = 0 THEN NULL ELSE id END AS x", "CASE WHEN id < 10 THEN 'a' END AS s",
                                      "CAST(NULL AS DATE) AS d", "id > 5 AS flag", "CAST(id AS DECIMAL(20,2)) AS m")
    df.repartition(3).write.parquet(f"{workdir}/nulls")
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    got = {r.column_name: r.nulls for r in V.footer_null_pattern(spark, f"{workdir}/nulls").collect()}
    assert got == {"id": 0, "x": 250, "s": 990, "d": 1000, "flag": 0, "m": 0}
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    lost = V.compare_nulls(df.withColumn("x", F.col("id")), V.footer_null_pattern(spark, f"{workdir}/nulls"), "t").collect()
    assert {r.column_name for r in lost if not r.match} == {"x"}
    for k, v in V._FOOTERS.items():
        spark.conf.set(k, v)
    try:
        plan = spark.read.parquet(f"{workdir}/nulls").agg(F.count("x"), F.count("s"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", before)
        spark.conf.unset("spark.sql.parquet.aggregatePushdown")
    assert "PushedAggregation: [COUNT(x), COUNT(s)]" in plan


def test_quarantine_by_reason(spark, workdir):
    lines = ["id,name,day", "1,ann,2020-01-01", "2,\"a, b\",2020-02-30", "x3,cid,2020-01-02", "4,dan", "5,eve,2020-01-03,more", ",fay,2020-01-04", "6,,", "7, ,2020-01-05"]
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(f"{workdir}/in")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("day", T.DateType())])
    got = {r.reason: (r.lines, r.rows_written, r.input_lines)
           for r in S.load_with_quarantine(spark, f"{workdir}/in", schema, ["id"], f"{workdir}/good", f"{workdir}/bad").collect()}
    assert got == {"good": (3, 3, 8), "malformed": (2, 2, 8), "id unreadable": (1, 1, 8), "day unreadable": (1, 1, 8), "id missing": (1, 1, 8)}
    assert sorted((r.id, r.day is None) for r in spark.read.parquet(f"{workdir}/good").collect()) == [(1, False), (6, True), (7, False)]
    assert {r.line for r in spark.read.parquet(f"{workdir}/bad").where("reason = 'malformed'").collect()} == {"4,dan", "5,eve,2020-01-03,more"}


def test_rebuild_goes_on_after_the_last_finished_table(spark, workdir):
    built = []

    def step(name, fail=False):
        def build():
            if fail:
                raise RuntimeError("killed")
            built.append(name)
            return spark.range(len(built))
        return name, build
    with pytest.raises(RuntimeError):
        S.rebuild(spark, [step("a"), step("b"), step("c", fail=True)], f"{workdir}/r")
    assert S.rebuild(spark, [step("a"), step("b"), step("c")], f"{workdir}/r") == [("a", 1), ("b", 2), ("c", 3)]
    assert built == ["a", "b", "c"]
