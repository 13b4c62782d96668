"""Hand-made frames, one per rule."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopwright.functions.keys import with_dense_key, with_group_sequence, with_small_key
from shopwright.functions.quantiles import cell_percentiles, counted_values
from shopwright.operators import audit as A
from shopwright.operators import checks as Q
from shopwright.operators import enterprise as M
from shopwright.operators import kpis as K
from shopwright.operators import profile as P
from shopwright.operators import staging as G
from shopwright.operators import star as D


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_dense_key_equals_row_number(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(5)
    out = with_dense_key(df, ["k"], "key").collect()
    assert sorted((r.k, r.key) for r in out) == [(k, k + 1) for k in range(1000)]


def test_group_sequence_with_hot_group(spark):
    # one group holds most rows: numbering stays 1..n per group
    rows = [(0, i) for i in range(500)] + [(g, i) for g in range(1, 20) for i in range(3)]
    df = spark.createDataFrame(rows, "g long, v long")
    out = with_group_sequence(df, ["g"], ["v"], "seq").collect()
    got = {}
    for r in out:
        got.setdefault(r.g, []).append((r.v, r.seq))
    for g, pairs in got.items():
        pairs.sort()
        assert [s for _, s in pairs] == list(range(1, len(pairs) + 1))


def test_geolocation_mode_tie_and_even_median(spark):
    raw = spark.createDataFrame([(1, 1.0, 10.0, "b", "sp"), (1, 3.0, 20.0, "a", "SP"), (1, 2.0, 30.0, "a", "rj"),
                                 (1, 4.0, 40.0, "b", "rj"), (2, 5.0, 5.0, " ", None)],
                                "geolocation_zip_code_prefix int, geolocation_lat double, geolocation_lng double, "
                                "geolocation_city string, geolocation_state string")
    g = {r.zip_code_prefix: r for r in G.stg_geolocation(raw).collect()}
    assert g["00001"].latitude == 2.5 and g["00001"].longitude == 25.0  # even count: interpolated
    assert g["00001"].city == "a"          # tie a/b -> lowest
    assert g["00001"].state == "RJ"        # tie RJ/SP -> lowest
    assert g["00001"].distinct_state_count == 2 and g["00001"].source_row_count == 4
    assert g["00002"].city is None and g["00002"].distinct_city_count == 0


def test_blank_strings_zip_zero_and_timestamps(spark):
    raw = spark.createDataFrame([("o1", "c1", " Delivered ", "2020-01-01 10:00:00", "", None, " ", "2020-02-01")],
                                "order_id string, customer_id string, order_status string, "
                                "order_purchase_timestamp string, order_approved_at string, "
                                "order_delivered_carrier_date string, order_delivered_customer_date string, "
                                "order_estimated_delivery_date string")
    o = G.stg_orders(raw).first()
    assert o.order_status == "delivered" and o.order_approved_at is None
    assert o.order_delivered_customer_date is None
    assert o.order_purchase_timestamp == ts("2020-01-01 10:00:00")
    c = G.stg_customers(spark.createDataFrame([("c", "u", 1234, " x ", " sp ")],
                                              "customer_id string, customer_unique_id string, "
                                              "customer_zip_code_prefix int, customer_city string, "
                                              "customer_state string")).first()
    assert c.customer_zip_code_prefix == "01234" and c.customer_state == "SP" and c.customer_city == "x"


def _orders(spark, rows):
    return spark.createDataFrame(rows, "order_id long, customer_id long, order_status string, "
                                       "order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz, "
                                       "order_delivered_carrier_date timestamp_ntz, "
                                       "order_delivered_customer_date timestamp_ntz, "
                                       "order_estimated_delivery_date timestamp_ntz")


def test_same_day_late_delivery_and_nullable_flags(spark):
    o = _orders(spark, [
        (1, 1, "delivered", ts("2020-01-01 00:00"), None, ts("2020-01-02 00:00"), ts("2020-01-05 15:00"),
         ts("2020-01-05 00:00")),
        (2, 1, "delivered", ts("2020-01-01 00:00"), None, None, None, ts("2020-01-05 00:00"))])
    cust = spark.createDataFrame([(1, 10)], "customer_id long, customer_key long")
    items = spark.createDataFrame([], "order_id long, product_id long, seller_id long, price decimal(12,2), "
                                      "freight_value decimal(12,2)")
    pays = spark.createDataFrame([], "order_id long, payment_type string, payment_installments int, "
                                     "payment_value decimal(12,2)")
    f = {r.order_id: r for r in D.fact_orders(o, items, pays, cust).collect()}
    assert f[1].delivery_variance_days == 0 and f[1].is_late_delivery is True
    assert f[1].delivery_days == Decimal("4.63")
    assert f[2].is_late_delivery is None and f[2].has_missing_delivery_timestamp is True
    assert f[2].has_items is False and f[2].has_payment_reconciliation_issue is False


def test_zero_price_margin_pct_is_null(spark):
    foi = spark.createDataFrame([(1, 1, Decimal("0.00")), (2, 1, Decimal("10.00"))],
                                "order_id long, product_key long, price decimal(12,2)")
    supply = spark.createDataFrame([(1, 7, Decimal("4.00"))],
                                   "product_key long, supplier_key long, estimated_unit_cost decimal(14,2)")
    r = {x.order_id: x for x in D.add_profitability(foi, supply).collect()}
    assert r[1].estimated_gross_margin_pct is None
    assert r[2].estimated_gross_margin_pct == Decimal("60.00") and r[2].estimated_gross_margin == Decimal("6.00")


def test_check_runner_orders_by_severity(spark):
    t = {"x": spark.createDataFrame([(1,), (-1,), (None,)], "v int")}
    checks = [Q.Check("INFO", "b_info", "x", lambda: F.col("v") > 0),
              Q.Check("ERROR", "z_err", "x", lambda: F.col("v") < 0),
              Q.Check("WARNING", "a_warn", "x", lambda: F.col("v").isNull())]
    out = [(r.severity, r.check_name, r.issue_count) for r in Q.run_checks(checks, t).collect()]
    assert out == [("ERROR", "z_err", 1), ("WARNING", "a_warn", 1), ("INFO", "b_info", 1)]


def test_inventory_roll_forward(spark):
    day = dt.date
    moves = [  # store, product, month, sold, received, day of the last sale
        ("S1", 1, day(2020, 1, 1), 4, 0, 20), ("S1", 1, day(2020, 2, 1), 0, 1, None), ("S1", 1, day(2020, 3, 1), 6, 2, 30),
        ("S1", 1, day(2020, 6, 1), 2, 9, 3), ("S1", 1, day(2019, 11, 1), 0, 1, None),
        ("S2", 2, day(2020, 6, 1), 1, 0, 10), ("S2", 2, day(2020, 8, 1), 0, 5, None), ("S3", 3, day(2020, 2, 1), 0, 7, None)]
    df = spark.createDataFrame(moves, "store_id string, product_id long, month date, sold long, received long, last_sale int")
    by = {}
    for r in M.roll_inventory(df).orderBy("store_id", "snapshot_month").collect():
        assert r.opening_stock_qty + r.received_qty - r.sold_qty == r.closing_stock_qty >= 0
        by.setdefault(r.store_id, []).append(r)
    for rows in by.values():
        assert all(b.opening_stock_qty == a.closing_stock_qty for a, b in zip(rows, rows[1:]))
    # from the first sale to the last month with a sale; a pair that never sold has no shelf
    assert [r.snapshot_month.month for r in by["S1"]] == [1, 2, 3, 4, 5, 6] and [r.snapshot_month.month for r in by["S2"]] == [6]
    # usual month 12 / 3 = 4, one unit shipped before: opens with 5; March needs 6, has 2 + 2, receives two more
    assert [(r.opening_stock_qty, r.received_qty, r.sold_qty, r.closing_stock_qty) for r in by["S1"]] == [
        (5, 0, 4, 1), (1, 1, 0, 2), (2, 4, 6, 0), (0, 0, 0, 0), (0, 0, 0, 0), (0, 9, 2, 7)]
    assert {r.reorder_point for r in by["S1"]} == {4} and [r.stockout_days for r in by["S1"]] == [0, 0, 1, 0, 0, 0]
    assert (by["S2"][0].opening_stock_qty, by["S2"][0].closing_stock_qty, by["S2"][0].stockout_days) == (1, 0, 20)


def test_shares_sum_to_hundred(spark):
    g = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, v long")
    s = sum(r.share for r in K.with_share(g, "v", "share").collect())
    assert abs(s - 100.0) < 0.02


def test_marketing_spend_is_the_promotions_of_the_channel(spark):
    day = dt.date
    sk = spark.createDataFrame([(day(2020, 1, 1), "S1"), (day(2020, 2, 1), "S1")], "month date, store_id string")
    promos = spark.createDataFrame([(1, "2.50"), (1, "1.25"), (2, "4.00"), (3, "7.00"), (4, "9.00")], "order_id long, a string").selectExpr("order_id", "CAST(a AS DECIMAL(14,2)) AS amount")
    channels = spark.createDataFrame([(1, "email"), (2, "social"), (3, "email"), (4, "email")], "order_id long, channel string")
    at = spark.createDataFrame([(1, "S1"), (2, "S1"), (3, "S1"), (4, "S1")], "order_id long, store_id string")
    orders = spark.createDataFrame([(1, "2020-01-05"), (2, "2020-01-31"), (3, "2020-01-09"), (4, "2020-07-01")], "order_id long, t string").selectExpr("order_id", "CAST(t AS TIMESTAMP) AS order_purchase_timestamp")
    rows = M.allocate_marketing(sk, promos, channels, at, orders).collect()
    assert len(rows) == 2 * len(M.CHANNELS)
    assert {(r.month.month, r.channel): r.spend for r in rows if r.spend} == {(1, "email"): 10.75, (1, "social"): 4.0}


def test_suppliers_and_costs_fall_back_to_the_category(spark):
    products = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None)], "product_id long, product_category_name string")
    suppliers = spark.createDataFrame([(7,), (8,), (9,)], "supplier_id long")
    items = spark.createDataFrame([(1, 8), (1, 8), (1, 7), (1, 99), (1, 99), (1, 99), (4, 9)], "product_id long, seller_id long")
    got = {r.product_id: r.supplier_id for r in M.map_suppliers(products, suppliers, items).collect()}
    assert got == {1: 8, 2: 8, 3: 8, 4: 9}
    sold = spark.createDataFrame([(1, 20.0, "delivered"), (1, 40.0, "shipped"), (4, 30.0, "shipped")], "product_id long, p double, order_status string").selectExpr("product_id", "CAST(p AS DECIMAL(14,2)) AS price", "order_status")
    wholesale = spark.createDataFrame([(1, 5), (2, 6), (3, 7), (4, 4)], "product_id long, w int").selectExpr("product_id", "CAST(w AS DECIMAL(14,2)) AS wholesale_price")
    units = spark.createDataFrame([(1, 3), (1, 3), (4, 3)], "product_id long, q int").selectExpr("product_id", "CAST(q AS DECIMAL(14,2)) AS quantity")
    cost = {r.product_id: (r.estimated_unit_cost, r.cost_ratio) for r in M.product_cost(products, sold, wholesale, units).collect()}
    # 1: 30 of 60; 2: its category; 3: nothing in its category, so 42 of 90 overall and the median of 20 and 30; 4: 12 of 30
    assert cost == {1: (10.0, 0.5), 2: (10.0, 0.5), 3: (11.67, 0.4667), 4: (12.0, 0.4)}


def test_budgets_follow_the_months_before(spark):
    day = dt.date
    sk = spark.createDataFrame([(day(2020, m, 1), "S1", s, s / 10, 1) for m, s in ((1, 0.0), (2, 90.0), (3, 30.0), (4, 0.0), (5, 60.0))],
                               "month date, store_id string, actual_sales double, actual_freight double, actual_orders int")
    aov = spark.createDataFrame([("S1", 45.0)], "store_id string, aov double")
    budgets, targets = M.plan_store_months(sk, aov)
    got = [(r.sales_budget, r.freight_budget) for r in budgets.orderBy("budget_month").collect()]
    assert got == [(45.0, 4.5), (45.0, 4.5), (45.0, 4.5), (40.0, 4.0), (40.0, 4.0)]
    assert [(r.sales_target, r.order_target) for r in targets.orderBy("target_month").collect()] == [(47.25, 2)] * 3 + [(42.0, 1)] * 2


def test_seeded_faults_are_caught(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id long")
    child = spark.createDataFrame([(1,), (3,), (None,)], "pid long")
    dup = spark.createDataFrame([(1,), (1,), (2,)], "id long")
    with pytest.raises(A.ConstraintViolation):
        A.assert_fk(child, ["pid"], parent, ["id"])
    with pytest.raises(A.ConstraintViolation):
        A.assert_unique(dup, ["id"])
    with pytest.raises(A.ConstraintViolation):
        A.assert_not_null(child, ["pid"])
    A.assert_unique(parent, ["id"])
    r = A.foreign_key_check(child, "pid", parent, "id", "x").first()
    assert (r.child_rows, r.unmatched_rows, r.unmatched_pct) == (2, 1, 50.0)


def test_empty_input_gives_zero_pct(spark):
    e = spark.createDataFrame([], "id long")
    r = A.foreign_key_check(e, "id", e, "id", "empty").first()
    assert r.child_rows == 0 and r.unmatched_pct == 0.0


def test_no_single_partition_exchange_in_fact_builders(spark):
    from shopwright.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001", materialize=False)
    for name in ("fact_orders", "fact_order_items"):
        lines = w[name]._jdf.queryExecution().executedPlan().toString().splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                # only the per-partition row counts of the dense key (one row per partition)
                assert "_dk_pid" in lines[i + 1], (name, line)


def test_deals_next_purchase_with_hot_user_matches_brute_force(spark):
    import random
    from shopwright.sources.bindings import raw_deals
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        user = 0 if i < 400 else rnd.randrange(1, 30)          # user 0 holds two thirds of the events
        kind = rnd.choice(["signup", "purchase", "view"])
        rows.append((i, base + dt.timedelta(minutes=rnd.randrange(0, 300)), user, kind, float(i % 37), "{}"))
    ev = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                                     "value double, props string")
    got = {r.mql_id: (r.won_date, r.seller_id) for r in raw_deals({"events": ev}).collect()}
    want = {}
    for e_id, ts_, u, k, _, _ in rows:
        if k != "signup":
            continue
        later = sorted((t2, i2) for i2, t2, u2, k2, _, _ in rows if k2 == "purchase" and u2 == u and t2 > ts_)
        if later:
            want[e_id] = (later[0][0], u)
    assert got == want


def test_exact_percentiles_with_hot_group_match_spark_percentile(spark):
    import random
    from shopwright.functions.quantiles import exact_medians, exact_percentiles
    rnd = random.Random(3)
    rows = []
    for i in range(6000):
        g = 0 if i < 2400 else rnd.randrange(1, 40)      # group 0 holds 40 % of the rows
        a = None if rnd.random() < 0.05 else round(rnd.uniform(-100, 100), 3)
        rows.append((g, a, float(rnd.randrange(0, 7))))
    rows.append((99, None, None))                          # a group without values
    df = spark.createDataFrame(rows, "g int, a double, b double")
    probs = (0.0, 0.05, 0.5, 0.9, 1.0)
    got = {(r.g, r.metric): tuple(r[f"q{i}"] for i in range(len(probs)))
           for r in exact_percentiles(df, ["g"], {"a": "a", "b": "b"}, probs).collect()}
    want = {}
    for m in ("a", "b"):
        for r in df.groupBy("g").agg(F.percentile(m, F.array(*[F.lit(p) for p in probs])).alias("q")).collect():
            if r.q is not None:
                want[(r.g, m)] = tuple(r.q)
    assert got == want
    glob = exact_medians(df, [], {"a": "a", "b": "b"}, bounded_groups=True).collect()[0]
    ref = df.agg(F.percentile("a", F.lit(0.5)).alias("a"), F.percentile("b", F.lit(0.5)).alias("b")).collect()[0]
    assert (glob.a, glob.b) == (ref.a, ref.b)


def test_foreign_key_counts_with_hot_orphan_key(spark):
    child = spark.createDataFrame([(i, 7 if i < 500 else (i % 5 if i % 3 else None)) for i in range(800)],
                                  "id int, fk int")
    parent = spark.createDataFrame([(k,) for k in range(4)], "pk int")
    rows = [(i, 7 if i < 500 else (i % 5 if i % 3 else None)) for i in range(800)]
    orphans = sum(1 for _, fk in rows if fk is not None and fk not in range(4))
    r = A.foreign_key_check(child, "fk", parent, "pk", "x").collect()[0]
    assert (r.child_rows, r.unmatched_rows) == (sum(1 for _, fk in rows if fk is not None), orphans)
    report = A.constraint_report({"c": child, "p": parent}, [A.Unique("pk", "p", ("pk",)), A.Unique("u", "c", ("fk",))],
                                 [A.Reference("fk", "c", ("fk",), "p", ("pk",))])
    got = {(x.table_name, x.constraint_name): x.violations for x in report.collect()}
    assert got == {("p", "pk"): 0, ("c", "u"): 7, ("c", "fk"): orphans}
    assert A.fk_violations(child, ["fk"], parent, ["pk"]).count() == orphans


def test_constraint_engine_scans_each_table_once(spark, tmp_path):
    paths = {}
    for name in ("a", "b"):
        spark.range(20).selectExpr("id", "id % 7 AS x", "CASE WHEN id % 5 = 0 THEN NULL ELSE id + 15 END AS y").write.parquet(f"{tmp_path}/{name}")
        paths[name] = spark.read.parquet(f"{tmp_path}/{name}")
    uniques = [A.Unique("k", "a", ("id",)), A.Unique("xy", "a", ("x", "y")), A.Unique("k", "b", ("id",))]
    refs = [A.Reference("r1", "b", ("y",), "a", ("id",)), A.Reference("r2", "b", ("x",), "a", ("id",)), A.Reference("r3", "a", ("y",), "b", ("id",))]
    groups = A.key_groups(paths, uniques, refs)
    plan = groups._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and plan.count("Exchange hashpartitioning") == 1
    got = {(x.table_name, x.constraint_name): x.violations for x in A.constraint_report(paths, uniques, refs).collect()}
    assert got == {("a", "k"): 0, ("a", "xy"): 4, ("b", "k"): 0, ("b", "r1"): 12, ("b", "r2"): 0, ("a", "r3"): 12}
    none = A.constraint_report({n: d.limit(0) for n, d in paths.items()}, uniques, refs).collect()
    assert len(none) == 6 and not any(x.violations for x in none)


def test_constraints_by_buckets_of_keys(spark):
    # keys are checked 64 at a time; only buckets that may break a rule are counted key by key
    day = dt.date(2020, 1, 1)
    rows = [(i, i % 40 - 3, dt.date(2000 + i % 9, i % 12 + 1, i % 2 + 1), f"s{i % 700}") for i in range(3_000)]
    rows += [(7, 5, day, "s1"), (7, 6, day, "s2"), (64, 1, day, None), (None, 2, day, "s3"), (-1, None, None, "s4"), (-1, 9, None, "s5"), (2 ** 62, 90, day, "s6")]
    child = spark.createDataFrame(rows, "id long, few int, day date, name string")
    parent = spark.createDataFrame([(k, dt.date(2000 + k % 7, k % 12 + 1, 1), f"s{k}") for k in range(-2, 90) if k != 11] + [(30, None, None)],
                                   "pk long, month date, code string")
    tables = {"c": child, "p": parent}
    keys = [("c", ("id",)), ("c", ("few",)), ("c", ("id", "few")), ("c", ("few", "day", "id")), ("c", ("day", "name")), ("c", ("name",)),
            ("p", ("pk",)), ("p", ("month",)), ("p", ("code",)), ("c", ("day", "few"))]
    foreign = [("few", "pk"), ("id", "pk"), ("day", "month"), ("name", "code"), ("few", "code")]
    uniques = [A.Unique("u" + "+".join(cols), t, cols) for t, cols in keys]
    refs = [A.Reference(f"{c}>{pc}", "c", (c,), "p", (pc,)) for c, pc in foreign]
    want = {}
    for u in uniques:
        at = [tables[u.table].columns.index(c) for c in u.columns]
        seen = {}
        for r in tables[u.table].collect():
            k = tuple(r[i] for i in at)
            seen[k] = seen.get(k, 0) + 1
        want[u.table, u.name] = sum(n > 1 or None in k for k, n in seen.items())
    for c, pc in foreign:
        known = {str(r[pc]) for r in parent.collect() if r[pc] is not None}
        want["c", f"{c}>{pc}"] = sum(r[c] is not None and str(r[c]) not in known for r in child.collect())
    got = {(x.table_name, x.constraint_name): x.violations for x in A.constraint_report(tables, uniques, refs).collect()}
    assert got == want and min(want.values()) > 0
    audit = A.relationship_audit([(f"{c}>{pc}", child, c, parent, pc) for c, pc in foreign]).collect()
    assert {r.relationship: r.unmatched_rows for r in audit} == {f"{c}>{pc}": want["c", f"{c}>{pc}"] for c, pc in foreign}
    assert {r.child_rows for r in audit if r.relationship.startswith("few")} == {sum(r[1] is not None for r in rows)}
    # good dense keys: no key is counted by itself, and the rows that meet are a small part of them
    good = {"g": spark.range(20_000).selectExpr("id", "id div 4 AS o", "id % 4 AS n", "add_months(DATE'2020-01-01', CAST(id % 50 AS INT)) AS m", "id div 50 AS q")}
    clean = [A.Unique("id", "g", ("id",)), A.Unique("on", "g", ("o", "n")), A.Unique("mq", "g", ("m", "q"))]
    assert A._buckets(good, clean, []).count() == 0 and not any(x.violations for x in A.constraint_report(good, clean, []).collect())
    loop = [A.Reference("self", "g", ("o",), "g", ("id",))]
    met = A._buckets(good, clean, loop).agg(F.count(F.lit(1)), F.count_if("bad"), F.sum("c0")).first()
    assert tuple(met) == (20_000 // 64 + 1, 0, 20_000)


def _rows_by_task(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]


def test_percentiles_of_mostly_equal_values(spark):
    df = spark.range(40_000).selectExpr("IF(id % 10 = 0, NULL, id % 3) AS g", "CAST(IF(id % 20 < 19, 0, id) AS DOUBLE) AS x")
    cells = df.selectExpr("g", "x AS _v")
    got = {r.g: (r.q0, r.q1, r.q2, r.q3) for r in cell_percentiles(cells, ["g"], (0.0, 0.5, 0.953, 1.0)).collect()}
    want = {r.g: tuple(r.p) for r in df.groupBy("g").agg(F.expr("percentile(x, array(0.0D, 0.5D, 0.953D, 1.0D))").alias("p")).collect()}
    assert got.keys() == want.keys() and all(abs(a - b) < 1e-9 for g in got for a, b in zip(got[g], want[g]))
    # equal values are one row before they are ranged: no task holds twice the mean
    sizes = [r["count"] for r in counted_values(cells, ["g"]).groupBy("_pid").count().collect()]
    assert sum(sizes) < 2_100 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    one = cell_percentiles(df.selectExpr("CAST(7 AS DOUBLE) AS _v", "'a' AS k"), ["k"], (0.25, 0.5), bounded_groups=True).collect()
    assert [tuple(r) for r in one] == [("a", 7.0, 7.0)]
    assert cell_percentiles(cells.where("_v IS NULL"), ["g"], (0.5,)).collect() == []


def test_group_sequence_of_a_hot_group(spark):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(20_000).selectExpr("CASE WHEN id % 10 < 8 THEN 5 WHEN id % 100 = 9 THEN NULL ELSE id % 1000 END AS g", "(id * 7919) % 20011 AS o")
        got = with_group_sequence(df, ["g"], ["o"], "n")
        by_group = {}
        for r in got.collect():
            by_group.setdefault(r.g, []).append((r.o, r.n))
        assert all([n for _, n in sorted(v)] == list(range(1, len(v) + 1)) for v in by_group.values())
        assert len(by_group[5]) >= 16_000 and sum(map(len, by_group.values())) == 20_000
        sizes = _rows_by_task(got)
        assert max(sizes) <= 2 * sum(sizes) / int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert with_group_sequence(df.limit(0), ["g"], ["o"], "n").collect() == []
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_repeat_orders_of_a_hot_person(spark):
    # person p placed most orders; q repeats within 90 days, r does not, s only once, t too late to tell
    rows = [(k, "p", f"2020-{1 + k % 9:02d}-{1 + k % 28:02d} 00:00:00") for k in range(3000)]
    rows += [(5000, "q", "2020-01-01 00:00:00"), (5001, "q", "2020-03-31 00:00:00"), (5002, "r", "2020-01-01 00:00:00"),
             (5003, "r", "2020-03-31 00:00:01"), (5004, "s", "2020-02-02 00:00:00"), (5005, "t", "2020-12-30 00:00:00")]
    fo = spark.createDataFrame([(f"o{k}", k, 1, t) for k, _, t in rows], "order_id string, customer_key long, order_status_key int, t string")
    fo = fo.withColumn("order_purchase_timestamp", F.to_timestamp("t"))
    people = spark.createDataFrame([(k, who) for k, who, _ in rows], "customer_key long, customer_unique_id string")
    status = spark.createDataFrame([(1, "delivered")], "order_status_key int, order_status string")
    out = K.repeat_within(fo, people, status, 90)
    r = out.first()
    assert (r.eligible_customers, r.customers_repeated_within_90_days) == (4, 2)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_column_profile_needs_one_shuffle_of_keys(spark, tmp_path):
    rows = [(1, "a", 0.0, [1.0, None]), (2, "a", -0.0, [1.0, None]), (3, None, float("nan"), None), (4, "b", float("nan"), []), (4, "b", None, [])]
    spark.createDataFrame(rows, "id long, s string, d double, v array<double>").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    got = {r.column: (r.non_null_count, r.null_count, r.unique_count) for r in P.column_profile({"t": t}).collect()}
    assert got == {"id": (5, 0, 4), "s": (4, 1, 2), "d": (4, 1, 2), "v": (4, 1, 2)}
    plan = P.cell_keys({"t": t, "u": t})._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange") == 1
    empty = P.column_profile({"t": t.limit(0)}).collect()
    assert len(empty) == 4 and all((r.non_null_count, r.unique_count, r.unique_pct) == (0, 0, 0.0) for r in empty)


def test_duplicate_rows_under_one_key_are_told_apart(spark):
    t = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "a"), (3, None), (3, None), (4, "z")], "id long, s string")
    assert tuple(P.duplicate_rows(t).first()) == (7, 3)
    # every row under one key: the comparison of whole rows decides
    assert tuple(P.duplicate_rows(t, keys=lambda df: [F.lit(1)]).first()) == (7, 3)
    assert tuple(P.duplicate_rows(t.limit(0)).first()) == (0, 0)


def test_date_bounds_scans_each_table_once(spark, tmp_path):
    spark.sql("SELECT DATE'2020-01-05' AS a, TIMESTAMP'2019-12-31 10:00:00' AS b UNION ALL SELECT NULL, TIMESTAMP'2021-03-01 00:00:00'").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    out = D.date_bounds([(t, "a"), (t, "b")])
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert tuple(out.first()) == (dt.date(2019, 12, 31), dt.date(2021, 3, 1))


def test_closed_lists_have_a_bound(spark):
    df = spark.range(12).selectExpr("12 - id AS x")
    assert [(r.x, r.k) for r in with_small_key(df, ["x"], "k", most=12).orderBy("k").collect()] == [(i, i) for i in range(1, 13)]
    with pytest.raises(Exception, match="more than 11 rows"):
        with_small_key(df, ["x"], "k", most=11).collect()


def test_a_warehouse_is_built_anew_when_its_files_change(spark, tmp_path):
    from shopwright.plans import catalog
    for k in range(4):
        (tmp_path / f"w{k}").mkdir()
        (tmp_path / f"w{k}" / "t.parquet").write_bytes(b"x")
    first = catalog.warehouse(spark, str(tmp_path / "w0"))
    assert catalog.warehouse(spark, str(tmp_path / "w0")) is first
    (tmp_path / "w0" / "t.parquet").write_bytes(b"longer")
    second = catalog.warehouse(spark, str(tmp_path / "w0"))
    assert second is not first
    for k in (1, 2, 3):
        catalog.warehouse(spark, str(tmp_path / f"w{k}"))
    assert len(catalog._WAREHOUSES) == catalog.KEPT and catalog.warehouse(spark, str(tmp_path / "w0")) is not second


def test_inventory_runs_unfold_after_the_last_shuffle(spark):
    # runs and their monthly rows give the same fact; the keys follow month, store, product over many ranges
    from pyspark.sql import Window
    from shopwright.functions.columns import unfold_months
    day = dt.date
    n = 300
    runs = (spark.range(n).selectExpr("id % 100 AS product_id", "concat('S', id div 100) AS store_id", "1 + id % 5 AS first")
            .selectExpr("add_months(DATE'2019-12-01', CAST(first AS INT)) AS snapshot_month", "store_id", "product_id", "CAST(first AS INT) AS opening_stock_qty",
                        "0 AS received_qty", "1 AS sold_qty", "CAST(first AS INT) - 1 AS closing_stock_qty", "2 AS reorder_point",
                        "IF(first = 1, 3, 0) AS stockout_days", "CAST(6 - first AS INT) AS months"))
    monthly = unfold_months(runs)
    assert monthly.count() == sum(6 - (1 + i % 5) for i in range(n))
    quiet = monthly.where("snapshot_month = DATE'2020-05-01' AND sold_qty = 0")
    assert quiet.where("opening_stock_qty <> closing_stock_qty OR received_qty <> 0 OR stockout_days <> 0").count() == 0 < quiet.count()
    dates = spark.createDataFrame([(day(2020, m, 1), 20200001 + 100 * m) for m in range(1, 6)], "full_date date, date_key int")
    stores = spark.createDataFrame([("S0", 1), ("S1", 2), ("S2", 3)], "store_id string, store_key long")
    supply = spark.range(100).selectExpr("id AS product_id", "id + 1 AS product_key", "7L AS supplier_key", "CAST(1.5 AS DECIMAL(14,2)) AS estimated_unit_cost")
    facts = [D.fact_inventory_monthly(inv, dates, stores, None, supply) for inv in (runs, monthly)]
    a, b = [sorted(map(tuple, f.collect())) for f in facts]
    assert a == b and [r[0] for r in a] == list(range(1, len(a) + 1))
    place = F.row_number().over(Window.orderBy("snapshot_date_key", "store_key", "product_key"))
    assert facts[0].withColumn("_n", place).where("_n <> inventory_key").count() == 0


def test_hot_orders_are_numbered_summed_and_counted_apart(spark):
    # usual orders in one shuffle without a row per distinct value, hot ones (7 and NULL) split off with the same results
    from shopwright.functions.keys import split_hot
    from shopwright.sources.bindings import raw_order_payments
    lines = spark.range(12_000).selectExpr(
        "CASE WHEN id < 5000 THEN 7 WHEN id < 8000 THEN NULL ELSE id div 4 END AS l_orderkey", "id % 1300 AS l_partkey", "id % 11 AS l_suppkey",
        "id AS l_linenumber", "CAST(id % 90 AS DOUBLE) AS l_extendedprice", "0.05D AS l_discount", "0.02D AS l_tax",
        "substr('ANR', CAST(1 + id % 3 AS INT), 1) AS l_returnflag", "IF(id % 5 < 2, 'F', 'O') AS l_linestatus")
    usual, hot = split_hot(lines, ["l_orderkey"])
    assert {r[0] for r in hot.select("l_orderkey").distinct().collect()} == {7, None} and usual.count() == 4_000 and hot.count() == 8_000
    assert split_hot(usual, ["l_orderkey"])[1] is None
    items = lines.selectExpr("l_orderkey AS order_id", "l_partkey AS product_id", "l_suppkey AS seller_id",
                             "CAST(l_extendedprice AS DECIMAL(12,2)) AS price", "CAST(1 AS DECIMAL(12,2)) AS freight_value")
    got = sorted(map(tuple, D.item_agg(items).collect()), key=str)
    items.createOrReplaceTempView("hot_items")
    want = spark.sql("SELECT order_id, count(*), count(DISTINCT product_id), count(DISTINCT seller_id), sum(price), sum(freight_value), "
                     "sum(price + freight_value) FROM hot_items GROUP BY order_id").collect()
    assert got == sorted(map(tuple, want), key=str)
    plan = D.item_agg(items.where("order_id <> 7"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    lines.createOrReplaceTempView("hot_lines")
    want = spark.sql("SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_returnflag, l_linestatus), count(*), "
                     "CAST(sum(round(CAST(l_extendedprice * (1 - l_discount) * (1 + l_tax) AS DECIMAL(20,6)), 2)) AS DOUBLE) "
                     "FROM hot_lines GROUP BY l_orderkey, l_returnflag, l_linestatus").collect()
    got = raw_order_payments({"lineitem": lines}).select("order_id", "payment_sequential", "payment_installments", "payment_value").collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    # the numbering itself is spread: a hot group is not one task's window
    from shopwright.functions.keys import with_group_sequence
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = with_group_sequence(lines.select("l_orderkey", "l_linenumber"), ["l_orderkey"], ["l_linenumber"], "n")
        tasks = numbered.where("n > 0").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert max(r["count"] for r in tasks) < 4_000


def test_facts_with_a_store_are_read_by_the_columns_used(spark):
    # the wide facts with a store are not written whole in between; a query's scans take its columns alone
    from shopwright.plans.warehouse import MATERIALIZED
    assert not {"fact_orders_ent", "fact_order_items_ent", "fact_payments_ent", "items_status", "gen_inventory"} & MATERIALIZED


def test_inventory_months_are_distinct_before_they_are_unfolded(spark):
    # the calendar needs the months alone; runs of the same start and length are one before the unfolding
    from shopwright.functions.columns import unfold_months
    runs = spark.range(500).selectExpr("add_months(DATE'2019-11-01', CAST(id % 7 AS INT)) AS snapshot_month", "id AS product_id", "CAST(id % 5 AS INT) AS months")
    got = M.inventory_months(runs)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, unfold_months(runs).select("snapshot_month").distinct().collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Generate"):]


def test_inventory_is_sorted_by_one_number(spark, monkeypatch):
    # months before 1970, stores and products in the order of their ids; without room for one number the columns are compared
    rows = [(dt.date(y, m, 1), f"S{s}", p) for y in (1969, 1970, 2020) for m in (1, 12) for s in (1, 2) for p in range(40)]
    inv = (spark.createDataFrame(rows, "snapshot_month date, store_id string, product_id long").repartition(3)
           .selectExpr("*", *[f"CAST({i} AS INT) AS {c}" for i, c in enumerate(G.INVENTORY_QTY)]))
    dates = inv.select("snapshot_month").distinct().selectExpr("snapshot_month AS full_date", "CAST(date_format(snapshot_month, 'yyyyMMdd') AS INT) AS date_key")
    stores = spark.createDataFrame([("S1", 1), ("S2", 2)], "store_id string, store_key long")
    supply = spark.range(40).selectExpr("id AS product_id", "id + 1 AS product_key", "7L AS supplier_key", "CAST(1.5 AS DECIMAL(14,2)) AS estimated_unit_cost")
    assert D._inventory_place(stores, supply) is not None and D._inventory_place(stores, spark.range(1).selectExpr("1L << 50 AS product_key")) is None
    want = [(i, int(m.strftime("%Y%m%d")), int(s[1]), p + 1) for i, (m, s, p) in enumerate(sorted(rows), 1)]
    for place in (D._inventory_place, lambda *_: None):
        monkeypatch.setattr(D, "_inventory_place", place)
        fact = D.fact_inventory_monthly(inv, dates, stores, None, supply)
        assert sorted(map(tuple, fact.select("inventory_key", "snapshot_date_key", "store_key", "product_key").collect())) == want


def test_inventory_is_numbered_by_its_runs(spark):
    # The months of a run are numbered as a list, neither sorted nor written; odd days, unknown months and strange keys are sorted
    from pyspark.sql import Window
    from shopwright.functions.columns import unfold_months
    from shopwright.functions.keys import with_run_keys
    # runs with gaps, empty ones, products with few and with all months, keys far apart
    runs = spark.range(4_000).selectExpr("add_months(DATE'1969-11-01', CAST(id % 5 * 3 AS INT)) AS m", "CAST(id div 5 % 4 + 1 AS INT) AS s",
                                         "id div 20 * IF(id > 3000, 1000, 1) AS p", "CAST(id % 4 AS INT) AS months", "id AS v")
    days = spark.range(30).selectExpr("add_months(DATE'1969-11-01', CAST(id AS INT)) AS full_date")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        numbered = with_run_keys(runs.repartition(5), "m", "months", "s", "p", "places", days)
        got = numbered.selectExpr("v", "size(places) AS n", "posexplode(places) AS (i, place)").selectExpr("v", "n", "i", "place").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows = runs.where("months > 0").selectExpr("*", "explode(sequence(0, months - 1)) AS i")
    place = F.row_number().over(Window.orderBy(F.expr("add_months(m, i)"), "s", "p"))
    want = rows.select("v", F.col("months").alias("n"), "i", place.alias("place")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == rows.count()
    assert with_run_keys(runs, "m", "months", "s", "p", "places", days.limit(3)) is None
    for c, odd in (("m", "date_add(m, IF(v = 7, 1, 0))"), ("s", "IF(v = 7, NULL, s)"), ("p", "IF(v = 7, -1, p)"), ("p", "1.5 * p")):
        assert with_run_keys(runs.withColumn(c, F.expr(odd)), "m", "months", "s", "p", "places", days) is None
    # the fact: as many rows are written as there are runs, and the values of first and quiet months are those of the rows
    keys = runs.where("months > 0").selectExpr(
        "m AS snapshot_month", "concat('S', s) AS store_id", "p AS product_id", "s AS store_key", "p AS product_key", "v AS supplier_key",
        "CAST(v % 97 / 7 AS DECIMAL(14,2)) AS estimated_unit_cost", "CAST(v % 11 AS INT) AS opening_stock_qty", "CAST(v % 3 AS INT) AS received_qty",
        "CAST(v % 5 AS INT) AS sold_qty", "CAST(v % 11 + v % 3 - v % 5 AS INT) AS closing_stock_qty", "4 AS reorder_point",
        "CAST(v % 4 AS INT) AS stockout_days", "months")
    dates = days.selectExpr("full_date", "CAST(date_format(full_date, 'yyyyMMdd') AS INT) AS date_key")
    fact = D.number_inventory(keys, dates, spark.range(1).selectExpr("4 AS store_key"), spark.range(1).selectExpr("200000L AS product_key"))
    assert sorted(map(tuple, fact.drop("inventory_key").collect())) == sorted(map(tuple, D.inventory_rows(keys, dates).collect()))
    files = [f for f in fact.inputFiles() if "inventory_key-" in f]
    assert files and spark.read.parquet(*files).count() == keys.count() < unfold_months(keys).count() == fact.count()


def test_missing_keys_are_counted_before_the_facts_are_numbered(spark):
    # the check sorts and unfolds nothing; a span with a NULL key counts its months, a fact's rows are those before its key
    from shopwright.plans import catalog
    from shopwright.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    q38 = catalog.REGISTRY["q38_missing_dimension_keys"]
    got = {r.check_name: r.issue_count for r in q38.build(w).collect()}
    assert not {"fact_orders", "fact_order_items", "fact_payments", "fact_reviews", "fact_inventory_monthly", "inventory_rows"} & set(w._memo)
    assert got == {r.check_name: r.issue_count for r in Q.missing_keys([(n, w[t], c) for n, t, c in catalog._MISSING]).collect()}
    for t, rows in catalog._UNNUMBERED.items():
        total = w[rows].agg(F.sum("months") if rows == "inventory_spans" else F.count(F.lit(1))).first()[0]
        assert total == w[t].count() > 0
    key = F.expr("IF(product_key % 3 = 0, NULL, supplier_key)")
    a, b = [Q.missing_keys([("x", w[t].withColumn("supplier_key", key), "supplier_key")]).first().issue_count for t in ("inventory_spans", "fact_inventory_monthly")]
    assert a == b > 0 == Q.missing_keys([("x", w["inventory_spans"].where("false"), "supplier_key")]).first().issue_count


def test_inventory_queries_read_rows_without_the_dense_key(spark):
    # The KPIs and checks of the inventory neither sort nor write the unfolded months, nor wait for payments or marketing spend
    from shopwright.plans import catalog
    from shopwright.plans.warehouse import Warehouse
    w = Warehouse(spark, "/root/testdata/sf0.001")
    for name in ("k21_inventory_by_store", "k11_inventory_kpis", "k24_stockout_products", "k28_supplier_stockouts", "q43_inventory_accounting"):
        catalog.REGISTRY[name].build(w).collect()
    assert not {"fact_inventory_monthly", "fact_orders", "stg_order_payments", "gen_marketing"} & set(w._memo)
    fact = w["fact_inventory_monthly"]
    assert fact.columns == ["inventory_key", *w["inventory_rows"].columns]
    assert sorted(map(tuple, fact.drop("inventory_key").collect())) == sorted(map(tuple, w["inventory_rows"].collect()))
    months = w["stg_marketing"].select("month").distinct().collect()
    assert {r[0] for r in months} <= {r[0] for r in w["enterprise_dates"].collect()}
    orders = M.delivered_geo_orders(w["fact_orders"], w["dim_customer"], w["dim_order_status"])
    same = [c for c in w["orders_geo"].columns if c in orders.columns]
    assert {"order_id", "order_status", "gross_order_value", "customer_state"} <= set(same)
    assert sorted(map(str, orders.select(*same).collect())) == sorted(map(str, w["orders_geo"].select(*same).collect()))
    plan = catalog.REGISTRY["k28_supplier_stockouts"].build(w)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Join"):plan.index("Generate")]  # summed per supplier above the unfolding, below the join


def test_quiet_months_are_added_up_unfolded_nowhere(spark):
    # KPIs and checks over spans (a row for a movement, one for the quiet months after it) equal those over monthly rows
    from shopwright.operators import checks as Q
    from shopwright.operators import kpis as K
    from shopwright.plans.warehouse import Warehouse
    keys = (spark.range(240).selectExpr("id % 40 AS p", "CAST(id div 40 % 2 AS INT) AS s", "id div 80 AS k")
            .selectExpr("add_months(DATE'2019-11-01', CAST(5 * k + p % 3 AS INT)) AS snapshot_month", "concat('S', s) AS store_id", "p AS product_id",
                        "s + 1L AS store_key", "p + 1 AS product_key", "1 + p % 4 AS supplier_key", "CAST(1.37 + p AS DECIMAL(14,2)) AS estimated_unit_cost",
                        "CAST(p % 5 AS INT) AS opening_stock_qty", "1 AS received_qty", "CAST(IF((p div 3 + k) % 3 = 0, 0, 2) AS INT) AS sold_qty",
                        "CAST((p + k) % 4 AS INT) AS closing_stock_qty", "2 AS reorder_point", "CAST(IF((p + k) % 4 = 0, 9, 0) AS INT) AS stockout_days",
                        "CAST(IF(k < 2, 5, 1 + p % 3) AS INT) AS months").where("months > 0"))
    days = [dt.date(2019 + (m - 1) // 12, (m - 1) % 12 + 1, 1) for m in range(1, 37)]
    dates = spark.createDataFrame([(d, int(d.strftime("%Y%m%d"))) for d in days], "full_date date, date_key int")
    stores = spark.createDataFrame([(1, "S0", "a", "x"), (2, "S1", "b", "y")], "store_key long, store_id string, store_name string, store_format string")
    products = spark.range(40).selectExpr("id + 1 AS product_key", "id AS product_id", "'c' AS product_category_name")
    suppliers = spark.range(1, 5).selectExpr("id AS supplier_key", *[f"concat('{c}', id) AS {c}" for c in K.SUPPLIER_ATTRS])
    rows, spans = D.inventory_rows(keys, dates), D.inventory_spans(keys, dates)
    assert spans.count() <= 2 * keys.count() < rows.count() == spans.agg(F.sum("months")).first()[0]

    def results(fim):
        return [sorted(map(str, df.collect())) for df in (
            K.inventory_kpis(fim, dates), K.inventory_by_store(fim, stores), K.stockout_by_store(fim, stores), K.high_value_products(fim, products),
            K.stockout_products(fim, products), K.slow_movers(fim, dates, stores, products), K.slow_movers(fim, dates, stores, products, months=2),
            K.supplier_stockouts(fim, suppliers), K.current_inventory(fim).select("snapshot_date_key", "store_key", "product_key", "closing_stock_qty"),
            Q.inventory_accounting(fim))]
    got = results(spans)
    assert got == results(rows) and all(got)
    assert results(spans.where("false"))[-1] == results(rows.where("false"))[-1]  # no rows: counts are zero
    # the warehouse's inventory waits neither for numbered items nor for unfolded months
    w = Warehouse(spark, "/root/testdata/sf0.001")
    assert w["inventory_spans"].count() < w["inventory_rows"].count() == w["inventory_spans"].agg(F.sum("months")).first()[0]
    margins = w["item_margins"]
    assert "fact_order_items" not in w._memo
    cols = ["order_id", "supplier_key", "order_status_key", "price", "estimated_gross_margin"]
    assert sorted(map(str, margins.select(*cols).collect())) == sorted(map(str, w["fact_order_items_ent"].select(*cols).collect()))
    items = w["fact_order_items"].select("order_id", "product_id", "price", "shipping_limit_date", "order_status_key").join(
        w["dim_order_status"].select("order_status_key", "order_status"), "order_status_key").drop("order_status_key")
    same = ["order_id", "product_id", "price", "shipping_limit_date", "order_status"]
    assert sorted(map(str, items.select(*same).collect())) == sorted(map(str, w["items_status"].select(*same).collect()))
