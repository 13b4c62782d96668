"""Quality checks (Q-00..Q-46): severity-ranked issue counts, drill-downs,
reconciliations and model checks.

Checks are data: ``Check(severity, name, table, predicate)``.  The runner
groups predicate checks by table and evaluates all of a table's checks in a
single aggregate (one scan, many ``count_if``), instead of one scan per
check; anti-join checks are small separate aggregates.  Results are unioned
and ordered ERROR, WARNING, INFO, then name.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import pct, ratio, round_half_up  # noqa: F401
from ..functions.measures import month_rows

SEVERITY_RANK = {"ERROR": 1, "WARNING": 2, "INFO": 3}  # fixed values


@dataclass(frozen=True)
class Check:
    severity: str
    name: str
    table: str
    predicate: Callable[[], Column] | None = None
    count: Callable[[dict[str, DataFrame]], DataFrame] | None = None  # -> one row, column issue_count


def run_checks(checks: list[Check], tables: dict[str, DataFrame]) -> DataFrame:
    """Q-00: evaluate checks and return (severity, check_name, issue_count)."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.predicate is not None:
            by_table.setdefault(c.table, []).append(c)
    for table, cs in by_table.items():
        row = tables[table].agg(*[F.count_if(c.predicate()).cast("long").alias(f"_c{i}") for i, c in enumerate(cs)])
        items = [F.struct(F.lit(c.severity).alias("severity"), F.lit(c.name).alias("check_name"),
                          F.col(f"_c{i}").alias("issue_count")) for i, c in enumerate(cs)]
        parts.append(row.select(F.explode(F.array(*items)).alias("x")).select("x.*"))
    for c in checks:
        if c.count is not None:
            parts.append(c.count(tables).select(F.lit(c.severity).alias("severity"), F.lit(c.name).alias("check_name"),
                                                F.col("issue_count").cast("long").alias("issue_count")))
    out = reduce(DataFrame.unionByName, parts)
    rank = F.lit(4)
    for sev, r in sorted(SEVERITY_RANK.items(), key=lambda kv: -kv[1]):
        rank = F.when(F.col("severity") == sev, F.lit(r)).otherwise(rank)
    return out.orderBy(rank, "check_name")


def _anti_count(left: str, right: str, lkey: str, rkey: str, where: Callable[[], Column] | None = None):
    def count(t: dict[str, DataFrame]) -> DataFrame:
        lhs = t[left] if where is None else t[left].filter(where())
        # rows per key first (a hot key collapses map-side), then the anti
        # join on distinct keys; a NULL key never matches, as in NOT EXISTS
        per = lhs.groupBy(F.col(lkey).alias("_l")).agg(F.count(F.lit(1)).alias("_n"))
        rhs = t[right].select(F.col(rkey).alias("_k"))
        return (per.join(rhs, per["_l"] == rhs["_k"], "left_anti")
                .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("issue_count")))
    return count


def order_totals(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Per-order item and payment totals, inner joined (both pre-aggregated,
    so neither side fans out)."""
    it = items.groupBy("order_id").agg(F.sum("price").alias("merchandise_total"),
                                       F.sum("freight_value").alias("freight_total"),
                                       F.sum(F.col("price") + F.col("freight_value")).alias("item_total"))
    pt = payments.groupBy("order_id").agg(
        F.sum("payment_value").alias("payment_total"), F.count(F.lit(1)).alias("payment_records"),
        F.countDistinct("payment_type").alias("payment_type_count"),
        F.array_join(F.array_sort(F.collect_set("payment_type")), ", ").alias("payment_types"))
    return (it.join(pt, "order_id")
            .withColumn("signed_difference", F.col("payment_total") - F.col("item_total"))
            .withColumn("absolute_difference", F.abs(F.col("signed_difference"))))


def _recon_count(t: dict[str, DataFrame]) -> DataFrame:
    r = order_totals(t["order_items"], t["order_payments"])
    return r.agg(F.count_if(F.col("absolute_difference") > 0.01).alias("issue_count"))


def _c(name: str) -> Column:
    return F.col(name)


CORE_CHECKS = [
    Check("ERROR", "approval_before_purchase", "orders",
          lambda: _c("order_approved_at") < _c("order_purchase_timestamp")),
    Check("ERROR", "carrier_delivery_before_purchase", "orders",
          lambda: _c("order_delivered_carrier_date") < _c("order_purchase_timestamp")),
    Check("ERROR", "customer_delivery_before_purchase", "orders",
          lambda: _c("order_delivered_customer_date") < _c("order_purchase_timestamp")),
    Check("ERROR", "customer_delivery_before_carrier", "orders",
          lambda: _c("order_delivered_customer_date").isNotNull() & _c("order_delivered_carrier_date").isNotNull()
          & (_c("order_delivered_customer_date") < _c("order_delivered_carrier_date"))),
    Check("WARNING", "delivered_orders_missing_customer_delivery_date", "orders",
          lambda: (_c("order_status") == "delivered") & _c("order_delivered_customer_date").isNull()),
    Check("ERROR", "negative_item_price", "order_items", lambda: _c("price") < 0),
    Check("ERROR", "negative_freight_value", "order_items", lambda: _c("freight_value") < 0),
    Check("ERROR", "negative_payment_value", "order_payments", lambda: _c("payment_value") < 0),
    Check("WARNING", "nonpositive_payment_installments", "order_payments", lambda: _c("payment_installments") <= 0),
    Check("ERROR", "invalid_customer_state", "customers",
          lambda: _c("customer_state").isNull() | ~_c("customer_state").rlike("^[A-Z]{2}$")),
    Check("ERROR", "invalid_customer_zip_prefix", "customers",
          lambda: _c("customer_zip_code_prefix").isNull() | ~_c("customer_zip_code_prefix").rlike("^[0-9]{5}$")),
    Check("ERROR", "missing_customer_unique_id", "customers",
          lambda: _c("customer_unique_id").isNull() | (F.trim(_c("customer_unique_id").cast("string")) == "")),
    Check("WARNING", "missing_product_category", "products", lambda: _c("product_category_name").isNull()),
    Check("WARNING", "nonpositive_product_measurements", "products",
          lambda: (_c("product_weight_g") <= 0) | (_c("product_length_cm") <= 0) | (_c("product_height_cm") <= 0)
          | (_c("product_width_cm") <= 0)),
    Check("WARNING", "orders_without_items", "orders", count=_anti_count("orders", "order_items", "order_id", "order_id")),
    Check("WARNING", "orders_without_payments", "orders",
          count=_anti_count("orders", "order_payments", "order_id", "order_id")),
    Check("WARNING", "order_payment_reconciliation_difference_gt_001", "orders", count=_recon_count),
]


def _deal_before_contact(t: dict[str, DataFrame]) -> DataFrame:
    j = t["closed_deals"].join(t["leads"].select("mql_id", "first_contact_date"), "mql_id")
    return j.agg(F.count_if(F.col("won_date").cast("date") < F.col("first_contact_date")).alias("issue_count"))


EXTENDED_CHECKS = [
    Check("ERROR", "invalid_seller_state", "sellers",
          lambda: _c("seller_state").isNull() | ~_c("seller_state").rlike("^[A-Z]{2}$")),
    Check("ERROR", "invalid_seller_zip_prefix", "sellers",
          lambda: _c("seller_zip_code_prefix").isNull() | ~_c("seller_zip_code_prefix").rlike("^[0-9]{5}$")),
    Check("ERROR", "review_score_outside_1_to_5", "order_reviews", lambda: ~_c("review_score").between(1, 5)),
    Check("ERROR", "review_answer_before_creation", "order_reviews",
          lambda: _c("review_answer_timestamp") < _c("review_creation_date")),
    Check("ERROR", "invalid_geolocation_latitude", "geolocation", lambda: ~_c("latitude").between(-90, 90)),
    Check("ERROR", "invalid_geolocation_longitude", "geolocation", lambda: ~_c("longitude").between(-180, 180)),
    Check("WARNING", "zip_prefix_multiple_states", "geolocation", lambda: _c("distinct_state_count") > 1),
    Check("INFO", "zip_prefix_multiple_city_labels", "geolocation", lambda: _c("distinct_city_count") > 1),
    Check("WARNING", "customer_zip_not_found_in_geolocation", "customers",
          count=_anti_count("customers", "geolocation", "customer_zip_code_prefix", "zip_code_prefix")),
    Check("WARNING", "seller_zip_not_found_in_geolocation", "sellers",
          count=_anti_count("sellers", "geolocation", "seller_zip_code_prefix", "zip_code_prefix")),
    Check("WARNING", "missing_category_translation", "products",
          count=_anti_count("products", "category_translation", "product_category_name", "product_category_name",
                            lambda: F.col("product_category_name").isNotNull())),
    Check("ERROR", "closed_deal_before_first_contact", "closed_deals", count=_deal_before_contact),
    Check("WARNING", "negative_declared_monthly_revenue", "closed_deals", lambda: _c("declared_monthly_revenue") < 0),
    Check("WARNING", "negative_declared_catalog_size", "closed_deals", lambda: _c("declared_product_catalog_size") < 0),
    Check("INFO", "closed_deal_seller_not_in_ecommerce", "closed_deals", lambda: ~_c("ecommerce_seller_match")),
]


# ------------------------------------------------------------------ drill-downs Q-21..Q-35

def drill_carrier_before_purchase(orders: DataFrame, n: int = 20) -> DataFrame:
    """Q-21: carrier date before purchase, largest gaps first (seconds)."""
    gap = F.timestamp_diff("MICROSECOND", _c("order_delivered_carrier_date"), _c("order_purchase_timestamp"))
    return (orders.filter(_c("order_delivered_carrier_date") < _c("order_purchase_timestamp"))
            .select("order_id", "order_status", "order_purchase_timestamp", "order_delivered_carrier_date",
                    (gap.cast("double") / 1e6).alias("carrier_before_purchase_seconds"))
            .orderBy(F.desc("carrier_before_purchase_seconds"), "order_id").limit(n))


def drill_delivery_before_carrier(orders: DataFrame) -> DataFrame:
    """Q-22: all deliveries before the carrier date, by gap."""
    gap = F.timestamp_diff("MICROSECOND", _c("order_delivered_customer_date"), _c("order_delivered_carrier_date"))
    return (orders.filter(_c("order_delivered_customer_date").isNotNull() & _c("order_delivered_carrier_date").isNotNull()
                          & (_c("order_delivered_customer_date") < _c("order_delivered_carrier_date")))
            .select("order_id", "order_status", "order_delivered_carrier_date", "order_delivered_customer_date",
                    (gap.cast("double") / 1e6).alias("delivery_before_carrier_seconds"))
            .orderBy(F.desc("delivery_before_carrier_seconds"), "order_id"))


def drill_missing_delivery(orders: DataFrame) -> DataFrame:
    """Q-23."""
    return (orders.filter((_c("order_status") == "delivered") & _c("order_delivered_customer_date").isNull())
            .orderBy("order_purchase_timestamp", "order_id"))


def drill_invalid_installments(payments: DataFrame) -> DataFrame:
    """Q-24a."""
    return payments.filter(_c("payment_installments") <= 0)


def drill_invalid_measures(products: DataFrame) -> DataFrame:
    """Q-24b."""
    return products.filter((_c("product_weight_g") <= 0) | (_c("product_length_cm") <= 0)
                           | (_c("product_height_cm") <= 0) | (_c("product_width_cm") <= 0))


def drill_orders_without_items(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Q-25: orders without items whose status should have some."""
    return (orders.join(items.select("order_id"), "order_id", "left_anti")
            .filter(~_c("order_status").isin("canceled", "unavailable", "created"))
            .orderBy("order_status", "order_purchase_timestamp", "order_id"))


def drill_orders_without_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Q-26."""
    return orders.join(payments.select("order_id"), "order_id", "left_anti")


def reconciliation_summary(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Q-27: one row."""
    r = order_totals(items, payments)
    a, s = _c("absolute_difference"), _c("signed_difference")
    return r.agg(F.count(F.lit(1)).alias("reconciled_orders"),
                 *[F.count_if(a > t).cast("long").alias(f"difference_gt_{n}")
                   for t, n in [(0.01, "001"), (1, "1"), (10, "10"), (100, "100")]],
                 F.count_if(s > 0.01).cast("long").alias("payment_greater_than_items"),
                 F.count_if(s < -0.01).cast("long").alias("payment_less_than_items"),
                 F.round(F.max(a), 2).cast("double").alias("maximum_absolute_difference"),
                 ratio(F.sum(a), F.count(a), 4).alias("average_absolute_difference"))


def largest_differences(items: DataFrame, payments: DataFrame, orders: DataFrame, n: int = 30) -> DataFrame:
    """Q-28: top-n orders by absolute difference."""
    r = order_totals(items, payments).filter(_c("absolute_difference") > 0.01)
    return (r.join(orders.select("order_id", "order_status"), "order_id")
            .select("order_id", "order_status", "merchandise_total", "freight_total", "item_total", "payment_total",
                    F.round("signed_difference", 2).alias("signed_difference"), "absolute_difference")
            .orderBy(F.desc("absolute_difference"), "order_id").limit(n).drop("absolute_difference"))


def item_completeness(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Q-29: per status, orders with and without items (existence join
    against the distinct order ids of the items)."""
    ids = items.select(F.col("order_id").alias("_oid")).distinct().withColumn("_has", F.lit(True))
    j = orders.join(ids, orders.order_id == ids._oid, "left")
    return (j.groupBy("order_status")
            .agg(F.count(F.lit(1)).alias("total_orders"), F.count_if(_c("_has").isNotNull()).cast("long").alias("with_items"),
                 F.count_if(_c("_has").isNull()).cast("long").alias("without_items"))
            .orderBy(F.desc("total_orders"), "order_status"))


def mismatch_scenarios(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Q-30: mismatches by voucher / multiple records / single payment."""
    m = order_totals(items, payments).filter(_c("absolute_difference") > 0.01)
    scen = (F.when(_c("payment_types").like("%voucher%"), "contains voucher")
            .when(_c("payment_records") > 1, "multiple payment records").otherwise("single non-voucher payment"))
    a = _c("absolute_difference")
    return (m.groupBy(scen.alias("payment_scenario"))
            .agg(F.count(F.lit(1)).alias("orders"), ratio(F.sum(a), F.count(a)).alias("avg_abs_difference"),
                 F.round(F.max(a), 2).cast("double").alias("max_abs_difference"))
            .orderBy(F.desc("orders"), "payment_scenario"))


def mismatch_by_types(items: DataFrame, payments: DataFrame) -> DataFrame:
    """Q-31."""
    m = order_totals(items, payments).filter(_c("absolute_difference") > 0.01)
    a = _c("absolute_difference")
    return (m.groupBy("payment_types")
            .agg(F.count(F.lit(1)).alias("mismatched_orders"), ratio(F.sum(a), F.count(a)).alias("avg_abs_difference"),
                 F.round(F.max(a), 2).cast("double").alias("max_abs_difference"))
            .orderBy(F.desc("mismatched_orders"), "payment_types"))


def mismatched_payments(items: DataFrame, payments: DataFrame, orders: DataFrame, n: int = 50) -> DataFrame:
    """Q-32: top-n mismatched orders with their payment records."""
    m = order_totals(items, payments).filter(_c("absolute_difference") > 0.01)
    return (m.join(orders.select("order_id", "order_status"), "order_id")
            .select("order_id", "order_status", "payment_records", "payment_types", "item_total", "payment_total",
                    F.round("signed_difference", 2).alias("signed_difference"), "absolute_difference")
            .orderBy(F.desc("absolute_difference"), "order_id").limit(n).drop("absolute_difference"))


def drill_deals_before_contact(leads: DataFrame, deals: DataFrame) -> DataFrame:
    """Q-33."""
    j = leads.join(deals, "mql_id")
    return (j.filter(_c("won_date").cast("date") < _c("first_contact_date"))
            .select("mql_id", "first_contact_date", "won_date", "seller_id", "business_segment", "lead_type",
                    "business_type", "ecommerce_seller_match"))


def untranslated_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Q-34."""
    p = products.filter(_c("product_category_name").isNotNull())
    return (p.join(translation.select("product_category_name"), "product_category_name", "left_anti")
            .groupBy("product_category_name").agg(F.count(F.lit(1)).alias("products"))
            .orderBy(F.desc("products"), "product_category_name"))


def geo_coverage(entities: DataFrame, zip_col: str, geo: DataFrame, label: str) -> DataFrame:
    """Q-35: how many customers (or sellers) find their ZIP in geolocation."""
    g = geo.select(F.col("zip_code_prefix").alias("_z"), F.lit(True).alias("_m"))
    j = entities.join(g, entities[zip_col] == g._z, "left")
    miss = _c("_m").isNull()
    return j.agg(F.count(F.lit(1)).alias(label), F.count_if(~miss).cast("long").alias("matched"),
                 F.count_if(miss).cast("long").alias("unmatched"),
                 pct(F.count_if(miss), F.count(F.lit(1)), 4).alias("unmatched_pct"))


__all__ = ["CORE_CHECKS", "EXTENDED_CHECKS", "Check", "run_checks", "round_half_up"]


# ------------------------------------------------------------------ model checks Q-36..Q-46

def row_counts(tables: dict[str, DataFrame], label: str = "table_name") -> DataFrame:
    """Q-36 / Q-42: row count per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias(label), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts).orderBy(label)


def duplicate_groups(specs: list[tuple[str, DataFrame, list[str]]]) -> DataFrame:
    """Q-37: business-key groups with more than one row, per fact."""
    parts = [df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
             .agg(F.count(F.lit(1)).alias("duplicate_groups")).select(F.lit(n).alias("check_name"), "duplicate_groups")
             for n, df, cols in specs]
    return reduce(DataFrame.unionByName, parts)


def missing_keys(specs: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Q-38: NULL dimension keys; one aggregate per table for all its keys.  Spans of inventory (D-17) count the months that they stand for."""
    by_df: dict[int, tuple[DataFrame, list[tuple[str, str]]]] = {}
    for name, df, col in specs:
        by_df.setdefault(id(df), (df, []))[1].append((name, col))
    parts = []
    for df, cols in by_df.values():
        row = df.agg(*[month_rows(df, F.col(c).isNull()).alias(f"_m{i}") for i, (_, c) in enumerate(cols)])
        items = [F.struct(F.lit(n).alias("check_name"), F.col(f"_m{i}").alias("issue_count"))
                 for i, (n, _) in enumerate(cols)]
        parts.append(row.select(F.explode(F.array(*items)).alias("x")).select("x.*"))
    return reduce(DataFrame.unionByName, parts)


def order_quality_flags(fo: DataFrame) -> DataFrame:
    """Q-39: the eight flag counts of fact_orders, one row."""
    c = F.col
    return fo.agg(F.count(F.lit(1)).alias("orders"),
                  F.count_if(~c("has_items")).cast("long").alias("orders_without_items"),
                  F.count_if(~c("has_payment")).cast("long").alias("orders_without_payment"),
                  F.count_if(c("has_payment_reconciliation_issue")).cast("long").alias("payment_reconciliation_issues"),
                  F.count_if(c("has_carrier_before_purchase_anomaly")).cast("long").alias("carrier_before_purchase"),
                  F.count_if(c("has_delivery_before_carrier_anomaly")).cast("long").alias("delivery_before_carrier"),
                  F.count_if(c("has_missing_delivery_timestamp")).cast("long").alias("delivered_missing_timestamp"),
                  F.count_if(c("is_late_delivery")).cast("long").alias("late_deliveries"))


def compare_totals(pairs: list[tuple[str, DataFrame, str]], money: bool = True) -> DataFrame:
    """Q-40 / Q-44: named totals from several tables side by side, one row
    (one-row aggregates cross joined: each side is a single scan)."""
    out = None
    for name, df, col in pairs:
        s = F.sum(col)
        one = df.agg((F.round(s, 2).cast("double") if money else s.cast("long")).alias(name))
        out = one if out is None else out.crossJoin(one)
    return out


def population_decomposition(fo: DataFrame) -> DataFrame:
    """Q-41: items x payment presence, and paid value without items."""
    i, p = F.col("has_items"), F.col("has_payment")
    return fo.agg(F.count_if(i & p).cast("long").alias("orders_with_items_and_payment"),
                  F.count_if(~i & p).cast("long").alias("paid_orders_without_items"),
                  F.count_if(i & ~p).cast("long").alias("item_orders_without_payment"),
                  F.count_if(~i & ~p).cast("long").alias("orders_without_items_or_payment"),
                  F.round(F.sum(F.when(~i & p, F.col("payment_value"))), 2).cast("double")
                  .alias("payment_value_without_items"))


def inventory_accounting(fim: DataFrame) -> DataFrame:
    """Q-43: balance errors, negative closing stock, stockout rows and rate."""
    c = F.col
    bal = c("opening_stock_qty") + c("received_qty") - c("sold_qty") != c("closing_stock_qty")
    return fim.agg(month_rows(fim).alias("inventory_rows"), month_rows(fim, bal).alias("balance_errors"),
                   month_rows(fim, c("closing_stock_qty") < 0).alias("negative_closing_stock"),
                   month_rows(fim, c("had_stockout")).alias("stockout_rows"),
                   pct(month_rows(fim, c("had_stockout")), month_rows(fim)).alias("stockout_row_rate_pct"))


def profitability_coverage(foi: DataFrame) -> DataFrame:
    """Q-45: missing cost, COGS, margin, margin %, and totals."""
    c = F.col
    return foi.agg(F.count(F.lit(1)).alias("item_rows"),
                   *[F.count_if(c(x).isNull()).cast("long").alias(n) for x, n in
                     [("estimated_unit_cost", "missing_cost"), ("estimated_cogs", "missing_cogs"),
                      ("estimated_gross_margin", "missing_margin"), ("estimated_gross_margin_pct", "missing_margin_pct")]],
                   F.round(F.sum("estimated_cogs"), 2).cast("double").alias("estimated_cogs"),
                   F.round(F.sum("estimated_gross_margin"), 2).cast("double").alias("estimated_gross_margin"))


def calendar_continuity(dim_date: DataFrame) -> DataFrame:
    """Q-46: first and last day, rows, and days missing in between."""
    return dim_date.agg(F.min("full_date").alias("min_date"), F.max("full_date").alias("max_date"),
                        F.count(F.lit(1)).alias("calendar_rows"),
                        (F.datediff(F.max("full_date"), F.min("full_date")) + 1
                         - F.countDistinct("full_date")).cast("long").alias("missing_days"))
