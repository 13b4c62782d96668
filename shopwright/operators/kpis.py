"""KPIs and analyses (K-01..K-41).

Patterns used throughout:
* facts are filtered to 'delivered' by a join to the (broadcast, closed
  domain) status dimension, so the filter prunes before any shuffle;
* shares of a grand total use a one-row aggregate of the grouped result,
  broadcast and cross joined (never an unpartitioned ``OVER ()`` window);
  the grouped subtree is shared, so Spark reuses its exchange;
* top-k reports are ``orderBy(...).limit(n)`` with the business key as the
  last sort key (a distributed TakeOrderedAndProject).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import pct, ratio
from ..functions.measures import MEASURES, count_if, mean, money_sum, month_rows


def delivered(fact: DataFrame, status: DataFrame, value: str = "delivered") -> DataFrame:
    """``delivered(x)``: inner join to the status dimension, status filter."""
    st = F.broadcast(status.filter(F.col("order_status") == value).select("order_status_key"))
    return fact.join(st, "order_status_key", "left_semi")


def with_share(grouped: DataFrame, value: str, name: str, scale: int = 2) -> DataFrame:
    """``round(100 * v / sum(v) over (), scale)`` via a broadcast one-row total."""
    total = grouped.agg(F.sum(value).alias("_total"))
    return (grouped.crossJoin(F.broadcast(total))
            .withColumn(name, pct(F.col(value), F.col("_total"), scale)).drop("_total"))


# ----------------------------------------------------------------- K-01..K-07

def executive_kpis(fo: DataFrame, status: DataFrame) -> DataFrame:
    """K-01: delivered orders and commercial totals, one row."""
    names = ["delivered_orders", "merchandise_value", "freight_value", "gross_order_value",
             "average_order_value", "average_items_per_order", "freight_pct"]
    return delivered(fo, status).agg(*[MEASURES[n]() for n in names])


def customer_kpis(fo: DataFrame, customers: DataFrame, status: DataFrame) -> DataFrame:
    """K-02: persons with delivered orders, repeat persons (>= 2), rate, max."""
    per = (delivered(fo, status).join(customers.select("customer_key", "customer_unique_id"), "customer_key")
           .groupBy("customer_unique_id").agg(F.countDistinct("order_id").alias("n")))
    return per.agg(F.count(F.lit(1)).alias("unique_customers"),
                   count_if(F.col("n") >= 2).alias("repeat_customers"),
                   pct(F.count_if(F.col("n") >= 2), F.count(F.lit(1))).alias("repeat_customer_rate_pct"),
                   F.max("n").alias("max_delivered_orders_one_customer"))


def delivery_kpis(fo: DataFrame, status: DataFrame) -> DataFrame:
    """K-03: eligible = delivered with a valid timeline and both dates."""
    e = delivered(fo, status).filter(
        F.col("has_valid_delivery_timeline") & F.col("order_delivered_customer_date").isNotNull()
        & F.col("order_estimated_delivery_date").isNotNull())
    late = F.col("is_late_delivery")
    return e.agg(F.count(F.lit(1)).alias("delivery_eligible_orders"),
                 count_if(late).alias("late_deliveries"),
                 count_if(~late).alias("on_time_deliveries"),
                 pct(F.count_if(late), F.count(F.lit(1))).alias("late_delivery_rate_pct"),
                 pct(F.count_if(~late), F.count(F.lit(1))).alias("on_time_delivery_rate_pct"),
                 mean("delivery_days").alias("average_delivery_days"))


def review_kpis(fr: DataFrame, status: DataFrame) -> DataFrame:
    """K-04."""
    r = delivered(fr, status)
    s = F.col("review_score")
    return r.agg(F.count(F.lit(1)).alias("delivered_review_records"),
                 mean(s).alias("average_review_score"),
                 pct(F.count_if(s >= 4), F.count(F.lit(1))).alias("positive_review_rate_pct"),
                 pct(F.count_if(s <= 2), F.count(F.lit(1))).alias("negative_review_rate_pct"))


def status_mix(fo: DataFrame, status: DataFrame) -> DataFrame:
    """K-05: orders by status with share."""
    g = (fo.groupBy("order_status_key").agg(F.count(F.lit(1)).alias("orders"))
         .join(F.broadcast(status), "order_status_key")
         .select("order_status", "order_status_group", "orders"))
    return with_share(g, "orders", "order_share_pct").orderBy(F.desc("orders"), "order_status")


def payment_mix(fp: DataFrame, status: DataFrame) -> DataFrame:
    """K-06: delivered payment value by type with share."""
    g = (delivered(fp, status).groupBy("payment_type")
         .agg(F.count(F.lit(1)).alias("payment_records"), F.sum("payment_value").alias("_v")))
    out = with_share(g, "_v", "payment_value_share_pct")
    return (out.select("payment_type", "payment_records",
                       F.round("_v", 2).cast("double").alias("payment_value"), "payment_value_share_pct")
            .orderBy(F.desc("payment_value"), "payment_type"))


def top_categories(foi: DataFrame, products: DataFrame, status: DataFrame, n: int = 15) -> DataFrame:
    """K-07: top categories by delivered merchandise value."""
    g = (delivered(foi, status)
         .join(products.select("product_key", "product_category_name"), "product_key")
         .groupBy("product_category_name")
         .agg(F.count(F.lit(1)).alias("item_rows"), F.countDistinct("order_id").alias("orders"),
              money_sum("price").alias("merchandise_value"), money_sum("freight_value").alias("freight_value")))
    return g.orderBy(F.desc("merchandise_value"), "product_category_name").limit(n)


# ----------------------------------------------------------------- K-29..K-41 (no enterprise data)

def customers_by_state(fo: DataFrame, customers: DataFrame, status: DataFrame, n: int = 20) -> DataFrame:
    """K-29: two-level aggregation, person within state, then state."""
    per = (delivered(fo, status).join(customers.select("customer_key", "customer_state", "customer_unique_id"),
                                      "customer_key")
           .groupBy("customer_state", "customer_unique_id")
           .agg(F.count(F.lit(1)).alias("d"), F.sum("gross_order_value").alias("g")))
    out = per.groupBy("customer_state").agg(
        F.countDistinct("customer_unique_id").alias("unique_customers"),
        F.sum("d").alias("delivered_orders"),
        count_if(F.col("d") >= 2).alias("repeat_customers"),
        pct(F.count_if(F.col("d") >= 2), F.count(F.lit(1))).alias("repeat_customer_rate_pct"),
        F.round(F.sum("g"), 2).cast("double").alias("gross_order_value"),
        ratio(F.sum("g"), F.sum("d")).alias("average_order_value"))
    return out.orderBy(F.desc_nulls_first("gross_order_value"), "customer_state").limit(n)


def repeat_within(fo: DataFrame, customers: DataFrame, status: DataFrame, days: int = 90) -> DataFrame:
    """K-30: censoring-adjusted repeat rate.

    The first two delivered orders per person are kept by a group limit that
    also runs before the shuffle, so a task sends at most two rows per person
    and a hot person costs no more than any other; nothing is joined back.
    """
    d = (delivered(fo, status).join(customers.select("customer_key", "customer_unique_id"), "customer_key")
         .select("customer_unique_id", "order_purchase_timestamp", "order_id"))
    place = F.row_number().over(Window.partitionBy("customer_unique_id").orderBy("order_purchase_timestamp", "order_id"))
    two = d.withColumn("_place", place).where(F.col("_place") <= 2)
    at = lambda k: F.min(F.when(F.col("_place") == k, F.col("order_purchase_timestamp")))
    per = two.groupBy("customer_unique_id").agg(at(1).alias("t1"), at(2).alias("t2"))
    last = d.agg(F.max("order_purchase_timestamp").alias("last_ts"))
    interval = F.expr(f"interval {int(days)} days")
    e = (per.crossJoin(F.broadcast(last)).filter(F.col("t1") <= F.col("last_ts") - interval)
         .withColumn("rep", F.when(F.col("t2") <= F.col("t1") + interval, 1).otherwise(0)))
    return e.agg(F.count(F.lit(1)).alias("eligible_customers"),
                 F.sum("rep").cast("long").alias(f"customers_repeated_within_{days}_days"),
                 pct(F.sum("rep"), F.count(F.lit(1))).alias(f"repeat_within_{days}_days_pct"))


def new_vs_returning(fo: DataFrame, customers: DataFrame, status: DataFrame) -> DataFrame:
    """K-31: active persons per month split into new and returning.

    First month per person by a grouped ``min`` joined back (instead of a
    ``min() over (partition by person)`` window)."""
    d = (delivered(fo, status).join(customers.select("customer_key", "customer_unique_id"), "customer_key")
         .select("customer_unique_id", F.trunc("order_purchase_timestamp", "MM").alias("order_month")))
    pm = d.distinct()
    first = pm.groupBy("customer_unique_id").agg(F.min("order_month").alias("first_order_month"))
    cm = pm.join(first, "customer_unique_id")
    new, ret = F.col("order_month") == F.col("first_order_month"), F.col("order_month") > F.col("first_order_month")
    return (cm.groupBy("order_month")
            .agg(count_if(new).alias("new_customers"), count_if(ret).alias("returning_customers"),
                 F.count(F.lit(1)).alias("active_customers"),
                 pct(F.count_if(ret), F.count(F.lit(1))).alias("returning_customer_share_pct"))
            .orderBy("order_month"))


def late_vs_review(fo: DataFrame, fr: DataFrame, status: DataFrame) -> DataFrame:
    """K-33: per-order mean review joined to delivered orders with a valid
    timeline; NULL lateness counts as 'On Time'."""
    rv = fr.groupBy("order_id").agg((F.sum("review_score").cast("double") / F.count("review_score"))
                                    .alias("avg_score"))
    e = (delivered(fo, status).filter(F.col("has_valid_delivery_timeline"))
         .join(rv, "order_id")
         .withColumn("delivery_status", F.when(F.col("is_late_delivery"), "Late").otherwise("On Time")))
    s = F.col("avg_score")
    return (e.groupBy("delivery_status")
            .agg(F.count(F.lit(1)).alias("reviewed_orders"), ratio(F.sum(s), F.count(s)).alias("average_review_score"),
                 mean("delivery_days").alias("average_delivery_days"),
                 pct(F.count_if(s >= 4), F.count(F.lit(1))).alias("positive_review_rate_pct"),
                 pct(F.count_if(s <= 2), F.count(F.lit(1))).alias("negative_review_rate_pct"))
            .orderBy("delivery_status"))


def _delivery_block(valid):
    return [count_if(valid).alias("valid_delivery_orders"),
            mean(F.when(valid, F.col("delivery_days"))).alias("average_delivery_days"),
            count_if(valid & F.col("is_late_delivery")).alias("late_orders"),
            pct(F.count_if(valid & F.col("is_late_delivery")), F.count_if(valid)).alias("late_delivery_rate_pct"),
            mean(F.when(valid, F.col("delivery_variance_days"))).alias("average_delivery_variance_days")]


def delivery_by_state(fo: DataFrame, customers: DataFrame, status: DataFrame, min_orders: int = 100) -> DataFrame:
    """K-34: delivery performance by customer state, HAVING >= min_orders."""
    valid = F.col("has_valid_delivery_timeline")
    g = (delivered(fo, status).join(customers.select("customer_key", "customer_state"), "customer_key")
         .groupBy("customer_state").agg(*_delivery_block(valid)))
    return (g.filter(F.col("valid_delivery_orders") >= min_orders).drop("late_orders")
            .orderBy(F.desc_nulls_first("late_delivery_rate_pct"), "customer_state"))


def delivery_by_store(fo: DataFrame, stores: DataFrame, status: DataFrame) -> DataFrame:
    """K-32: delivery performance by store."""
    valid = F.col("has_valid_delivery_timeline")
    g = (delivered(fo, status).join(F.broadcast(stores.select("store_key", "store_id", "store_name", "store_format")),
                                    "store_key")
         .groupBy("store_id", "store_name", "store_format").agg(*_delivery_block(valid)))
    return g.orderBy(F.desc_nulls_first("late_delivery_rate_pct"), "store_id")


def review_distribution(fr: DataFrame, fo: DataFrame, status: DataFrame) -> DataFrame:
    """K-36: review score distribution on delivered orders (fact-to-fact
    join on order_id after reducing the order side to its delivered ids)."""
    ids = delivered(fo, status).select("order_id")
    g = fr.join(ids, "order_id", "left_semi").groupBy("review_score").agg(F.count(F.lit(1)).alias("review_records"))
    return with_share(g, "review_records", "review_share_pct").orderBy("review_score")


def lifecycle_rates(fo: DataFrame, status: DataFrame) -> DataFrame:
    """K-37: cancellation rate and exception rate over all orders."""
    j = fo.join(F.broadcast(status.select("order_status_key", "order_status_group")), "order_status_key")
    return j.agg(F.count(F.lit(1)).alias("orders"),
                 count_if(F.col("order_status") == "canceled").alias("canceled_orders"),
                 pct(F.count_if(F.col("order_status") == "canceled"), F.count(F.lit(1))).alias("cancellation_rate_pct"),
                 count_if(F.col("order_status_group") == "Exception").alias("exception_orders"),
                 pct(F.count_if(F.col("order_status_group") == "Exception"), F.count(F.lit(1)))
                 .alias("exception_rate_pct"))


def performance_by(foi: DataFrame, status: DataFrame, dim: DataFrame, key: str, attrs: list[str]) -> DataFrame:
    """K-38: delivered item performance by any dimension of fact_order_items
    (product, seller, category)."""
    f = foi.drop(*[a for a in attrs if a in foi.columns])
    d = delivered(f, status).join(dim.select(key, *attrs), key)
    return d.groupBy(*attrs).agg(
        money_sum("price").alias("merchandise_value"),
        F.count(F.lit(1)).alias("items"),
        F.countDistinct("order_id").alias("orders"),
        mean("price").alias("average_item_price"),
        money_sum("freight_value").alias("freight_value"))


def active_repeat(fo: DataFrame, customers: DataFrame) -> DataFrame:
    """K-41: active and repeat persons over all orders (any status)."""
    per = (fo.join(customers.select("customer_key", "customer_unique_id"), "customer_key")
           .groupBy("customer_unique_id").agg(F.countDistinct("order_id").alias("n")))
    return per.agg(F.count(F.lit(1)).alias("active_customers"),
                   count_if(F.col("n") >= 2).alias("repeat_customers"),
                   pct(F.count_if(F.col("n") >= 2), F.count(F.lit(1))).alias("repeat_customer_rate_pct"))


# ----------------------------------------------------------------- enterprise KPIs K-08..K-14

def delivered_profitability(foi: DataFrame, status: DataFrame) -> DataFrame:
    """K-08: ratio of sums, never a mean of ratios."""
    d = delivered(foi, status)
    return d.agg(F.countDistinct("order_id").alias("delivered_orders"),
                 money_sum("price").alias("merchandise_value"), money_sum("estimated_cogs").alias("estimated_cogs"),
                 money_sum("estimated_gross_margin").alias("estimated_gross_margin"),
                 pct(F.sum("estimated_gross_margin"), F.sum("price")).alias("estimated_gross_margin_pct"))


def _store_orders(fo: DataFrame, status: DataFrame) -> DataFrame:
    return delivered(fo, status).groupBy("store_key").agg(
        F.count(F.lit(1)).alias("delivered_orders"), F.sum("gross_order_value").alias("_gross"))


def _store_margins(foi: DataFrame, status: DataFrame) -> DataFrame:
    return delivered(foi, status).groupBy("store_key").agg(
        F.sum("price").alias("_merch"), F.sum("estimated_cogs").alias("_cogs"),
        F.sum("estimated_gross_margin").alias("_margin"))


def store_performance(fo: DataFrame, foi: DataFrame, stores: DataFrame, status: DataFrame) -> DataFrame:
    """K-09: two facts aggregated separately per store, joined after."""
    j = (F.broadcast(stores.select("store_key", "store_id", "store_name", "state", "store_format"))
         .join(_store_orders(fo, status), "store_key").join(_store_margins(foi, status), "store_key"))
    return (j.select("store_id", "store_name", "state", "store_format", "delivered_orders",
                     F.round("_gross", 2).cast("double").alias("gross_order_value"),
                     F.round("_merch", 2).cast("double").alias("merchandise_value"),
                     F.round("_margin", 2).cast("double").alias("estimated_gross_margin"),
                     pct("_margin", "_merch").alias("estimated_margin_pct"))
            .orderBy(F.desc("gross_order_value"), "store_id"))


def monthly_store_actuals(fo: DataFrame, status: DataFrame) -> DataFrame:
    """Delivered orders and sales per (month, store): shared by K-10, K-14, K-16..K-18, K-35."""
    return (delivered(fo, status).groupBy(F.trunc("order_purchase_timestamp", "MM").alias("month"), "store_key")
            .agg(F.count(F.lit(1)).alias("actual_orders"), F.sum("gross_order_value").alias("actual_sales")))


def plan_comparison(fo: DataFrame, plan: DataFrame, dates: DataFrame, status: DataFrame) -> DataFrame:
    """Plan rows with the month's actuals (left join, zero filled)."""
    d = F.broadcast(dates.select(F.col("date_key").alias("plan_date_key"), F.col("full_date").alias("month")))
    a = monthly_store_actuals(fo, status)
    return (plan.join(d, "plan_date_key", "left").join(a, ["month", "store_key"], "left")
            .select("month", "plan_date_key", "store_key",
                    F.coalesce(F.col("actual_sales"), F.lit(0).cast("decimal(24,2)")).alias("actual_sales"),
                    F.coalesce("actual_orders", F.lit(0)).alias("actual_orders"),
                    "sales_budget", "sales_target", "order_target"))


def plan_attainment(fo: DataFrame, plan: DataFrame, dates: DataFrame, status: DataFrame) -> DataFrame:
    """K-10: actual vs budget and target over all planned store-months."""
    c = plan_comparison(fo, plan, dates, status)
    a, b, t = F.col("actual_sales"), F.col("sales_budget"), F.col("sales_target")
    return c.agg(F.round(F.sum(a), 2).cast("double").alias("actual_sales"),
                 F.round(F.sum(b), 2).cast("double").alias("sales_budget"),
                 F.round(F.sum(t), 2).cast("double").alias("sales_target"),
                 pct(F.sum(a), F.sum(b)).alias("budget_attainment_pct"),
                 pct(F.sum(a), F.sum(t)).alias("target_attainment_pct"),
                 count_if(a >= b).alias("store_months_at_or_above_budget"),
                 count_if(a >= t).alias("store_months_at_or_above_target"),
                 F.count(F.lit(1)).alias("planned_store_months"))


def inventory_kpis(fim: DataFrame, dates: DataFrame) -> DataFrame:
    """K-11: period metrics x latest snapshot (semi-additive: balances are
    summed over stores and products on the latest date only)."""
    out, below = F.col("had_stockout"), F.col("is_below_reorder_point")
    period = fim.agg(
        month_rows(fim).alias("inventory_snapshot_rows"), F.countDistinct("product_key").alias("inventory_products"),
        F.countDistinct("store_key").alias("inventory_stores"), F.sum("sold_qty").alias("units_sold"),
        F.sum("received_qty").alias("units_received"), F.sum("stockout_days").alias("total_stockout_days"),
        month_rows(fim, out).alias("stockout_rows"), pct(month_rows(fim, out), month_rows(fim)).alias("stockout_row_rate_pct"),
        month_rows(fim, below).alias("below_reorder_rows"), pct(month_rows(fim, below), month_rows(fim)).alias("below_reorder_rate_pct"))
    cur = current_inventory(fim).join(
        F.broadcast(dates.select(F.col("date_key").alias("snapshot_date_key"),
                                 F.col("full_date").alias("current_inventory_date"))), "snapshot_date_key")
    current = cur.groupBy("current_inventory_date").agg(
        F.count(F.lit(1)).alias("current_store_product_rows"), F.sum("closing_stock_qty").alias("current_units_on_hand"),
        money_sum("estimated_closing_inventory_value").alias("current_inventory_value"),
        count_if(F.col("is_below_reorder_point")).alias("current_below_reorder_rows"),
        pct(F.count_if(F.col("is_below_reorder_point")), F.count(F.lit(1))).alias("current_below_reorder_rate_pct"))
    return period.crossJoin(current)  # one row x one row


def current_inventory(fim: DataFrame) -> DataFrame:
    """Rows of the latest snapshot: those (of spans: that reach up to) a one-row max, broadcast into a semi join."""
    last = _last_key(fim)
    latest = fim.agg(F.max(last).alias("_latest"))
    rows = fim.join(F.broadcast(latest), F.col(last) == F.col("_latest"), "left_semi")
    return rows if last == "snapshot_date_key" else rows.withColumn("snapshot_date_key", F.col(last)).drop("months", last)


def _last_key(fim: DataFrame) -> str:
    return "last_date_key" if "last_date_key" in fim.columns else "snapshot_date_key"


def supplier_performance(foi: DataFrame, suppliers: DataFrame, status: DataFrame, n: int = 15) -> DataFrame:
    """K-12: top suppliers by delivered merchandise value."""
    attrs = ["supplier_id", "supplier_name", "supplier_state", "supplier_rating", "standard_lead_time_days",
             "contractual_fill_rate_pct"]
    g = (delivered(foi, status).join(suppliers.select("supplier_key", *attrs), "supplier_key").groupBy(*attrs)
         .agg(F.count(F.lit(1)).alias("delivered_item_rows"), F.countDistinct("order_id").alias("delivered_orders"),
              money_sum("price").alias("merchandise_value"), money_sum("estimated_cogs").alias("estimated_cogs"),
              money_sum("estimated_gross_margin").alias("estimated_gross_margin"),
              pct(F.sum("estimated_gross_margin"), F.sum("price")).alias("estimated_margin_pct")))
    return g.orderBy(F.desc("merchandise_value"), "supplier_id").limit(n)


def marketing_by_channel(fms: DataFrame, channels: DataFrame) -> DataFrame:
    """K-13: spend by channel with share."""
    g = (fms.join(F.broadcast(channels), "marketing_channel_key").groupBy("channel")
         .agg(F.sum("spend").alias("_s")))
    return (with_share(g, "_s", "marketing_spend_share_pct")
            .select("channel", F.round("_s", 2).cast("double").alias("marketing_spend"), "marketing_spend_share_pct")
            .orderBy(F.desc("marketing_spend"), "channel"))


def sales_marketing_coverage(fo: DataFrame, fms: DataFrame, dates: DataFrame, status: DataFrame) -> DataFrame:
    """(month, store) with delivered sales and marketing spend: a full outer
    join of two pre-aggregates with coalesced keys (R-05)."""
    s = monthly_store_actuals(fo, status).select("month", "store_key", F.col("actual_sales").alias("_sales"))
    d = F.broadcast(dates.select(F.col("date_key").alias("spend_date_key"), F.col("full_date").alias("month")))
    m = fms.join(d, "spend_date_key").groupBy("month", "store_key").agg(F.sum("spend").alias("_spend"))
    return (s.join(m, ["month", "store_key"], "full")
            .select("month", "store_key", F.coalesce("_sales", F.lit(0).cast("decimal(24,2)")).alias("delivered_sales"),
                    F.coalesce("_spend", F.lit(0).cast("decimal(24,2)")).alias("marketing_spend")))


def marketing_vs_sales(fo: DataFrame, fms: DataFrame, dates: DataFrame, status: DataFrame) -> DataFrame:
    """K-14: marketing against delivered sales incl. zero-sales months."""
    c = sales_marketing_coverage(fo, fms, dates, status)
    s, m = F.col("delivered_sales"), F.col("marketing_spend")
    active = F.when(s > 0, m).otherwise(F.lit(0))
    return c.agg(F.round(F.sum(s), 2).cast("double").alias("total_delivered_sales"),
                 F.round(F.sum(m), 2).cast("double").alias("total_marketing_spend"),
                 F.round(F.sum(active), 2).cast("double").alias("marketing_spend_active_sales_months"),
                 F.round(F.sum(F.when(s == 0, m).otherwise(F.lit(0))), 2).cast("double")
                 .alias("marketing_spend_zero_sales_months"),
                 count_if(s > 0).alias("active_sales_store_months"),
                 count_if((s == 0) & (m > 0)).alias("marketing_store_months_without_sales"),
                 pct(F.sum(m), F.sum(s)).alias("total_marketing_spend_pct_sales"),
                 pct(F.sum(active), F.sum(s)).alias("active_month_marketing_spend_pct_sales"))


def marketing_spend_per_order(fo: DataFrame, fms: DataFrame, status: DataFrame) -> DataFrame:
    """K-42: marketing spend per delivered order, one row."""
    orders = delivered(fo, status).agg(F.count(F.lit(1)).alias("delivered_orders"))
    spend = fms.agg(F.sum("spend").alias("_s"))
    return orders.crossJoin(spend).select(  # two one-row relations
        "delivered_orders", F.round("_s", 2).cast("double").alias("marketing_spend"),
        ratio("_s", "delivered_orders").alias("marketing_spend_per_order"))


# ----------------------------------------------------------------- store profitability K-15..K-20

def _store_combined(fo: DataFrame, foi: DataFrame, stores: DataFrame, status: DataFrame) -> DataFrame:
    o = delivered(fo, status).groupBy("store_key").agg(
        F.count(F.lit(1)).alias("delivered_orders"), F.sum("gross_order_value").alias("_gross"),
        F.count("gross_order_value").alias("_gross_n"))
    return (F.broadcast(stores.select("store_key", "store_id", "store_name", "state", "store_format"))
            .join(o, "store_key").join(_store_margins(foi, status), "store_key"))


def store_commercial(fo: DataFrame, foi: DataFrame, stores: DataFrame, status: DataFrame) -> DataFrame:
    """K-15: per store sales, AOV, margin, and shares of the all-store totals
    (totals from a one-row aggregate of the per-store rows, broadcast)."""
    c = _store_combined(fo, foi, stores, status)
    tot = c.agg(F.sum("_gross").alias("_tg"), F.sum("_margin").alias("_tm"))
    return (c.crossJoin(F.broadcast(tot))
            .select("store_id", "store_name", "state", "store_format", "delivered_orders",
                    F.round("_gross", 2).cast("double").alias("gross_order_value"),
                    ratio("_gross", "_gross_n").alias("average_order_value"),
                    F.round("_merch", 2).cast("double").alias("merchandise_value"),
                    F.round("_cogs", 2).cast("double").alias("estimated_cogs"),
                    F.round("_margin", 2).cast("double").alias("estimated_gross_margin"),
                    pct("_margin", "_merch").alias("estimated_margin_pct"),
                    pct("_gross", "_tg").alias("sales_share_pct"), pct("_margin", "_tm").alias("margin_share_pct"))
            .orderBy(F.desc("gross_order_value"), "store_id"))


def store_plan(fo: DataFrame, plan: DataFrame, dates: DataFrame, stores: DataFrame, status: DataFrame) -> DataFrame:
    """K-16: per store actual vs budget/target, variance, attainment, months at or above."""
    c = plan_comparison(fo, plan, dates, status).filter(F.col("month").isNotNull())
    a, b, t = F.col("actual_sales"), F.col("sales_budget"), F.col("sales_target")
    g = (c.join(F.broadcast(stores.select("store_key", "store_id", "store_name", "store_format")), "store_key")
         .groupBy("store_id", "store_name", "store_format")
         .agg(F.count(F.lit(1)).alias("planned_months"), F.sum(a).alias("_a"), F.sum(b).alias("_b"),
              F.sum(t).alias("_t"), count_if(a >= b).alias("months_at_or_above_budget"),
              count_if(a >= t).alias("months_at_or_above_target")))
    return (g.select("store_id", "store_name", "store_format", "planned_months",
                     *[F.round(x, 2).cast("double").alias(n) for x, n in
                       [("_a", "actual_sales"), ("_b", "sales_budget"), ("_t", "sales_target")]],
                     F.round(F.col("_a") - F.col("_b"), 2).cast("double").alias("budget_variance"),
                     F.round(F.col("_a") - F.col("_t"), 2).cast("double").alias("target_variance"),
                     pct("_a", "_b").alias("budget_attainment_pct"), pct("_a", "_t").alias("target_attainment_pct"),
                     "months_at_or_above_budget", "months_at_or_above_target")
            .orderBy("budget_variance", "store_id"))


def _store_months(fo, plan, dates, stores, status, how: str) -> DataFrame:
    d = F.broadcast(dates.select(F.col("date_key").alias("plan_date_key"), F.col("full_date").alias("month")))
    a = monthly_store_actuals(fo, status)
    j = (plan.join(d, "plan_date_key").join(F.broadcast(stores.select("store_key", "store_id", "store_name",
                                                                      "store_format")), "store_key")
         .join(a, ["month", "store_key"], how))
    act = F.coalesce(F.col("actual_sales"), F.lit(0).cast("decimal(24,2)"))
    return j.select("month", "store_id", "store_name", "store_format",
                    F.coalesce("actual_orders", F.lit(0)).alias("actual_orders"),
                    F.round(act, 2).cast("double").alias("actual_sales"),
                    F.col("sales_budget").cast("double").alias("sales_budget"),
                    F.round(act - F.col("sales_budget"), 2).cast("double").alias("budget_variance"),
                    pct(act, "sales_budget").alias("budget_attainment_pct"),
                    F.col("sales_target").cast("double").alias("sales_target"),
                    F.round(act - F.col("sales_target"), 2).cast("double").alias("target_variance"))


def store_month_shortfalls(fo, plan, dates, stores, status, n: int = 20) -> DataFrame:
    """K-17: largest shortfalls against budget (months without sales count as zero)."""
    return _store_months(fo, plan, dates, stores, status, "left").orderBy(
        "budget_variance", "month", "store_id").limit(n)


def store_month_outperformance(fo, plan, dates, stores, status, n: int = 20) -> DataFrame:
    """K-18: strongest outperformance (months with sales only)."""
    return _store_months(fo, plan, dates, stores, status, "inner").orderBy(
        F.desc("budget_variance"), "month", "store_id").limit(n)


def format_performance(fo: DataFrame, foi: DataFrame, stores: DataFrame, status: DataFrame) -> DataFrame:
    """K-19: store formats compared (aggregate of per-store aggregates)."""
    c = _store_combined(fo, foi, stores, status)
    return (c.groupBy("store_format")
            .agg(F.count(F.lit(1)).alias("stores"), F.sum("delivered_orders").alias("delivered_orders"),
                 F.round(F.sum("_gross"), 2).cast("double").alias("gross_order_value"),
                 ratio(F.sum("_gross"), F.count(F.lit(1))).alias("average_sales_per_store"),
                 F.round(F.sum("_margin"), 2).cast("double").alias("estimated_gross_margin"),
                 pct(F.sum("_margin"), F.sum("_merch")).alias("estimated_margin_pct"))
            .orderBy(F.desc("gross_order_value"), "store_format"))


def store_concentration(fo: DataFrame, foi: DataFrame, status: DataFrame) -> DataFrame:
    """K-20: top-3 / top-5 store shares of sales and margin (ranked by sales).
    The ranking window runs over one row per store (a bounded list)."""
    s = delivered(fo, status).groupBy("store_key").agg(F.sum("gross_order_value").alias("g"))
    m = delivered(foi, status).groupBy("store_key").agg(F.sum("estimated_gross_margin").alias("m"))
    r = s.join(m, "store_key").withColumn("rk", F.row_number().over(Window.orderBy(F.desc("g"), "store_key")))
    top = lambda k, c: F.sum(F.when(F.col("rk") <= k, F.col(c)).otherwise(F.lit(0)))
    return r.agg(pct(top(3, "g"), F.sum("g")).alias("top_3_store_sales_share_pct"),
                 pct(top(5, "g"), F.sum("g")).alias("top_5_store_sales_share_pct"),
                 pct(top(3, "m"), F.sum("m")).alias("top_3_store_margin_share_pct"),
                 pct(top(5, "m"), F.sum("m")).alias("top_5_store_margin_share_pct"))


# ----------------------------------------------------------------- inventory and supplier K-21..K-28, K-40

def _cur_with(fim: DataFrame) -> DataFrame:
    return current_inventory(fim)


def inventory_by_store(fim: DataFrame, stores: DataFrame) -> DataFrame:
    """K-21: latest snapshot by store with value share."""
    b = F.col("is_below_reorder_point")
    g = (_cur_with(fim).join(F.broadcast(stores.select("store_key", "store_id", "store_name", "store_format")),
                             "store_key")
         .groupBy("store_id", "store_name", "store_format")
         .agg(F.count(F.lit(1)).alias("product_rows"), F.sum("closing_stock_qty").alias("units_on_hand"),
              F.sum("estimated_closing_inventory_value").alias("_v"), count_if(b).alias("below_reorder_rows"),
              pct(F.count_if(b), F.count(F.lit(1))).alias("below_reorder_rate_pct")))
    return (with_share(g, "_v", "inventory_value_share_pct")
            .withColumn("current_inventory_value", F.round("_v", 2).cast("double")).drop("_v")
            .orderBy(F.desc("current_inventory_value"), "store_id"))


def stockout_by_store(fim: DataFrame, stores: DataFrame) -> DataFrame:
    """K-22."""
    s, b = F.col("had_stockout"), F.col("is_below_reorder_point")
    return (fim.join(F.broadcast(stores.select("store_key", "store_id", "store_name", "store_format")), "store_key")
            .groupBy("store_id", "store_name", "store_format")
            .agg(month_rows(fim).alias("inventory_snapshot_rows"), F.sum("stockout_days").alias("stockout_days"),
                 month_rows(fim, s).alias("stockout_rows"), pct(month_rows(fim, s), month_rows(fim)).alias("stockout_row_rate_pct"),
                 month_rows(fim, b).alias("below_reorder_rows"),
                 pct(month_rows(fim, b), month_rows(fim)).alias("below_reorder_rate_pct"))
            .orderBy(F.desc("stockout_row_rate_pct"), F.desc("stockout_days"), "store_id"))


def high_value_products(fim: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    """K-23: most valuable products on hand at the latest snapshot."""
    g = (_cur_with(fim).join(products.select("product_key", "product_id", "product_category_name"), "product_key")
         .groupBy("product_id", "product_category_name")
         .agg(F.sum("closing_stock_qty").alias("units_on_hand"),
              money_sum("estimated_closing_inventory_value").alias("inventory_value"),
              F.countDistinct("store_key").alias("stores_holding_product"),
              count_if(F.col("is_below_reorder_point")).alias("stores_below_reorder")))
    return g.orderBy(F.desc("inventory_value"), "product_id").limit(n)


def _stockouts(fim: DataFrame, key: str, *more: Column) -> DataFrame:
    """Rows, rows with a stockout and stockout days per ``key``, summed before
    the dimension is joined: the months of the inventory are not shuffled."""
    return fim.groupBy(key).agg(month_rows(fim).alias("_rows"), month_rows(fim, F.col("had_stockout")).alias("_out"),
                                F.sum("stockout_days").alias("_days"), *more)


def stockout_products(fim: DataFrame, products: DataFrame, n: int = 20) -> DataFrame:
    """K-24: products with stockouts, most stockout days first."""
    per = _stockouts(fim, "product_key", F.sum("sold_qty").alias("_sold"))
    g = (per.join(products.select("product_key", "product_id", "product_category_name"), "product_key")
         .groupBy("product_id", "product_category_name")
         .agg(F.sum("_rows").alias("snapshot_rows"), F.sum("_out").alias("stockout_rows"),
              F.sum("_days").alias("stockout_days"),
              pct(F.sum("_out"), F.sum("_rows")).alias("stockout_row_rate_pct"), F.sum("_sold").alias("units_sold")))
    return (g.filter(F.col("stockout_rows") > 0)
            .orderBy(F.desc("stockout_days"), F.desc("stockout_row_rate_pct"), "product_id").limit(n))


def slow_movers(fim: DataFrame, dates: DataFrame, stores: DataFrame, products: DataFrame,
                months: int = 3, n: int = 30) -> DataFrame:
    """K-25: stock on hand with no sales in the last ``months`` months."""
    d = F.broadcast(dates.select(F.col("date_key").alias("snapshot_date_key"), "full_date"))
    latest = (fim.agg(F.max(_last_key(fim)).alias("snapshot_date_key")).join(d, "snapshot_date_key")
              .select(F.col("full_date").alias("_latest")))
    # only rows that sold count: the quiet months of a span need no place in the calendar
    recent = (fim.filter(F.col("sold_qty") != 0).join(d, "snapshot_date_key").crossJoin(F.broadcast(latest))  # one-row relation
              .filter(F.col("full_date") >= F.add_months("_latest", -(months - 1)))
              .groupBy("store_key", "product_key").agg(F.sum("sold_qty").alias("_recent")))
    cur = current_inventory(fim).select("store_key", "product_key", "closing_stock_qty", "estimated_closing_inventory_value")
    out = (cur.join(recent, ["store_key", "product_key"], "left")
           .withColumn(f"last_{months}_month_units_sold", F.coalesce("_recent", F.lit(0)).cast("long"))
           .filter((F.col("closing_stock_qty") > 0) & (F.col(f"last_{months}_month_units_sold") == 0))
           .join(F.broadcast(stores.select("store_key", "store_id", "store_name")), "store_key")
           .join(products.select("product_key", "product_id", "product_category_name"), "product_key"))
    return (out.select("store_id", "store_name", "product_id", "product_category_name", "closing_stock_qty",
                       F.round("estimated_closing_inventory_value", 2).cast("double").alias("current_inventory_value"),
                       f"last_{months}_month_units_sold")
            .orderBy(F.desc("current_inventory_value"), "store_id", "product_id").limit(n))


SUPPLIER_ATTRS = ["supplier_id", "supplier_name", "supplier_state", "supplier_rating", "standard_lead_time_days",
                  "contractual_fill_rate_pct"]


def supplier_exposure(foi: DataFrame, fim: DataFrame, suppliers: DataFrame, status: DataFrame,
                      n: int = 20) -> DataFrame:
    """K-26: supplier commercial and inventory exposure; the share is taken
    over all suppliers before the limit."""
    com = delivered(foi, status).groupBy("supplier_key").agg(
        F.countDistinct("order_id").alias("delivered_orders"), F.sum("price").alias("_merch"),
        F.sum("estimated_gross_margin").alias("_margin"))
    inv = _cur_with(fim).groupBy("supplier_key").agg(
        F.sum("closing_stock_qty").alias("current_units_on_hand"),
        F.sum("estimated_closing_inventory_value").alias("_inv"),
        count_if(F.col("is_below_reorder_point")).alias("below_reorder_rows"))
    j = com.join(suppliers.select("supplier_key", *SUPPLIER_ATTRS), "supplier_key").join(inv, "supplier_key", "left")
    j = with_share(j, "_merch", "merchandise_share_pct")
    return (j.select(*SUPPLIER_ATTRS, "delivered_orders", F.round("_merch", 2).cast("double").alias("merchandise_value"),
                     F.round("_margin", 2).cast("double").alias("estimated_gross_margin"),
                     pct("_margin", "_merch").alias("estimated_margin_pct"), "current_units_on_hand",
                     F.round("_inv", 2).cast("double").alias("current_inventory_value"), "below_reorder_rows",
                     "merchandise_share_pct")
            .orderBy(F.desc("merchandise_value"), "supplier_id").limit(n))


def supplier_concentration(foi: DataFrame, status: DataFrame, tops: tuple[int, ...] = (5, 10, 20)) -> DataFrame:
    """K-27: top-5/10/20 supplier shares of delivered merchandise.  Only the
    top max(tops) suppliers are ranked (distributed top-k), the total comes
    from a one-row aggregate: no window over all suppliers."""
    s = delivered(foi, status).groupBy("supplier_key").agg(F.sum("price").alias("v"))
    top = s.orderBy(F.desc("v"), "supplier_key").limit(max(tops))
    ranked = top.withColumn("rk", F.row_number().over(Window.orderBy(F.desc("v"), "supplier_key")))
    parts = ranked.agg(*[F.sum(F.when(F.col("rk") <= k, F.col("v")).otherwise(F.lit(0))).alias(f"_t{k}")
                         for k in tops])
    total = s.agg(F.sum("v").alias("_all"))
    return parts.crossJoin(total).select(*[pct(f"_t{k}", "_all").alias(f"top_{k}_supplier_sales_share_pct")
                                           for k in tops])


def supplier_stockouts(fim: DataFrame, suppliers: DataFrame, n: int = 20) -> DataFrame:
    """K-28."""
    attrs = ["supplier_id", "supplier_name", "supplier_rating", "standard_lead_time_days", "contractual_fill_rate_pct"]
    g = (_stockouts(fim, "supplier_key").join(suppliers.select("supplier_key", *attrs), "supplier_key").groupBy(*attrs)
         .agg(F.sum("_rows").alias("inventory_snapshot_rows"), F.sum("_out").alias("stockout_rows"),
              F.sum("_days").alias("stockout_days"),
              pct(F.sum("_out"), F.sum("_rows")).alias("stockout_row_rate_pct")))
    return (g.filter(F.col("stockout_rows") > 0)
            .orderBy(F.desc("stockout_days"), F.desc("stockout_row_rate_pct"), "supplier_id").limit(n))


def inventory_turnover(fim: DataFrame) -> DataFrame:
    """K-40 (our definition; the source names the KPI without a formula):
    turnover = COGS sold / mean average-inventory value over the period;
    days of supply = units on hand at the latest snapshot / mean daily units
    sold over the period (30-day months)."""
    period = fim.agg(F.sum("estimated_cogs_sold").alias("_cogs"), F.sum("estimated_average_inventory_value").alias("_avgv"),
                     F.count(F.lit(1)).alias("_n"), F.sum("sold_qty").alias("_sold"),
                     F.countDistinct("snapshot_date_key").alias("_months"))
    cur = _cur_with(fim).agg(F.sum("closing_stock_qty").alias("_onhand"))
    return period.crossJoin(cur).select(
        F.round("_cogs", 2).cast("double").alias("cogs_sold"),
        ratio(F.col("_cogs"), F.col("_avgv") / F.col("_n")).alias("inventory_turnover"),
        F.col("_onhand").cast("long").alias("units_on_hand"),
        ratio(F.col("_onhand"), F.col("_sold") / (F.col("_months") * 30)).alias("days_of_supply"))


def marketing_by_store(fo: DataFrame, fms: DataFrame, dates: DataFrame, stores: DataFrame,
                       status: DataFrame) -> DataFrame:
    """K-35: marketing against delivered sales per store (full outer coverage)."""
    c = sales_marketing_coverage(fo, fms, dates, status)
    s, m = F.col("delivered_sales"), F.col("marketing_spend")
    return (c.join(F.broadcast(stores.select("store_key", "store_id", "store_name", "store_format")), "store_key")
            .groupBy("store_id", "store_name", "store_format")
            .agg(F.round(F.sum(s), 2).cast("double").alias("delivered_sales"),
                 F.round(F.sum(m), 2).cast("double").alias("total_marketing_spend"),
                 F.round(F.sum(F.when(s > 0, m).otherwise(F.lit(0))), 2).cast("double")
                 .alias("active_month_marketing_spend"),
                 count_if((s == 0) & (m > 0)).alias("marketing_months_without_sales"),
                 pct(F.sum(m), F.sum(s)).alias("marketing_spend_pct_sales"))
            .orderBy(F.desc_nulls_first("marketing_spend_pct_sales"), "store_id"))
