"""Staging layer (G-01..G-20): typed, trimmed, blank-safe copies of the raw
tables.  Pure projections except G-09 (one row per ZIP) and G-11 (existence
join), so each runs as one scan stage with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import blank_to_null, money, to_date, to_int, to_ts, zip5
from ..functions.quantiles import exact_medians, join_on_groups


def _t(df: DataFrame, name: str):
    return df.schema[name].dataType


def stg_customers(raw: DataFrame) -> DataFrame:
    """G-01: ZIP to five characters, trimmed city, upper-case state."""
    return raw.select(
        "customer_id", "customer_unique_id",
        zip5("customer_zip_code_prefix").alias("customer_zip_code_prefix"),
        F.trim("customer_city").alias("customer_city"),
        F.upper(F.trim("customer_state")).alias("customer_state"))


def stg_products(raw: DataFrame) -> DataFrame:
    """G-02: blank category -> NULL, misspelt ``lenght`` renamed, float -> int."""
    renames = [("product_name_lenght", "product_name_length"),
               ("product_description_lenght", "product_description_length"),
               ("product_photos_qty", "product_photos_qty"),
               ("product_weight_g", "product_weight_g"),
               ("product_length_cm", "product_length_cm"),
               ("product_height_cm", "product_height_cm"),
               ("product_width_cm", "product_width_cm")]
    return raw.select(
        "product_id",
        blank_to_null("product_category_name").alias("product_category_name"),
        *[to_int(src, _t(raw, src)).alias(dst) for src, dst in renames])


ORDER_TIMESTAMPS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
                    "order_delivered_customer_date", "order_estimated_delivery_date"]


def stg_orders(raw: DataFrame) -> DataFrame:
    """G-03: status lower/trim, five blank-safe timestamps."""
    return raw.select(
        "order_id", "customer_id",
        F.lower(F.trim("order_status")).alias("order_status"),
        *[to_ts(c, _t(raw, c)).alias(c) for c in ORDER_TIMESTAMPS])


def stg_order_items(raw: DataFrame) -> DataFrame:
    """G-04: integer sequence, timestamp, money as decimal(12,2)."""
    return raw.select(
        "order_id", to_int("order_item_id", _t(raw, "order_item_id")).alias("order_item_id"),
        "product_id", "seller_id",
        to_ts("shipping_limit_date", _t(raw, "shipping_limit_date")).alias("shipping_limit_date"),
        money("price").alias("price"), money("freight_value").alias("freight_value"))


def stg_order_payments(raw: DataFrame) -> DataFrame:
    """G-05: integer sequence and instalments, lower type, money."""
    return raw.select(
        "order_id",
        to_int("payment_sequential", _t(raw, "payment_sequential")).alias("payment_sequential"),
        F.lower(F.trim("payment_type")).alias("payment_type"),
        to_int("payment_installments", _t(raw, "payment_installments")).alias("payment_installments"),
        money("payment_value").alias("payment_value"))


def stg_sellers(raw: DataFrame) -> DataFrame:
    """G-06: ZIP, blank-safe city and state."""
    return raw.select(
        "seller_id", zip5("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        blank_to_null("seller_city").alias("seller_city"),
        F.upper(blank_to_null("seller_state")).alias("seller_state"))


def stg_category_translation(raw: DataFrame) -> DataFrame:
    """G-07."""
    return raw.select(blank_to_null("product_category_name").alias("product_category_name"),
                      blank_to_null("product_category_name_english").alias("product_category_name_english"))


def stg_order_reviews(raw: DataFrame) -> DataFrame:
    """G-08: integer score, blank-safe texts and timestamps."""
    return raw.select(
        "review_id", "order_id",
        to_int("review_score", _t(raw, "review_score")).alias("review_score"),
        blank_to_null("review_comment_title").alias("review_comment_title"),
        blank_to_null("review_comment_message").alias("review_comment_message"),
        to_ts("review_creation_date", _t(raw, "review_creation_date")).alias("review_creation_date"),
        to_ts("review_answer_timestamp", _t(raw, "review_answer_timestamp")).alias("review_answer_timestamp"))


def stg_geolocation(raw: DataFrame, dedupe: bool = False, exact: bool = True) -> DataFrame:
    """G-09: one representative row per ZIP.

    Median latitude/longitude (continuous percentile), modal city and state
    (lowest value on ties), row count and distinct label counts.  Exact
    duplicate rows are kept by default, so they weigh in, as in the source
    model.  Labels are counted per (ZIP, label) first — a partial aggregate,
    so a hot ZIP collapses map-side — and the mode is the ``min`` of
    (-count, label) per ZIP, again combinable map-side: no per-ZIP label map.
    The exact medians come from the global sort of :mod:`quantiles`, so a hot
    ZIP is split over many tasks; ``exact=False`` uses a bounded sketch.
    """
    src = raw.dropDuplicates() if dedupe else raw
    keyed = src.select(zip5("geolocation_zip_code_prefix").alias("zip_code_prefix"),
                       F.col("geolocation_lat").cast("double").alias("lat"),
                       F.col("geolocation_lng").cast("double").alias("lng"),
                       blank_to_null("geolocation_city").alias("city"),
                       F.upper(blank_to_null("geolocation_state")).alias("state"))
    per_label = (keyed.select("zip_code_prefix", F.explode(F.array(
                     F.struct(F.lit(0).alias("k"), F.col("city").alias("v")),
                     F.struct(F.lit(1).alias("k"), F.col("state").alias("v")))).alias("_l"))
                 .groupBy("zip_code_prefix", "_l.k", "_l.v").agg(F.count(F.lit(1)).alias("n")))
    named = lambda k: (F.col("k") == k) & F.col("v").isNotNull()
    modal = lambda k: F.min(F.when(named(k), F.struct((-F.col("n")).alias("m"), "v")))["v"]
    labels = per_label.groupBy("zip_code_prefix").agg(
        modal(0).alias("city"), modal(1).alias("state"),
        F.sum(F.when(F.col("k") == 0, F.col("n"))).cast("int").alias("source_row_count"),
        F.count_if(named(0)).cast("int").alias("distinct_city_count"),
        F.count_if(named(1)).cast("int").alias("distinct_state_count"))
    if exact:
        med = exact_medians(keyed, ["zip_code_prefix"], {"latitude": "lat", "longitude": "lng"})
    else:
        med = keyed.groupBy("zip_code_prefix").agg(F.percentile_approx("lat", 0.5, 10000).alias("latitude"),
                                                   F.percentile_approx("lng", 0.5, 10000).alias("longitude"))
    out = join_on_groups(labels, med, ["zip_code_prefix"])
    return out.select("zip_code_prefix", "latitude", "longitude", "city", "state", "source_row_count",
                      "distinct_city_count", "distinct_state_count")


def stg_leads(raw: DataFrame) -> DataFrame:
    """G-10: date, lower-case origin."""
    return raw.select(
        "mql_id", to_date("first_contact_date", _t(raw, "first_contact_date")).alias("first_contact_date"),
        "landing_page_id", F.lower(blank_to_null("origin")).alias("origin"))


def stg_deals(raw: DataFrame, sellers: DataFrame) -> DataFrame:
    """G-11: cleaning plus ``ecommerce_seller_match`` (EXISTS as a column).

    The seller keys are reduced to distinct ids before the left join, so the
    join cannot fan out; Catalyst plans it as an existence join.
    """
    known = sellers.select(F.col("seller_id").alias("_sid")).distinct().withColumn("_hit", F.lit(True))
    lower = lambda c: F.lower(blank_to_null(c))
    return (raw.join(known, raw.seller_id == known._sid, "left")
            .select("mql_id", "seller_id", "sdr_id", "sr_id",
                    to_ts("won_date", _t(raw, "won_date")).alias("won_date"),
                    lower("business_segment").alias("business_segment"),
                    lower("lead_type").alias("lead_type"),
                    lower("lead_behaviour_profile").alias("lead_behaviour_profile"),
                    "has_company", "has_gtin",
                    lower("average_stock").alias("average_stock"),
                    lower("business_type").alias("business_type"),
                    to_int("declared_product_catalog_size", _t(raw, "declared_product_catalog_size"))
                    .alias("declared_product_catalog_size"),
                    money("declared_monthly_revenue", 14).alias("declared_monthly_revenue"),
                    F.coalesce(F.col("_hit"), F.lit(False)).alias("ecommerce_seller_match")))


# --------------------------------------------------------------------------- enterprise staging (G-12..G-20)

def _dec(c: str, p: int, s: int):
    return F.round(F.col(c).cast("decimal(20,6)"), s).cast(f"decimal({p},{s})").alias(c)


def stg_stores(raw: DataFrame) -> DataFrame:
    """G-12."""
    return raw.select("store_id", "store_name", F.lower(blank_to_null("city")).alias("city"),
                      F.upper(blank_to_null("state")).alias("state"), F.col("latitude").cast("double").alias("latitude"),
                      F.col("longitude").cast("double").alias("longitude"), "store_format",
                      F.col("opening_date").cast("date").alias("opening_date"),
                      F.col("floor_area_sqm").cast("int").alias("floor_area_sqm"))


def stg_assignment(raw: DataFrame) -> DataFrame:
    """G-13."""
    return raw.select("order_id", "store_id", "assignment_method")


def stg_suppliers(raw: DataFrame) -> DataFrame:
    """G-14: rating numeric(4,2), fill rate numeric(5,2)."""
    return raw.select("supplier_id", "supplier_name", F.upper(blank_to_null("supplier_state")).alias("supplier_state"),
                      _dec("supplier_rating", 4, 2), F.col("standard_lead_time_days").cast("int")
                      .alias("standard_lead_time_days"), _dec("contractual_fill_rate_pct", 5, 2))


def stg_product_supplier(raw: DataFrame) -> DataFrame:
    """G-15."""
    return raw.select("product_id", "supplier_id")


def stg_product_cost(raw: DataFrame) -> DataFrame:
    """G-16: cost numeric(14,2), ratio numeric(8,4)."""
    return raw.select("product_id", _dec("estimated_unit_cost", 14, 2), _dec("cost_ratio", 8, 4))


INVENTORY_QTY = ["opening_stock_qty", "received_qty", "sold_qty", "closing_stock_qty", "reorder_point",
                 "stockout_days"]


def stg_inventory(raw: DataFrame) -> DataFrame:
    """G-17, of monthly rows or of runs of ``months``."""
    return raw.select(F.col("snapshot_month").cast("date").alias("snapshot_month"), "store_id", "product_id",
                      *[F.col(c).cast("int").alias(c) for c in [*INVENTORY_QTY, "months"] if c in raw.columns or c != "months"])


def stg_budget(raw: DataFrame) -> DataFrame:
    """G-18."""
    return raw.select(F.col("budget_month").cast("date").alias("budget_month"), "store_id",
                      _dec("sales_budget", 14, 2), _dec("freight_budget", 14, 2), _dec("operating_cost_budget", 14, 2))


def stg_targets(raw: DataFrame) -> DataFrame:
    """G-19."""
    return raw.select(F.col("target_month").cast("date").alias("target_month"), "store_id",
                      _dec("sales_target", 14, 2), F.col("order_target").cast("int").alias("order_target"),
                      _dec("margin_target_pct", 6, 2))


def stg_marketing(raw: DataFrame) -> DataFrame:
    """G-20: lower-case channel."""
    return raw.select(F.col("month").cast("date").alias("month"), "store_id",
                      F.lower(blank_to_null("channel")).alias("channel"), _dec("spend", 14, 2))
