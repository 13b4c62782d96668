"""Bind the driver's TPC-H-like test tables to the retail raw layout.

The operators are written for the retail source layout (customers, orders,
order_items, order_payments, ...).  These functions derive that layout from
``region nation customer supplier part orders lineitem events`` with native
expressions only; every derived table grows with its inputs.

Fixed values of the binding (they must equal the ones the oracle SQL uses):
  order status      F -> delivered, O -> shipped, P -> canceled
  payment type      A -> credit_card, N -> boleto, R -> voucher
  estimated date    purchase + 600 days
  approval          purchase + (order_id % 72) hours, NULL when order_id % 97 = 0
  geolocation       nation 23 labelled 'ZZ' throughout, nation 24 left out,
                    customers with id % 10 = 0 labelled 'ZZ'
  product category  blank when part % 50 = 0; the alphabetically last type
                    has no translation; weight 0 when part % 40 = 0
  lead origins      organic_search, paid_search, social, email, direct, blank
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import split_hot, with_dense_key, with_group_sequence
from .tables import ParquetTables

ZZ_NATION = 23
UNMATCHED_NATION = 24
LEAD_ORIGINS = ["ORGANIC_SEARCH", "PAID_SEARCH", "SOCIAL", "EMAIL", "DIRECT", " "]
SEGMENTS = ["Health_Beauty", "Car_Accessories", "Home_Decor", " "]
LEAD_TYPES = ["Online_Medium", "Online_Big", "Offline"]
PROFILES = ["Cat", "Eagle", "Wolf", " "]


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def state_code(regionkey: Column, nationkey: Column) -> Column:
    """Two capitals per nation: chr(65+region) || chr(65+nation)."""
    return F.concat(F.chr(F.lit(65) + regionkey), F.chr(F.lit(65) + nationkey))


def raw_customers(t: ParquetTables) -> DataFrame:
    c, n = t["customer"], t["nation"]
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("customer_id"),
                    (F.col("c_custkey") - F.col("c_custkey") % 2).alias("customer_unique_id"),
                    F.col("c_nationkey").alias("customer_zip_code_prefix"),
                    F.concat(F.lit(" "), F.col("c_mktsegment")).alias("customer_city"),
                    F.lower(state_code(F.col("n_regionkey"), F.col("n_nationkey"))).alias("customer_state")))


def raw_geolocation(t: ParquetTables) -> DataFrame:
    c, n = t["customer"], t["nation"]
    code = state_code(F.col("n_regionkey"), F.col("n_nationkey"))
    return (c.filter(F.col("c_nationkey") != UNMATCHED_NATION)
            .join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_nationkey").alias("geolocation_zip_code_prefix"),
                    ((F.col("c_acctbal") % 60) - 30).alias("geolocation_lat"),
                    ((F.col("c_acctbal") % 90) - 90).alias("geolocation_lng"),
                    F.col("c_mktsegment").alias("geolocation_city"),
                    F.when((F.col("c_custkey") % 10 == 0) | (F.col("c_nationkey") == ZZ_NATION),
                           F.lit("ZZ")).otherwise(code).alias("geolocation_state")))


def raw_products(t: ParquetTables) -> DataFrame:
    p = t["part"]
    size = F.col("p_size")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 50 == 0, F.lit("  ")).otherwise(F.col("p_type"))
        .alias("product_category_name"),
        F.length("p_name").cast("double").alias("product_name_lenght"),
        (F.length("p_name") * 10 + size).cast("double").alias("product_description_lenght"),
        (size % 4 + 1).cast("double").alias("product_photos_qty"),
        F.when(F.col("p_partkey") % 40 == 0, F.lit(0.0)).otherwise(size.cast("double"))
        .alias("product_weight_g"),
        (size % 30 + 10).cast("double").alias("product_length_cm"),
        (size % 20 + 2).cast("double").alias("product_height_cm"),
        (size % 25 + 6).cast("double").alias("product_width_cm"))


def raw_category_translation(t: ParquetTables) -> DataFrame:
    types = t["part"].select("p_type").distinct()
    last = types.agg(F.max("p_type").alias("_last"))
    return (types.crossJoin(F.broadcast(last))  # one-row relation
            .filter(F.col("p_type") != F.col("_last"))
            .select(F.col("p_type").alias("product_category_name"),
                    F.lower("p_type").alias("product_category_name_english")))


def raw_sellers(t: ParquetTables) -> DataFrame:
    s, n = t["supplier"], t["nation"]
    return (s.join(n, s.s_nationkey == n.n_nationkey, "left")
            .select(F.col("s_suppkey").alias("seller_id"),
                    F.col("s_nationkey").alias("seller_zip_code_prefix"),
                    F.lower("n_name").alias("seller_city"),
                    F.lower(state_code(F.col("n_regionkey"), F.col("n_nationkey"))).alias("seller_state")))


def raw_orders(t: ParquetTables) -> DataFrame:
    o, li = t["orders"], t["lineitem"]
    ship = li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("_carrier"),
                                        F.max("l_shipdate").alias("_delivered"))
    status = (F.when(F.col("o_orderstatus") == "F", "DELIVERED")
              .when(F.col("o_orderstatus") == "O", "Shipped")
              .when(F.col("o_orderstatus") == "P", " canceled "))
    approved = F.when(F.col("o_orderkey") % 97 == 0, F.lit(None)).otherwise(
        F.timestamp_add("HOUR", (F.col("o_orderkey") % 72).cast("int"), F.col("o_orderdate")))
    return (o.join(ship, o.o_orderkey == ship.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("order_id"),
                    F.col("o_custkey").alias("customer_id"),
                    status.alias("order_status"),
                    F.col("o_orderdate").alias("order_purchase_timestamp"),
                    approved.alias("order_approved_at"),
                    F.col("_carrier").alias("order_delivered_carrier_date"),
                    F.col("_delivered").alias("order_delivered_customer_date"),
                    F.timestamp_add("DAY", F.lit(600), F.col("o_orderdate"))
                    .alias("order_estimated_delivery_date")))


def raw_order_items(t: ParquetTables) -> DataFrame:
    li = t["lineitem"]
    numbered = with_group_sequence(
        li, ["l_orderkey"],
        ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
         "l_shipdate", "l_discount", "l_tax"],
        "order_item_id")
    return numbered.select(
        F.col("l_orderkey").alias("order_id"),
        "order_item_id",
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"))


def raw_order_payments(t: ParquetTables) -> DataFrame:
    """One payment per (order, returnflag, linestatus).  Lines of usual orders
    are shuffled once, by order, for the sums and the numbering; those of hot
    orders are summed before they are shuffled."""
    line_value = F.round((F.col("l_extendedprice") * (1 - F.col("l_discount"))
                          * (1 + F.col("l_tax"))).cast("decimal(20,6)"), 2)
    lines = t["lineitem"].select("l_orderkey", "l_returnflag", "l_linestatus", line_value.alias("_line"))
    # At most one row per (returnflag, linestatus): the window groups are bounded.
    seq = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_returnflag", "l_linestatus"))
    ptype = (F.when(F.col("l_returnflag") == "A", "credit_card")
             .when(F.col("l_returnflag") == "N", "Boleto")
             .when(F.col("l_returnflag") == "R", "VOUCHER"))

    def payments(rows: DataFrame) -> DataFrame:
        per = (rows.groupBy("l_orderkey", "l_returnflag", "l_linestatus")
               .agg(F.count(F.lit(1)).alias("payment_installments"), F.sum("_line").alias("_value")))
        return per.select(F.col("l_orderkey").alias("order_id"), seq.alias("payment_sequential"), ptype.alias("payment_type"),
                          "payment_installments", F.col("_value").cast("double").alias("payment_value"))
    usual, hot = split_hot(lines, ["l_orderkey"])
    found = payments(usual.repartition("l_orderkey"))
    return found if hot is None else found.unionByName(payments(hot))


def raw_order_reviews(t: ParquetTables) -> DataFrame:
    e = t["events"]
    n_orders = t["orders"].agg(F.count(F.lit(1)).alias("_n"))
    k_hours = F.get_json_object("props", "$.k").cast("int")
    return (e.crossJoin(F.broadcast(n_orders))  # one-row relation
            .select(F.col("event_id").alias("review_id"),
                    (F.col("event_id") % F.col("_n")).alias("order_id"),
                    (F.col("event_id") % 5 + 1).cast("double").alias("review_score"),
                    F.when(F.col("value") > 20, F.col("event_type")).otherwise(F.lit(" "))
                    .alias("review_comment_title"),
                    F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("props"))
                    .alias("review_comment_message"),
                    F.col("ts").alias("review_creation_date"),
                    F.timestamp_add("DAY", F.lit(-1), F.timestamp_add("HOUR", k_hours, F.col("ts")))
                    .alias("review_answer_timestamp")))


def raw_leads(t: ParquetTables) -> DataFrame:
    e = t["events"].filter(F.col("event_type") == "signup")
    return e.select(F.col("event_id").alias("mql_id"),
                    F.col("ts").cast("date").alias("first_contact_date"),
                    F.concat(F.lit("lp_"), (F.col("user_id") % 7).cast("string")).alias("landing_page_id"),
                    _pick(LEAD_ORIGINS, F.col("event_id")).alias("origin"))


def raw_deals(t: ParquetTables) -> DataFrame:
    """Each signup's first purchase by the same user strictly after it.

    Skew-safe without a per-user window: ``g`` is the dense index of every
    event in (user, ts, purchase-before-signup, id) order and ``k`` the
    dense index in (kind, user, ts, id) order, which ranks purchases 1..P
    and signups P+1..P+S.  The purchases ordered before a signup number
    ``g - (k - P)``, so its next purchase is the one with rank
    ``g - (k - P) + 1``: an equi-join on a unique rank, kept when the user
    matches.  Range partitioning spreads a hot user over many tasks.
    """
    e = (t["events"].filter(F.col("event_type").isin("signup", "purchase"))
         .select("event_id", "user_id", "ts", "value",
                 F.when(F.col("event_type") == "purchase", 0).otherwise(1).alias("_kind")))
    g = with_dense_key(e, ["user_id", "ts", "_kind", "event_id"], "_g")
    k = with_dense_key(g, ["_kind", "user_id", "ts", "event_id"], "_k")
    n_p = e.filter(F.col("_kind") == 0).agg(F.count(F.lit(1)).alias("_np"))
    signups = (k.filter(F.col("_kind") == 1).crossJoin(F.broadcast(n_p))  # one-row relation
               .select("event_id", "user_id", (F.col("_g") - (F.col("_k") - F.col("_np")) + 1).alias("_want")))
    purchases = k.filter(F.col("_kind") == 0).select(
        F.col("_k").alias("_want"), F.col("user_id").alias("_pu"), F.col("ts").alias("_pts"),
        F.col("event_id").alias("_pid"), F.col("value").alias("_pval"))
    nxt = signups.join(purchases, "_want").filter(F.col("_pu") == F.col("user_id"))
    pid, pval = F.col("_pid"), F.col("_pval")
    return nxt.select(
        F.col("event_id").alias("mql_id"),
        F.col("user_id").alias("seller_id"),
        F.concat(F.lit("sdr_"), (F.col("user_id") % 5).cast("string")).alias("sdr_id"),
        F.concat(F.lit("sr_"), (F.col("user_id") % 3).cast("string")).alias("sr_id"),
        F.col("_pts").alias("won_date"),
        _pick(SEGMENTS, pid).alias("business_segment"),
        _pick(LEAD_TYPES, pid).alias("lead_type"),
        _pick(PROFILES, F.col("event_id")).alias("lead_behaviour_profile"),
        (F.col("user_id") % 2 == 0).alias("has_company"),
        F.when(pid % 4 == 3, F.lit(None)).otherwise(pid % 3 == 0).alias("has_gtin"),
        F.when(pid % 2 == 0, F.lit("5-20")).otherwise(F.lit(" ")).alias("average_stock"),
        F.when(pid % 2 == 0, F.lit("Reseller")).otherwise(F.lit("Manufacturer")).alias("business_type"),
        (F.floor(pval) - 10).cast("double").alias("declared_product_catalog_size"),
        ((pval - 5) * 1000).alias("declared_monthly_revenue"))


# Feeds of the enterprise model ---------------------------------------------------

def wholesale_prices(t: ParquetTables) -> DataFrame:
    """(product_id, wholesale_price) of a unit: the part's list price."""
    return t["part"].select(F.col("p_partkey").alias("product_id"), F.col("p_retailprice").cast("decimal(14,2)").alias("wholesale_price"))


def sold_quantities(t: ParquetTables) -> DataFrame:
    """(product_id, quantity) of each line."""
    return t["lineitem"].select(F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("decimal(14,2)").alias("quantity"))


def promotions(t: ParquetTables) -> DataFrame:
    """(order_id, amount): the money that a line's discount gave away."""
    amount = F.round((F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(20,6)"), 2)
    return t["lineitem"].select(F.col("l_orderkey").alias("order_id"), amount.alias("amount"))


def order_channels(t: ParquetTables) -> DataFrame:
    """(order_id, channel): the order priority's leading digit stands for the channel that brought the order."""
    digit = F.substring("o_orderpriority", 1, 1).try_cast("int")
    names = ["paid_search", "social", "email", "display", "affiliate"]  # fixed values
    return t["orders"].select(F.col("o_orderkey").alias("order_id"), F.get(F.array(*[F.lit(n) for n in names]), digit - 1).alias("channel"))
