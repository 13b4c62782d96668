"""Enterprise model (M-01..M-22): stores, order-to-store assignment, suppliers,
product cost, monthly plans, marketing and the inventory roll-forward.

Everything is computed from the warehouse and from feeds that
``sources/bindings.py`` reads from the given tables: wholesale prices,
quantities sold, price promotions per order and the channel that brought the
order.  Nothing is drawn at random.

Scale notes: all per-row work is native column expressions.  The only
"small side" relations are the store list (bounded by ``n_stores``), the
channel list (5) and one-row aggregates; those are broadcast.  Windows run
only over one state's cities, one store's months or the months of one (store,
product), so no group grows with the data volume.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import haversine_km, round_half_up, unfold_months
from ..functions.quantiles import exact_medians, exact_percentiles
from ..session import stored

# Store formats by rank, channels, assignment labels.
STORE_FORMATS = [(4, "Fulfilment Hub"), (8, "Urban Store"), (12, "Regional Store")]
CHANNELS = ["paid_search", "social", "email", "display", "affiliate"]
NEAREST, STATE_FALLBACK, NATIONAL_FALLBACK = "nearest_geolocation", "state_fallback", "national_fallback"


@dataclass(frozen=True)
class Policy:
    """Planning parameters."""
    n_stores: int = 12
    n_states: int = 10
    past_months: int = 3            # a budget is the mean of so many months before
    target_uplift: float = 0.05     # target over budget
    operating_rate: float = 0.12    # operating cost per unit of budgeted sales
    margin_target: float = 30.0     # percent
    default_aov: float = 150.0      # order value of a store without orders
    min_product_sales: int = 5
    max_products: int = 1200        # of the best-seller report


DEFAULT = Policy()


# ----------------------------------------------------------------- M-02 stores

def delivered_geo_orders(orders: DataFrame, customers: DataFrame, status: DataFrame) -> DataFrame:
    """Orders (of D-10, or their values by customer id) with their customer's state, city and coordinates."""
    customer, kind = [k if k in orders.columns else other for k, other in (("customer_key", "customer_id"), ("order_status_key", "order_status"))]
    c = customers.select(customer, "customer_state", "customer_city", "latitude", "longitude")
    st = F.broadcast(status.select("order_status_key", "order_status"))
    return (orders.select("order_id", kind, "order_purchase_timestamp", "merchandise_value",
                          "freight_value", "gross_order_value", customer)
            .join(st, kind).join(c, customer))


def _ranked(df: DataFrame, by: list[Column], name: str) -> DataFrame:
    """``name`` = 1..n in the order of ``by`` for a relation of at most n_stores rows."""
    rows = df.agg(F.sort_array(F.collect_list(F.struct(*[c.alias(f"_o{i}") for i, c in enumerate(by)], F.struct(*df.columns).alias("r")))).alias("x"))
    return rows.select(F.posexplode("x").alias("_at", "_x")).select("_x.r.*", (F.col("_at") + 1).alias(name))


def select_stores(orders_geo: DataFrame, f: Policy = DEFAULT) -> DataFrame:
    """M-02: busiest city of each of the top states, then the next busiest
    cities, up to ``n_stores``; ranked by delivered orders."""
    d = orders_geo.filter((F.col("order_status") == "delivered") & F.col("latitude").isNotNull()
                          & F.col("longitude").isNotNull() & F.col("customer_state").isNotNull()
                          & F.col("customer_city").isNotNull())
    d = d.withColumnRenamed("customer_state", "state").withColumnRenamed("customer_city", "city")
    city = d.groupBy("state", "city").agg(F.count(F.lit(1)).alias("source_order_count"))
    states = (d.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "state").limit(f.n_states).select("state"))
    # the busiest city per state is an aggregate, the next ones a distributed
    # top-n; only the at most n_stores chosen cities are ranked
    best = (city.join(F.broadcast(states), "state", "left_semi").groupBy("state")
            .agg(F.min(F.struct((-F.col("source_order_count")).alias("n"), "city")).alias("x"))
            .select("state", "x.city", (-F.col("x.n")).alias("source_order_count")))
    order = [-F.col("source_order_count"), F.col("state"), F.col("city")]
    rest = city.join(best.select("state", "city"), ["state", "city"], "left_anti").orderBy(*order).limit(f.n_stores)
    n_best = best.agg(F.count(F.lit(1)).alias("_nb"))
    rest = (_ranked(rest, order, "_r").crossJoin(F.broadcast(n_best))  # one-row relation
            .filter(F.col("_r") <= F.lit(f.n_stores) - F.col("_nb")).drop("_r", "_nb"))
    ranked = _ranked(best.unionByName(rest), order, "store_rank")
    # Exact medians only for the chosen cities (at most n_stores rows, so the
    # semi join broadcasts them), by a global sort: a busy city is split
    # over many tasks instead of buffered in one.
    at_store = d.join(F.broadcast(ranked.select("state", "city")), ["state", "city"], "left_semi")
    med = exact_medians(at_store, ["state", "city"], {"latitude": "latitude", "longitude": "longitude"},
                        bounded_groups=True)
    ranked = ranked.join(med, ["state", "city"], "left")
    fmt = F.lit(STORE_FORMATS[-1][1])
    for upto, name in reversed(STORE_FORMATS[:-1]):
        fmt = F.when(F.col("store_rank") <= upto, F.lit(name)).otherwise(fmt)
    first_day = d.agg(F.to_date(F.min("order_purchase_timestamp")).alias("_first"))
    return (ranked.crossJoin(F.broadcast(first_day))
            .select(F.format_string("STORE%03d", F.col("store_rank")).alias("store_id"),
                    F.concat_ws(" ", F.initcap("city"), F.col("state"), fmt).alias("store_name"),
                    "city", "state", "latitude", "longitude", fmt.alias("store_format"),
                    F.date_sub("_first", (F.lit(365) + F.lit(100) * F.col("store_rank")).cast("int"))
                    .alias("opening_date"),
                    (F.lit(700) + F.lit(500) * F.col("store_rank")).cast("int").alias("floor_area_sqm"),
                    "source_order_count", "store_rank"))


# ----------------------------------------------------------------- M-03 assignment

def assign_stores(orders_geo: DataFrame, stores: DataFrame) -> DataFrame:
    """M-03: nearest store by great-circle distance; no coordinates -> the
    busiest store of the customer's state, else the first store.

    The store list (bounded by ``n_stores``) is collected into one array
    column and broadcast; ``array_min`` over (distance, rank, id) structs is
    the argmin, ties going to the earlier store."""
    arr = stores.agg(F.collect_list(F.struct("store_rank", "store_id", "latitude", "longitude")).alias("_stores"))
    lat, lon = F.col("latitude"), F.col("longitude")
    nearest = F.array_min(F.transform("_stores", lambda s: F.struct(
        haversine_km(lat, lon, s["latitude"], s["longitude"]).alias("d"), s["store_rank"].alias("r"),
        s["store_id"].alias("id"))))
    by_state = (stores.groupBy(F.col("state").alias("customer_state"))
                .agg(F.min_by("store_id", "store_rank").alias("_state_store")))
    first = stores.agg(F.min_by("store_id", "store_rank").alias("_first_store"))
    o = (orders_geo.select("order_id", "customer_state", "latitude", "longitude")
         .crossJoin(F.broadcast(arr)).crossJoin(F.broadcast(first))  # one-row relations
         .join(F.broadcast(by_state), "customer_state", "left"))
    geo = lat.isNotNull() & lon.isNotNull()
    return o.select(
        "order_id",
        F.when(geo, nearest["id"]).when(F.col("_state_store").isNotNull(), F.col("_state_store"))
        .otherwise(F.col("_first_store")).alias("store_id"),
        F.when(geo, F.lit(NEAREST)).when(F.col("_state_store").isNotNull(), F.lit(STATE_FALLBACK))
        .otherwise(F.lit(NATIONAL_FALLBACK)).alias("assignment_method"))


# ----------------------------------------------------------------- M-04 suppliers

def suppliers_from_source(supplier: DataFrame, nation: DataFrame) -> DataFrame:
    """Supplier attributes derived from the supplier table (binding; see
    FIXTURES): rating, lead time and fill rate are functions of the key."""
    k = F.col("s_suppkey")
    code = F.concat(F.chr(F.lit(65) + F.col("n_regionkey")), F.chr(F.lit(65) + F.col("n_nationkey")))
    return (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
            .select(k.alias("supplier_id"), F.col("s_name").alias("supplier_name"), code.alias("supplier_state"),
                    (F.lit(3.3) + (k * 37 % 100) * F.lit(0.017)).alias("supplier_rating"),
                    (F.lit(2) + k % 14).cast("int").alias("standard_lead_time_days"),
                    (F.lit(88.0) + (k * 53 % 100) * F.lit(0.115)).alias("contractual_fill_rate_pct")))


def _most(rows: DataFrame, keys: list[str], value: str, count: str, name: str) -> DataFrame:
    """Per group the value with the highest total count, ties to the smallest."""
    total = rows.groupBy(*keys, value).agg(F.sum(count).alias("_t"))
    return total.groupBy(*keys).agg(F.min(F.struct((-F.col("_t")).alias("_t"), F.col(value).alias("v")))["v"].alias(name))


def map_suppliers(products: DataFrame, suppliers: DataFrame, items: DataFrame) -> DataFrame:
    """M-04: each product gets the supplier that sold most of its items; a
    product without sales gets the busiest supplier of its category, else the
    busiest of all (ties to the smaller id).

    Items are counted per (product, supplier) before anything is joined, so
    a hot product or supplier collapses map-side."""
    known = suppliers.select("supplier_id")
    sold = (items.groupBy("product_id", F.col("seller_id").alias("supplier_id")).agg(F.count(F.lit(1)).alias("_n"))
            .join(known, "supplier_id", "left_semi"))
    cat = F.coalesce(F.col("product_category_name"), F.lit("Unknown"))
    p = products.select("product_id", cat.alias("_cat"))
    by_cat = _most(sold.join(p, "product_id"), ["_cat"], "supplier_id", "_n", "_by_category")
    every = known.join(sold.groupBy("supplier_id").agg(F.sum("_n").alias("_n")), "supplier_id", "left").fillna(0, ["_n"])
    overall = every.agg(F.min(F.struct((-F.col("_n")).alias("_n"), "supplier_id"))["supplier_id"].alias("_overall"))
    return (p.join(_most(sold, ["product_id"], "supplier_id", "_n", "_by_product"), "product_id", "left")
            .join(by_cat, "_cat", "left").crossJoin(F.broadcast(overall))  # one-row relation
            .select("product_id", F.coalesce("_by_product", "_by_category", "_overall").alias("supplier_id")))


# ----------------------------------------------------------------- M-05 product cost

def product_cost(products: DataFrame, items_status: DataFrame, wholesale: DataFrame, quantities: DataFrame) -> DataFrame:
    """M-05: reference price (delivered mean, else overall mean, else the
    category median, else the global median) x a cost ratio.

    The ratio is the wholesale value of the units sold over the money they
    were sold for, of the product, else of its category, else of all.
    """
    price = F.col("price")  # exact decimal sums, divided in double
    dprice = F.when(F.col("order_status") == "delivered", price)
    per = items_status.groupBy("product_id").agg(
        (F.sum(price).cast("double") / F.count(price)).alias("all_avg"),
        (F.sum(dprice).cast("double") / F.count(dprice)).alias("delivered_avg"), F.sum(price).alias("_money"))
    units = quantities.groupBy("product_id").agg(F.sum("quantity").alias("_units"))
    base = (products.select("product_id", "product_category_name").join(per, "product_id", "left")
            .join(wholesale.select("product_id", "wholesale_price"), "product_id", "left").join(units, "product_id", "left")
            .withColumn("_ref", F.coalesce("delivered_avg", "all_avg"))
            .withColumn("_worth", F.when(F.col("_money").isNotNull(), F.col("wholesale_price") * F.col("_units"))))
    base = stored(base, "product_prices")  # one row a product, read five times: the items are summed once
    # exact medians from counted values: no category's prices are buffered in one task
    cat_med = exact_medians(base.withColumnRenamed("product_category_name", "_cat"), ["_cat"],
                            {"_cat_med": "_ref"})
    glob = exact_medians(base, [], {"_glob_med": "_ref"}, bounded_groups=True)

    def share(worth, money) -> Column:
        return worth.cast("double") / F.nullif(money.cast("double"), F.lit(0.0))
    paid = F.when(F.col("_worth").isNotNull(), F.col("_money"))
    cat_ratio = base.groupBy(F.col("product_category_name").alias("_cat2")).agg(share(F.sum("_worth"), F.sum(paid)).alias("_cat_ratio"))
    glob_ratio = base.agg(share(F.sum("_worth"), F.sum(paid)).alias("_glob_ratio"))
    out = (base.join(cat_med, base.product_category_name.eqNullSafe(cat_med._cat), "left")
           .join(cat_ratio, base.product_category_name.eqNullSafe(cat_ratio._cat2), "left")
           .crossJoin(F.broadcast(glob)).crossJoin(F.broadcast(glob_ratio))  # one-row relations
           .select("product_id", F.coalesce("_ref", "_cat_med", "_glob_med").alias("reference_price"),
                   round_half_up(F.coalesce(share(F.col("_worth"), F.col("_money")), "_cat_ratio", "_glob_ratio"), 4).alias("cost_ratio")))
    return out.select("product_id",
                      round_half_up(F.col("reference_price") * F.col("cost_ratio"), 2).alias("estimated_unit_cost"),
                      "cost_ratio")


# ----------------------------------------------------------------- M-06..M-09 plans

def delivered_store_orders(orders_geo: DataFrame, assignment: DataFrame) -> DataFrame:
    return (orders_geo.filter(F.col("order_status") == "delivered")
            .join(assignment.select("order_id", "store_id"), "order_id", "left")
            .withColumn("month", F.trunc("order_purchase_timestamp", "MM")))


def monthly_actuals(delivered: DataFrame) -> DataFrame:
    """M-06: delivered sales, freight and distinct orders per month and store."""
    return delivered.groupBy("month", "store_id").agg(
        F.sum("gross_order_value").alias("actual_sales"), F.sum("freight_value").alias("actual_freight"),
        F.count("order_id").alias("actual_orders"))  # one row per order


def store_month_skeleton(delivered: DataFrame, stores: DataFrame, actuals: DataFrame) -> DataFrame:
    """M-07: every store in every month from the first to the last delivered
    month, actuals zero-filled.  Months come from ``sequence`` on each store
    row (stores are a bounded list), not from a cross join."""
    span = delivered.agg(F.min("month").alias("_first"), F.max("month").alias("_last"))
    sk = (stores.select("store_id").crossJoin(F.broadcast(span))  # one-row relation
          .select("store_id", F.explode(F.sequence("_first", "_last", F.expr("interval 1 month"))).alias("month")))
    return (sk.join(actuals, ["month", "store_id"], "left")
            .select("month", "store_id",
                    F.coalesce(F.col("actual_sales").cast("double"), F.lit(0.0)).alias("actual_sales"),
                    F.coalesce(F.col("actual_freight").cast("double"), F.lit(0.0)).alias("actual_freight"),
                    F.coalesce("actual_orders", F.lit(0)).alias("actual_orders")))


def store_aov(delivered: DataFrame) -> DataFrame:
    g = F.col("gross_order_value")
    return delivered.groupBy("store_id").agg((F.sum(g).cast("double") / F.count(g)).alias("aov"))


def plan_store_months(skeleton: DataFrame, aov: DataFrame, f: Policy = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """M-08: monthly budget and target per store.

    The budget is the store's mean sales (and freight) of the months before;
    without sales there, one order of its usual value and the chain's freight
    share.  The window holds one store's months, a list bounded by the
    calendar.
    """
    past = Window.partitionBy("store_id").orderBy("month").rowsBetween(-f.past_months, -1)
    sales, freight = F.col("actual_sales").cast("decimal(20,2)"), F.col("actual_freight").cast("decimal(20,2)")
    chain = skeleton.agg(F.coalesce(F.sum(freight).cast("double") / F.nullif(F.sum(sales).cast("double"), F.lit(0.0)), F.lit(0.0)).alias("_share"))
    s = (skeleton.join(F.broadcast(aov), "store_id", "left").crossJoin(F.broadcast(chain))  # store list, one-row relation
         .withColumn("_aov", F.greatest(F.coalesce("aov", F.lit(f.default_aov)), F.lit(1.0)))
         .withColumn("_sales", F.sum(sales).over(past)).withColumn("_freight", F.sum(freight).over(past))
         .withColumn("_months", F.count(F.lit(1)).over(past)))
    has = F.coalesce(F.col("_sales") > 0, F.lit(False))
    s = s.withColumn("_sb", F.when(has, F.col("_sales").cast("double") / F.col("_months")).otherwise(F.col("_aov")))
    s = (s.withColumn("_fb", F.when(has, F.col("_freight").cast("double") / F.col("_months")).otherwise(F.col("_sb") * F.col("_share")))
         .withColumn("_cents", F.round(F.col("_sb").cast("decimal(38,10)"), 2).cast("decimal(20,2)")))
    rate = lambda x: F.lit(f"{x:.4f}").cast("decimal(10,4)")
    s = s.withColumn("_st", F.round(F.col("_cents") * rate(1 + f.target_uplift), 2))  # of the rounded budget, in exact decimals
    budgets = s.select(F.col("month").alias("budget_month"), "store_id",
                       round_half_up("_sb", 2).alias("sales_budget"), round_half_up("_fb", 2).alias("freight_budget"),
                       F.round(F.col("_cents") * rate(f.operating_rate), 2).cast("double").alias("operating_cost_budget"))
    targets = s.select(F.col("month").alias("target_month"), "store_id",
                       F.col("_st").cast("double").alias("sales_target"),
                       F.greatest(F.lit(1), F.ceil(F.col("_st").cast("double") / F.col("_aov"))).cast("int").alias("order_target"),
                       F.lit(f.margin_target).alias("margin_target_pct"))
    return budgets, targets


def allocate_marketing(skeleton: DataFrame, promotions: DataFrame, channels: DataFrame, assignment: DataFrame,
                       orders: DataFrame) -> DataFrame:
    """M-09: marketing spend per plan month, store and channel: the price
    promotions of the orders that a channel brought to a store in the month
    (orders of any status; months outside the plan are not planned for).
    Promotions are summed per order before the joins."""
    per = promotions.groupBy("order_id").agg(F.sum("amount").alias("_amount"))
    spent = (per.join(channels.select("order_id", "channel"), "order_id").join(assignment.select("order_id", "store_id"), "order_id")
             .join(orders.select("order_id", F.trunc("order_purchase_timestamp", "MM").alias("month")), "order_id")
             .groupBy("month", "store_id", "channel").agg(F.sum("_amount").alias("_spend")))
    grid = skeleton.select("month", "store_id", F.explode(F.array(*[F.lit(c) for c in CHANNELS])).alias("channel"))
    return (grid.join(spent, ["month", "store_id", "channel"], "left")
            .select("month", "store_id", "channel", round_half_up(F.coalesce(F.col("_spend").cast("double"), F.lit(0.0)), 2).alias("spend")))


# ----------------------------------------------------------------- M-10..M-12 inventory

def delivered_items(items_status: DataFrame, assignment: DataFrame, orders: DataFrame) -> DataFrame:
    """Delivered items with their store, month and day of sale, and the month their replacement was shipped.
    ``orders`` is joined where the items lack the moment of purchase."""
    at = "order_purchase_timestamp"
    known = [at] if at in items_status.columns else []
    items = items_status.filter(F.col("order_status") == "delivered").select("order_id", "product_id", "shipping_limit_date", *known)
    items = items.join(assignment.select("order_id", "store_id"), "order_id", "left")
    if not known:
        items = items.join(orders.select("order_id", at), "order_id", "left")
    return (items.withColumn("snapshot_month", F.trunc("order_purchase_timestamp", "MM"))
            .withColumn("receipt_month", F.trunc("shipping_limit_date", "MM")))


def stocked_products(d_items: DataFrame, f: Policy = DEFAULT) -> DataFrame:
    """Products with at least ``min_product_sales`` delivered item rows, and
    their sales; the inventory chain carries every one of them."""
    return (d_items.groupBy("product_id").agg(F.count(F.lit(1)).alias("sales"))
            .filter(F.col("sales") >= f.min_product_sales))


def eligible_products(stocked: DataFrame, top: int) -> DataFrame:
    """M-10: the ``top`` best sellers of the stocked products (a top-k report)."""
    return stocked.orderBy(F.desc("sales"), "product_id").limit(top).select("product_id")


def monthly_units(d_items: DataFrame, stocked: DataFrame) -> DataFrame:
    """M-11: units sold per month, store and product."""
    return (d_items.join(stocked.select("product_id"), "product_id", "left_semi")
            .groupBy("snapshot_month", "store_id", "product_id").agg(F.count(F.lit(1)).cast("int").alias("sold_qty")))


def stock_movements(d_items: DataFrame, stocked: DataFrame) -> DataFrame:
    """(store_id, product_id, month, sold, received, last_sale): units sold and
    shipped in per month, and the day of the month's last sale; one partial
    aggregate over the stocked products' items."""
    moves = F.array(F.struct(F.col("snapshot_month").alias("month"), F.lit(1).alias("sold"), F.lit(0).alias("received"),
                             F.dayofmonth("order_purchase_timestamp").alias("day")),
                    F.struct(F.col("receipt_month").alias("month"), F.lit(0).alias("sold"), F.lit(1).alias("received"),
                             F.lit(None).cast("int").alias("day")))
    return (d_items.join(stocked.select("product_id"), "product_id", "left_semi")
            .select("store_id", "product_id", F.explode(moves).alias("x")).select("store_id", "product_id", "x.*").where("month IS NOT NULL")
            .groupBy("store_id", "product_id", "month")
            .agg(F.sum("sold").alias("sold"), F.sum("received").alias("received"), F.max("day").alias("last_sale")))


def stock_course(movements: DataFrame) -> DataFrame:
    """Per (store, product) and month with a movement, from the pair's first
    sale on: opening, received, sold and closing units and the month of the
    next movement.

    opening + received - sold = closing; the units shipped in a month are
    received, and more where they would leave the shelf short, so the closing
    stock is max(opening + shipped - sold, 0): the running sum x of first stock
    and movements, lifted by how far it has been below zero so far.  The
    reorder point is a usual month's sale, the first opening stock that and
    what was shipped before.  The windows hold one pair's months, a list
    bounded by the calendar.
    """
    pair = Window.partitionBy("store_id", "product_id")
    course = pair.orderBy("month")
    upto = course.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    month, sold, zero = F.col("month"), F.coalesce("sold", F.lit(0)).cast("long"), F.lit(0).cast("long")
    sale = F.when(F.col("sold") > 0, month)
    shipped = F.coalesce("received", F.lit(0)).cast("long")
    m = (movements.withColumn("_first", F.min(sale).over(pair)).where("_first IS NOT NULL")
         .withColumn("_reorder", F.ceil(F.greatest(F.try_divide(F.sum("sold").over(pair).cast("double"), F.count(sale).over(pair)), F.lit(1.0))))
         .withColumn("_open0", F.col("_reorder") + F.sum(F.when(month < F.col("_first"), shipped).otherwise(zero)).over(pair))
         .where(month >= F.col("_first")))
    m = m.withColumn("_x", F.col("_open0") + F.sum(shipped - sold).over(upto))
    m = m.withColumn("_closing", F.col("_x") + F.greatest(zero, F.max(-F.col("_x")).over(upto)))
    m = m.withColumn("_opening", F.coalesce(F.lag("_closing").over(course), "_open0"))
    out_of_stock = (sold > 0) & (F.col("_closing") == 0)
    days = F.when(out_of_stock, F.dayofmonth(F.last_day("month")) - F.col("last_sale")).otherwise(F.lit(0))
    return m.select(month.alias("snapshot_month"), "store_id", "product_id", F.col("_opening").cast("int").alias("opening_stock_qty"),
                    (F.col("_closing") - F.col("_opening") + sold).cast("int").alias("received_qty"), sold.cast("int").alias("sold_qty"),
                    F.col("_closing").cast("int").alias("closing_stock_qty"), F.col("_reorder").cast("int").alias("reorder_point"),
                    days.cast("int").alias("stockout_days"), F.lead("month").over(course).alias("next_month"))


def inventory_runs(course: DataFrame) -> DataFrame:
    """The course with ``months`` = the months until the next movement or past
    the global last month of sale, in which nothing moves but in the first."""
    last = course.agg(F.max(F.when(F.col("sold_qty") > 0, F.col("snapshot_month"))).alias("_last"))
    index = lambda c: F.year(c) * 12 + F.month(c)
    until = F.least(index("next_month"), index("_last") + 1)  # no next movement: up to the last month
    return (course.crossJoin(F.broadcast(last)).where(F.col("snapshot_month") <= F.col("_last"))  # one-row relation
            .withColumn("months", (until - index("snapshot_month")).cast("int")).drop("next_month", "_last"))


def inventory_months(runs: DataFrame) -> DataFrame:
    """The months with a row of inventory, once each: runs that start in the
    same month and are as long are one before they are unfolded."""
    return unfold_months(runs.select("snapshot_month", "months").distinct()).distinct()


def roll_inventory(movements: DataFrame) -> DataFrame:
    """M-12: month-by-month stock roll-forward per (store, product), from the
    pair's first sale to the global last one.  A month that closes with an
    empty shelf is out of stock from the day after its last sale.  Only months
    with a movement are computed (windows over them); the quiet months between
    are unfolded from the month before."""
    return unfold_months(inventory_runs(stock_course(movements)))


# ----------------------------------------------------------------- M-13..M-22 validation

def describe(df: DataFrame, col: str, percentiles: tuple[float, ...], metric: str | None = None,
             scale: int = 2) -> DataFrame:
    """pandas-style describe of one column as one row: count, mean, sample
    std, min, exact percentiles, max (rounded half-up)."""
    return describe_many(df, {metric or col: col}, percentiles, scale)


def describe_many(df: DataFrame, columns: dict[str, str], percentiles: tuple[float, ...],
                  scale: int = 2) -> DataFrame:
    """:func:`describe` of several columns of one frame, one row per column
    (``metric`` = the key).  The moments are one partial aggregate; the exact
    percentiles of all columns come from one global sort (no single-task
    value buffer), looked up with a broadcast of one row per percentile."""
    names = list(columns)
    aggs = []
    for i, n in enumerate(names):
        x = F.col(columns[n]).cast("double")
        aggs += [F.count(x).alias(f"c{i}"), (F.sum(F.col(columns[n])).cast("double") / F.count(x)).alias(f"a{i}"),
                 F.stddev_samp(x).alias(f"s{i}"), F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}")]
    moments = df.agg(*aggs).select(F.explode(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(f"c{i}").alias("count"), F.col(f"a{i}").alias("_mean"),
                 F.col(f"s{i}").alias("_std"), F.col(f"l{i}").alias("_min"), F.col(f"h{i}").alias("_max"))
        for i, n in enumerate(names)])).alias("_m")).select("_m.*")
    q = exact_percentiles(df, [], {n: F.col(c).cast("double") for n, c in columns.items()}, percentiles,
                          bounded_groups=True)
    # one row per column on both sides; a column without values keeps NULL percentiles
    row = moments.join(F.broadcast(q), "metric", "left")
    return row.select("metric", "count",
                      round_half_up("_mean", scale).alias("mean"), round_half_up("_std", scale).alias("std"),
                      round_half_up("_min", scale).alias("min"),
                      *[round_half_up(F.col(f"q{i}"), scale).alias(f"p{int(round(p * 100)):02d}")
                        for i, p in enumerate(percentiles)],
                      round_half_up("_max", scale).alias("max"))


def _flags(row: DataFrame, names: list[str]) -> DataFrame:
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("passed"))
                                         for n in names])).alias("x")).select("x.*")


def validate_enterprise(orders: DataFrame, products: DataFrame, stores: DataFrame, assignment: DataFrame,
                        suppliers: DataFrame, mapping: DataFrame, cost: DataFrame, inventory: DataFrame,
                        budgets: DataFrame, targets: DataFrame, marketing: DataFrame) -> DataFrame:
    """M-13: structural checks of the generated tables -> (check_name, passed);
    one aggregate per table, and one anti join per subset check, whose child
    keys are distinct first."""
    total = F.count(F.lit(1))

    def different(c: str) -> Column:
        return F.countDistinct(c)

    def lost(df: DataFrame, c: str, ref: DataFrame, name: str) -> DataFrame:
        keys = df.select(F.col(c).alias("_k")).where("_k IS NOT NULL").distinct()
        return keys.join(ref.select(F.col(c).alias("_k")), "_k", "left_anti").agg(total.alias(name))
    moved = F.col("opening_stock_qty") + F.col("received_qty") - F.col("sold_qty")
    parts = [stores.agg(total.alias("stores"), different("store_id").alias("stores_d")), orders.agg(total.alias("orders")),
             assignment.agg(total.alias("asg"), different("order_id").alias("asg_d"), F.count_if(F.col("store_id").isNull()).alias("asg_null")),
             lost(assignment, "store_id", stores, "asg_orphan"),
             suppliers.agg(total.alias("sup"), different("supplier_id").alias("sup_d")), products.agg(total.alias("products")),
             mapping.agg(total.alias("map"), different("product_id").alias("map_d")), lost(mapping, "supplier_id", suppliers, "map_orphan"),
             cost.agg(total.alias("cost"), different("product_id").alias("cost_d"), F.count_if(F.col("estimated_unit_cost") < 0).alias("cost_neg"),
                      F.count_if(~F.col("cost_ratio").between(0, 1)).alias("ratio_bad")),
             inventory.agg(F.count_if(F.col("closing_stock_qty") < 0).alias("inv_neg"), F.count_if(moved != F.col("closing_stock_qty")).alias("inv_bal")),
             budgets.agg(total.alias("bud")), targets.agg(total.alias("tgt")), marketing.agg(total.alias("mkt"))]
    row = parts[0]
    for p in parts[1:]:
        row = row.crossJoin(p)  # one-row aggregates
    c = F.col
    checks = {
        "stores_unique": c("stores") == c("stores_d"),
        "all_orders_assigned": c("asg") == c("orders"),
        "assignment_order_unique": c("asg") == c("asg_d"),
        "assignment_store_not_null": c("asg_null") == 0,
        "assignment_store_in_stores": c("asg_orphan") == 0,
        "suppliers_unique": c("sup") == c("sup_d"),
        "mapping_covers_products": c("map") == c("products"),
        "mapping_product_unique": c("map") == c("map_d"),
        "mapping_supplier_in_suppliers": c("map_orphan") == 0,
        "cost_covers_products": c("cost") == c("products"),
        "cost_product_unique": c("cost") == c("cost_d"),
        "cost_nonnegative": c("cost_neg") == 0,
        "cost_ratio_between_0_and_1": c("ratio_bad") == 0,
        "inventory_closing_nonnegative": c("inv_neg") == 0,
        "inventory_balances": c("inv_bal") == 0,
        "budget_target_rows_equal": c("bud") == c("tgt"),
        "marketing_rows_five_per_plan_row": c("mkt") == c("bud") * len(CHANNELS),
    }
    return _flags(row.select(*[v.alias(k) for k, v in checks.items()]), list(checks))


def assignment_mix(assignment: DataFrame) -> DataFrame:
    """M-15: orders per assignment method with share."""
    g = assignment.groupBy("assignment_method").agg(F.count(F.lit(1)).alias("orders"))
    tot = g.agg(F.sum("orders").alias("_t"))
    from ..functions.columns import pct
    return g.crossJoin(F.broadcast(tot)).select("assignment_method", "orders", pct("orders", "_t").alias("pct"))


def store_distribution(delivered: DataFrame, stores: DataFrame) -> DataFrame:
    """M-16: delivered orders and sales per store with share."""
    from ..functions.columns import pct
    g = delivered.groupBy("store_id").agg(F.count("order_id").alias("delivered_orders"),  # one row per order
                                          F.sum("gross_order_value").alias("_g"))
    tot = g.agg(F.sum("_g").alias("_t"))
    return (g.join(F.broadcast(stores.select("store_id", "state", "store_format")), "store_id", "left")
            .crossJoin(F.broadcast(tot))
            .select("store_id", "state", "store_format", "delivered_orders",
                    F.round("_g", 2).cast("double").alias("gross_order_value"), pct("_g", "_t").alias("sales_share_pct")))


def supplier_distribution(suppliers: DataFrame, mapping: DataFrame) -> DataFrame:
    """M-17: describe of supplier attributes and of products per supplier."""
    q = (0.25, 0.5, 0.75)
    per = mapping.groupBy("supplier_id").agg(F.count(F.lit(1)).alias("products_per_supplier"))
    attrs = describe_many(suppliers, {c: c for c in ("supplier_rating", "standard_lead_time_days",
                                                    "contractual_fill_rate_pct")}, q)
    return attrs.unionByName(describe(per, "products_per_supplier", q))


def margin_distribution(cost: DataFrame, d_items: DataFrame) -> DataFrame:
    """M-18: cost-ratio summary and estimated product margin % distribution."""
    per = d_items.groupBy("product_id").agg((F.sum("price") / F.count("price")).cast("double").alias("_avg"))
    m = (per.join(cost, "product_id", "left")
         .select((F.lit(100.0) * (F.col("_avg") - F.col("estimated_unit_cost").cast("double")) / F.col("_avg"))
                 .alias("estimated_margin_pct")))
    q = (0.05, 0.25, 0.5, 0.75, 0.95)
    return describe(cost, "cost_ratio", q, scale=4).unionByName(describe(m, "estimated_margin_pct", q))


def inventory_plausibility(inventory: DataFrame) -> DataFrame:
    """M-19: balance, negatives, stockout rate, and combinations reaching the last month."""
    from ..functions.columns import pct
    last = inventory.agg(F.max("snapshot_month").alias("_last"))
    combos = (inventory.groupBy("store_id", "product_id").agg(F.max("snapshot_month").alias("_m"))
              .crossJoin(F.broadcast(last))
              .agg(F.count(F.lit(1)).alias("store_product_combinations"),
                   F.count_if(F.col("_m") == F.col("_last")).cast("long").alias("combinations_at_final_month")))
    c = F.col
    base = inventory.agg(
        F.count(F.lit(1)).alias("inventory_rows"), F.countDistinct("product_id").alias("distinct_products"),
        F.countDistinct("store_id").alias("distinct_stores"),
        F.count_if(c("opening_stock_qty") + c("received_qty") - c("sold_qty") != c("closing_stock_qty"))
        .cast("long").alias("balance_errors"),
        F.count_if(c("closing_stock_qty") < 0).cast("long").alias("negative_closing_rows"),
        F.count_if(c("stockout_days") > 0).cast("long").alias("stockout_rows"),
        pct(F.count_if(c("stockout_days") > 0), F.count(F.lit(1))).alias("stockout_row_rate_pct"),
        F.max("snapshot_month").alias("latest_inventory_month"))
    return base.crossJoin(combos)


def stockout_days_distribution(inventory: DataFrame) -> DataFrame:
    """M-19 (second part)."""
    return describe(inventory, "stockout_days", (0.5, 0.75, 0.9, 0.95, 0.99))


def plan_attainment_distribution(budgets: DataFrame, targets: DataFrame, delivered: DataFrame) -> DataFrame:
    """M-20: actual as % of budget and of target over store-months with sales."""
    a = delivered.groupBy("month", "store_id").agg(F.sum("gross_order_value").alias("_a"))
    p = (budgets.join(targets, (budgets.budget_month == targets.target_month) & (budgets.store_id == targets.store_id))
         .select(budgets.budget_month.alias("month"), budgets.store_id, "sales_budget", "sales_target")
         .join(a, ["month", "store_id"], "left").filter(F.col("_a") > 0))
    x = p.select((F.lit(100.0) * F.col("_a").cast("double") / F.col("sales_budget").cast("double")).alias("actual_pct_budget"),
                 (F.lit(100.0) * F.col("_a").cast("double") / F.col("sales_target").cast("double")).alias("actual_pct_target"))
    q = (0.05, 0.25, 0.5, 0.75, 0.95)
    return describe_many(x, {"actual_pct_budget": "actual_pct_budget", "actual_pct_target": "actual_pct_target"}, q)


def marketing_plausibility(marketing: DataFrame, delivered: DataFrame) -> DataFrame:
    """M-21: marketing spend as % of sales over store-months with sales."""
    a = delivered.groupBy("month", "store_id").agg(F.sum("gross_order_value").alias("_a"))
    m = marketing.groupBy("month", "store_id").agg(F.sum("spend").alias("_m"))
    x = a.join(m, ["month", "store_id"], "left").select(
        (F.lit(100.0) * F.col("_m").cast("double") / F.col("_a").cast("double")).alias("marketing_pct_sales"))
    return describe(x, "marketing_pct_sales", (0.05, 0.25, 0.5, 0.75, 0.95))


def run_assertions(stores: DataFrame, orders: DataFrame, assignment: DataFrame, products: DataFrame,
                   mapping: DataFrame, cost: DataFrame, inventory: DataFrame, budgets: DataFrame, targets: DataFrame,
                   marketing: DataFrame, f: Policy = DEFAULT) -> DataFrame:
    """M-22: the named pass/fail assertions -> (assertion, status)."""
    plaus = inventory_plausibility(inventory)
    c = F.col
    row = (stores.agg(F.count(F.lit(1)).alias("ns"))
           .crossJoin(orders.agg(F.count(F.lit(1)).alias("no")))
           .crossJoin(assignment.agg(F.count(F.lit(1)).alias("na"), F.count_if(c("store_id").isNull()).alias("na_null")))
           .crossJoin(products.agg(F.count(F.lit(1)).alias("np")))
           .crossJoin(mapping.agg(F.countDistinct("product_id").alias("nm")))
           .crossJoin(cost.agg(F.countDistinct("product_id").alias("nc"),
                               F.count_if(~c("cost_ratio").between(0, 1)).alias("bad_ratio")))
           .crossJoin(plaus)
           .crossJoin(budgets.agg(F.count(F.lit(1)).alias("nb")))
           .crossJoin(targets.agg(F.count(F.lit(1)).alias("nt")))
           .crossJoin(marketing.agg(F.count(F.lit(1)).alias("nmk"))))
    rate = c("stockout_rows") / c("inventory_rows")
    checks = {  # fixed names
        f"{f.n_stores} stores": c("ns") == f.n_stores,
        "all orders assigned": (c("na") == c("no")) & (c("na_null") == 0),
        "all products mapped to supplier": c("nm") == c("np"),
        "all products have cost": c("nc") == c("np"),
        "cost ratios between 0 and 1": c("bad_ratio") == 0,
        "inventory balances": c("balance_errors") == 0,
        "no negative closing inventory": c("negative_closing_rows") == 0,
        "inventory contains meaningful stockouts": (rate >= 0.01) & (rate <= 0.20),
        "inventory combinations persist to final month":
            c("combinations_at_final_month") == c("store_product_combinations"),
        "budget and target grains align": c("nb") == c("nt"),
        "five marketing channels per plan row": c("nmk") == c("nb") * len(CHANNELS),
    }
    flags = row.select(*[F.when(v, "PASS").otherwise("FAIL").alias(k) for k, v in checks.items()])
    return flags.select(F.explode(F.array(*[F.struct(F.lit(k).alias("assertion"), F.col(f"`{k}`").alias("status"))
                                            for k in checks])).alias("x")).select("x.*")


def raise_if_failed(result: DataFrame, status_col: str = "status", name_col: str = "assertion") -> None:
    """Driver-side verdict over a small result (one row per assertion)."""
    failed = [r[name_col] for r in result.filter(F.col(status_col) != "PASS").collect()]
    if failed:
        raise RuntimeError("Validation failed: " + ", ".join(failed))
