"""What new rows change in the sums behind the KPI tables.

Every table of the star given here has a column ``_known``: whether the row was there before. Rows
are only added, so an order has its values now and, from its known rows, those it had before. Both
are found in one pass: facts are brought to one row per order, lines meet them once, and each sum
adds the value now less the value before. With nothing known that is the sum itself.

All sums are linear in orders or lines, so orders that did not change need not be left out first;
they add nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersight.operators.marts import CATEGORY_SUMS, KPI_SUMS, delivery_months, kpi_sums
from ordersight.plans.per_order import NOT_COMPLETED, copies
from ordersight.plans.shared_store import stored_while
from ordersight.star import StarSchema

KNOWN = "_known"
#: Columns of an order that new rows of other tables can change; ``<name>_before`` holds what was known.
TOTALS = ["found", "item_rows", "paid", "payment_rows", "valued_rows", "review_rows", "scored_rows", "score_sum"]


def _per_order(df: DataFrame, rows: str, value: str | None = None, total: str = "", valued: str = "") -> DataFrame:
    """order_id, how many rows it has and, of a column, the sum and number of values; each now and before."""
    found = []
    for suffix, wanted in (("", F.lit(True)), ("_before", F.col(KNOWN))):
        found.append(F.count_if(wanted).alias(rows + suffix))
        if value:
            seen = F.when(wanted, F.col(value))
            found += [F.sum(seen).alias(total + suffix), F.count(seen).alias(valued + suffix)]
    return df.groupBy("order_id").agg(*found)


def order_changes(star: StarSchema) -> DataFrame:
    """A row per order: what the KPIs need of it, and :data:`TOTALS` now and before.

    ``paid_for``, ``bought`` (and completed) and ``counted`` (with lines too) tell for now and before what the
    order counts for, ``changed`` whether anything is not what it was.
    """
    accounts = star.dim_customers.groupBy("customer_id").agg(F.bool_or(KNOWN).alias("found_before"), F.lit(True).alias("found"))
    orders = star.fact_orders.select(
        "order_id",
        "customer_id",
        F.col(KNOWN).alias("known"),
        F.col("order_purchase_timestamp").alias("day"),
        F.coalesce(~F.col("order_status").isin(*NOT_COMPLETED), F.lit(False)).alias("done"),
        (F.col("order_status") == "canceled").alias("canceled"),
        F.col("order_delivered_customer_date").isNotNull().alias("delivered"),
        (F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")).alias("on_time"),
    )
    joined = (
        orders.join(accounts, "customer_id", "left")
        .join(_per_order(star.fact_order_payments, "payment_rows", "payment_value", "paid", "valued_rows"), "order_id", "left")
        .join(_per_order(star.fact_order_items, "item_rows"), "order_id", "left")
        .join(_per_order(star.fact_order_reviews, "review_rows", "review_score", "score_sum", "scored_rows"), "order_id", "left")
    )
    same, flags = F.col("known"), {}
    for name in TOTALS:
        same = same & F.col(name).eqNullSafe(F.col(f"{name}_before"))
    for suffix, there in (("", F.lit(True)), ("_before", F.col("known"))):
        paid_for = there & F.coalesce(F.col(f"found{suffix}") & (F.col(f"payment_rows{suffix}") > 0), F.lit(False))
        lines = F.coalesce(F.col(f"item_rows{suffix}") > 0, F.lit(False))
        flags |= {f"paid_for{suffix}": paid_for, f"bought{suffix}": paid_for & F.col("done"), f"counted{suffix}": paid_for & lines}
    return joined.select("*", (~same).alias("changed"), *[value.alias(name) for name, value in flags.items()])


def _accounts(star: StarSchema) -> DataFrame:
    return star.dim_customers.select("customer_id", "customer_unique_id")


def _by_person(star: StarSchema, by_account: DataFrame, *keys: str) -> DataFrame:
    """Sums by account (and ``keys``) as sums by person, so that a busy account meets the customers as one row."""
    sums = [(F.max if name == "last_purchase_date" else F.sum)(name).alias(name) for name in by_account.columns if name not in ("customer_id", *keys)]
    return by_account.join(_accounts(star), "customer_id").groupBy(*keys, "customer_unique_id").agg(*sums)


def person_kpi_changes(star: StarSchema, orders: DataFrame) -> DataFrame:
    """As :func:`ordersight.operators.marts.person_kpis`."""
    fixed, totals = ["customer_id", "canceled", "delivered", "on_time"], [name for name in TOTALS if name not in ("found", "item_rows")]
    now = orders.where("changed AND counted").select(*fixed, F.lit(1).cast("bigint").alias("sign"), "item_rows", *totals)
    # Every sum but the orders is a multiple of the lines, so negative lines take away what was added before.
    before = orders.where("changed AND counted_before").select(
        *fixed, F.lit(-1).cast("bigint").alias("sign"), (-F.col("item_rows_before")).alias("item_rows"), *[F.col(f"{name}_before").alias(name) for name in totals]
    )
    sums = kpi_sums() | {"orders": F.col("sign")}
    return _by_person(star, now.unionAll(before).groupBy("customer_id").agg(*[F.sum(sums[name]).alias(name) for name in KPI_SUMS]))


def _purchases(orders: DataFrame) -> DataFrame:
    """customer_id, day, sign and what was paid, of completed orders with a payment."""
    now = orders.where("changed AND bought").select("customer_id", "day", F.lit(1).cast("bigint").alias("sign"), "paid", "valued_rows")
    before = orders.where("changed AND bought_before").select(
        "customer_id", "day", F.lit(-1).cast("bigint").alias("sign"), (-F.col("paid_before")).alias("paid"), (-F.col("valued_rows_before")).alias("valued_rows")
    )
    return now.unionAll(before)


def buyer_changes(star: StarSchema, orders: DataFrame) -> DataFrame:
    """As :func:`ordersight.operators.rfm.buyers`."""
    by_account = _purchases(orders).groupBy("customer_id").agg(
        F.max(F.when(F.col("sign") > 0, F.col("day"))).alias("last_purchase_date"), F.sum("sign").alias("frequency_orders"), F.sum("paid").alias("monetary")
    )
    return _by_person(star, by_account)


def person_month_changes(star: StarSchema, orders: DataFrame) -> DataFrame:
    """As :func:`ordersight.operators.marts.person_months`."""
    by_account = _purchases(orders).groupBy(F.trunc("day", "month").alias("month"), "customer_id").agg(
        F.sum("sign").alias("orders"), F.sum("paid").alias("paid"), F.sum("valued_rows").alias("valued_rows")
    )
    return _by_person(star, by_account, "month")


def line_changes(star: StarSchema, orders: DataFrame) -> DataFrame:
    """A row per line of an order that is completed or counted in the general KPIs.

    order_id, product_id, seller_id; ``counted`` and, NULL unless the order is completed, :data:`CATEGORY_SUMS` with
    ``orders`` are changes; ``done`` and ``done_before`` tell whether the line was in a completed order.
    """
    by_id = orders.groupBy("order_id").agg(
        *[F.bool_or(f"paid_for{at}").cast("int").alias(f"paid_for{at}") for at in ("", "_before")],
        F.count_if("done").alias("times"),
        F.count_if(F.col("done") & F.col("known")).alias("times_before"),
        *[F.max(name + at).alias(name + at) for name in ("review_rows", "scored_rows", "score_sum") for at in ("", "_before")],
    )
    values = []
    for at in ("", "_before"):
        times = F.col(f"times{at}")
        values += [
            (times > 0).alias(f"done{at}"),
            (times * copies(F.col(f"review_rows{at}"))).alias(f"rows{at}"),
            (times * F.coalesce(f"score_sum{at}", F.lit(0))).alias(f"score{at}"),
            (times * F.coalesce(f"scored_rows{at}", F.lit(0))).alias(f"scored{at}"),
        ]
    by_id = by_id.select("order_id", "paid_for", "paid_for_before", *values)
    # Known lines come first, so the first line of a product in its order is the first of the known ones
    # too. The sort is the one the join by order needs.
    place = F.row_number().over(Window.partitionBy("order_id", "product_id").orderBy(F.desc(KNOWN)))
    lines = star.fact_order_items.select("order_id", "product_id", "seller_id", "price", KNOWN).repartition("order_id")
    lines = lines.withColumn("first", place == 1).join(by_id, "order_id").where("done OR paid_for = 1")

    def change(name: str) -> Column:
        return F.col(name) - F.when(F.col(KNOWN), F.col(f"{name}_before")).otherwise(0)

    was_done = F.col(KNOWN) & F.col("done_before")
    return lines.select(
        "order_id",
        "product_id",
        "seller_id",
        "price",
        "done",
        was_done.alias("done_before"),
        change("paid_for").alias("counted"),
        F.when(F.col("done"), F.when(F.col("first") & ~was_done, 1).otherwise(0)).alias("orders"),
        *[F.when(F.col("done"), change(name)).alias(to) for name, to in (("rows", "line_rows"), ("score", "score_sum"), ("scored", "scored_rows"))],
    ).withColumn("revenue", (F.col("price") * F.col("line_rows").cast("decimal(15,0)")).cast("decimal(38,2)")).drop("price")


def product_changes(lines: DataFrame) -> DataFrame:
    """Per product_id the sums of its category's KPIs, and ``lines`` in orders the general KPIs count."""
    sums = [F.sum(name).alias(name) for name in ("orders", *CATEGORY_SUMS)]
    return lines.groupBy("product_id").agg(F.sum("counted").alias("lines"), *sums)


def active_changes(lines: DataFrame, products: DataFrame) -> DataFrame:
    """seller_id, product_id, lines: a row per seller and one per product, the other column NULL.

    The general KPIs count sellers and products, not pairs of them, of which there are nearly as many as lines.
    """
    none = F.lit(None).cast("string")
    sellers = lines.where("counted <> 0").groupBy("seller_id").agg(F.sum("counted").alias("lines"))
    return sellers.select("seller_id", none.alias("product_id"), "lines").unionByName(
        products.where("lines <> 0").select(none.alias("seller_id"), "product_id", "lines")
    )


def category_changes(star: StarSchema, lines: DataFrame) -> DataFrame:
    """Per category the completed orders that hold one of its products and did not before."""
    categories = star.dim_products.where("product_category_name IS NOT NULL").select("product_id", F.col("product_category_name").alias("category"), KNOWN)
    held = lines.where("done").select("order_id", "product_id", "done_before").join(categories, "product_id")
    return (
        held.groupBy("category", "order_id")
        .agg(F.bool_or(F.col("done_before") & F.col(KNOWN)).alias("before"))
        .where("NOT before")
        .groupBy("category")
        .agg(F.count("*").alias("total_orders"))
    )


def last_day(star: StarSchema) -> DataFrame:
    return star.fact_orders.agg(F.count("*").alias("orders"), F.max("order_purchase_timestamp").alias("last_day"))


@contextmanager
def state_changes(star: StarSchema) -> Iterator[dict[str, DataFrame]]:
    """Changes of every sum that :mod:`ordersight.sources.mart_states` keeps."""
    # An order does not change after it was loaded, so what needs orders alone needs the new ones.
    new = star.replace(fact_orders=star.fact_orders.where(~F.col(KNOWN)))
    with ExitStack() as kept:
        orders = kept.enter_context(stored_while(order_changes(star)))
        lines = kept.enter_context(stored_while(line_changes(star, orders)))
        products = kept.enter_context(stored_while(product_changes(lines)))
        yield {
            "person_kpis": person_kpi_changes(star, orders),
            "seller_products": active_changes(lines, products),
            "person_months": person_month_changes(star, orders),
            "product_sums": products.where("orders IS NOT NULL").select("product_id", "orders", *CATEGORY_SUMS),
            "category_orders": category_changes(star, lines),
            "delivery_months": delivery_months(new),
            "buyers": buyer_changes(star, orders),
            "last_day": last_day(new),
        }
