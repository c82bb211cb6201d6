"""The spread plans against plain windows and joins on random, skewed data."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordersight.functions import percent, ratio, round_to, whole_percent
from ordersight.operators import anomaly, marts, ranking, rfm
from ordersight.plans.first_row import keep_first
from ordersight.plans.hot_groups import add_previous, add_ranks
from ordersight.plans.tiles import add_ntiles, rows_at
from tests.conftest import order, values


@pytest.fixture(scope="module")
def skewed(spark):
    """Rows of which a third belong to one group and many share a value."""
    rng = random.Random(7)
    rows = [
        (
            i,
            None if i % 50 == 0 else ("hot" if rng.random() < 0.34 else f"g{rng.randrange(9)}"),
            rng.randrange(6),
            None if rng.random() < 0.1 else Decimal(rng.randrange(40)) / 4,
            None if rng.random() < 0.1 else rng.randrange(30) / 7,
        )
        for i in range(3000)
    ]
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows, "id INT, grp STRING, day INT, amount DECIMAL(10,2), score DOUBLE"
    ).repartition(5)


@pytest.mark.parametrize(("partitions", "held"), [("3", 20_000), ("16", 40)])
def test_tiles_match_ntile(spark, skewed, partitions, held):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        measures = {"a": F.col("day"), "b": -F.coalesce("amount", F.lit(-1))}
        for size in (0, 1, 4, 5, 7, 3000):
            df = skewed.filter(F.col("id") < size)
            mine = add_ntiles(df, measures, "id", held=held)
            plain = df.select("id", *[F.ntile(5).over(Window.orderBy(value, "id")).alias(name) for name, value in measures.items()])
            assert sorted(values(mine, "id", "a", "b")) == sorted(values(plain, "id", "a", "b"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("max_rows", [0, 400])
@pytest.mark.parametrize("partitions", ["2", "16"])
def test_previous_and_ranks_match_windows(spark, skewed, max_rows, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        bounds = skewed.groupBy("grp").agg(F.count("*").alias("n"))
        previous = add_previous(
            skewed, "grp", ["day", "id"], {"prev": "amount", "prev_id": "id"}, bounds, max_rows
        )
        window = Window.partitionBy("grp").orderBy("day", "id")
        plain = skewed.select(
            "id", F.lag("amount").over(window).alias("prev"), F.lag("id").over(window).alias("prev_id")
        )
        assert sorted(values(previous, "id", "prev", "prev_id"), key=str) == sorted(values(plain), key=str)

        kinds = ["row", "rank", "dense"]
        measures = {name: (F.col(name), kinds) for name in ("day", "amount", "score")}
        names = [f"{measure}_{kind}" for measure in measures for kind in kinds] + ["group_rows"]
        spread = add_ranks(skewed, "grp", "id", measures, bounds, max_rows)
        plain = add_ranks(skewed, "grp", "id", measures, bounds)
        assert sorted(values(spread, "id", *names)) == sorted(values(plain, "id", *names))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("max_rows", [0, 400, 10_000])
def test_previous_is_lazy_and_cut_by_several_columns(spark, skewed, max_rows):
    """Days without a value, slices of equal days, no job before an action."""
    df = skewed.withColumn("day", F.when(F.col("id") % 11 > 0, F.col("day"))).withColumn("code", F.format_string("%05d", "id"))
    bounds = df.groupBy("grp").agg(F.count("*").alias("n"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "")
    mine = add_previous(df, "grp", ["day", "code"], {"prev": "amount"}, bounds, max_rows, [F.col("day"), F.substring("code", 1, 3)])
    assert not tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    window = Window.partitionBy("grp").orderBy(F.asc_nulls_last("day"), "code")
    plain = df.select("id", F.lag("amount").over(window).alias("prev"))
    assert sorted(values(mine, "id", "prev"), key=str) == sorted(values(plain), key=str)


def test_deliveries_join_the_facts_once(random_star):
    """Rows and summary read one exchange; the lines are read once more, for the sizes of the groups."""
    for operator in (ranking.seller_deliveries, ranking.seller_delivery_trend, ranking.seller_trend_summary):
        assert "ReusedExchange" in _executed(operator(random_star))


def test_keep_first_cuts_copies_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), "id")
    kept = keep_first(df, ["key"], ["id"])
    assert sorted(values(kept)) == [(0, 0), (1, 1), (2, 2)]
    plan = _executed(kept)
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_numbers(spark):
    row = spark.range(1).select(
        round_to(F.lit(1.005), 2).alias("a"),
        ratio(F.lit(1), F.lit(0)).alias("b"),
        percent(F.lit(1), F.lit(3)).alias("c"),
        whole_percent(F.lit(-61), F.lit(200)).alias("d"),
        whole_percent(F.lit(1), F.lit(0)).alias("e"),
    )
    assert values(row) == [(1.01, None, 33.33, -30.0, None)]


@pytest.fixture(scope="module")
def random_star(make_star):
    rng = random.Random(11)
    statuses = ["delivered", "delivered", "shipped", "canceled", "unavailable"]
    orders, items, payments, reviews = [], [], [], []
    for i in range(200):
        bought = date(2018, 1, 1) + timedelta(days=rng.randrange(120))
        received = bought + timedelta(days=rng.randrange(30)) if rng.random() < 0.8 else None
        orders.append(
            order(
                f"o{i}", f"c{rng.randrange(45)}", str(bought), rng.choice(statuses),
                str(received) if received else None, str(bought + timedelta(days=14)),
            )
        )
        for line in range(rng.randrange(4)):
            items.append((f"o{i}", line, f"p{rng.randrange(12)}", f"s{rng.randrange(5)}", rng.randrange(100), 1))
        for payment in range(rng.randrange(4)):
            payments.append((f"o{i}", payment, "card", 1, rng.randrange(100)))
        for review in range(rng.randrange(4)):
            reviews.append((f"r{i}-{review}", f"o{i}", rng.choice([1, 3, 5, None])))
    return make_star(
        customers=[(f"c{i}", f"u{i // 2}") for i in range(40)],
        products=[(f"p{i}", f"k{i % 3}" if i else None) for i in range(11)],
        orders=orders,
        items=items,
        payments=payments,
        reviews=reviews,
    )


def test_kpis_match_the_multiplied_join(random_star):
    star = random_star
    joined = (
        star.fact_orders.join(star.dim_customers, "customer_id")
        .join(star.fact_order_items, "order_id")
        .join(star.fact_order_payments, "order_id")
        .join(star.fact_order_reviews, "order_id", "left")
    )
    on_time = F.col("order_delivered_customer_date") <= F.col("order_estimated_delivery_date")
    expected = joined.select(
        F.count_distinct("order_id"),
        F.count_distinct("customer_unique_id"),
        F.count_distinct("seller_id"),
        F.count_distinct("product_id"),
        F.sum("payment_value").cast("double"),
        round_to(F.avg("payment_value"), 2),
        round_to(F.sum("payment_value") / F.count_distinct("customer_unique_id"), 2),
        percent(F.count_if(on_time), F.count("order_delivered_customer_date")),
        percent(F.count_if(F.col("order_status") == "canceled"), F.count("*")),
        round_to(F.avg("review_score"), 2),
    )
    assert values(marts.kpi_general(star)) == values(expected)


def test_product_totals_match_the_multiplied_join(random_star):
    star = random_star
    joined = (
        star.fact_order_items.join(star.fact_orders, "order_id")
        .filter(~F.col("order_status").isin("canceled", "unavailable"))
        .join(star.dim_products, "product_id")
        .join(star.fact_order_reviews, "order_id", "left")
    )
    sums = [
        F.sum("price").cast("double"),
        round_to(F.avg("price"), 2),
        round_to(F.avg("review_score"), 2),
    ]
    by_product = joined.groupBy("product_id").agg(
        F.count_distinct("order_id"), *sums, F.count_distinct("review_id")
    )
    mine = values(
        ranking.product_metrics(star),
        "product_id",
        "total_orders",
        "total_revenue",
        "avg_price",
        "avg_review_score",
        "total_reviews",
    )
    assert sorted(mine) == sorted(values(by_product))
    by_category = joined.filter("product_category_name IS NOT NULL").groupBy("product_category_name").agg(
        F.count_distinct("order_id"), F.count_distinct("product_id"), *sums
    )
    mine = values(
        marts.top_categories(star),
        "category",
        "total_orders",
        "unique_products",
        "total_revenue",
        "avg_price",
        "avg_review_score",
    )
    assert sorted(mine) == sorted(values(by_category))


def _executed(df) -> str:
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize(
    "build",
    [
        rfm.rfm_scored,
        anomaly.late_deliveries,
        anomaly.payment_outliers,
        lambda star: ranking.product_ranking(star, max_group_rows=0),
        lambda star: ranking.seller_deliveries(star, max_group_rows=0),
    ],
)
def test_plans_have_no_python_no_cross_join_and_no_single_sort(random_star, build):
    plan = _executed(build(random_star))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in plan
    assert not _gathered_rows(plan)


def _gathered_rows(plan: str) -> list[str]:
    """Operators that hand unaggregated rows to a single task: the node below each such exchange."""
    lines = plan.split("\n")
    found = []
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" not in line:
            continue
        below = [x for x in lines[at + 1 :] if not re.search(r"InputAdapter|ColumnarToRow|WholeStageCodegen|AQEShuffleRead|QueryStage", x)][0]
        # One row a task of a partial aggregate, or the summary of a sorted partition.
        if not re.search(r"functions=\[(partial_|max_by|last)", below) and "Aggregate" not in below:
            found.append(below.strip())
    return found


def test_the_guard_refuses_a_window_over_everything(skewed):
    """The plain NTILE brings every row to one task."""
    plain = skewed.select("id", F.ntile(5).over(Window.orderBy("day", "id")).alias("tile"))
    assert _gathered_rows(_executed(plain))
    assert not _gathered_rows(_executed(skewed.agg(F.max("id"))))


def test_a_missing_tiebreak_on_each_border(spark):
    """The row without id comes before its equals, also when a tile begins with it."""
    for border in range(1, 5):
        rows = [(None if i == 2 * border else i, 0 if i >= 2 * border else -1) for i in range(10)]
        df = spark.createDataFrame(rows, "id INT, v INT").repartition(3)
        plain = df.select("id", F.ntile(5).over(Window.orderBy("v", "id")).alias("a"))
        for held in (20_000, 2):
            mine = add_ntiles(df, {"a": F.col("v")}, "id", held=held)
            assert sorted(values(mine, "id", "a"), key=str) == sorted(values(plain), key=str)


def test_tiles_move_no_rows(spark, skewed):
    """Neither the search nor the result sorts or shuffles the table; texts break ties too."""
    df = skewed.withColumn("name", F.concat(F.lit("é"), F.col("id").cast("string")))
    measures = {"a": F.col("day"), "b": F.col("id") % 2}
    mine = add_ntiles(df, measures, "name", tiles=7, held=50)
    assert "Exchange" not in mine._jdf.queryExecution().executedPlan().toString()
    plain = df.select("name", *[F.ntile(7).over(Window.orderBy(value, "name")).alias(name) for name, value in measures.items()])
    assert sorted(values(mine, "name", "a", "b")) == sorted(values(plain))


def test_places_are_found_by_counting(spark):
    """Far more rows than are held, most of them with one key."""
    rows = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("id"), F.when(F.col("id") % 50 == 0, F.col("id")).otherwise(0).cast("decimal(38,2)").alias("_key0"))
    rows = rows.persist()
    ordered = [(r._key0, r.id) for r in rows.orderBy("_key0", "id").collect()]
    places = [0, 1, 39_999, 100_000, 195_999, 196_000, 199_999]
    found = rows_at(rows, [(0, place) for place in places], 200_000, "id", held=500)
    assert found == {(0, place): ordered[place] for place in places}
    rows.unpersist()
