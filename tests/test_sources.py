from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ordersight.__main__ import main
from ordersight.operators import cleaning, marts, quality, ranking
from ordersight.plans.shared_store import drop_stored, shared_folder, store
from ordersight.sources import csv_files, published
from ordersight.sources.star_tables import (
    StarHome,
    create_star,
    load_idempotent,
    new_rows,
    read_star,
    run_etl,
)
from ordersight.star import STAR_SCHEMAS
from tests.conftest import order, values

RAW = {
    "customers": """customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state,unused
c1,u1,01001, SAO PAULO ,SP,x
c1,u9,99999,other,zz,x
c2,u2,,rio,RJ,x
""",
    "products": """product_id,product_category_name,product_name_length,product_description_length,product_photos_qty,product_weight_g,product_length_cm,product_height_cm,product_width_cm
p1,toys,10,20,1,100,1,2,3
p2,,,,,,,,
""",
    "sellers": """seller_id,seller_zip_code_prefix,seller_city,seller_state
s1,1,Rio,RJ
""",
    "orders": """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date
o1,c1,delivered,2018-01-05 10:00:00,2018-01-05 11:00:00,,2018-01-09 00:00:00,2018-01-20
o2,c2,canceled,2018-01-06 10:00:00,,,,2018-01-20
o2,c1,delivered,2017-01-06 10:00:00,,,,2018-01-20
""",
    "order_items": """order_id,order_item_id,product_id,seller_id,price,freight_value
o1,1,p1,s1,10.50,1
o1,1,p2,s1,99,9
o1,2,p2,s1,abc,1
o2,1,p1,s1,3,1
""",
    "payments": """order_id,payment_sequential,payment_type,payment_installments,payment_value
o1,1,card,2,11.50
o1,2,voucher,1,1
o2,1,card,1,3
""",
    "reviews": """review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp
r1,o1,5,"Great, really","two
lines with ""quotes\""",2018-01-10,2018-01-11 08:00:00
r2,o1,9,,,2018-01-10,
""",
}


@pytest.fixture(scope="module")
def raw_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    for name, text in RAW.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


def test_read_raw_keeps_text_as_it_is(spark, raw_folder):
    raw = csv_files.read_raw(spark, raw_folder)
    assert set(raw) == set(csv_files.RAW_COLUMNS)
    customer = raw["customers"].orderBy("_file", "_block", "_row").first()
    assert customer.customer_zip_code_prefix == "01001" and customer.customer_city == " SAO PAULO "
    review = raw["reviews"].filter("review_id = 'r1'").first()
    assert review.review_comment_title == "Great, really"
    assert review.review_comment_message == 'two\nlines with "quotes"'


def test_read_raw_knows_texts_for_missing_values(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text(
        'seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,"",NA,nan\ns2,NULL, ,Nantes\n'
    )
    raw = csv_files._read_csv(spark, str(tmp_path / "sellers.csv"), "sellers")
    assert values(raw.orderBy("seller_id").drop("_file", "_block", "_row")) == [
        ("s1", None, None, None),
        ("s2", None, " ", "Nantes"),
    ]


def test_ranges_reach_the_files(spark, make_star, tmp_path):
    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    load_idempotent(make_star(orders=[order("o", "c", "2018-01-05")]).fact_orders, home, "fact_orders")
    found = ranking.orders_in_range(read_star(spark, home), date(2018, 1, 1), date(2018, 1, 31))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(order_purchase_timestamp" in plan
    assert "ReadSchema: struct<order_id:string,order_status:string,order_purchase_timestamp:date>" in plan
    assert found.count() == 1


def test_read_raw_names_missing_columns(spark, raw_folder, tmp_path):
    for name in RAW:
        (tmp_path / f"{name}.csv").write_text("order_id\n1\n")
    with pytest.raises(ValueError, match="lacks columns"):
        csv_files.read_raw(spark, str(tmp_path))


def test_file_order_survives_split_files(spark, tmp_path):
    """First-in-file wins also when one file is read in many pieces."""
    from ordersight.operators.cleaning import FILE_ORDER, clean_sellers

    lines = [f"s{i % 50},{i},city{i},st" for i in range(2000)]
    (tmp_path / "sellers.csv").write_text(
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\n" + "\n".join(lines) + "\n"
    )
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        raw = csv_files._read_csv(spark, str(tmp_path / "sellers.csv"), "sellers")
        assert raw.rdd.getNumPartitions() > 3
        kept = clean_sellers(raw, FILE_ORDER)
        assert sorted(int(row.seller_zip_code_prefix) for row in kept.collect()) == list(range(50))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("kind", ["paths", "database", "buckets"])
def test_run_etl_loads_and_repeats(spark, raw_folder, tmp_path, kind):
    home = StarHome(
        str(tmp_path / "star"),
        database=None if kind == "paths" else f"shop_{kind}",
        buckets=4 if kind == "buckets" else None,
    )
    expected = {
        "dim_customers": 2,
        "dim_products": 2,
        "dim_sellers": 1,
        "dim_date": 3,
        "fact_orders": 2,
        "fact_order_items": 3,
        "fact_order_payments": 3,
        "fact_order_reviews": 1,
    }
    for _ in range(2):
        star = run_etl(csv_files.read_raw(spark, raw_folder), home, str(tmp_path / "processed"))
        assert dict(values(quality.row_counts(star))) == expected
    assert values(star.fact_orders.filter("order_id = 'o2'"), "customer_id", "order_status") == [
        ("c2", "canceled")
    ]
    line = star.fact_order_items.filter("order_id = 'o1' AND order_item_id = 1").first()
    assert line.product_id == "p1" and line.price == Decimal("10.50")
    assert star.fact_orders.schema.simpleString() == STAR_SCHEMAS["fact_orders"].simpleString()
    snapshot = spark.read.option("header", True).csv(str(tmp_path / "processed" / "orders_clean.csv"))
    assert snapshot.count() == 2 and "order_delivered_carrier_date" in snapshot.columns
    reviews = spark.read.options(header=True, multiLine=True, escape='"').csv(
        str(tmp_path / "processed" / "order_reviews_clean.csv")
    )
    assert reviews.first().review_comment_message == 'two\nlines with "quotes"'


def test_the_log_of_a_load_agrees_with_the_metrics(spark, raw_folder, tmp_path, caplog):
    raw = csv_files.read_raw(spark, raw_folder)
    with caplog.at_level("INFO", logger="ordersight.sources.star_tables"):
        run_etl(raw, StarHome(str(tmp_path / "star")))
    expected = [f"{name}: {rows} raw rows, {dropped} dropped without key" for name, rows, dropped in values(cleaning.clean_metrics(raw))]
    assert sorted(record.getMessage() for record in caplog.records) == sorted(expected)


def test_bucketed_tables_join_without_shuffle(spark, make_star, tmp_path):
    home = StarHome(str(tmp_path / "star"), database="shop_joins", buckets=4)
    create_star(spark, home)
    star = make_star(
        orders=[order(f"o{i}", "c", "2018-01-01") for i in range(20)],
        items=[(f"o{i}", 1, "p", "s", 1, 1) for i in range(20)],
    )
    for name in ("fact_orders", "fact_order_items"):
        load_idempotent(star.table(name), home, name)
    stored = read_star(spark, home)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = stored.fact_orders.join(stored.fact_order_items, "order_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 20
        # A load shuffles its batch, but not the stored lines.
        batch = star.fact_order_items.limit(5)
        fresh = new_rows(batch, stored.fact_order_items, ["order_id", "order_item_id"])
        fresh.collect()
        plan = fresh._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        lines = plan.splitlines()
        at = next(i for i, line in enumerate(lines) if "shop_joins.fact_order_items" in line)
        depth, above = len(lines[at]) - len(lines[at].lstrip(" :")), []
        for line in reversed(lines[:at]):
            if len(line) - len(line.lstrip(" :")) < depth:
                depth = len(line) - len(line.lstrip(" :"))
                above.append(line)
                if "LeftSemi" in line:
                    break
        assert "LeftSemi" in above[-1] and not any("Exchange" in line for line in above)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_load_keeps_first_of_batch_and_skips_stored(spark, tmp_path):
    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    schema = "order_id STRING, payment_sequential INT, payment_type STRING, payment_installments INT, payment_value DECIMAL(10,2), ord INT"

    def batch(*rows):
        return spark.createDataFrame([(*row[:4], Decimal(row[4]), row[5]) for row in rows], schema)

    load_idempotent(batch(("o", 1, "first", 1, "1.00", 1), ("o", 1, "second", 1, "2.00", 2)), home, "fact_order_payments", ["ord"])
    load_idempotent(batch(("o", 1, "third", 1, "3.00", 1), ("o", 2, "new", 1, "4.00", 2)), home, "fact_order_payments", ["ord"])
    load_idempotent(batch(("o", 1, "x", 1, "1.00", 1)).limit(0), home, "fact_order_payments", ["ord"])
    stored = read_star(spark, home).fact_order_payments
    assert sorted(values(stored, "payment_sequential", "payment_type")) == [(1, "first"), (2, "new")]


def test_load_refuses_or_drops_null_keys(spark, tmp_path):
    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    df = spark.createDataFrame([("s",), (None,)], "seller_id STRING")
    with pytest.raises(Exception, match="null in primary key"):
        load_idempotent(df, home, "dim_sellers")
    load_idempotent(df, home, "dim_sellers", null_keys="drop")
    assert values(read_star(spark, home).dim_sellers, "seller_id") == [("s",)]


def test_marts_are_stored_and_replaced(spark, make_star, tmp_path):
    star = make_star(
        customers=[("c", "u")],
        products=[("p", "toys")],
        orders=[order("o", "c", "2018-01-05", received="2018-01-09", promised="2018-01-10")],
        items=[("o", 1, "p", "s", 10, 1)],
        payments=[("o", 1, "card", 1, 11)],
    )
    for _ in range(2):
        published.refresh_all(star, str(tmp_path))
        for name in published.MARTS:
            assert published.read_mart(spark, str(tmp_path), name).count() == 1
    assert published.read_mart(spark, str(tmp_path), "kpi_general").first().total_revenue == 11.0
    published.publish_mart(marts.delivery_performance(star), str(tmp_path), "delivery_performance", "kpis")
    assert spark.table("kpis.mv_delivery_performance").first().total_delivered == 1


def test_without_a_checkpoint_folder_steps_go_to_the_warehouse(spark, monkeypatch):
    get = type(spark.conf).get
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, *rest: None if "checkpoint" in key else get(self, key, *rest))
    folder = shared_folder(spark)
    assert folder == shared_folder(spark) and folder.startswith(spark.conf.get("spark.sql.warehouse.dir"))


def test_store_uses_the_shared_folder(spark):
    stored = store(spark.range(3))
    assert all(shared_folder(spark) in name for name in stored.inputFiles())
    assert drop_stored(spark)


def test_command_line(spark, raw_folder, tmp_path):
    home = str(tmp_path / "star")
    main(["etl", raw_folder, home, "--snapshots", str(tmp_path / "processed")])
    main(["report", "status_distribution", home, str(tmp_path / "report")])
    report = spark.read.option("header", True).csv(str(tmp_path / "report"))
    assert sorted(values(report)) == [("canceled", "1"), ("delivered", "1")]
    main(["refresh", home, str(tmp_path / "marts")])
    assert published.read_mart(spark, str(tmp_path / "marts"), "revenue_monthly").count() == 1
    everything = ["--set", "first=1990-01-01", "--set", "last=2100-01-01"]
    main(["report", "orders_in_range", home, str(tmp_path / "range"), *everything])
    assert spark.read.option("header", True).csv(str(tmp_path / "range")).count() > 0


def test_a_report_on_a_missing_star_fails(spark, tmp_path):
    for command in (["report", "row_counts", str(tmp_path / "none"), str(tmp_path / "out")], ["refresh", str(tmp_path / "none"), str(tmp_path / "marts")]):
        with pytest.raises(FileNotFoundError, match="run etl first"):
            main(command)
    assert not (tmp_path / "none").exists()


def test_files_are_named_on_the_command_line(spark, raw_folder, tmp_path):
    with pytest.raises(Exception, match="other.csv"):
        main(["etl", raw_folder, str(tmp_path / "star"), "--file", "orders=other.csv"])
