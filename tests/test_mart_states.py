"""KPI tables from sums that loads extend, against the whole star computed anew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ordersight.operators import marts
from ordersight.sources import mart_states, published
from ordersight.sources.mart_states import MartStates
from ordersight.sources.star_tables import StarHome, create_star, load_idempotent, read_star
from tests.conftest import order, values

TABLES = ["dim_customers", "dim_products", "fact_orders", "fact_order_items", "fact_order_payments", "fact_order_reviews"]


def rows_of_shop():
    draw = random.Random(11)
    customers = [(f"c{i}", f"u{i // 2}" if i % 13 else None) for i in range(40)]
    products = [(f"p{i}", None if i % 7 == 0 else f"k{i % 4}") for i in range(20)]
    orders, items, payments, reviews = [], [], [], []
    for i in range(120):
        day = f"2018-{1 + i % 9:02d}-{1 + i % 27:02d}"
        status = draw.choice(["delivered"] * 6 + ["canceled", "unavailable", "shipped"])
        orders.append(order(f"o{i}", f"c{draw.randrange(44)}", day, status, None if i % 6 == 0 else f"2018-10-{1 + i % 27:02d}", f"2018-10-{1 + i % 20:02d}"))
        items += [(f"o{i}", n, f"p{draw.randrange(22)}", f"s{draw.randrange(5)}", draw.randrange(1, 90), 1) for n in range(draw.randrange(4))]
        payments += [(f"o{i}", n, "card", 1, None if draw.random() < 0.2 else draw.randrange(1, 200)) for n in range(draw.randrange(3))]
        reviews += [(f"r{i}.{n}", f"o{i}", draw.choice([None, 1, 4, 5])) for n in range(draw.randrange(3))]
    return dict(customers=customers, products=products, orders=orders, items=items, payments=payments, reviews=reviews)


def assert_same(states, star):
    whole = {
        "kpi_general": marts.kpi_general(star),
        "revenue_monthly": marts.revenue_monthly(star),
        "top_categories": marts.top_categories(star),
        "delivery_performance": marts.delivery_performance(star),
        "rfm_segments": marts.rfm_segments_mart(star),
    }
    for name, df in states.results().items():
        assert sorted(values(df, *whole[name].columns), key=str) == sorted(values(whole[name]), key=str), name


def test_updates_equal_a_recompute(spark, make_star, tmp_path, monkeypatch):
    monkeypatch.setattr(mart_states, "MOST_PARTS", 2)
    rows = rows_of_shop()
    # Each row comes with one of three loads, whatever its order, customer or product come with.
    draw = random.Random(5)
    loads: list[dict[str, list]] = [{name: [] for name in rows} for _ in range(3)]
    for name, some in rows.items():
        for row in some:
            loads[draw.choice([0, 0, 1, 2])][name].append(row)
    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    states = MartStates(spark, home, str(tmp_path / "states"))
    for turn, part in enumerate(loads):
        batch = make_star(**part)
        for name in TABLES:
            load_idempotent(batch.table(name).coalesce(1), home, name)
        states.update()
        if turn > 0:
            assert_same(states, read_star(spark, home))
            # The third part is put together with the others.
            assert len(states._covered()[1]) == (2 if turn == 1 else 1)
    _, parts = states._covered()
    states.update()
    assert states._covered()[1] == parts


def test_only_touched_orders_are_read(spark, make_star, tmp_path):
    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    states = MartStates(spark, home, str(tmp_path / "states"))
    for first in (0, 100):
        batch = make_star(
            customers=[(f"c{n:03d}", f"u{n:03d}") for n in range(first, first + 20)],
            orders=[order(f"o{n:03d}", f"c{n:03d}", "2018-01-05") for n in range(first, first + 20)],
            payments=[(f"o{n:03d}", 1, "card", 1, 5) for n in range(first, first + 20)],
        )
        for name in ("dim_customers", "fact_orders", "fact_order_payments"):
            load_idempotent(batch.table(name).coalesce(1), home, name)
    states.update()
    load_idempotent(make_star(payments=[("o105", 2, "card", 1, 7)]).fact_order_payments, home, "fact_order_payments")
    covered, _ = states._covered()
    files = {name: [p for p in mart_states.table_files(spark, home, name) if mart_states.file_name(p) not in covered[name]] for name in mart_states.STAR_SCHEMAS}
    before, after = states._touched(files, covered)
    assert values(after.fact_orders, "order_id") == [("o105",)] and after.fact_order_payments.count() == 2
    assert before.fact_order_payments.count() == 1 and values(after.dim_customers, "customer_id") == [("c105",)]
    states.update()
    part = states._covered()[1][-1]
    delta = spark.read.parquet(f"{states.folder}/parts/{part}/person_months")
    assert [(r.customer_unique_id, r.orders, float(r.paid)) for r in delta.collect()] == [("u105", 0, 7.0)]
    assert_same(states, read_star(spark, home))


def test_refresh_publishes_from_sums(spark, make_star, tmp_path):
    home, root = StarHome(str(tmp_path / "star")), str(tmp_path / "marts")
    create_star(spark, home)
    with pytest.raises(FileNotFoundError, match="update first"):
        MartStates(spark, home, f"{root}/_states").read()
    batch = make_star(customers=[("c", "u")], orders=[order("o", "c", "2018-01-05")], payments=[("o", 1, "card", 1, 11)])
    for name in ("dim_customers", "fact_orders", "fact_order_payments"):
        load_idempotent(batch.table(name), home, name)
    published.refresh_changed(spark, home, root)
    assert published.read_mart(spark, root, "revenue_monthly").first().revenue == 11.0
