from __future__ import annotations

from datetime import date

import pytest

from ordersight.operators import marts
from ordersight.sources.star_tables import StarHome, store_star
from tests.conftest import order, values


@pytest.fixture(scope="module")
def star(make_star):
    return make_star(
        customers=[("a", "A"), ("a2", "A"), ("b", "B")],
        products=[("p1", "toys"), ("p2", "toys"), ("p3", None), ("p4", "books")],
        orders=[
            order("o1", "a", "2018-01-05", received="2018-01-10", promised="2018-01-10"),
            order("o2", "a2", "2018-01-20", received="2018-02-10", promised="2018-01-30"),
            order("o3", "b", "2018-03-02", status="canceled"),
            order("o4", "b", "2018-04-02", status="shipped"),
            order("o5", "x", "2018-03-02"),
        ],
        items=[
            ("o1", 1, "p1", "s1", 10, 1),
            ("o1", 2, "p2", "s2", 20, 1),
            ("o2", 1, "p1", "s1", 30, 1),
            ("o3", 1, "p4", "s3", 40, 1),
            ("o5", 1, "p3", "s9", 40, 1),
            ("o5", 2, "p4", "s9", 60, 1),
        ],
        payments=[
            ("o1", 1, "card", 1, 25),
            ("o1", 2, "voucher", 1, 5),
            ("o2", 1, "card", 1, 30),
            ("o3", 1, "card", 1, 40),
            ("o4", 1, "card", 1, 0),
            ("o5", 1, "card", 1, 100),
        ],
        reviews=[("r1", "o1", 5), ("r2", "o1", 2), ("r3", "o2", 3)],
    )


def test_kpi_general_weighs_the_joined_rows(star):
    found = marts.kpi_general(star).first().asDict()
    # o1 makes 2 items x 2 payments x 2 reviews = 8 rows, o2 and o3 one each;
    # o4 has no items and o5 no known customer.
    revenue = 30 * 2 * 2 + 30 + 40
    assert found == {
        "total_orders": 3,
        "unique_customers": 2,
        "active_sellers": 3,
        "products_sold": 3,
        "total_revenue": float(revenue),
        "avg_order_value": revenue / 10,
        "revenue_per_customer": revenue / 2,
        "on_time_delivery_rate": round(100 * 8 / 9, 2),
        "cancellation_rate": 10.0,
        "avg_review_score": round((5 * 4 + 2 * 4 + 3) / 9, 2),
    }


def test_kpi_general_of_nothing(make_star):
    found = marts.kpi_general(make_star()).first()
    assert found.total_orders == 0 and found.total_revenue is None and found.cancellation_rate is None


def test_revenue_monthly(star):
    assert values(marts.revenue_monthly(star)) == [
        (date(2018, 1, 1), "2018-01", 2, 1, 60.0, 20.0, None, None),
        # The month before is the one that exists, and growth from it is -100 %.
        (date(2018, 4, 1), "2018-04", 1, 1, 0.0, 0.0, 60.0, -100.0),
    ]


def test_growth_from_zero_is_null(make_star):
    star = make_star(
        customers=[("a", "A")],
        orders=[order("o1", "a", "2018-01-01"), order("o2", "a", "2018-02-01")],
        payments=[("o1", 1, "card", 1, 0), ("o2", 1, "card", 1, 5)],
    )
    assert values(marts.revenue_monthly(star), "prev_month_revenue", "mom_growth_pct") == [(None, None), (0.0, None)]


def test_top_categories(star):
    assert values(marts.top_categories(star)) == [
        # o1's lines count twice: (10 + 20) * 2 + 30; the canceled order is left out.
        ("toys", 2, 2, 90.0, 18.0, 3.4, 60.0, 1),
        ("books", 1, 1, 60.0, 60.0, None, 40.0, 2),
    ]


def test_delivery_performance(star):
    assert values(marts.delivery_performance(star)) == [
        (date(2018, 1, 1), "2018-01", 2, 13.0, 7.5, 1, 1, 50.0)
    ]


def test_general_kpis_read_each_fact_once(spark, make_star, tmp_path):
    star = make_star(
        customers=[("c", "u"), ("d", None)],
        orders=[order("o", "c", "2018-01-05"), order("q", "d", "2018-01-06"), order("alone", "x", "2018-01-07")],
        items=[("o", 1, "p", "s", 10, 1), ("o", 2, "p", "s", 10, 1), ("o", 3, "p2", "s", 10, 1), ("q", 1, "p3", None, 10, 1), ("alone", 1, "p4", "t", 5, 1)],
        payments=[("o", 1, "card", 1, 11), ("q", 1, "card", 1, None), ("alone", 1, "card", 1, 3)],
    )
    stored = store_star(star, StarHome(str(tmp_path / "star")))
    found = marts.kpi_general(stored)
    plan = found._jdf.queryExecution().executedPlan().toString()
    for column in ("order_status", "product_id", "payment_value", "review_score", "customer_unique_id"):
        assert sum(column in line.split("ReadSchema")[-1] for line in plan.splitlines() if "FileScan" in line) == 1, column
    assert plan.count("FileScan parquet") == 5
    row = found.first()
    assert (row.total_orders, row.unique_customers, row.active_sellers, row.products_sold) == (2, 1, 1, 3)
    assert row.total_revenue == 33.0 and row.avg_order_value == 11.0
    # The sums kept per person and pair give the same.
    assert values(marts.kpi_general_of(marts.person_kpis(stored), marts.seller_products(stored))) == [tuple(row)]
