from __future__ import annotations

import re
from datetime import date, timedelta

import pytest

from ordersight.operators import anomaly, marts, ranking
from ordersight.plans.per_order import TASK_LINES
from tests.conftest import order, values


@pytest.fixture(scope="module")
def shop(make_star):
    return make_star(
        products=[("p1", "toys"), ("p2", "toys"), ("p3", "toys"), ("p4", "toys"), ("p5", "books"), ("p6", None)],
        orders=[order(f"o{i}", "c", f"2018-01-0{i}") for i in range(1, 6)]
        + [order("bad", "c", "2018-01-01", status="unavailable")],
        items=[
            ("o1", 1, "p1", "s", 10, 1),
            ("o1", 2, "p1", "s", 30, 1),
            ("o2", 1, "p2", "s", 80, 1),
            ("o3", 1, "p3", "s", 80, 1),
            ("o4", 1, "p4", "s", 5, 1),
            ("o5", 1, "p5", "s", 7, 1),
            ("o5", 2, "p6", "s", 9, 1),
            ("o5", 3, "gone", "s", 9, 1),
            ("bad", 1, "p4", "s", 999, 1),
        ],
        reviews=[("r1", "o1", 5), ("r2", "o1", 2), ("r3", "o2", 4)],
    )


@pytest.mark.parametrize("report", [ranking.product_metrics, anomaly.weekly_sales, marts.top_categories])
def test_many_lines_are_dealt_by_order(shop, report):
    many = shop.replace()
    many.line_bound = lambda: 9 * TASK_LINES
    found = report(many)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Not left to adaptive execution, which puts partitions together by compressed bytes.
    assert re.search(r"hashpartitioning\(order_id#\d+, 9\), REPARTITION_BY_NUM", plan)
    assert sorted(map(str, values(found))) == sorted(map(str, values(report(shop))))


def test_metrics_repeat_lines_per_review(shop):
    found = {row[0]: row[1:] for row in values(ranking.product_metrics(shop))}
    # Two lines meet two reviews each: 40 counts twice.
    assert found["p1"] == ("toys", 1, 80.0, 20.0, 3.5, 2)
    assert found["p2"] == ("toys", 1, 80.0, 80.0, 4.0, 1)
    assert found["p4"] == ("toys", 1, 5.0, 5.0, None, 0)
    assert set(found) == {"p1", "p2", "p3", "p4", "p5", "p6"}


@pytest.mark.parametrize("max_group_rows", [0, 2, 1000])
def test_ranks_with_ties(shop, max_group_rows):
    found = ranking.product_ranking(shop, max_group_rows=max_group_rows)
    ranks = {
        row[0]: row[1:]
        for row in values(
            found,
            "product_id",
            "rank_by_revenue",
            "dense_rank_by_revenue",
            "row_number_by_revenue",
            "rank_by_orders",
            "rank_by_satisfaction",
            "products_in_category",
        )
    }
    assert ranks == {
        "p1": (1, 1, 1, 1, 2, 4),
        "p2": (1, 1, 2, 1, 1, 4),
        "p3": (1, 1, 3, 1, 3, 4),
        "p4": (4, 2, 4, 1, 3, 4),
        "p5": (1, 1, 1, 1, 1, 1),
        "p6": (1, 1, 1, 1, 1, 1),
    }


def test_top_products_keep_ties(shop):
    found = values(ranking.top_products(shop, n=1), "product_category_name", "position", "product_id")
    assert found == [("books", 1, "p5"), ("toys", 1, "p1"), ("toys", 1, "p2"), ("toys", 1, "p3"), (None, 1, "p6")]


def deliveries(make_star, days, seller="s"):
    """One order per day; the i-th was delivered after days[i] days."""
    start = date(2018, 1, 1)
    orders, items = [], []
    for i, needed in enumerate(days):
        bought = start + timedelta(days=i)
        orders.append(
            order(f"{seller}{i:02}", "c", str(bought), received=str(bought + timedelta(days=needed)))
        )
        items.append((f"{seller}{i:02}", 1, "p", seller, 1, 1))
    return orders, items


@pytest.mark.parametrize("max_group_rows", [0, 2, 1000])
def test_deliveries_look_back_within_the_seller(make_star, max_group_rows):
    orders, items = deliveries(make_star, [5, 3, 3, 9])
    more_orders, more_items = deliveries(make_star, [4], seller="t")
    orders += more_orders + [order("lost", "c", "2018-01-02"), order("way", "c", "2018-01-02", "shipped", "2018-01-03")]
    items += more_items + [("lost", 1, "p", "s", 1, 1), ("way", 1, "p", "s", 1, 1)]
    # A second line of the same order is a delivery of its own.
    items += [("s00", 2, "p", "s", 1, 1)]
    star = make_star(orders=orders, items=items)
    found = ranking.seller_deliveries(star, max_group_rows=max_group_rows)
    rows = sorted(
        values(found, "seller_id", "order_id", "delivery_days", "prev_delivery_days", "prev_order_date"), key=str
    )
    first = date(2018, 1, 1)
    assert rows == [
        ("s", "s00", 5, 5, first),
        ("s", "s00", 5, None, None),
        ("s", "s01", 3, 5, first),
        ("s", "s02", 3, 3, date(2018, 1, 2)),
        ("s", "s03", 9, 3, date(2018, 1, 3)),
        ("t", "t00", 4, None, None),
    ]
    trend = values(
        ranking.seller_delivery_trend(star, max_group_rows=max_group_rows), "order_id", "days_difference", "trend"
    )
    assert trend == [
        ("s00", 0, ranking.SAME),
        ("s01", -2, ranking.IMPROVED),
        ("s02", 0, ranking.SAME),
        ("s03", 6, ranking.WORSENED),
    ]


def test_summary_needs_ten_deliveries(make_star):
    orders, items = deliveries(make_star, [5] * 10)
    assert values(ranking.seller_trend_summary(make_star(orders=orders, items=items))) == []
    orders, items = deliveries(make_star, [5] * 11)
    found = values(ranking.seller_trend_summary(make_star(orders=orders, items=items)))
    assert found == [("s", 10, 5.0, 0, 0, 10, 0.0, ranking.TREND_NONE)]


def test_share_must_exceed_sixty_percent(make_star):
    def summary(improved, worsened):
        days = [50]
        for _ in range(improved):
            days.append(days[-1] - 1)
        for _ in range(worsened):
            days.append(days[-1] + 1)
        orders, items = deliveries(make_star, days)
        found = ranking.seller_trend_summary(make_star(orders=orders, items=items))
        return values(found, "improved", "worsened", "improvement_rate", "seller_trend")[0]

    assert summary(6, 4) == (6, 4, 60.0, ranking.TREND_NONE)
    assert summary(7, 4) == (7, 4, 63.0, ranking.TREND_UP)
    assert summary(4, 7) == (4, 7, 36.0, ranking.TREND_DOWN)


def test_range_and_revenue_since(shop):
    found = values(ranking.orders_in_range(shop, date(2018, 1, 2), date(2018, 1, 4)), "order_id")
    assert sorted(found) == [("o2",), ("o3",), ("o4",)]
    since = dict(values(ranking.product_revenue_since(shop, date(2018, 1, 3))))
    assert since == {"p3": 80.0, "p4": 5.0, "p5": 7.0, "p6": 9.0, "gone": 9.0}
