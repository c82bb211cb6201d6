from __future__ import annotations

from datetime import date, timedelta
from statistics import mean, stdev

import pytest

from ordersight.operators import anomaly
from tests.conftest import order, values


def test_payment_outliers(make_star):
    amounts = [100] * 30 + [101] * 30 + [300, 160]
    star = make_star(
        orders=[order(f"o{i:02}", "c", "2018-01-01") for i in range(61)],
        payments=[(f"o{i:02}", 1, "card", 1, amount - 1) for i, amount in enumerate(amounts)]
        + [(f"o{i:02}", 2, "card", 1, 1) for i in range(len(amounts))],
    )
    z = (300 - mean(amounts)) / stdev(amounts)
    # The second outlier has no order and is left out.
    assert values(anomaly.payment_outliers(star)) == [
        (
            "o60",
            date(2018, 1, 1),
            "delivered",
            300.0,
            round(mean(amounts), 2),
            round(stdev(amounts), 2),
            round(z, 2),
            anomaly.PAYMENT_CRITICAL,
        )
    ]


def test_low_payments_are_labelled(make_star):
    amounts = [100] * 30 + [1]
    star = make_star(
        orders=[order(f"o{i}", "c", "2018-01-01") for i in range(31)],
        payments=[(f"o{i}", 1, "card", 1, amount) for i, amount in enumerate(amounts)],
    )
    assert values(anomaly.payment_outliers(star), "order_id", "anomaly_type") == [("o30", anomaly.PAYMENT_LOW)]


@pytest.mark.parametrize("count", [1, 5])
def test_equal_or_single_values_are_no_outliers(make_star, count):
    star = make_star(
        orders=[
            order(f"o{i}", "c", f"2018-01-0{i + 1}", received="2018-02-01", promised="2018-02-01")
            for i in range(count)
        ],
        payments=[(f"o{i}", 1, "card", 1, 10) for i in range(count)],
    )
    assert values(anomaly.payment_outliers(star)) == []
    assert values(anomaly.daily_volume_outliers(star)) == []


def weekly(make_star, counts):
    """A product with counts[i] orders in the i-th week; a zero leaves the week out."""
    start = date(2018, 1, 1)
    orders, items = [], []
    for week, count in enumerate(counts):
        for i in range(count):
            orders.append(order(f"{week}-{i}", "c", str(start + timedelta(days=7 * week + i % 7))))
            # Two lines of one order count as one order.
            items += [(f"{week}-{i}", 1, "p", "s", 6, 1), (f"{week}-{i}", 2, "p", "s", 4, 1)]
    return make_star(products=[("p", "toys")], orders=orders, items=items)


def test_weekly_sales_counts_orders_not_lines(make_star):
    star = weekly(make_star, [3, 0, 2])
    assert sorted(values(anomaly.weekly_sales(star))) == [
        ("p", "toys", date(2018, 1, 1), 3, 30.0),
        ("p", "toys", date(2018, 1, 15), 2, 20.0),
    ]


def test_drop_needs_31_percent_and_enough_orders(make_star):
    # 100 -> 70 is -30, 70 -> 49 is -30, 49 -> 33 is -32 (cut from -32.65).
    star = weekly(make_star, [100, 70, 49, 0, 33])
    assert values(anomaly.weekly_sales_drop(star)) == [
        ("p", "toys", date(2018, 1, 29), 49, 33, -32.0, 490.0, 330.0, -32.65, anomaly.SALES_DROP)
    ]
    # 1000 -> 691 is -30.9, cut to -30; 5 -> 2 counts, 4 -> 1 does not.
    assert values(anomaly.weekly_sales_drop(weekly(make_star, [1000, 691]))) == []
    assert len(values(anomaly.weekly_sales_drop(weekly(make_star, [5, 2])))) == 1
    assert values(anomaly.weekly_sales_drop(weekly(make_star, [4, 1]))) == []
    assert len(values(anomaly.weekly_sales_drop(weekly(make_star, [4, 1]), min_prev=4))) == 1


def test_product_week_zscore(make_star):
    counts = [2] * 9 + [9]
    found = values(anomaly.product_week_zscore(weekly(make_star, counts)))
    z = (9 - mean(counts)) / stdev(counts)
    assert found == [
        ("p", "toys", date(2018, 3, 5), 9, round(mean(counts), 2), round(stdev(counts), 2), round(z, 2))
    ]


def test_daily_volume(make_star):
    counts = [2] * 10 + [12]
    orders = [
        order(f"{day}-{i}", "c", str(date(2018, 1, 1) + timedelta(days=day)))
        for day, count in enumerate(counts)
        for i in range(count)
    ]
    orders += [order(f"x{i}", "c", "2018-01-01", status="canceled") for i in range(50)]
    found = values(anomaly.daily_volume_outliers(make_star(orders=orders)))
    z = (12 - mean(counts)) / stdev(counts)
    assert found == [
        (date(2018, 1, 11), 12, round(mean(counts), 2), round(stdev(counts), 2), round(z, 2), anomaly.DAY_PEAK)
    ]


def test_late_deliveries_once_per_review(make_star):
    orders = [
        order(f"o{i:02}", "c", "2018-01-01", received="2018-01-05", promised="2018-01-10") for i in range(40)
    ]
    late = [
        order(f"late{i}", "c", "2018-01-01", received="2018-04-01", promised="2018-01-11") for i in range(3)
    ]
    reviews = [("r1", "late1", 2), ("r2", "late2", 3), ("r3", "late2", 5), ("r4", "o01", 1)]
    star = make_star(orders=orders + late, reviews=reviews)
    found = values(
        anomaly.late_deliveries(star), "order_id", "actual_days", "delay_days", "review_score", "impact_label"
    )
    assert found == [
        ("late0", 90, 80, None, anomaly.LATE_POSITIVE),
        ("late1", 90, 80, 2, anomaly.LATE_NEGATIVE),
        ("late2", 90, 80, 3, anomaly.LATE_NEUTRAL),
        ("late2", 90, 80, 5, anomaly.LATE_POSITIVE),
    ]
