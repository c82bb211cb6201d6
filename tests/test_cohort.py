from __future__ import annotations

from datetime import date

import pytest

from ordersight.operators import cohort
from tests.conftest import order, values


@pytest.fixture(scope="module")
def star(make_star):
    return make_star(
        customers=[("a", "A"), ("a2", "A"), ("b", "B"), ("c", "C"), ("d", "D")],
        orders=[
            order("1", "a", "2017-11-20"),
            order("2", "a2", "2018-01-03"),
            order("3", "b", "2017-11-02"),
            order("4", "b", "2017-11-02"),
            order("5", "c", "2017-11-30"),
            order("6", "d", "2018-01-31"),
            order("7", "d", "2018-09-01"),
            order("8", "d", "2017-01-01", status="canceled"),
        ],
    )


def test_first_purchase_over_accounts(star):
    found = {row[0]: row[1:] for row in values(cohort.first_purchase(star))}
    assert found["A"] == (date(2017, 11, 20), date(2017, 11, 1))
    assert found["D"] == (date(2018, 1, 31), date(2018, 1, 1))


def test_months_are_counted_over_the_year_end(star):
    found = sorted(values(cohort.all_purchases(star), "customer_unique_id", "purchase_month", "month_number"))
    assert found == [
        ("A", date(2017, 11, 1), 0),
        ("A", date(2018, 1, 1), 2),
        ("B", date(2017, 11, 1), 0),
        ("B", date(2017, 11, 1), 0),
        ("C", date(2017, 11, 1), 0),
        ("D", date(2018, 1, 1), 0),
        ("D", date(2018, 9, 1), 8),
    ]


def test_sizes_activity_and_retention(star):
    assert sorted(values(cohort.cohort_sizes(star))) == [(date(2017, 11, 1), 3), (date(2018, 1, 1), 1)]
    assert sorted(values(cohort.cohort_activity(star))) == [
        (date(2017, 11, 1), 0, 3),
        (date(2017, 11, 1), 2, 1),
        (date(2018, 1, 1), 0, 1),
        (date(2018, 1, 1), 8, 1),
    ]
    assert values(cohort.cohort_retention(star)) == [
        ("2017-11", 0, 3, 3, 100.0),
        ("2017-11", 2, 3, 1, 33.33),
        ("2018-01", 0, 1, 1, 100.0),
    ]


def test_pivot_cuts_to_whole_percent_and_leaves_gaps_null(star):
    assert values(cohort.cohort_pivot(star)) == [
        ("2017-11", 3, 100.0, None, 33.0, None, None, None, None),
        ("2018-01", 1, 100.0, None, None, None, None, None, None),
    ]


def test_repurchase_interval(star):
    # A waits 44 days, B none; D's canceled order counts here, so D waits 395 days.
    average, least, most, median = values(cohort.repurchase_interval(star))[0]
    assert (least, most, median) == (0, 395, 44.0)
    assert average == pytest.approx((0 + 44 + 395) / 3)
    # Without it D waits 213 days.
    assert values(cohort.repurchase_interval(star, ("canceled", "unavailable")))[0][2] == 213


def test_repurchase_needs_two_dated_orders(make_star):
    star = make_star(
        customers=[("a", "A"), ("b", "B")],
        orders=[order("1", "a", "2018-01-01"), order("2", "b", "2018-01-01"), order("3", "b", None)],
    )
    assert values(cohort.repurchase_interval(star)) == [(None, None, None, None)]
