from __future__ import annotations

import pytest

from ordersight.operators import quality
from tests.conftest import order, values


@pytest.fixture(scope="module")
def faulty(make_star):
    return make_star(
        customers=[("c1", "u1", "1", "rio", "rj"), ("c1", "u2", "1", "rio", "long"), (None, "u", "1", "r", "rj")],
        products=[("p1", "toys")],
        sellers=[("s1", "1", "x" * 51, "rj")],
        date=[("2018-01-01",)],
        orders=[
            order("o1", "c1", "2018-01-01"),
            order("o2", "nobody", "2018-02-01", status=None),
            order("o3", None, None, status="shipped"),
        ],
        items=[("o1", 1, "p1", "s1"), ("o1", 1, "p1", "s1"), ("gone", 1, "p9", "s9"), (None, 1, None, None)],
        payments=[("o1", 1), ("gone", 1), ("gone", 2)],
        reviews=[("r1", "o1", 5), ("r2", "gone", 9), ("r3", None, None), ("r4", "o1", 0)],
    )


def test_row_counts(faulty):
    assert dict(values(quality.row_counts(faulty))) == {
        "dim_customers": 3,
        "dim_products": 1,
        "dim_sellers": 1,
        "dim_date": 1,
        "fact_orders": 3,
        "fact_order_items": 4,
        "fact_order_payments": 3,
        "fact_order_reviews": 4,
    }


def test_orphans_count_missing_and_null_orders(faulty):
    assert values(quality.orphan_items(faulty)) == [(2,)]
    assert values(quality.orphan_payments(faulty)) == [(2,)]
    assert values(quality.orphan_reviews(faulty)) == [(2,)]
    assert quality.orphan_items(faulty).columns == ["items_sin_orden"]


def test_foreign_keys_allow_null(faulty):
    assert dict(values(quality.fk_violations(faulty))) == {
        "fk_orders_customer": 1,
        "fk_orders_date": 1,
        "fk_items_orders": 1,
        "fk_items_products": 1,
        "fk_items_sellers": 1,
        "fk_payments_orders": 2,
        "fk_reviews_orders": 1,
    }


def test_primary_keys(faulty):
    found = {row[0]: row[1:] for row in values(quality.pk_violations(faulty))}
    assert found["dim_customers"] == (1, 1)
    assert found["fact_order_items"] == (1, 1)
    assert found["fact_order_reviews"] == (0, 0)


def test_nulls_scores_lengths(faulty):
    assert values(quality.critical_nulls(faulty)) == [(1, 1, 1)]
    assert values(quality.check_violations(faulty)) == [("chk_review_score", 2)]
    found = {row[:2]: row[3] for row in values(quality.length_violations(faulty)) if row[3]}
    assert found == {("dim_customers", "customer_state"): 1, ("dim_sellers", "seller_city"): 1}


def test_dates_and_statuses(make_star):
    star = make_star(
        orders=[
            order("a", "c", "2018-01-01", status="shipped"),
            order("b", "c", "2018-01-01"),
            order("c", "c", "2018-03-01"),
            order("d", "c", None, status="shipped"),
            order("e", "c", None),
        ]
    )
    assert [str(value) for value in values(quality.date_coverage(star))[0]] == ["2018-01-01", "2018-03-01", "2"]
    assert values(quality.status_distribution(star)) == [("delivered", 3), ("shipped", 2)]


def test_empty_tables(make_star):
    star = make_star()
    assert values(quality.orphan_items(star)) == [(0,)]
    assert values(quality.date_coverage(star)) == [(None, None, 0)]
    assert all(row[1:] == (0, 0) for row in values(quality.pk_violations(star)))
