from __future__ import annotations

from datetime import date, timedelta
from itertools import product

import pytest
from pyspark.sql import functions as F

from ordersight.operators import marts, rfm
from tests.conftest import order, values

REF = date(2018, 10, 18)


@pytest.fixture(scope="module")
def seven(make_star):
    """Seven people; person i bought last i days before REF, and all but two bought once."""
    customers = [(f"c{i}", f"u{i}") for i in range(1, 8)] + [("c1b", "u1")]
    orders = [order(f"o{i}", f"c{i}", str(REF - timedelta(days=i))) for i in range(1, 8)]
    orders += [
        order("o1b", "c1b", "2018-01-01"),
        order("o2b", "c2", "2018-01-01"),
        order("gone", "c7", "2018-10-17", status="canceled"),
        order("unpaid", "c6", "2018-10-17"),
        order("stranger", "x", "2018-10-17"),
    ]
    payments = [(f"o{i}", 1, "card", 1, 10 * i) for i in range(1, 8)]
    payments += [("o1b", 1, "card", 1, 1), ("o1b", 2, "card", 1, "0.55"), ("o2b", 1, "card", 1, 5)]
    payments += [("gone", 1, "card", 1, 1000), ("stranger", 1, "card", 1, 1000)]
    return make_star(customers=customers, orders=orders, payments=payments)


def test_raw_merges_accounts_and_payments(seven):
    found = {row[0]: row[1:] for row in values(rfm.rfm_raw(seven, REF))}
    assert len(found) == 7
    assert found["u1"][1:3] == (1, 2) and float(found["u1"][3]) == 11.55
    # Neither the canceled order nor the one without payment counts.
    assert found["u7"][1] == 7 and found["u6"][1] == 6


def test_reference_date_is_the_day_after_the_last_order(seven):
    assert values(rfm.rfm_reference_date(seven)) == [(date(2018, 10, 18),)]
    assert values(rfm.rfm_raw(seven).filter("customer_unique_id = 'u1'"), "recency_days") == [(1,)]


def test_scores_split_seven_into_2_2_1_1_1(seven):
    scored = rfm.rfm_scored(seven, REF).orderBy("customer_unique_id")
    assert [row[0] for row in values(scored, "recency_score")] == [1, 1, 2, 2, 3, 4, 5]
    # u1 and u2 bought twice; the rest tie and follow their id.
    assert [row[0] for row in values(scored, "frequency_score")] == [1, 1, 2, 2, 3, 4, 5]
    assert [row[0] for row in values(scored, "monetary_score")] == [5, 4, 3, 2, 2, 1, 1]
    best = rfm.rfm_scored(seven, REF, high_is_best=True)
    assert [row[0] for row in values(best.orderBy("customer_unique_id"), "recency_score")] == [5, 4, 3, 2, 2, 1, 1]


def test_fewer_than_five_people(make_star):
    star = make_star(
        customers=[("a", "a"), ("b", "b"), ("c", "c")],
        orders=[order(x, x, f"2018-01-0{i}") for i, x in enumerate("abc", 1)],
        payments=[(x, 1, "card", 1, i) for i, x in enumerate("abc", 1)],
    )
    scored = rfm.rfm_scored(star).orderBy("customer_unique_id")
    assert values(scored, "recency_score", "frequency_score", "monetary_score") == [
        (3, 1, 3),
        (2, 2, 2),
        (1, 3, 1),
    ]


def test_no_people(make_star):
    assert rfm.rfm_scored(make_star(), REF).count() == 0


def test_rules_cover_all_scores(spark):
    scores = spark.createDataFrame(list(product(range(1, 6), repeat=3)), rfm.SCORES)
    found = scores.select(*rfm.SCORES, rfm.segment("detail").alias("a"), rfm.segment("mart").alias("b"))
    by_scores = {row[:3]: row[3:] for row in values(found)}
    assert by_scores[(4, 4, 4)] == ("Champions", "Champions")
    assert by_scores[(3, 3, 1)] == ("Loyal customers", "Loyal Customers")
    assert by_scores[(4, 2, 1)] == ("New customers", "New customers")
    assert by_scores[(2, 3, 1)] == ("At risk", "At Risk")
    assert by_scores[(1, 3, 1)] == ("Lost", "At Risk")
    assert by_scores[(1, 1, 5)] == ("Lost", "Lost")
    assert by_scores[(2, 2, 4)] == ("Lost", "Big Spenders")
    assert by_scores[(2, 2, 3)] == ("Lost", "Potential Loyalists")
    assert {row[1] for row in by_scores.values()} == {label for *_, label in rfm.MART_RULES} | {rfm.MART_OTHER}


def test_detail_and_summary(seven):
    detail = values(rfm.rfm_segments_detail(seven, REF), "customer_unique_id", "rfm_total", "segment")
    assert [row[1] for row in detail] == sorted((row[1] for row in detail), reverse=True)
    summary = values(rfm.rfm_segment_summary(seven, REF))
    assert sum(row[1] for row in summary) == 7
    assert dict((row[0], row[2]) for row in summary)["Lost"] == round(
        100 * sum(row[2] == "Lost" for row in detail) / 7, 2
    )
    mart = values(marts.rfm_segments_mart(seven, REF))
    assert sum(row[1] for row in mart) == 7


def test_simple_has_same_scores(seven):
    simple = rfm.rfm_simple(seven, REF)
    full = rfm.rfm_scored(seven, REF)
    assert sorted(values(simple, "customer_unique_id", "r_score", "f_score", "m_score")) == sorted(
        values(full, "customer_unique_id", *rfm.SCORES)
    )
    assert simple.filter(F.col("rfm_total") != F.expr("r_score + f_score + m_score")).count() == 0
