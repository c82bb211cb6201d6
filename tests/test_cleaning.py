from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ordersight.operators import cleaning
from tests.conftest import values

ORDER = ["ord"]


@pytest.fixture(scope="module")
def raw(spark):
    def build(columns, rows):
        return spark.createDataFrame(rows, ", ".join(f"{name} STRING" for name in columns) + ", ord INT")

    return build


def test_customers_first_row_wins_and_text_is_trimmed(raw):
    df = raw(
        ["customer_id", "customer_unique_id", "customer_zip_code_prefix", "customer_city", "customer_state"],
        [
            ("a", "later", "2", "x", "y", 5),
            ("a", "u1", None, "\t São Paulo \n", " SP", 1),
            ("b", None, "1", "x", "y", 2),
            ("b", "u2", "1", "x", "y", 3),
            (None, "u3", "1", "x", "y", 4),
            ("c", "u4", "01001", None, None, 6),
        ],
    )
    result = sorted(values(cleaning.clean_customers(df, ORDER)))
    # The first row of b has no unique id, so b is lost although a later row has one.
    assert result == [("a", "u1", "00000", "são paulo", "sp"), ("c", "u4", "01001", None, None)]


def test_products_fill_and_cut_numbers(raw):
    columns = ["product_id", "product_category_name", *cleaning.PRODUCT_NUMBERS]
    df = raw(
        columns,
        [
            ("p", None, "12.9", None, "bad", "1e3", "1", "2", "3", 1),
            ("p", "later", *["9"] * 7, 2),
            (None, "a", *["1"] * 7, 3),
            (None, "b", *["1"] * 7, 4),
        ],
    )
    result = sorted(values(cleaning.clean_products(df, ORDER)), key=str)
    assert result == [("p", "unknown", 12, 0, 0, 1000, 1, 2, 3), (None, "a", *[1] * 7)]


def test_sellers(raw):
    df = raw(
        ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
        [("s", None, " RIO ", "RJ\t", 1), ("s", "9", "z", "z", 2)],
    )
    assert values(cleaning.clean_sellers(df, ORDER)) == [("s", "0", "rio", "rj")]


def test_orders_dates_are_read_or_null(raw):
    df = raw(
        ["order_id", "customer_id", "order_status", *cleaning.ORDER_DAYS],
        [
            ("o", "c", "delivered", "2018-02-03 23:59:59", "2018-13-01", "soon", None, "2018-02-10", 1),
            ("o", "c", "later", "2018-01-01", None, None, None, None, 2),
            ("x", None, "delivered", None, None, None, None, None, 3),
            (None, "c", "delivered", None, None, None, None, None, 4),
        ],
    )
    assert values(cleaning.clean_orders(df, ORDER)) == [
        ("o", "c", "delivered", date(2018, 2, 3), None, None, None, date(2018, 2, 10))
    ]


def test_items_and_payments_fill_bad_numbers(raw):
    items = raw(
        ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
        [
            ("o", "1", "p", "s", "abc", "1.005", 1),
            ("o", "1", "p", "s", None, "2", 2),
            (None, "1", "p", "s", "1", "1", 3),
            ("o", "1", None, "s", "1", "1", 4),
            ("o", "1", "p", None, "1", "1", 5),
        ],
    )
    result = values(cleaning.clean_order_items(items).orderBy("ord"), "order_item_id", "price", "freight_value")
    assert result == [(1, Decimal("0.00"), Decimal("1.01")), (1, Decimal("0.00"), Decimal("2.00"))]
    payments = raw(
        ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
        [("o", "1", "card", "x", "y", 1), ("o", "2", "card", "2.7", "3.5", 2), (None, "1", "c", "1", "1", 3)],
    )
    result = values(cleaning.clean_order_payments(payments).orderBy("ord"))
    assert [row[:5] for row in result] == [
        ("o", 1, "card", 1, Decimal("0.00")),
        ("o", 2, "card", 2, Decimal("3.50")),
    ]


def test_reviews_keep_scores_one_to_five(raw):
    columns = [
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ]
    scores = ["0", "1", "5", "6", None, "bad", "3"]
    rows = [(f"r{i}", "o", score, None, "m", "2018-01-01", "x", i) for i, score in enumerate(scores)]
    rows += [("r1", "o", "4", "t", "m", None, None, 99), (None, "o", "4", "t", "m", None, None, 98)]
    result = sorted(values(cleaning.clean_reviews(raw(columns, rows), ORDER)))
    assert [(row[0], row[2]) for row in result] == [("r1", 1), ("r2", 5), ("r6", 3)]
    assert result[0][3:] == ("NA", "m", date(2018, 1, 1), None)


def test_dim_date_weeks_and_weekends(raw):
    days = ["2016-01-03", "2018-12-31", "2018-12-31 10:00:00", "2017-07-08", None, "nope"]
    df = raw(["order_purchase_timestamp"], [(day, i) for i, day in enumerate(days)])
    assert sorted(values(cleaning.build_dim_date(df))) == [
        (date(2016, 1, 3), 2016, 1, 1, 53, 3, True),
        (date(2017, 7, 8), 2017, 3, 7, 27, 8, True),
        (date(2018, 12, 31), 2018, 4, 12, 1, 31, False),
    ]


def test_null_profile_and_metrics(raw):
    df = raw(
        ["order_id", "customer_id", "order_status", *cleaning.ORDER_DAYS],
        [
            ("o", "c", None, *[None] * 5, 1),
            ("o", None, None, *[None] * 5, 2),
            (None, "c", "x", *[None] * 5, 3),
            (None, "d", "x", *[None] * 5, 4),
        ],
    )
    profile = dict(values(cleaning.null_profile(df)))
    assert profile["order_id"] == 2 and profile["customer_id"] == 1 and profile["order_approved_at"] == 4
    # Repeats go first: one order and one keyless row are left, and the latter is dropped.
    assert values(cleaning.clean_metrics({"orders": df}, ORDER)) == [("orders", 4, 1)]


def test_watched_rows_count_while_cleaning(raw):
    """As the metrics do: repeats are gone before rows without key are counted."""
    rows = [("o", "c", 1), ("o", None, 2), (None, "c", 3), (None, "d", 4), ("p", None, 5), ("p", "c", 6)]
    df = raw(["order_id", "customer_id"], rows)
    seen = cleaning.WatchedRows(df, "orders", ORDER)
    seen.rows.dropna(subset=["order_id", "customer_id"]).collect()
    assert seen.counts() == (6, 2)
    assert values(cleaning.clean_metrics({"orders": df}, ORDER)) == [("orders", *seen.counts())]
    # One scan of the raw rows, and no second shuffle where a cleaner drops repeats again.
    plan = cleaning.clean_metrics({"orders": df}, ORDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") + plan.count("Relation [") == 1
    again = cleaning._drop_repeats(cleaning.WatchedRows(df, "orders", ORDER).rows, "orders", ORDER)
    assert again._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 1


def _items(spark, key, price):
    columns = "order_id STRING, order_item_id STRING, product_id STRING, seller_id STRING, shipping_limit_date STRING, price STRING, freight_value STRING"
    return spark.createDataFrame([("o", key, "p", "s", None, price, "1")], columns)


def test_keys_written_as_decimals_are_read(spark):
    for text, number in (("1.0", 1), ("2", 2), ("1.5", None), ("x", None)):
        assert cleaning.clean_order_items(_items(spark, text, "3")).first().order_item_id == number


def test_an_amount_that_does_not_fit_fails_with_its_text(spark):
    assert str(cleaning.clean_order_items(_items(spark, "1", "99999999.99")).first().price) == "99999999.99"
    assert str(cleaning.clean_order_items(_items(spark, "1", "no number")).first().price) == "0.00"
    for text in ("123456789.50", "1e60"):
        with pytest.raises(Exception, match=text):
            cleaning.clean_order_items(_items(spark, "1", text)).collect()
