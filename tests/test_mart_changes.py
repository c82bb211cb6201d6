"""Changes of the stored sums from one pass, against the sums before and after; loads into empty and large tables."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ordersight.operators import mart_changes, marts, rfm
from ordersight.sources import mart_states, star_tables
from ordersight.sources.mart_states import MartStates
from ordersight.sources.star_tables import StarHome, create_star, load_idempotent, new_rows, new_rows_sorted, read_star
from ordersight.star import STAR_SCHEMAS, StarSchema
from tests.conftest import order, values
from tests.test_mart_states import assert_same, rows_of_shop

SUMS = {
    "person_kpis": (marts.person_kpis, 1),
    "person_months": (marts.person_months, 2),
    "product_sums": (marts.product_sums, 1),
    "category_orders": (marts.category_orders, 1),
    "delivery_months": (marts.delivery_months, 1),
    "buyers": (lambda star: rfm.buyers(star).drop("last_purchase_date"), 1),
}


def test_changes_are_the_sums_now_less_those_before(spark, make_star):
    rows = rows_of_shop()
    # Rows that come twice, and values and keys that are missing.
    rows["orders"] += [rows["orders"][3], order("o500", None, None, None)]
    rows["items"] += [rows["items"][5], ("o3", 9, None, None, None, 1), ("o4", 8, "p1", "s1", None, 1)]
    rows["reviews"] += [("r9", None, 4), ("r8", "o3", None)]
    rows["products"].append(("p3", "k0"))
    star = make_star(**rows)
    # About half of the rows were known, of each table and whatever the order.
    known = {"fact_orders": "order_id", "fact_order_reviews": "review_id", "dim_customers": "customer_id", "dim_products": "product_id"}
    marked = {}
    for name, df in star.tables().items():
        key = [known[name]] if name in known else [F.col(c) for c in df.columns[:2]]
        marked[name] = df.withColumn("_known", F.pmod(F.xxhash64(*key), F.lit(2)) == 0)
    before = StarSchema(**{name: df.where("_known").drop("_known") for name, df in marked.items()})
    with mart_changes.state_changes(StarSchema(**marked)) as found:
        for name, (compute, keys) in SUMS.items():
            now, old = (defaultdict(lambda: [None] * 20, {row[:keys]: list(row[keys:]) for row in values(compute(of))}) for of in (star, before))
            df = compute(star)
            expected = {key: [None if a is None else a - (b or 0) for a, b in zip(row, old[key])] for key, row in now.items()}
            got = {row[:keys]: list(row[keys:]) for row in values(found[name], *df.columns)}
            changed = {key: row for key, row in expected.items() if any(row)}
            assert {key: row for key, row in got.items() if any(row)} == changed and changed, name
        pairs = [{(row.seller_id, row.product_id): row.lines for row in marts.seller_products(of).collect()} for of in (star, before)]
        lines = defaultdict(int)
        for (seller, product), n in pairs[0].items():
            for at in ((seller, None), (None, product)):
                lines[at] += n - (pairs[1].get((seller, product)) or 0)
        got = defaultdict(int)
        for seller, product, n in values(found["seller_products"]):
            got[seller, product] += n
        assert {k: n for k, n in got.items() if n and any(k)} == {k: n for k, n in lines.items() if n and any(k)}


@pytest.mark.parametrize("many", [0, 10**9])
def test_touched_orders_and_all_rows_give_the_same(spark, make_star, tmp_path, monkeypatch, many):
    monkeypatch.setattr(mart_states, "MANY_NEW", many)
    asked = []
    monkeypatch.setattr(MartStates, "_orders_touched", lambda self, new, f=MartStates._orders_touched: asked.append(1) or f(self, new))
    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    states = MartStates(spark, home, str(tmp_path / "states"))
    draw, rows = random.Random(3), rows_of_shop()
    cut = {name: [draw.random() < 0.6 for _ in some] for name, some in rows.items()}
    for first in (True, False):
        part = make_star(**{name: [row for row, early in zip(some, cut[name]) if early == first] for name, some in rows.items()})
        for name in ("dim_customers", "dim_products", "fact_orders", "fact_order_items", "fact_order_payments", "fact_order_reviews"):
            # Each row is in one of the two loads; files without an index may hold any key.
            part.table(name).coalesce(1).write.mode("append").parquet(home.path(name))
        states.update()
    assert_same(states, read_star(spark, home))
    assert len(asked) == (many == 0)
    # Sellers and products are kept, not each pair of them.
    pairs = states.read()["seller_products"]
    assert pairs.where("seller_id IS NOT NULL AND product_id IS NOT NULL").count() == 0 and pairs.count() <= 5 + 22


def test_one_sort_finds_the_new_rows_that_two_joins_find(spark):
    schema = STAR_SCHEMAS["fact_order_payments"]
    draw = random.Random(8)

    def some(n):
        rows = [(draw.choice([None, "o1", "o2", "o3", "o4"]), draw.choice([None, 1, 2, 3]), draw.choice([None, "a", "b"]), None, None) for _ in range(n)]
        return spark.createDataFrame(rows, schema)

    batch, stored = some(60), some(6)
    for order_by in (None, ["payment_type"]):
        found = [find(batch, stored, ["order_id", "payment_sequential"], order_by, "drop") for find in (new_rows, new_rows_sorted)]
        assert len({str(sorted(values(df), key=str)) for df in found}) == 1 and found[0].count() > 1
    with pytest.raises(Exception, match="null in primary key"):
        new_rows_sorted(batch, stored, ["order_id", "payment_sequential"]).collect()


def test_a_load_into_an_empty_table_stores_no_copy(spark, tmp_path, monkeypatch):
    def refuse(df):
        raise AssertionError("a copy of the batch was stored")

    home = StarHome(str(tmp_path / "star"))
    create_star(spark, home)
    monkeypatch.setattr(star_tables, "stored_while", refuse)
    load_idempotent(spark.createDataFrame([("s1",), ("s2",), ("s1",)], "seller_id STRING"), home, "dim_sellers")
    assert sorted(values(read_star(spark, home).dim_sellers, "seller_id")) == [("s1",), ("s2",)]
