from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from ordersight.session import build_session
from ordersight.star import STAR_SCHEMAS, StarSchema


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def _convert(value, kind: str):
    if value is None:
        return None
    if kind == "date" and isinstance(value, str):
        return date.fromisoformat(value)
    if kind.startswith("decimal"):
        return Decimal(str(value))
    return value


@pytest.fixture(scope="session")
def make_star(spark):
    """A star from short tuples; columns left out at the end of a tuple are NULL.

    Tables may be given without their prefix: ``orders=[(...), ...]``.
    """

    def build(**tables) -> StarSchema:
        frames = {}
        for name, schema in STAR_SCHEMAS.items():
            short = name.removeprefix("dim_").removeprefix("fact_order_").removeprefix("fact_")
            rows = []
            for row in tables.pop(short, []):
                padded = list(row) + [None] * (len(schema) - len(row))
                rows.append(
                    tuple(
                        _convert(value, field.dataType.simpleString())
                        for value, field in zip(padded, schema)
                    )
                )
            frames[name] = spark.createDataFrame(rows, schema)
        assert not tables, f"unknown tables {list(tables)}"
        return StarSchema(**frames)

    return build


def order(order_id, customer_id, day, status="delivered", received=None, promised=None):
    return (order_id, customer_id, status, day, None, None, received, promised)


def values(df, *columns):
    """Rows as tuples of the given columns (all by default), in the frame's order."""
    return [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
