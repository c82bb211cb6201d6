"""Reading the given tables, and what several operators share."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()


def ship_library(spark: SparkSession) -> None:
    """Let Python workers import this package where PYTHONPATH does not.

    The zip is served to the executors by Spark, as with ``--py-files``.
    """
    root, application = _PACKAGE.parent, spark.sparkContext.applicationId
    paths = os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if application in _shipped or any(p and Path(p).resolve() == root for p in paths):
        return
    place = Path(tempfile.mkdtemp()) / "ordersight_library.zip"
    with zipfile.ZipFile(place, "w") as archive:
        for file in sorted(_PACKAGE.rglob("*.py")):
            archive.write(file, file.relative_to(root))
    spark.sparkContext.addPyFile(str(place))
    _shipped.add(application)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    ship_library(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_bytes(text: Column) -> Column:
    """UTF-8 length; null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def id_remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id written as text, modulo ``divisor`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % divisor


def partitions_for(amount: int, each: int, least: int) -> int:
    """Partitions of about ``each`` for an amount of rows or bytes."""
    return max(least, -(-amount // each))


def first_of_each(df: DataFrame, *keys: str) -> DataFrame:
    """One row of each key, that with the smallest hash of the other columns; each task sends one row a key."""
    others = [name for name in df.columns if name not in keys]
    best = F.min(F.struct(F.xxhash64(*others).alias("_hash"), *others)).alias("_first")
    return df.groupBy(*keys).agg(best).select(*[name if name in keys else F.col(f"_first.{name}").alias(name) for name in df.columns])


def as_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """One struct column ``row`` of the named columns (all by default), text as string.

    Columns an operator adds then never clash with those of the input.
    """
    kept = [docs[f"`{name}`"] for name in (columns or docs.columns)]
    kept = [c.cast("string").alias("text") if name == "text" else c for name, c in zip(columns or docs.columns, kept)]
    return docs.select(F.struct(*kept).alias("row"))
