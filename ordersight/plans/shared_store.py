"""Intermediate tables in the shared folder the cluster names.

A stored table cuts the lineage: it is read back from shared storage, so it
outlives lost executors and is not computed again by later steps.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session, or else a folder in its warehouse."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_steps"


def run_folder(spark: SparkSession) -> str:
    """The part of the shared folder this application may fill and drop."""
    return f"{shared_folder(spark).rstrip('/')}/ordersight-{spark.sparkContext.applicationId}"


def store(df: DataFrame) -> DataFrame:
    """Write ``df`` once and return a frame that reads the written copy."""
    spark = df.sparkSession
    path = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def stored_while(df: DataFrame) -> Iterator[DataFrame]:
    """A stored copy of ``df`` that is removed afterwards."""
    spark = df.sparkSession
    place = f"{run_folder(spark)}/{uuid.uuid4().hex}"
    try:
        df.write.parquet(place)
        yield spark.read.schema(df.schema).parquet(place)
    finally:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def drop_stored(spark: SparkSession) -> bool:
    """Remove everything this application stored; call when results are used up."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_folder(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.delete(path, True)
