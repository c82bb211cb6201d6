"""Raw CSV files in, cleaned CSV snapshots out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ordersight.operators.cleaning import ORDER_DAYS, PRODUCT_NUMBERS
from ordersight.sources.quoted_lines import read_records

# The columns of each raw dataset that are used.
RAW_COLUMNS = {
    "customers": [
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ],
    "products": ["product_id", "product_category_name", *PRODUCT_NUMBERS],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"],
    "orders": ["order_id", "customer_id", "order_status", *ORDER_DAYS],
    "order_items": ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value"],
    "payments": [
        "order_id",
        "payment_sequential",
        "payment_type",
        "payment_installments",
        "payment_value",
    ],
    "reviews": [
        "review_id",
        "order_id",
        "review_score",
        "review_comment_title",
        "review_comment_message",
        "review_creation_date",
        "review_answer_timestamp",
    ],
}
# Texts that mean "no value" in the raw files.
NULL_TEXTS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]
RAW_FILES = {name: f"{name}.csv" for name in RAW_COLUMNS}


def read_raw(
    spark: SparkSession,
    folder: str,
    files: dict[str, str] | None = None,
    multi_line: tuple[str, ...] = ("reviews",),
    split: tuple[str, ...] = (),
) -> dict[str, DataFrame]:
    """The seven datasets as strings, found by header name, in lazy frames.

    ``files`` maps a dataset to its file (or folder of part files) in
    ``folder``. Rows carry their place in the file (``_file``, ``_block``,
    ``_row``), so "the first of several" means the first in the file however
    the file is split.

    Datasets in ``multi_line`` may hold line breaks inside quotes. One task reads
    such a file, unless the dataset is in ``split`` too: then many tasks do
    (``sources/quoted_lines``), with equal rows, which pays for large files only.
    """
    files = {**RAW_FILES, **(files or {})}
    return {
        name: _read_csv(spark, f"{folder}/{files[name]}", name, name in multi_line, name in split)
        for name in RAW_COLUMNS
    }


def _read_csv(
    spark: SparkSession, path: str, dataset: str, multi_line: bool = False, split: bool = False
) -> DataFrame:
    # Only the header line is read here; no values are inspected.
    header = spark.read.option("header", True).csv(path).columns
    missing = [name for name in RAW_COLUMNS[dataset] if name not in header]
    if missing:
        raise ValueError(f"{path} lacks columns {missing}")
    schema = StructType([StructField(name, StringType()) for name in header])
    if multi_line and split:
        rows = _parsed(read_records(spark, path), schema)
    else:
        rows = (
            spark.read.schema(schema)
            .option("header", True)
            # A part file with its columns in another order fails rather than being read by place.
            .option("enforceSchema", False)
            .option("quote", '"')
            .option("escape", '"')
            .option("multiLine", multi_line)
            .csv(path)
            .select(
                *RAW_COLUMNS[dataset],
                F.col("_metadata.file_path").alias("_file"),
                F.col("_metadata.file_block_start").alias("_block"),
                F.monotonically_increasing_id().alias("_row"),
            )
        )
    return rows.select(
        *[F.when(~F.col(name).isin(NULL_TEXTS), F.col(name)).alias(name) for name in RAW_COLUMNS[dataset]],
        "_file",
        "_block",
        "_row",
    )


def _parsed(records: DataFrame, schema: StructType) -> DataFrame:
    """Fields of CSV records; a file whose first record has other names fails."""
    header = F.array(*[F.lit(f.name) for f in schema])
    columns = ", ".join(f"`{f.name}` string" for f in schema)
    parsed = records.withColumn("fields", F.from_csv("record", columns, {"quote": '"', "escape": '"'}))
    names = F.array(*[F.regexp_replace(F.col(f"fields.`{f.name}`"), "^\ufeff", "") for f in schema])
    wrong = F.raise_error(F.concat(F.lit("CSV header does not conform to the schema in "), "_file", F.lit(": "), "record"))
    data = F.when(F.col("is_first") & (F.lower(F.array_join(names, ",")) != F.lower(F.array_join(header, ","))), wrong.cast("boolean")).otherwise(~F.col("is_first"))
    return parsed.filter(data).select("fields.*", "_file", "_block", "_row")


def write_clean(df: DataFrame, folder: str, name: str, file_format: str = "csv") -> str:
    """Save a cleaned dataset as ``<folder>/<name>_clean.<format>``, with header if CSV."""
    path = f"{folder}/{name}_clean.{file_format}"
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer = (
            writer.option("header", True)
            .option("escape", '"')
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
        )
    writer.format(file_format).save(path)
    return path
