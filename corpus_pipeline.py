"""From documents to training sequences: five stages, each written and read again.

1. ``quality``: documents that the classifier rejects go.
2. ``near_duplicates``: of each group of near copies the smallest id stays.
3. ``repeats``: strings of 50 bytes that start in an earlier document are cut out.
4. ``decontamination``: documents that hold a window of a benchmark item go.
5. ``packing``: what is left is packed into sequences.

All stages but the last return the columns of ``documents``; the third puts the new
length into ``n_chars``. SQL cannot express the first two and the last stage, so the tests
compare the stages with brute force.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.llm import decontamination, near_duplicates, packing, quality_model, repeats
from ordersight.llm.tables import ship_library, table
from ordersight.plans.shared_store import store


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least the contract's limit."""
    ship_library(spark)
    model = quality_model.train(docs, quality_model.quality_labels(table(spark, sf_dir, "labels")))
    scored = quality_model.score_quality(docs, model)
    return scored.where(F.col("score") >= quality_model.GOOD).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each class; rows without an id stay, of rows that are alike in id and text one."""
    ship_library(spark)
    classes = near_duplicates.near_duplicate_classes(docs)
    # Ids of kept documents; every class has one, whatever its size.
    kept = classes.where("doc_id = class_id").select(F.col("doc_id").alias("kept_id"))
    found = docs.join(kept, docs["doc_id"].cast("long") == kept["kept_id"], "left_semi")
    if not docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        found = found.dropDuplicates(["doc_id", "text"])
    return found.unionByName(docs.where("doc_id is null"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the strings that an earlier one has; a null text stays null."""
    ship_library(spark)
    cut = repeats.remove_repeats(docs, as_text=True)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept"))
    changed = {"text": text, "n_chars": F.char_length(text).cast("long")}
    return cut.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("items") == 0).select("row.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_library(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_dedup),
    ("repeats", cut_repeats),
    ("decontamination", decontaminate),
    ("packing", pack),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
