"""CSV records with line breaks inside quotes, from files that are split over tasks.

Whether a line begins inside a quoted field is known only from all lines before it. So each line is read
as a map from "inside or not" at its beginning to the same at its end: it keeps the state, turns it, or sets
it. Such maps are composed, first over the lines of a block of the file, then over the blocks (one row each),
and so every block learns its state without one task reading the file.

Each block also learns which record is open at its beginning, so all lines are grouped by the block and
number at which their record starts.

Lines end with ``\\n`` or ``\\r\\n``; inside quotes both become ``\\n``. A quote opens a field only at its
beginning, and is written twice inside one. Empty lines between records are left out. A quote that is never closed makes the rest of its file one record.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_BLOCK = ["_file", "_block"]


def _ends_inside(line: Column) -> Column:
    """Whether a line that begins outside of quotes ends inside of them (0 or 1)."""
    # Pairs of quotes are escaped ones or empty fields; then closed fields go.
    single = F.replace(line, F.lit('""'), F.lit(""))
    return F.regexp_replace(single, '(^|,)"[^"]*+"', "$1x").rlike('(^|,)"').cast("int")


def _composed(maps: DataFrame, window: Window) -> DataFrame:
    """``maps`` (``from_out``, ``from_in``: the state after each row) with ``_turns`` and ``_base`` up to each row.

    The state after it is ``_base``, or that at the beginning of the window where ``_base`` is null, turned
    if ``_turns`` is odd.
    """
    turn = (F.col("from_out") > F.col("from_in")).cast("int")
    turned = maps.withColumn("_turns", F.sum(turn).over(window))
    base = F.when(F.col("from_out") == F.col("from_in"), F.col("from_out").bitwiseXOR(_odd(F.col("_turns"))))
    return turned.withColumn("_base", F.last(base, ignorenulls=True).over(window))


def _odd(turns: Column) -> Column:
    return (turns % 2).cast("int")


def _state(base: Column, turns: Column, entry: Column) -> Column:
    return F.coalesce(base, entry).bitwiseXOR(_odd(turns))


def _entries(lines: DataFrame) -> DataFrame:
    """For each block of a file the state at its beginning, and the record that is open there (block and number)."""
    last = F.max_by(F.struct("_base", "_turns"), "_line").alias("last")
    starts = [F.sum((~F.col("blank") & (F.col(f"before_{e}") == 0)).cast("int")).alias(f"starts_{e}") for e in (0, 1)]
    ends = [_state(F.col("last._base"), F.col("last._turns"), F.lit(e)).alias(name) for e, name in enumerate(("from_out", "from_in"))]
    blocks = lines.groupBy(*_BLOCK).agg(last, *starts).select(*_BLOCK, *ends, "starts_0", "starts_1")
    in_file = Window.partitionBy("_file").orderBy("_block")
    after = _state(F.col("_base"), F.col("_turns"), F.lit(0))
    known = _composed(blocks, in_file.rowsBetween(Window.unboundedPreceding, 0)).withColumn("after", after)
    known = known.withColumn("entry", F.lag("after", 1, 0).over(in_file))
    known = known.withColumn("starts", F.when(F.col("entry") == 0, F.col("starts_0")).otherwise(F.col("starts_1")))
    begun = F.when(F.col("starts") > 0, F.struct(F.col("_block").alias("block"), F.col("starts").alias("number")))
    opened = F.last(begun, ignorenulls=True).over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    return known.select(*_BLOCK, "entry", opened.alias("opened"))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Records of CSV files: ``_file``, ``_block`` and ``_row`` (order within the file), ``record``, ``is_first`` of its file."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
        F.regexp_replace("value", "\r$", "").alias("value"),
    )
    quoted = F.col("value").contains('"')
    lines = lines.select(
        "*",
        (F.col("value") == "").alias("blank"),
        F.when(quoted, _ends_inside(F.col("value"))).otherwise(0).alias("from_out"),
        F.when(quoted, _ends_inside(F.concat(F.lit('"'), "value"))).otherwise(1).alias("from_in"),
    )
    in_block = Window.partitionBy(*_BLOCK).orderBy("_line")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    before = F.lag(F.struct("_base", "_turns")).over(in_block)
    lines = _composed(lines, so_far).withColumn("_before", before)
    turns = F.coalesce("_before._turns", F.lit(0))
    lines = lines.select(
        *_BLOCK, "_line", "value", "blank", "_turns", "_base", *[_state(F.col("_before._base"), turns, F.lit(e)).alias(f"before_{e}") for e in (0, 1)]
    )
    starts = ~F.col("blank") & (F.col("before") == 0)
    numbered = (
        lines.join(_entries(lines), _BLOCK)
        .withColumn("before", F.when(F.col("entry") == 0, F.col("before_0")).otherwise(F.col("before_1")))
        .filter(starts | (F.col("before") == 1))
        .withColumn("number", F.sum(starts.cast("int")).over(so_far))
    )
    # Lines before the first start of a block belong to the record that is open there.
    own = F.struct(F.col("_block").alias("block"), F.col("number"))
    records = numbered.select("_file", F.when(F.col("number") > 0, own).otherwise(F.col("opened")).alias("at"), F.struct("_block", "_line", "value").alias("line"))
    records = records.groupBy("_file", "at").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return records.select(
        "_file",
        F.col("at.block").alias("_block"),
        F.col("at.number").alias("_row"),
        F.array_join("lines.value", "\n").alias("record"),
        ((F.col("at.block") == 0) & (F.col("at.number") == 1)).alias("is_first"),
    )
