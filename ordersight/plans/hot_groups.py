"""Ordered windows over groups that may be too large for one task.

A window with PARTITION BY gives each group to one task. That is the cheapest
plan while groups are of a bounded size; the rows of larger groups spread over
many tasks.

* :func:`add_previous` is one lazy plan: groups beyond ``max_rows`` are cut into
  slices that follow the order, and the first row of a slice takes its value from a
  summary with one row per slice.
* :func:`add_ranks` checks the groups first: those within ``max_rows`` take the plain
  window, the others are range-sorted, and what a row needs from an earlier task is
  carried over from a summary with one row per sorted partition and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ordersight.plans.shared_store import store

SLOT_BITS = 33  # monotonically_increasing_id keeps the partition above this bit
MAX_GROUP_ROWS = 4_000_000
MAX_BROADCAST_KEYS = 50_000


def _split(
    df: DataFrame, group: str, row_bounds: DataFrame, max_rows: int
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of groups within ``max_rows``, rows of larger groups or None)."""
    large = row_bounds.filter(F.col("n") > max_rows).select(F.col(group).alias("_large"))
    keys = large.count()
    if keys == 0:
        return df, None
    if keys <= MAX_BROADCAST_KEYS:
        large = F.broadcast(large)
    same = F.col(group).eqNullSafe(F.col("_large"))
    return df.join(large, same, "left_anti"), df.join(large, same, "left_semi")


def _range_sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    """``df`` sorted over the cluster and stored, with _pos (order) and _slot (partition)."""
    placed = df.orderBy(*order).withColumn("_pos", F.monotonically_increasing_id())
    return store(placed).withColumn("_slot", F.shiftright("_pos", SLOT_BITS))


def add_previous(
    df: DataFrame,
    group: str,
    order: list[str],
    previous: dict[str, str],
    row_bounds: DataFrame,
    max_rows: int = MAX_GROUP_ROWS,
    slices: list[Column] | None = None,
) -> DataFrame:
    """``lag(column, 1)`` within ``group`` for each ``previous[new_name] = column``.

    ``order`` must be unique within a group. ``row_bounds`` has (group, n) with
    n an upper bound of the group's rows. ``slices`` (the first column of ``order`` by
    default) cut a group with more than ``max_rows``: ascending with NULL last they must
    follow ``order``, and the different ones of a group must fit a task.
    """
    ascending = [F.asc_nulls_last(name) for name in order]
    # At most one key for every ``max_rows`` rows.
    large = F.broadcast(row_bounds.filter(F.col("n") > max_rows).select(F.col(group).alias("_large"), F.lit(True).alias("_hot")))
    cuts = {f"_slice{k}": F.when(F.col("_hot"), cut) for k, cut in enumerate(slices or [F.col(order[0])])}
    marked = df.join(large, F.col(group).eqNullSafe(F.col("_large")), "left").withColumns(cuts).drop("_large", "_hot")
    # One exchange, which both the rows and the summary read.
    dealt = marked.withColumn("_part", F.xxhash64(group, *cuts)).repartition("_part")
    keys = ["_part", group, *cuts]
    values = F.struct(*[F.col(source).alias(name) for name, source in previous.items()])
    place = F.struct(*[part for name in order for part in (F.col(name).isNull(), F.col(name))])
    # All columns take part, so that the summary needs the same exchange as the rows.
    last = F.max_by(F.struct(F.struct(*df.columns).alias("row"), values.alias("values")), place).alias("last")
    by_slice = Window.partitionBy(group).orderBy(*[F.asc_nulls_last(name) for name in cuts])
    carried = dealt.groupBy(*keys).agg(last).select(*keys, F.lag("last").over(by_slice).alias("_carried"))
    in_slice = Window.partitionBy(*keys).orderBy(*ascending)
    rows = dealt.withColumn("_before", F.lag(values).over(in_slice)).withColumn("_first", F.row_number().over(in_slice) == 1)
    same = F.col("r._part") == F.col("c._part")
    for name in keys[1:]:
        same &= F.col(f"r.{name}").eqNullSafe(F.col(f"c.{name}"))
    chosen = F.when(F.col("_first"), F.col("_carried.values")).otherwise(F.col("_before"))
    found = rows.alias("r").join(carried.alias("c"), same).withColumn("_chosen", chosen)
    return found.select(*[F.col(f"r.{name}") for name in df.columns], *[F.col(f"_chosen.{name}") for name in previous])


def add_ranks(
    df: DataFrame,
    group: str,
    unique: str,
    measures: dict[str, tuple[Column, list[str]]],
    row_bounds: DataFrame,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add ``<measure>_<kind>`` within ``group`` for each measure: (value, kinds).

    A kind is ``row``, ``rank`` or ``dense``. A measure is ranked from high to
    low with NULL last; equal values share rank and dense rank, and row numbers
    follow ``unique``, the key of ``df``. Also adds ``group_rows``.
    """
    functions = {"row": F.row_number, "rank": F.rank, "dense": F.dense_rank}

    def plain(rows: DataFrame) -> DataFrame:
        columns = []
        for name, (value, kinds) in measures.items():
            by_value = Window.partitionBy(group).orderBy(value.desc_nulls_last())
            by_row = Window.partitionBy(group).orderBy(value.desc_nulls_last(), F.col(unique).asc())
            for kind in kinds:
                window = by_row if kind == "row" else by_value
                columns.append(functions[kind]().over(window).alias(f"{name}_{kind}"))
        total = F.count("*").over(Window.partitionBy(group)).alias("group_rows")
        return rows.select("*", *columns, total)

    def spread(rows: DataFrame) -> DataFrame:
        def side(name: str, value: Column) -> Column:
            # Doubles and exact numbers keep their own field, so no digit is lost.
            double = rows.select(value).schema[0].dataType == DoubleType()
            both = F.struct(
                (F.lit(None) if double else value).cast("decimal(38,2)").alias("exact"),
                (value if double else F.lit(None)).cast("double").alias("inexact"),
            )
            return F.struct(F.lit(name).alias("measure"), both.alias("value"))

        sides = F.array(*[side(name, value) for name, (value, _) in measures.items()])
        # A missing value is the smallest struct field, so it comes last.
        placed = _range_sorted(
            rows.select(group, unique, F.explode(sides).alias("side")).select(
                group, unique, "side.measure", "side.value"
            ),
            [F.col("measure"), F.col(group), F.col("value").desc(), F.col(unique)],
        )
        in_run = Window.partitionBy("_slot", "measure", group)
        by_value = in_run.orderBy(F.col("value").desc())
        local = placed.select(
            "*",
            F.row_number().over(in_run.orderBy("_pos")).alias("local_row"),
            F.rank().over(by_value).alias("local_rank"),
            F.dense_rank().over(by_value).alias("local_dense"),
        )
        # One run per sorted partition and group: at most partitions + groups rows.
        runs = local.groupBy("measure", group, "_slot").agg(
            F.count("*").alias("n"),
            F.max("local_dense").alias("values_in_run"),
            F.max("local_rank").alias("last_value_at"),
            F.min_by("value", "_pos").alias("first_value"),
            F.max_by("value", "_pos").alias("last_value"),
        )
        by_slot = Window.partitionBy("measure", group).orderBy("_slot")
        earlier = by_slot.rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            runs.withColumn("rows_before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            .withColumn(
                "goes_on",
                F.col("first_value").eqNullSafe(F.lag("last_value").over(by_slot)),
            )
            .withColumn(
                "values_before",
                F.coalesce(
                    F.sum(F.col("values_in_run") - F.col("goes_on").cast("int")).over(earlier), F.lit(0)
                ),
            )
            # Where the last value of a run began, unless it began in an earlier run.
            .withColumn(
                "began_at",
                F.when(
                    ~F.col("goes_on") | (F.col("values_in_run") > 1),
                    F.col("rows_before") + F.col("last_value_at"),
                ),
            )
            .withColumn("open_rank", F.last("began_at", ignorenulls=True).over(earlier))
            .select("measure", group, "_slot", "rows_before", "values_before", "goes_on", "open_rank")
        )
        run_keys = (
            (F.col("l._slot") == F.col("c._slot"))
            & (F.col("l.measure") == F.col("c.measure"))
            & F.col(f"l.{group}").eqNullSafe(F.col(f"c.{group}"))
        )
        ranked = (
            local.alias("l")
            .join(carried.alias("c"), run_keys)
            .select(
                f"l.{unique}",
                "l.measure",
                (F.col("rows_before") + F.col("local_row")).alias("row"),
                F.when(F.col("goes_on") & (F.col("local_dense") == 1), F.col("open_rank"))
                .otherwise(F.col("rows_before") + F.col("local_rank"))
                .alias("rank"),
                (
                    F.col("values_before") + F.col("local_dense") - F.col("goes_on").cast("int")
                ).alias("dense"),
            )
        )
        wide = ranked.groupBy(unique).agg(
            *[
                F.max(F.when(F.col("measure") == name, F.col(kind))).cast("int").alias(f"{name}_{kind}")
                for name, (_, kinds) in measures.items()
                for kind in kinds
            ]
        )
        totals = rows.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("group_rows"))
        return (
            rows.join(wide, unique)
            .join(totals, F.col(group).eqNullSafe(F.col("_group")))
            .drop("_group")
        )

    small, large = _split(df, group, row_bounds, max_rows)
    if large is None:
        return plain(small)
    # Read several times below, so it is computed once.
    small, large = _split(store(df), group, row_bounds, max_rows)
    return plain(small).unionByName(spread(large))
