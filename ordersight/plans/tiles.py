"""NTILE over a whole table by selection, without sorting it.

A window without PARTITION BY moves every row to a single task, and sorting the table over the
cluster only to cut it in five moves every row too. All that is needed are the few rows at which
tiles begin. They are found by counting: a bounded sample of the rows gives two pivots around
each wanted place, one aggregate counts the rows below and between them, and the search goes on
between them until so few rows are left that the driver can hold them. Samples only choose
pivots; counts are of all rows, so the rows found are exact. Nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.plans.shared_store import store

KEY_TYPE = "decimal(38,2)"
#: Rows of a stretch that the driver sorts; longer stretches are sampled.
HELD_ROWS = 20_000
_HASH_SPACE = 1 << 30


@dataclass(frozen=True)
class Stretch:
    """Rows from ``low`` up to but not with ``high`` in the order of one measure.

    Borders are (key, tie-break), None is open; ``before`` rows come earlier, ``rows`` are in it.
    """

    measure: int
    low: tuple | None
    high: tuple | None
    before: int
    rows: int


def _sort_key(row: tuple) -> tuple:
    """As Spark sorts (key, tie-break): NULL first."""
    key, tie = row
    return (key, False) if tie is None else (key, True, tie)


def _reaches(key: Column, tie: Column, border: tuple | None, tie_type) -> Column:
    """Whether a row is at ``border`` or after it."""
    if border is None:
        return F.lit(True)
    at = F.lit(border[0]).cast(KEY_TYPE)
    # NULL is the smallest tie-break, so it is reached by all and reaches no other.
    tied = F.lit(True) if border[1] is None else F.coalesce(tie >= F.lit(border[1]).cast(tie_type), F.lit(False))
    return (key > at) | ((key == at) & tied)


def _inside(stretch: Stretch, tie: Column, tie_type) -> Column:
    key = F.col(f"_key{stretch.measure}")
    inside = _reaches(key, tie, stretch.low, tie_type)
    return inside if stretch.high is None else inside & ~_reaches(key, tie, stretch.high, tie_type)


def _draw(rows: DataFrame, stretches: list[Stretch], tiebreak: str, held: int, turn: int) -> list[list[tuple]]:
    """Of each stretch all rows, or about ``held`` of them by a hash of the tie-break, in order."""
    tie, tie_type = F.col(tiebreak), rows.schema[tiebreak].dataType
    taken = []
    for at, stretch in enumerate(stretches):
        wanted = _inside(stretch, tie, tie_type)
        if stretch.rows > held:
            limit = ceil(_HASH_SPACE * held / stretch.rows)
            wanted = wanted & (F.pmod(F.xxhash64(tie, F.lit(turn)), F.lit(_HASH_SPACE)) < limit)
        taken.append(F.when(wanted, F.struct(F.lit(at).alias("at"), F.col(f"_key{stretch.measure}").alias("key"))))
    found = rows.select(tie.alias("tie"), F.explode(F.array_compact(F.array(*taken))).alias("row")).select("row.at", "row.key", "tie").toArrow()
    drawn: list[list[tuple]] = [[] for _ in stretches]
    for at, key, tied in zip(*(found.column(c).to_pylist() for c in ("at", "key", "tie"))):
        drawn[at].append((key, tied))
    return [sorted(part, key=_sort_key) for part in drawn]


def _narrow(rows: DataFrame, wanted: dict[tuple[int, int], tuple[Stretch, list[tuple]]], tiebreak: str) -> dict[tuple[int, int], Stretch]:
    """For each (measure, place) the shorter stretch it lies in, by counting all rows around two pivots."""
    tie, tie_type = F.col(tiebreak), rows.schema[tiebreak].dataType
    pivots, counts = {}, []
    for at, ((_, place), (stretch, drawn)) in enumerate(wanted.items()):
        # Four standard deviations; never so wide that nothing would be cut off.
        middle, spread = (place - stretch.before) * len(drawn) / stretch.rows, min(2 * sqrt(len(drawn)), len(drawn) / 4)
        first, last = int(middle - spread), ceil(middle + spread)
        low = drawn[first] if first >= 0 and drawn else stretch.low
        high = drawn[last] if last < len(drawn) else stretch.high
        part = Stretch(stretch.measure, low, high, 0, 0)
        pivots[at] = part
        below = Stretch(stretch.measure, stretch.low, low, 0, 0)
        counts.append((F.count_if(_inside(below, tie, tie_type)) if first >= 0 and drawn else F.lit(0).cast("long")).alias(f"below{at}"))
        counts.append(F.count_if(_inside(part, tie, tie_type)).alias(f"inside{at}"))
    found = rows.agg(*counts).first()
    result = {}
    for at, (target, (stretch, _)) in enumerate(wanted.items()):
        part, below, inside = pivots[at], found[f"below{at}"], found[f"inside{at}"]
        start, end = stretch.before + below, stretch.before + below + inside
        if target[1] < start:
            result[target] = Stretch(stretch.measure, stretch.low, part.low, stretch.before, below)
        elif target[1] < end:
            result[target] = Stretch(stretch.measure, part.low, part.high, start, inside)
        else:
            result[target] = Stretch(stretch.measure, part.high, stretch.high, end, stretch.rows - below - inside)
    return result


def rows_at(rows: DataFrame, targets: list[tuple[int, int]], total: int, tiebreak: str, held: int = HELD_ROWS) -> dict[tuple[int, int], tuple]:
    """The (key, tie-break) at each (measure, place) of ``rows``, whose keys are columns _key0, _key1, ...

    Every turn reads the keys and the tie-break twice and keeps about ``4 / sqrt(held)`` of a
    stretch, so a billion rows take four turns.
    """
    open_ = {target: Stretch(target[0], None, None, 0, total) for target in targets}
    found: dict[tuple[int, int], tuple] = {}
    turn = 0
    while open_:
        stretches = list(dict.fromkeys(open_.values()))
        drawn = dict(zip(stretches, _draw(rows, stretches, tiebreak, held, turn)))
        wanted = {}
        for target, stretch in open_.items():
            if stretch.rows <= held:
                found[target] = drawn[stretch][target[1] - stretch.before]
            else:
                wanted[target] = (stretch, drawn[stretch])
        open_ = _narrow(rows, wanted, tiebreak) if wanted else {}
        turn += 1
    return found


def add_ntiles(
    df: DataFrame,
    measures: dict[str, Column],
    tiebreak: str,
    tiles: int = 5,
    held: int = HELD_ROWS,
) -> DataFrame:
    """Add one INT column per measure holding ``ntile(tiles)``.

    Every measure is a numeric column read in ascending order (negate it for
    descending order), at most two decimals, not NULL. ``tiebreak`` must be
    unique; one NULL comes before all others. Matches
    ``ntile(tiles) OVER (ORDER BY measure, tiebreak NULLS FIRST)``.
    """
    keys = [value.cast(KEY_TYPE).alias(f"_key{at}") for at, value in enumerate(measures.values())]
    # Read several times below, so it is computed once.
    rows = store(df.select("*", *keys))
    total = rows.count()
    size, larger = divmod(total, tiles)
    starts = [tile * size + min(tile, larger) for tile in range(1, tiles)]
    targets = [(at, start) for at in range(len(measures)) for start in starts if start < total]
    cuts = rows_at(rows, targets, total, tiebreak, held)

    tie, tie_type = F.col(tiebreak), rows.schema[tiebreak].dataType

    def tile(at: int, name: str) -> Column:
        score = F.lit(1)
        for (measure, _), cut in cuts.items():
            if measure == at:
                score = score + F.when(_reaches(F.col(f"_key{at}"), tie, cut, tie_type), 1).otherwise(0)
        return score.cast("int").alias(name)

    return rows.select(*df.columns, *[tile(at, name) for at, name in enumerate(measures)])
