"""Group work that stays balanced when one group holds much of the data.

Counts, sums, means and minima merge before the shuffle and need no care.
Windows and exact quantiles do: Spark gives a whole group to one task. Here a
group is cut into slots by the leading order column (a minute of time, the upper
bits of a value), a function of the row alone. Counts and sums of the slots
merge before the shuffle; their running totals, one row per slot, tell each slot where it
begins. So the same lazy plan serves groups of any size, without a look at
the data first, and every evaluation puts a row into the same place.

Operators whose input is known to be bounded (one row per device and minute
gives at most 1440 rows per device-day) pass ``bounded=True`` and use one window per group.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from airq.functions.aggregates import n_rows

#: Rows of a group that one window holds.
CHUNK_ROWS = 1_000_000
#: Width of a slot: seconds of a time, units of a number.
SLOT = 60

WindowColumn = Callable[[WindowSpec], Column]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on equally named keys where NULL matches NULL; keys appear once."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(and_, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def with_slot(df: DataFrame, by: str, width: float = SLOT) -> DataFrame:
    """Add ``_slot``, which ascends with the column ``by``: a time, a date or a number."""
    kind = dict(df.dtypes)[by]
    if kind.startswith("timestamp") or kind == "date":
        place = F.unix_micros(F.col(by).cast("timestamp")) / 1_000_000
    else:
        place = F.col(by).cast("double")
    return df.withColumn("_slot", F.floor(place / width))


def _slot_starts(slotted: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """Per group and slot: sums over all earlier slots of the group.

    The window sees one row per slot that has rows. Missing times come first, as in an ascending order.
    """
    per_slot = slotted.groupBy(*keys, "_slot").agg(*[s.alias(n) for n, s in sums.items()])
    earlier = W.partitionBy(*keys).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    return per_slot.select(*keys, "_slot", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(n) for n in sums])


def with_row_windows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: Sequence[Mapping[str, WindowColumn]],
    before: int,
    after: int,
    bounded: bool = False,
    chunk_rows: int = CHUNK_ROWS,
    slot: float = SLOT,
) -> DataFrame:
    """Add window columns that look at most ``before``/``after`` rows away.

    ``columns`` is a list of steps; a step may use the columns of earlier
    ones, ``before`` and ``after`` cover the reach of all steps together.
    ``order`` must be total within a group for a repeatable result.

    Unless ``bounded``, rows are numbered through their slots and a group's rows are
    computed in chunks of ``chunk_rows`` rows; a chunk also gets the rows of its neighbours that its frames reach.
    """

    def compute(frame: DataFrame, group: Sequence[str], by: Sequence[str]) -> DataFrame:
        w = W.partitionBy(*group).orderBy(*by)
        for step in columns:
            frame = frame.withColumns({name: make(w) for name, make in step.items()})
        return frame

    if bounded:
        return compute(df, keys, order)
    chunk = max(chunk_rows, before + after + 1)
    slotted = with_slot(df, order[0], slot)
    starts = _slot_starts(slotted, keys, {"_start": n_rows()})
    in_slot = W.partitionBy(*keys, "_slot").orderBy(*order)
    placed = null_safe_join(slotted, starts, [*keys, "_slot"], "inner").withColumn("_row", F.row_number().over(in_slot))
    position = F.col("_row") + F.col("_start") - 1
    own, place = F.floor(position / chunk), position % chunk
    nothing = F.lit(None).cast("bigint")
    copies = F.array_compact(F.array(
        F.lit(0).cast("bigint"),
        F.when(place >= chunk - before, F.lit(1).cast("bigint")).otherwise(nothing),
        F.when((place < after) & (own > 0), F.lit(-1).cast("bigint")).otherwise(nothing),
    ))
    spread = placed.withColumns({"_position": position, "_own": own, "_copy": copies}).withColumn("_copy", F.explode("_copy"))
    spread = spread.withColumn("_chunk", F.col("_own") + F.col("_copy"))
    done = compute(spread, [*keys, "_chunk"], ["_position"]).where(F.col("_copy") == 0)
    names = [name for step in columns for name in step]
    return done.select(*[c for c in df.columns if c not in names], *dict.fromkeys(names))


def with_running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    bounded: bool = False,
    slot: float = SLOT,
) -> DataFrame:
    """Running sum per group; missing from the first missing value onwards.

    Unless ``bounded``, each slot is summed on its own and begins with the sum of the slots before it.
    """
    holes = F.when(F.col(value).isNull(), 1).otherwise(0)

    def add(frame: DataFrame, group: Sequence[str], start: Column, start_holes: Column) -> DataFrame:
        so_far = W.partitionBy(*group).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
        total = F.coalesce(F.sum(value).over(so_far), F.lit(0.0)) + start
        return frame.withColumn(name, F.when(F.sum(holes).over(so_far) + start_holes == 0, total))

    if bounded:
        return add(df, keys, F.lit(0.0), F.lit(0))
    slotted = with_slot(df, order[0], slot)
    starts = _slot_starts(slotted, keys, {"_sum": F.coalesce(F.sum(value), F.lit(0.0)), "_holes": F.sum(holes)})
    joined = null_safe_join(slotted, starts, [*keys, "_slot"], "inner")
    return add(joined, [*keys, "_slot"], F.col("_sum"), F.col("_holes")).select(*[c for c in df.columns if c != name], name)


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    probabilities: Sequence[float],
    bounded: bool = False,
) -> DataFrame:
    """Per group: mean and exact quantiles of each measure.

    Columns: keys, ``<measure>_mean`` and ``<measure>_q``, an array in the order
    of ``probabilities``; linear interpolation between the neighbouring values.
    Unless ``bounded``, values are selected by rank from merged counts.
    """
    levels = F.array(*[F.lit(float(p)) for p in probabilities])
    means = [F.avg(m).alias(f"{m}_mean") for m in measures]
    if bounded:
        return df.groupBy(*keys).agg(*means, *[F.percentile(m, levels).alias(f"{m}_q") for m in measures])
    return _quantiles_by_rank(df, keys, measures, probabilities)


def _value_slot(value: Column) -> Column:
    """Ascends with the value: two millionths of it and less fall into one slot, whatever its size."""
    size = F.floor(F.log2(F.abs(value)))
    # The exponent, then the leading bits of the fraction; mirrored for negative values, infinite ones and NaN outermost.
    part = F.floor((F.abs(value) / F.pow(F.lit(2.0), size) - 1) * (1 << 20))
    endless = F.when(F.isnan(value), F.lit(1 << 41)).when(F.abs(value) == float("inf"), F.signum(value) * (1 << 40))
    return endless.when(value == 0, F.lit(0)).otherwise(F.signum(value) * ((size + 1100) * (1 << 21) + part)).cast("bigint")


def _quantiles_by_rank(df, keys, measures, probabilities):
    """A narrowing histogram: merged counts of slots say in which slot a rank lies, merged counts of its values which value it is.

    Equal values merge before the shuffle. One row per slot and group is put in order, then the values of the few
    slots that hold a wanted rank.
    """
    group = [*keys, "_measure"]
    numbers = F.array(*[F.struct(F.lit(i).alias("_measure"), F.col(m).cast("double").alias("_value")) for i, m in enumerate(measures)])
    long = df.select(*keys, F.inline(numbers)).where(F.col("_value").isNotNull())
    counted = long.groupBy(*group, "_value").agg(n_rows().alias("_n")).withColumn("_slot", _value_slot(F.col("_value")))
    slots = counted.groupBy(*group, "_slot").agg(F.sum("_n").alias("_n"), F.sum(F.col("_value") * F.col("_n")).alias("_sum"))
    upto = W.partitionBy(*group).orderBy("_slot").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*group).orderBy("_slot").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    slots = slots.withColumns({"_end": F.sum("_n").over(upto), "_size": F.sum("_n").over(whole), "_mean": F.sum("_sum").over(whole) / F.sum("_n").over(whole)})
    places = [(F.col("_size") - 1) * F.lit(float(p)) for p in probabilities]
    first = F.col("_end") - F.col("_n")
    wanted = reduce(lambda a, b: a | b, [r(p).between(first, F.col("_end") - 1) for p in places for r in (F.floor, F.ceil)])
    slots = slots.where(wanted).select(*group, "_slot", first.alias("_start"), "_size", "_mean")

    chosen = null_safe_join(counted, slots, [*group, "_slot"], "inner")
    in_slot = W.partitionBy(*group, "_slot").orderBy("_value").rowsBetween(W.unboundedPreceding, W.currentRow)
    last = F.col("_start") + F.sum("_n").over(in_slot) - 1
    chosen = chosen.withColumn("_last", last)
    picks = [F.max("_mean").alias("_mean")]
    for i, place in enumerate(places):
        for name, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            picks.append(F.max(F.when(rank.between(F.col("_last") - F.col("_n") + 1, F.col("_last")), F.col("_value"))).alias(f"_{name}{i}"))
        picks.append(F.max(place).alias(f"_place{i}"))

    def interpolated(i: int) -> Column:
        low, high, place = F.col(f"_low{i}"), F.col(f"_high{i}"), F.col(f"_place{i}")
        between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        return F.when(low == high, low).otherwise(between)

    found = chosen.groupBy(*group).agg(*picks)
    found = found.select(*group, "_mean", F.array(*[interpolated(i) for i in range(len(probabilities))]).alias("_q"))
    # Groups whose values are all missing are there too.
    every = df.select(*keys).distinct().withColumns({"_measure": F.lit(None).cast("int"), "_mean": F.lit(None).cast("double"), "_q": F.lit(None).cast("array<double>")}) if keys else None
    if every is not None:
        found = found.unionByName(every)

    def of(i: int, c: str) -> Column:
        return F.max(F.when(F.col("_measure") == i, F.col(c)))

    return found.groupBy(*keys).agg(*[of(i, "_mean").alias(f"{m}_mean") for i, m in enumerate(measures)], *[of(i, "_q").alias(f"{m}_q") for i, m in enumerate(measures)])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One whole row per key, the first in ``order``; merges before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.struct(*order, row)
    return df.groupBy(*keys).agg(F.min_by(row, rank).alias("_row")).select(*keys, "_row.*")
