"""Joins by time: the last known value before a moment, and points inside intervals.

``as_of_join`` gives every left row the values of the last right row of its
group before it. Both sides are laid out together by (group, time) in range
partitions, so that a hot group is spread over as many tasks as its rows ask
for; inside a partition the last right row is carried forward by a window over
(partition, group), and one row per (partition, group) carries it into the
partitions behind. No task holds more of a group than one range partition.

``interval_join`` finds the points inside intervals without a nested loop.
An interval lies in at most two bins of a width of its own length's power of two,
so it is dealt to two rows at most however long it is; a point is dealt to one bin
of every width that occurs (never more than there are powers of two), and equal
(group, width, bin) is an equi-join, rechecked exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import checkpoint_root


def as_of_join(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str],
               strict: bool = True) -> DataFrame:
    """All rows and columns of ``left``, and ``values`` of the last right row with equal ``by``
    and ``on`` before the left row's (at or before it unless ``strict``).

    Right rows with a null in ``by`` or ``on`` match nothing, left rows with one get nulls.
    Among right rows equal in ``by`` and ``on`` the greatest ``values`` win.
    """
    checkpoint_root(left.sparkSession)
    known = (right.select(*by, on, F.struct(*values).alias("value"))
             .filter(F.forall(F.array(*[F.col(c).isNotNull() for c in [*by, on]]), lambda c: c))
             .groupBy(*by, on).agg(F.max("value").alias("value")))
    # At equal times a strict join puts the left rows first.
    mine = left.select(*by, on, F.lit(0 if strict else 1).alias("side"),
                       F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("row"))
    known = known.select(*by, on, F.lit(1 if strict else 0).alias("side"), "value")
    keys = [*by, on, "side"]
    laid = (mine.unionByName(known, allowMissingColumns=True)
            .repartitionByRange(*keys).sortWithinPartitions(*keys)
            .select(*by, "row", "value", F.spark_partition_id().alias("part"),
                    F.monotonically_increasing_id().alias("at")).checkpoint(eager=True))
    last = F.max_by("value", F.when(F.col("value").isNotNull(), F.col("at")))
    ends = laid.groupBy("part", *by).agg(last.alias("end"))
    behind = Window.partitionBy(*by).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", *by, F.last("end", ignorenulls=True).over(behind).alias("carried"))
    here = (Window.partitionBy("part", *by).orderBy("at")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    filled = laid.withColumn("value", F.last("value", ignorenulls=True).over(here)).filter(
        "row is not null")
    same = [filled["part"] == carried["part"], *[filled[c].eqNullSafe(carried[c]) for c in by]]
    found = F.coalesce(filled["value"], carried["carried"]).alias("value")
    return (filled.join(carried, same, "left").select(filled["row"].alias("row"), found)
            .select("row.*", "value.*"))


def _level(length: Column) -> Column:
    """Smallest k with length <= 2^k (0 for lengths up to 1)."""
    return F.ceil(F.log2(F.greatest(length, F.lit(1)).cast("double"))).cast("int")


def interval_join(points: DataFrame, intervals: DataFrame, by: list[str], point: str, start: str,
                  end: str) -> DataFrame:
    """Rows of both sides (columns of ``points``, then those of ``intervals`` without ``by``)
    with equal ``by`` and ``start <= point <= end``, all three whole numbers.

    Nulls match nothing, nor does an interval that ends before it starts.
    """
    whole = intervals.filter(F.col(start) <= F.col(end)).withColumn(
        "_level", _level(F.col(end) - F.col(start)))
    levels = whole.select("_level").distinct().collect()  # at most as many as a long has bits

    def bin_of(value: Column, level: Column) -> Column:
        return F.floor(value / F.pow(F.lit(2.0), level)).cast("long")

    binned = whole.withColumn("_bin", F.explode(F.sequence(
        bin_of(F.col(start), F.col("_level")), bin_of(F.col(end), F.col("_level")))))
    used = F.array(*[F.lit(r["_level"]) for r in levels]).cast("array<int>")
    spread = (points.filter(F.col(point).isNotNull()).withColumn("_level", F.explode(used))
              .withColumn("_bin", bin_of(F.col(point), F.col("_level"))))
    rest = [c for c in intervals.columns if c not in by]
    return (spread.join(binned, [*by, "_level", "_bin"])
            .filter((F.col(start) <= F.col(point)) & (F.col(point) <= F.col(end)))
            .select(*points.columns, *rest))
