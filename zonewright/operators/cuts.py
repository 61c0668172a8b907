"""Distributed prefix sums: take rows of each group in key order up to an exact budget.

Rows get a position in [0, 1) that orders them within their group. Each group is cut into ranges
of positions, as many as its row count needs for ``rows_per_range`` rows in a range; sizes are
summed per range (combined before the shuffle), the sums are accumulated over the ranges of a
group, and only inside its range is a row placed one by one. So no task ever holds a whole group,
however many rows one group has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_RANGE = 20_000


def unit_hash(*cols: Column, seed: int = 42) -> Column:
    """A number in (0, 1) drawn from a hash of the columns, the same in every run."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)
    return (h + F.lit(0.5)) / F.lit(float(1 << 53))


def prefix_sums(
    rows: DataFrame, group: list[str], position: str, tie: str, size: Column, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """``rows`` with ``size_``, ``before_`` (sizes of the rows in front) and ``group_total_``.

    ``position`` must lie in [0, 1); equal positions are ordered by ``tie``, which must be unique
    within a group. Null sizes count as 0.
    """
    sized = rows.withColumn("size_", F.coalesce(size, F.lit(0)).cast("bigint"))
    key = [F.col(g) for g in group]
    counts = sized.groupBy(*key).agg(F.count("*").alias("n_"), F.sum("size_").alias("group_total_"))
    n_ranges = F.ceil(F.col("n_") / rows_per_range)
    counts = counts.select(*[F.col(g).alias(f"{g}__k") for g in group], n_ranges.alias("ranges_"), "group_total_")
    same = None
    for g in group:
        eq = F.col(g).eqNullSafe(F.col(f"{g}__k"))
        same = eq if same is None else same & eq
    ranged = sized.join(counts, same).drop(*[f"{g}__k" for g in group])
    ranged = ranged.withColumn("range_", F.floor(F.col(position) * F.col("ranges_")).cast("int"))
    per_range = ranged.groupBy(*group, "range_").agg(F.sum("size_").alias("sum_"))
    over = Window.partitionBy(*group).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *[F.col(g).alias(f"{g}__k") for g in group], F.col("range_").alias("range__k"),
        F.coalesce(F.sum("sum_").over(over), F.lit(0)).alias("offset_"),
    )
    inside = Window.partitionBy(*group, "range_").orderBy(position, tie).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("inside_", F.coalesce(F.sum("size_").over(inside), F.lit(0)))
    out = placed.join(offsets, same & (F.col("range_") == F.col("range__k"))).withColumn("before_", F.col("offset_") + F.col("inside_"))
    return out.drop("offset_", "inside_", "range_", "range__k", "ranges_", *[f"{g}__k" for g in group])
