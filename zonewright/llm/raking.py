"""A sample whose categories follow given targets, in several margins at once.

1. Rows are counted into cells (stratum x category x further margins), combined before the shuffle.
2. Cell weights are raked by iterative proportional fitting: each sweep scales the weights so that
   each margin in turn meets its targets. A sweep is one window a margin over the cells, which are
   as many as there are combinations of categories, however many rows there are.
3. Each row draws an exponential key, -ln(u) / weight; within a category the rows with the smallest
   keys are taken up to its target, as far as there are rows, by distributed prefix sums (``operators.cuts``),
   so no category is held in one task.
4. The sample is then repaired: a category that has fewer rows than the minimum gets the next ones of its order.
5. What remains between target and sample is reported for every category, and for every value of every margin
   beside what raking itself reached and whether it settled there.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators import cuts
from ..session import materialize


#: Share of a margin's target by which raking may miss it and still count as settled.
TOLERANCE = 0.005


@dataclass(frozen=True)
class Drawn:
    """A sample and what it missed."""

    sample: DataFrame
    report: DataFrame
    margins: DataFrame


def rake(
    cells: DataFrame, margins: list[tuple[list[str], str]], count: str = "n", stratum: str | None = None,
    sweeps: int = 4, rounds: int = 4, tolerance: float = TOLERANCE,
) -> DataFrame:
    """``cells`` with ``weight`` such that ``sum(count * weight)`` over the cells of each margin
    meets the margin's target, as nearly as the margins allow together.

    A margin is its columns and the column that holds its target, the same in all its cells. Cells
    whose target is 0 in any margin get weight 0. If every margin lies within a ``stratum``, cells are
    placed by it once a round, and the sweeps shuffle no more. Sweeps are written to the shared folder after
    each round of ``sweeps``; rounds end when no margin is off by more than ``tolerance``. Margins that cannot be met
    together do not settle: ``reached`` tells which.
    """
    out = cells.withColumn("weight", F.lit(1.0))
    for _ in range(rounds):
        out = out.repartition(stratum) if stratum else out
        for _ in range(sweeps):
            for cols, target in margins:
                total = F.sum(F.col(count) * F.col("weight")).over(Window.partitionBy(*cols))
                out = out.withColumn("weight", F.when(total > 0, F.col("weight") * F.col(target) / total).otherwise(0.0))
        out = materialize(out, "rake")
        # the last margin fits by construction, so the others tell whether the sweeps have settled
        if all(reached(out, *m, count, tolerance).where("NOT settled").limit(1).count() == 0 for m in margins[:-1]):
            break
    return out


def reached(cells: DataFrame, cols: list[str], target: str, count: str = "n", tolerance: float = TOLERANCE) -> DataFrame:
    """``cols, target, raked, settled`` of one margin of raked cells."""
    out = cells.groupBy(*cols).agg(F.max(target).alias("target"), F.sum(F.col(count) * F.col("weight")).alias("raked"))
    return out.withColumn("settled", F.abs(F.col("raked") - F.col("target")) <= tolerance * F.greatest("target", F.lit(1.0)))


def quotas(available: DataFrame, targets: DataFrame, keys: list[str], minimum: int) -> DataFrame:
    """``keys, target, available, quota, least``: the target as far as there are rows, and what the category
    has after it is repaired to ``minimum`` rows, or all it has."""
    both = targets.join(available, keys, "full_outer")
    have = F.coalesce("available", F.lit(0))
    quota = F.least(F.greatest(F.coalesce("target", F.lit(0)), F.lit(0)), have)
    return both.select(*keys, "target", have.alias("available"), quota.alias("quota"), F.greatest(quota, F.least(F.lit(minimum), have)).alias("least"))


def draw(
    rows: DataFrame, targets: DataFrame, stratum: str, category: str, row_id: str, also: list[str],
    minimum: int = 1, seed: int = 42,
) -> Drawn:
    """The sample and the reports of its gaps.

    ``rows`` needs ``stratum, category, row_id`` and the columns ``also``, further margins whose
    share in the sample of a stratum shall be their share in its rows. ``targets`` has ``stratum,
    category, target`` with one row a category.

    The sample has ``row_id, stratum, category, also, weight, repaired`` (whether the row is there for the minimum);
    the report ``stratum, category, target,
    available, sampled, gap`` for each category with rows or a target. ``gap`` is the part of the
    target that was not met, null without a target. ``margins`` has ``stratum, margin, value, target, raked,
    sampled, residual, settled`` for each value of each margin with rows: what raking aimed at and reached, what
    the sample holds, and the difference between sample and target.

    Rows without a category or stratum are not drawn and not reported; null targets set no demand; ties of
    keys are broken by the id; no rows give an empty sample, with every target a gap.
    """
    keys = [stratum, category]
    named = F.col(category).isNotNull() & F.col(stratum).isNotNull()
    narrow = materialize(rows.where(named).select(*dict.fromkeys([row_id, *keys, *also])), "rows")
    cells = materialize(narrow.groupBy(*keys, *also).agg(F.count("*").alias("n")), "cells")
    available = cells.groupBy(*keys).agg(F.sum("n").alias("available"))
    wanted = materialize(quotas(available, targets.where(named).select(*keys, "target"), keys, minimum), "quotas")
    planned = cells.join(wanted.select(*keys, F.col("quota").alias("t0"), "least"), keys).repartition(stratum)
    margins = [(keys, "t0")]
    in_stratum = Window.partitionBy(stratum)
    # the stratum's sample size, each category counted once
    share = F.col("t0") * F.col("n") / F.sum("n").over(Window.partitionBy(*keys))
    planned = planned.withColumn("quota_", share).withColumn("size_", F.sum("quota_").over(in_stratum)).withColumn("rows_", F.sum("n").over(in_stratum))
    for i, m in enumerate(also, 1):
        planned = planned.withColumn(f"t{i}", F.col("size_") * F.sum("n").over(Window.partitionBy(stratum, m)) / F.col("rows_"))
        margins.insert(0, ([stratum, m], f"t{i}"))
    raked = rake(planned.select(*keys, *also, "n", "least", *[t for _, t in margins]), margins, stratum=stratum)
    weights = raked.select(*keys, *also, "weight", "t0", "least", "n")
    weights = weights.withColumn("mean_", F.sum(F.col("weight") * F.col("n")).over(Window.partitionBy(*keys)) / F.sum("n").over(Window.partitionBy(*keys)))
    same = _null_safe(narrow, weights, [*keys, *also])
    keyed = narrow.join(weights, same).select(narrow[row_id].alias("id_"), *[narrow[c] for c in (*keys, *also)], "weight", "mean_", "t0", "least")
    # a category without a quota has no weights: its rows lie at random
    u = cuts.unit_hash(F.col("id_"), seed=seed)
    place = F.when(F.col("weight") > 0, F.least(1 - F.exp(F.log(u) / F.col("weight") * F.col("mean_")), F.lit(1 - 2.0**-52))).when(F.col("mean_") > 0, F.lit(1 - 2.0**-53)).otherwise(u)
    keyed = materialize(keyed.select("id_", *keys, *also, "weight", F.col("t0").alias("quota_"), "least", place.alias("place_")), "keyed")
    taken = cuts.prefix_sums(keyed, keys, "place_", "id_", F.lit(1)).where("before_ < least")
    sample = materialize(taken.select(F.col("id_").alias(row_id), *keys, *also, "weight", (F.col("before_") >= F.col("quota_")).alias("repaired")), "sample")
    sampled = sample.groupBy(*keys).agg(F.count("*").alias("sampled"))
    report = wanted.join(sampled, keys, "left").select(
        *keys, "target", "available", F.coalesce("sampled", F.lit(0)).alias("sampled"),
        F.when(F.col("target").isNotNull(), F.greatest(F.col("target") - F.coalesce("sampled", F.lit(0)), F.lit(0))).alias("gap"),
    )
    return Drawn(sample, report, _margins(raked, sample, margins, stratum))


def _margins(raked: DataFrame, sample: DataFrame, margins: list[tuple[list[str], str]], stratum: str) -> DataFrame:
    out = None
    for cols, target in reversed(margins):
        aimed = reached(raked, cols, target).select(stratum, F.col(cols[1]).cast("string").alias("value"), "target", "raked", "settled", F.lit(0).alias("one"))
        got = sample.select(stratum, F.col(cols[1]).cast("string").alias("value"), *[F.lit(None).cast(t).alias(c) for c, t in (("target", "double"), ("raked", "double"), ("settled", "boolean"))], F.lit(1).alias("one"))
        both = aimed.withColumn("target", F.col("target").cast("double")).unionByName(got).groupBy(stratum, "value")
        told = both.agg(F.max("target").alias("target"), F.max("raked").alias("raked"), F.sum("one").alias("sampled"), F.max("settled").alias("settled"))
        told = told.select(stratum, F.lit(cols[1]).alias("margin"), "value", "target", "raked", "sampled", (F.col("sampled") - F.col("target")).alias("residual"), "settled")
        out = told if out is None else out.unionByName(told)
    return out


def _null_safe(a: DataFrame, b: DataFrame, cols: list[str]) -> Column:
    out = None
    for c in cols:
        eq = a[c].eqNullSafe(b[c])
        out = eq if out is None else out & eq
    return out
