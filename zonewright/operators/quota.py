"""Quotas: largest-remainder allocation, redistribution of deficits, proportional reduction.

Allocation over few sources is plain Python on the driver; the same rule over a relation of any
size is a window query.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import order_hash
from . import cuts


@dataclass(frozen=True)
class Share:
    """What one source was given, and why."""

    index: int
    count: int
    raw: float
    floor: int
    remainder: float
    adjustment: int

    @property
    def quota(self) -> int:
        return self.floor + self.adjustment


def allocate_details(counts: Sequence[int], target: int) -> list[Share]:
    """Shares of ``target`` in proportion to ``counts``: floors, then one more for the largest
    remainders, the earlier source at a tie."""
    if target <= 0:
        raise ValueError("the target must be positive")
    if not counts:
        return []
    total = sum(counts)
    if total <= 0:
        raise ValueError("nothing to allocate by")
    exact = [target * c / total for c in counts]
    floors = [int(x) for x in exact]
    order = sorted(range(len(counts)), key=lambda i: floors[i] - exact[i])  # stable: earlier first
    more = set(order[: target - sum(floors)])
    return [Share(i, c, exact[i], floors[i], exact[i] - floors[i], int(i in more)) for i, c in enumerate(counts)]


def allocate(counts: Sequence[int], target: int) -> list[int]:
    return [s.quota for s in allocate_details(counts, target)]


def redistribute(deficit: int, raw_rows: Sequence[int]) -> list[int]:
    """A deficit over the receivers by their rows, evenly if none has any."""
    if deficit <= 0 or not raw_rows:
        return [0] * len(raw_rows)
    return allocate(raw_rows if sum(raw_rows) > 0 else [1] * len(raw_rows), deficit)


def split_even(total: int, parts: int) -> list[int]:
    """``total`` in equal parts, the first ones larger by one where it does not divide."""
    base, rest = divmod(total, parts) if parts else (0, 0)
    return [base + (i < rest) for i in range(parts)]


def fill_quotas(capacities: Sequence[int], raw_rows: Sequence[int], target: int) -> tuple[list[int], int]:
    """Accepted rows of each source, and what stays unfilled.

    Every round gives each source its quota, as far as it has rows; what a source cannot deliver
    goes to those that have not run dry, by their raw rows. A source that met its quota exactly
    still receives. Rounds end when nothing moves.
    """
    quotas = allocate(raw_rows, target)
    taken = [0] * len(quotas)
    dry: set[int] = set()
    while True:
        for i, q in enumerate(quotas):
            taken[i] = min(q, capacities[i])
            if capacities[i] < q:
                dry.add(i)
        deficit = target - sum(taken)
        open_ = [i for i in range(len(quotas)) if i not in dry]
        if deficit <= 0 or not open_:
            return taken, max(deficit, 0)
        for i in dry:
            quotas[i] = taken[i]
        for i, more in zip(open_, redistribute(deficit, [raw_rows[i] for i in open_]), strict=True):
            quotas[i] += more


def largest_remainder(rows: DataFrame, weight: str, target: Column | int, tie: str, group: Sequence[str] = ()) -> DataFrame:
    """``rows`` (one a source) with ``raw_quota``, ``floor_quota`` and ``quota``, by group.

    The window holds the sources of a group, not their data. Groups whose weights add up to 0 get
    null quotas; null weights count as 0.
    """
    w = F.coalesce(F.col(weight), F.lit(0)).cast("double")
    over = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    goal = target if isinstance(target, Column) else F.lit(target)
    total = F.sum(w).over(over)
    out = rows.withColumn("raw_quota", F.when(total > 0, goal * w / total)).withColumn("floor_quota", F.floor("raw_quota"))
    rank = F.row_number().over(over.orderBy((F.col("floor_quota") - F.col("raw_quota")), tie))
    rest = goal - F.sum("floor_quota").over(over)
    return out.withColumn("rest_", rest).withColumn("rank_", rank).withColumn("quota", F.col("floor_quota") + (F.col("rank_") <= F.col("rest_")).cast("bigint")).drop("rest_", "rank_")


def take_by_hash(rows: DataFrame, group: str, name: str, quota: str, seed: int = 42) -> DataFrame:
    """The first ``quota`` rows of each group in hash order of ``seed:group:name``.

    Rows are placed by the leading bits of the hash, ranges of them are counted, and only the
    range in which the quota ends is sorted; a group of any size is spread over many tasks.
    """
    h = order_hash(seed, group, name)
    placed = rows.withColumn("hash_", h).withColumn("place_", F.conv(F.substring("hash_", 1, 13), 16, 10).cast("double") / float(1 << 52))
    taken = cuts.prefix_sums(placed, [group], "place_", "hash_", F.lit(1))
    return taken.where(F.col("before_") < F.col(quota)).drop("hash_", "place_", "size_", "before_", "group_total_")


def reduce_proportionally(rows: DataFrame, group: str, name: str, target: int, seed: int = 42) -> DataFrame:
    """``target`` of the rows, each group in proportion, by ``take_by_hash``.

    Floors first, then one more by falling remainder and group name. Fewer rows than the target
    are all kept.
    """
    counts = rows.groupBy(group).agg(F.count("*").alias("n_"))
    quotas = largest_remainder(counts, "n_", target, group)
    capped = quotas.select(F.col(group).alias("g_"), F.least(F.coalesce("quota", F.lit(0)), F.col("n_")).alias("quota_"))
    joined = rows.join(capped, F.col(group).eqNullSafe(F.col("g_"))).drop("g_")
    return take_by_hash(joined, group, name, "quota_", seed).drop("quota_")


def plan_evenly(categories: Sequence[tuple[str, str | None, int | None]], target: int) -> dict[str, int]:
    """Quotas of ``(code, category, cap)``: evenly over sorted categories, then over their codes;
    codes without a category form one. Caps cut a quota, what is cut is not given to others."""
    groups: dict[str, list[tuple[str, int | None]]] = {}
    for code, category, cap in categories:
        groups.setdefault(category or "", []).append((code, cap))
    out = {}
    for name, share in zip(sorted(groups), split_even(target, len(groups)), strict=True):
        members = sorted(groups[name])
        for (code, cap), quota in zip(members, split_even(share, len(members)), strict=True):
            out[code] = quota if cap is None else min(quota, cap)
    return out

