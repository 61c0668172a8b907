"""Duplicates and membership: the first row of a key wins, in an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_wins(rows: DataFrame, key: str, order: str, ties: bool = True) -> DataFrame:
    """The row with the smallest ``order`` of each key; null keys and null orders are dropped.

    The least order of each key comes from a hash aggregate, combined in each task, so a key with very many rows
    costs one number a task; rows are then picked by key and order together, which no frequent key can skew.
    Of rows that share key and order, the smallest by the other columns is taken; a caller whose order is unique
    saves that step with ``ties=False``.
    """
    k, o = F.col(f"`{key}`"), F.col(f"`{order}`")
    named = rows.where(k.isNotNull() & o.isNotNull())
    best = named.groupBy(k.alias("k_")).agg(F.min(o).alias("o_"))
    firsts = named.join(best, (k == F.col("k_")) & (o == F.col("o_")), "left_semi")
    if not ties:
        return firsts
    others = [c for c in rows.columns if c not in (key, order)]
    one = firsts.groupBy(k.alias(key), o.alias(order)).agg(F.min(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in others])).alias("best_"))
    return one.select(*[F.col(f"`{c}`") if c in (key, order) else F.col(f"best_.`{c}`").alias(c) for c in rows.columns])


def insert_or_ignore(store: DataFrame, batch: DataFrame, key: str, order: str, ties: bool = True) -> DataFrame:
    """Rows of ``batch`` to append: first of their key in the batch and not in the store."""
    return first_wins(batch, key, order, ties).join(store.select(key), key, "left_anti").select(*batch.columns)


def without_overlap(rows: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key ``other`` does not have. Null keys stay."""
    return rows.join(other.select(key).distinct(), key, "left_anti").select(*rows.columns)


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys on both sides."""
    return a.select(key).where(F.col(key).isNotNull()).intersect(b.select(key))


def disjoint(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether no key is on both sides; stops at the first that is."""
    return a.select(key).join(b.select(key), key, "left_semi").limit(1).count() == 0


def membership_counts(rows: DataFrame, key: Column, order: str, group: list[str] | None = None) -> DataFrame:
    """``n_rows, n_keys, n_repeats, n_null`` by group, repeats counted in the group."""
    by = group or []
    counted = rows.select(*by, key.alias("k_")).groupBy(*by, "k_").agg(F.count("*").alias("n_"))
    named = F.col("k_").isNotNull()
    return counted.groupBy(*by).agg(
        F.sum("n_").alias("n_rows"), F.count_if(named).alias("n_keys"),
        F.coalesce(F.sum(F.when(named, F.col("n_") - 1)), F.lit(0)).alias("n_repeats"),
        F.coalesce(F.sum(F.when(~named, F.col("n_"))), F.lit(0)).alias("n_null"),
    )
