"""Deterministic sampling: order-independent, reproducible on any partitioning."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from decimal import Decimal
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import sha_text, uint64
from ..session import materialize
from . import cuts

#: Rows that may be sorted at once to find a cut.
SORTED = 100_000


def nth_smallest(rows: DataFrame, order: str, n: int) -> int | None:
    """The ``n``-th smallest (from 1) of a unique whole number, None if there are fewer.

    Approximate quantiles enclose it, rows up to both ends are counted, and only what lies between is looked at
    again, until so few are left that they can be sorted. A round narrows the range some thousand times, however the
    numbers are spread.
    """
    part = rows.select(F.col(order).alias("o")).where("o IS NOT NULL")
    size, before = part.count(), 0
    if n < 1 or n > size:
        return None
    while size > SORTED:
        share = (n - before) / size
        low, high = part.agg(F.percentile_approx("o", [max(share - 2e-4, 0.0), min(share + 2e-4, 1.0)], 10_000)).first()[0]
        upto_low, upto_high = part.agg(F.count_if(F.col("o") <= low), F.count_if(F.col("o") <= high)).first()
        if n - before <= upto_low:
            part, left = part.where(F.col("o") <= low), upto_low
        elif n - before <= upto_high:
            part, left, before = part.where((F.col("o") > low) & (F.col("o") <= high)), upto_high - upto_low, before + upto_low
        else:
            part, left, before = part.where(F.col("o") > high), size - upto_high, before + upto_high
        if left == size:
            break
        size = left
    return part.orderBy("o").limit(n - before).agg(F.max("o")).first()[0]


def first_n(rows: DataFrame, order: str, n: int) -> DataFrame:
    """The ``n`` rows with the smallest ``order``, a unique whole number; null orders are left out. A plain
    ``orderBy().limit(n)`` would bring n rows into one task."""
    if n <= 0:
        return rows.limit(0)
    cut = nth_smallest(rows, order, n)
    return rows.where(F.col(order).isNotNull() if cut is None else F.col(order) <= cut)


def _placed(rows: DataFrame, name: str, seed: int) -> DataFrame:
    hashed = rows.withColumn("hash_", sha_text(seed, F.col(name)))
    return hashed.withColumn("place_", F.conv(F.substring("hash_", 1, 13), 16, 10).cast("double") / float(1 << 52))


def bottom_k(rows: DataFrame, name: str, k: int, seed: int = 42, group: list[str] | None = None) -> DataFrame:
    """The ``k`` rows (of each group) with the smallest hash of ``seed:name``: a uniform sample
    without replacement that does not depend on the order of the input.

    Without groups, hashes being even, all but little more than ``k`` rows are cut off where they are read; only
    in the rare case that the cut was too low are all rows ranked.
    """
    if group is None:
        n = rows.count()
        share = (k + 6 * k**0.5 + 30) / max(n, 1)
        few = materialize(_placed(rows, name, seed).where(F.col("place_") < share), "candidates")
        placed = few if few.count() >= min(k, n) else _placed(rows, name, seed)
        if k <= SORTED:
            return placed.orderBy("hash_", *rows.columns).limit(k).select(*rows.columns)
        placed, g = placed.withColumn("all_", F.lit(0)), ["all_"]
    else:
        placed, g = _placed(rows, name, seed), group
    taken = cuts.prefix_sums(placed, g, "place_", "hash_", F.lit(1)).where(F.col("before_") < k)
    return taken.select(*rows.columns)


def seed_of(base: int, text: str) -> int:
    """64-bit seed of a text on the driver; equals ``hashing.stable_seed``."""
    return int.from_bytes(hashlib.sha256(f"{base}:{text}".encode()).digest()[:8], "big")


def stride(total: int, seed: int) -> tuple[int, int]:
    """Start and step, coprime to ``total``, of a walk that visits every line once."""
    if total <= 1:
        return 0, 1
    start, step = seed % total, 1 + (seed // total) % (total - 1)
    while gcd(step, total) != 1:
        step = step % (total - 1) + 1
    return start, step


def stride_order(line: Column, total: int, start: int, step: int) -> Column:
    """When line ``line`` (from 0) is visited by the walk ``start + i * step mod total``."""
    inverse = pow(step, -1, total) if total > 1 else 0
    # products of two 32-bit numbers fit; larger files are multiplied as decimals
    diff = F.pmod(line - start, F.lit(max(total, 1)))
    product = diff.cast("decimal(38,0)") * F.lit(inverse).cast("decimal(19,0)") if total > 1 << 31 else diff * inverse
    return F.pmod(product, F.lit(max(total, 1))).cast("bigint")


def walk_of(file_id: int, lines: int, seed: int) -> tuple[int, int, int, int]:
    """``file_id, lines, start, inverse``: the walk through all lines of one file, for ``walk_turn``."""
    start, step = stride(lines, seed)
    return file_id, max(lines, 1), start, pow(step, -1, lines) if lines > 1 else 0


WALKS = "file_id bigint, lines bigint, start bigint, inverse bigint"


def walk_turn(line: Column) -> Column:
    """When line ``line`` (from 0) is visited by the walk of its file, whose columns stand beside it."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.pmod(wide(line - F.col("start")) * wide(F.col("inverse")), wide(F.col("lines"))).cast("bigint")


def alias_table(weights: Sequence[int]) -> list[tuple[int, int]]:
    """``(threshold, other)`` of each place of a table of n places: a draw takes a place evenly, then a number
    below the sum of the weights, and the place's own item if that is below its threshold, else the other. Each
    item so comes in exact proportion to its weight, by a look-up and no search."""
    n, total = len(weights), sum(weights)
    scaled = [w * n for w in weights]
    table = [(total, i) for i in range(n)]
    low, high = ([i for i in range(n) if (scaled[i] < total) == small] for small in (True, False))
    while low and high:
        a, b = low.pop(), high[-1]
        table[a] = (scaled[a], b)
        scaled[b] -= total - scaled[a]
        if scaled[b] < total:
            low.append(high.pop())
    return table


def refill(pool: DataFrame, source: str, name: str, weights: DataFrame, missing: int, seed: int = 42) -> DataFrame:
    """``missing`` draws with replacement: ``slot, source, name``.

    A slot's hash picks a source by its weight (0 and null count as 1) and a row of the source's pool by index.
    Sources stand in an alias table (one row a source, read by the driver), pool rows are numbered within their
    source by prefix counts; both look-ups are joins by equality, no pool is held in memory.
    """
    spark = pool.sparkSession
    placed = pool.select(F.col(source).alias("source"), F.col(name).alias("name")).withColumn("place_", cuts.unit_hash(F.col("name"), seed=seed))
    indexed = materialize(cuts.prefix_sums(placed, ["source"], "place_", "name", F.lit(1)).select("source", "name", F.col("before_").alias("index"), F.col("group_total_").alias("size")), "pool")
    sizes = indexed.groupBy("source").agg(F.max("size").alias("size"))
    live = weights.select(F.col(source).alias("source"), F.greatest(F.col("weight"), F.lit(1)).cast("bigint").alias("weight")).join(sizes, "source")
    rows = live.orderBy("source").collect()
    if not rows:
        return spark.createDataFrame([], f"slot bigint, source {dict(pool.dtypes)[source]}, name string")
    total, kind = sum(r.weight for r in rows), dict(pool.dtypes)[source]
    table = spark.createDataFrame(
        [(i, r.source, r.size, Decimal(t), rows[other].source, rows[other].size) for i, (r, (t, other)) in enumerate(zip(rows, alias_table([r.weight for r in rows]), strict=True))],
        f"i bigint, a {kind}, a_size bigint, threshold decimal(38,0), b {kind}, b_size bigint",
    )
    drawn = lambda what, n: F.pmod(uint64(sha_text(seed, F.col("slot"), F.lit(what))), F.lit(n).cast("decimal(20,0)"))
    slots = spark.range(missing).withColumnRenamed("id", "slot").withColumn("i", drawn("place", len(rows)).cast("bigint")).withColumn("u", drawn("source", total))
    own = F.col("u") < F.col("threshold")
    chosen = slots.join(table, "i").select("slot", F.when(own, F.col("a")).otherwise(F.col("b")).alias("source"), F.when(own, F.col("a_size")).otherwise(F.col("b_size")).alias("size"))
    at = F.pmod(uint64(sha_text(seed, F.col("slot"), F.lit("row"))), F.col("size").cast("decimal(20,0)")).cast("bigint")
    return chosen.select("slot", "source", at.alias("index")).join(indexed.select("source", "index", "name"), ["source", "index"]).select("slot", "source", "name")


def sample_sources(pool: DataFrame, source: str, name: str, quotas: DataFrame, replacement: bool = False, seed: int = 42) -> DataFrame:
    """``source, name``: exactly ``quota`` rows of each source in hash order; where it has fewer, all
    of them and, with ``replacement``, repeats of them up to the quota."""
    key = F.col(source)
    placed = pool.select(key.alias("source"), F.col(name).alias("name")).withColumn("place_", cuts.unit_hash(F.col("name"), seed=seed))
    ranked = cuts.prefix_sums(placed, ["source"], "place_", "name", F.lit(1))
    wanted = quotas.select(F.col(source).alias("source"), "quota")
    joined = ranked.join(wanted, "source").where(F.col("before_") < F.col("quota"))
    if not replacement:
        return joined.select("source", "name")
    # row i stands for the slots i, i + size, i + 2 size, ... below the quota
    copies = F.ceil((F.col("quota") - F.col("before_")) / F.col("group_total_")).cast("int")
    return joined.select("source", "name", F.explode(F.sequence(F.lit(1), copies)).alias("copy")).select("source", "name")
