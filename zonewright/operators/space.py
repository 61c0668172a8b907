"""Parameter spaces of generators as range queries: which seed, date or slot a request uses."""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import int_seed, sha_text, uint64

# How far the date windows reach.
DAYS_OF_WINDOW, MONTHS_OF_WINDOW = 31, 24


def seed_axis(slot: Column, strategy: str, base: int = 0, code: Column | str = "") -> Column:
    """Seed of a request: ``fixed``, ``incremental``, ``sequential`` or ``hashed_round_robin``."""
    if strategy == "fixed":
        return F.lit(base).cast("bigint")
    if strategy == "hashed_round_robin":
        return int_seed(F.concat(code if isinstance(code, Column) else F.lit(code), F.lit(":"), slot.cast("string")))
    return slot + base


def date_bounds(low: str, high: str, base: str, years_back: int = 0, years_ahead: int = 0) -> tuple[Column, Column]:
    """Least and greatest date: the given ones, narrowed to years of 365 days around the base."""
    lo, hi = F.to_date(F.lit(low)), F.to_date(F.lit(high))
    b = F.to_date(F.lit(base))
    if years_back > 0:
        lo = F.greatest(lo, F.date_sub(b, 365 * years_back))
    if years_ahead > 0:
        hi = F.least(hi, F.date_add(b, 365 * years_ahead))
    return F.least(lo, hi), F.greatest(lo, hi)


def bounded(day: Column, low: Column, high: Column, policy: str = "clamp") -> Column:
    """A date brought between the bounds: ``clamp``, ``wrap`` around, or back to the first."""
    inside = (day >= low) & (day <= high)
    if policy == "clamp":
        return F.greatest(low, F.least(day, high))
    if policy == "wrap":
        return F.when(inside, day).otherwise(F.date_add(low, F.pmod(F.datediff(day, low), F.datediff(high, low) + 1)))
    return F.when(inside, day).otherwise(low)


def date_axis(slot: Column, strategy: str, base: str) -> Column:
    """Date of a request: ``fixed``, ``daily_forward``, ``daily_window``, ``monthly_window``, ``hourly_roll``."""
    b = F.to_date(F.lit(base))
    if strategy == "fixed":
        return b
    if strategy == "daily_window":
        return F.date_add(b, F.pmod(slot, F.lit(DAYS_OF_WINDOW)).cast("int"))
    if strategy == "monthly_window":
        return F.add_months(F.trunc(b, "month"), F.pmod(slot, F.lit(MONTHS_OF_WINDOW)).cast("int"))
    if strategy == "hourly_roll":
        return F.date_add(b, F.floor(slot / 24).cast("int"))
    return F.date_add(b, slot.cast("int"))


def clamped_month(day: Column, months: Column | int) -> Column:
    """Months later, on the 28th at the latest."""
    first = F.add_months(F.trunc(day, "month"), months)
    return F.make_date(F.year(first), F.month(first), F.least(F.dayofmonth(day), F.lit(28)))


def iso_date(text: Column) -> Column:
    """An ISO date; 2020-01-01 if it is none."""
    return F.coalesce(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"), F.to_date(F.lit("2020-01-01")))


def mixed_radix(slot: Column, radices: dict[str, int]) -> dict[str, Column]:
    """Digits of a slot, the last named varying fastest; the first takes what is left over."""
    out, rest = {}, slot
    names = list(radices)
    for name in reversed(names[1:]):
        out[name] = F.pmod(rest, F.lit(radices[name]))
        rest = F.floor(rest / radices[name])
    return {names[0]: F.pmod(rest, F.lit(radices[names[0]]))} | {n: out[n] for n in names[1:]}


def strided(slot: Column, span: int, step: int, offset: int = 0) -> Column:
    """``(slot * step + offset) mod span``, the step made coprime, so that every place comes once."""
    while span > 1 and gcd(step, span) != 1:
        step += 1
    return F.pmod(slot * step + offset, F.lit(max(span, 1)))


def slots(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "slot")


def mutated(rows: DataFrame, base: str, slot: str, suffixes: list[str], changes: int = 2, seed: int = 42) -> DataFrame:
    """``slot, base, domain``: each base label with ``changes`` letters replaced and a suffix drawn,
    all from hashes, so that a slot gives the same name in every run."""
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")
    name = F.col(base)
    for i in range(changes):
        h = uint64(sha_text(seed, F.col(slot), F.lit(f"change{i}")))
        at = F.pmod(h, F.greatest(F.length(base), F.lit(1))).cast("int") + 1
        ch = F.substring(letters, F.pmod(F.floor(h / 256), F.lit(26)).cast("int") + 1, F.lit(1))
        name = F.overlay(name, ch, at, F.lit(1))
    pick = F.pmod(uint64(sha_text(seed, F.col(slot), F.lit("suffix"))), F.lit(len(suffixes))).cast("int")
    return rows.select(slot, base, F.concat(name, F.lit("."), F.get(F.array(*map(F.lit, suffixes)), pick)).alias("domain"))


def hash_chunks(rows: DataFrame, text: str, suffixes: list[str]) -> DataFrame:
    """``text, chunk, domain``: four pieces of an MD5, each under every suffix."""
    from ..functions.hashing import md5_chunks

    parts = rows.select(text, F.posexplode(md5_chunks(F.col(text))).alias("chunk", "label"))
    return parts.select(text, "chunk", F.explode(F.array(*map(F.lit, suffixes))).alias("tld"), "label").select(text, "chunk", F.concat("label", F.lit("."), "tld").alias("domain"))
