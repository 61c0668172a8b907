"""The balanced, labelled data set: generated names first, then listed ones, one to one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import order_hash
from ..functions.names import final_name, key_form, suffix
from . import dedup, quota, sampling


def generated_names(rows: DataFrame, domain: str, code: str, order: str) -> DataFrame:
    """``pos, domain, class_value`` of the valid generated names, first of each name. A row whose
    name or code is missing or invalid is dropped."""
    named = rows.select(F.col(order).cast("bigint").alias("pos"), final_name(domain).alias("domain"), key_form(code).alias("class_value"))
    return dedup.first_wins(named.where("domain is not null and class_value is not null"), "domain", "pos")


def listed_names(rows: DataFrame, domain: str, order: str, generated: DataFrame) -> DataFrame:
    """``pos, domain`` of the valid listed names that no generator made, first of each name."""
    named = rows.select(F.col(order).cast("bigint").alias("pos"), final_name(domain).alias("domain"))
    return dedup.without_overlap(dedup.first_wins(named, "domain", "pos"), generated, "domain")


#: Columns that order the rows of a data set.
ORDER = ("part_", "code_", "hash_", "pos_")


def balanced(generated: DataFrame, listed: DataFrame, seed: int = 42, ordered: bool = False) -> DataFrame:
    """``domain, class_value, label`` with as many generated (1) as listed (0) names, and the columns ``ORDER`` if
    asked for: generated names before listed ones, each in their order; reduced ones by code and hash instead.

    Listed names are taken in their order up to the number of generated ones; if there are fewer,
    the generated ones are reduced in proportion to their codes. ``ValueError`` if a class is empty.
    """
    n_gen, n_list = generated.count(), listed.count()
    rows = min(n_gen, n_list)
    if rows == 0:
        raise ValueError("each class needs at least one valid name")
    reduced = n_list < n_gen
    if reduced:
        generated = quota.reduce_proportionally(generated, "class_value", "domain", rows, seed)
    listed = sampling.first_n(listed, "pos", rows)
    none, pos = F.lit(None).cast("string"), F.col("pos").cast("bigint")
    places = lambda part, *order: [F.lit(part).alias("part_"), *[c.alias(n) for c, n in zip(order, ORDER[1:], strict=True)]] if ordered else []
    by_hash = (F.col("class_value"), order_hash(seed, "class_value", "domain"), F.lit(0).cast("bigint"))
    first = places(0, *(by_hash if reduced else (none, none, pos)))
    return generated.select("domain", "class_value", F.lit(1).cast("tinyint").alias("label"), *first).unionByName(
        listed.select("domain", suffix("domain").alias("class_value"), F.lit(0).cast("tinyint").alias("label"), *places(1, none, none, pos))
    )


def selection_counts(
    gen_rows: DataFrame, list_rows: DataFrame, domain: str, code: str, order: str,
    generated: DataFrame | None = None, listed: DataFrame | None = None,
) -> DataFrame:
    """One row of counters of the two scans. Who has the ``generated_names`` and ``listed_names`` already passes them.

    The scan of listed names stops at the row that fills the class, so its counters reach to that
    row only. Duplicates are tested before overlap, and overlapping names never count as seen: each
    of their rows is an overlap.
    """
    gen = gen_rows.select(final_name(domain).alias("d"), key_form(code).alias("k"))
    valid = F.col("d").isNotNull() & F.col("k").isNotNull()
    g = gen.groupBy(F.when(valid, F.col("d")).alias("d")).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("generated_rows_read"),
        F.coalesce(F.sum(F.when(F.col("d").isNull(), F.col("n"))), F.lit(0)).alias("generated_invalid"),
        F.coalesce(F.sum(F.when(F.col("d").isNotNull(), F.col("n") - 1)), F.lit(0)).alias("generated_duplicates"),
        F.count("d").alias("generated_unique"),
    )
    generated = generated_names(gen_rows, domain, code, order) if generated is None else generated
    listed = listed_names(list_rows, domain, order, generated) if listed is None else listed
    wanted = generated.count()
    kept = sampling.first_n(listed, "pos", wanted)
    full, last = kept.agg(F.count("*"), F.max("pos")).first()
    scanned = list_rows.select(F.col(order).cast("bigint").alias("pos"), final_name(domain).alias("domain"))
    if full >= wanted > 0:
        scanned = scanned.where(F.col("pos") <= last)
    marked = scanned.join(generated.select("domain", F.lit(1).alias("gen")), "domain", "left")
    per_name = marked.groupBy("domain", "gen").agg(F.count("*").alias("n"))
    named, over = F.col("domain").isNotNull(), F.col("gen").isNotNull()
    b = per_name.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("listed_rows_read"),
        F.coalesce(F.sum(F.when(~named, F.col("n"))), F.lit(0)).alias("listed_invalid"),
        F.coalesce(F.sum(F.when(named & over, F.col("n"))), F.lit(0)).alias("listed_overlap"),
        F.coalesce(F.sum(F.when(named & ~over, F.col("n") - 1)), F.lit(0)).alias("listed_duplicates"),
        F.count_if(named & ~over).alias("listed_unique"),
    )
    return g.withColumn("one", F.lit(1)).join(b.withColumn("one", F.lit(1)), "one").drop("one")
