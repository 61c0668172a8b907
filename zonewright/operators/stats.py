"""Histograms, rates, curves and structural statistics of name corpora."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.lexical import entropy
from ..functions.names import suffix

# Other spellings of a status; an absent one is usable.
STATUS_ALIASES = {"parcial": "partial", "descartado": "discarded"}
# How the category of a generator follows from its parameters and its name.
DATE_PARAMETERS, SEED_PARAMETERS = ("date", "d", "dt", "when", "time"), ("seed", "magic")
FAMILIES = ("locky", "qakbot", "necurs", "ramnit", "tinba")


def digit_ratio(name: Column) -> Column:
    n = F.length(name)
    return F.when(n > 0, F.length(F.regexp_replace(name, r"[^\p{Nd}]", "")) / n).otherwise(0.0)


def digit_bucket(ratio: Column) -> Column:
    """Tenths as ``0.0-0.1`` to ``1.0-1.0``."""
    i = F.least((ratio * 10).cast("int"), F.lit(10))
    return F.format_string("%.1f-%.1f", i / 10.0, F.least((i + 1) / 10.0, F.lit(1.0)))


def entropy_bucket(bits: Column) -> Column:
    """Halves as ``0.0-0.5`` to ``10.0-10.5``."""
    i = F.least((bits / 0.5).cast("int"), F.lit(20))
    return F.format_string("%.1f-%.1f", i * 0.5, i * 0.5 + 0.5)


def distributions(rows: DataFrame, domain: str, label: str) -> DataFrame:
    """``measure, label, bucket, n`` of length, TLD, digit ratio and entropy, for each label and
    for all rows (null label), by grouping sets on one pass."""
    d = F.col(domain)
    buckets = F.array(
        F.struct(F.lit("length").alias("measure"), F.length(d).cast("string").alias("bucket")),
        F.struct(F.lit("tld").alias("measure"), suffix(d).alias("bucket")),
        F.struct(F.lit("digit_ratio").alias("measure"), digit_bucket(digit_ratio(d)).alias("bucket")),
        F.struct(F.lit("entropy").alias("measure"), entropy_bucket(F.round(entropy(d), 9)).alias("bucket")),
    )
    tall = rows.where(d.isNotNull() & F.col(label).isNotNull()).select(F.col(label).alias("label"), F.explode(buckets).alias("b")).select("label", "b.*")
    return tall.groupingSets([["measure", "label", "bucket"], ["measure", "bucket"]], "measure", "label", "bucket").agg(F.count("*").alias("n"))


def top_suffixes(rows: DataFrame, domain: str, k: int = 10) -> DataFrame:
    """The ``k`` commonest TLDs (a report limit), by name at a tie."""
    t = rows.select(suffix(domain).alias("tld")).where("tld <> ''").groupBy("tld").agg(F.count("*").alias("n"))
    return t.orderBy(F.desc("n"), "tld").limit(k)


def rolling_yields(histories: DataFrame, keys: list[str], history: str, window: int = 8) -> DataFrame:
    """``keys, step, yield_now, yield_sum, yield_mean, yield_median`` over the last ``window`` values
    of an array, at each position. NaN and null values are left out."""
    tall = histories.select(*keys, F.posexplode(F.col(history)).alias("step", "value"))
    tall = tall.where(F.col("value").isNotNull() & ~F.isnan("value"))
    w = Window.partitionBy(*keys).orderBy("step").rowsBetween(1 - window, 0)
    return tall.select(
        *keys, "step", F.col("value").alias("yield_now"), F.sum("value").over(w).alias("yield_sum"), F.avg("value").over(w).alias("yield_mean"),
        F.percentile("value", 0.5).over(w).alias("yield_median"),
    )


def streaks(histories: DataFrame, keys: list[str], history: str, below: float) -> DataFrame:
    """``keys, longest_low, current_low``: runs of consecutive values under ``below`` (gaps and islands)."""
    tall = histories.select(*keys, F.posexplode(F.col(history)).alias("step", "value")).withColumn("low", F.coalesce(F.col("value") < below, F.lit(False)) & ~F.isnan("value"))
    w = Window.partitionBy(*keys).orderBy("step")
    tall = tall.withColumn("island", F.sum(F.when(~F.col("low"), 1).otherwise(0)).over(w)).withColumn("last", F.max("step").over(Window.partitionBy(*keys)))
    runs = tall.groupBy(*keys, "island").agg(F.count_if("low").alias("n"), (F.max("step") == F.max("last")).alias("open"))
    return runs.groupBy(*keys).agg(F.max("n").alias("longest_low"), F.max(F.when(F.col("open"), F.col("n")).otherwise(0)).alias("current_low"))


def first_of_key(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``order`` of each first bearer of a key; combined before the shuffle."""
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias(order)).select(order)


def collision_curve(rows: DataFrame, key: str, order: str, step: int) -> DataFrame:
    """``checkpoint, rows_seen, unique_seen, marginal_yield`` after each ``step`` of the order (a
    number from 1): how fast new keys run out. One row a checkpoint enters the window."""
    bucket = F.ceil(F.col(order) / step).cast("bigint").alias("bucket")
    seen = rows.groupBy(bucket).agg(F.count("*").alias("n"))
    fresh = first_of_key(rows, key, order).groupBy(bucket).agg(F.count("*").alias("u"))
    both = seen.join(fresh, "bucket", "left").withColumn("u", F.coalesce("u", F.lit(0)))
    w = Window.partitionBy(F.lit(0)).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    return both.select(
        (F.col("bucket") * step).alias("checkpoint"), F.sum("n").over(w).alias("rows_seen"), F.sum("u").over(w).alias("unique_seen"),
        (F.col("u") / F.col("n")).alias("marginal_yield"),
    )


def common_suffix(rows: DataFrame, group: str, text: str) -> DataFrame:
    """Longest common suffix of the texts of each group: that of the least and greatest reversed one."""
    r = rows.groupBy(group).agg(F.min(F.reverse(text)).alias("a"), F.max(F.reverse(text)).alias("b"))
    n = F.length(F.regexp_extract(F.concat(F.col("a"), F.lit("\x00"), F.col("b")), r"(?s)\A(.*)[^\x00]*\x00\1", 1))
    return r.select(group, F.reverse(F.substring("a", F.lit(1), n)).alias("common_suffix"))


def structure(rows: DataFrame, group: str, text: str) -> DataFrame:
    """Structural variability of each group's texts: ``n_texts, positions, variable_positions,
    log10_capacity, pooled_entropy``. Capacity is the product of the distinct characters by position."""
    chars = rows.where(F.col(text).isNotNull()).select(group, F.posexplode(F.filter(F.split(text, ""), lambda c: c != "")).alias("at", "ch"))
    counts = chars.groupBy(group, "at", "ch").agg(F.count("*").alias("n"))
    per_pos = counts.groupBy(group, "at").agg(F.count("*").alias("distinct_"))
    shape = per_pos.groupBy(group).agg(F.count("*").alias("positions"), F.count_if(F.col("distinct_") > 1).alias("variable_positions"), F.sum(F.log10("distinct_")).alias("log10_capacity"))
    pooled = counts.groupBy(group, "ch").agg(F.sum("n").alias("n")).groupBy(group).agg((F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n")).alias("pooled_entropy"))
    texts = rows.where(F.col(text).isNotNull()).groupBy(group).agg(F.count("*").alias("n_texts"))
    return texts.join(shape, group, "left").join(pooled, group, "left")


def merged_counts(rows: DataFrame, group: str, counts: str) -> DataFrame:
    """``group, reason, n``: maps of counts added up by key."""
    return rows.select(group, F.explode(counts).alias("reason", "v")).groupBy(group, "reason").agg(F.sum("v").alias("n"))


def sorted_json(entries: Column) -> Column:
    """A map as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(entries))))


def status(c: Column) -> Column:
    """A status in its usual spelling; unknown ones in lower case."""
    k = F.lower(c)
    named = k
    for alias, name in STATUS_ALIASES.items():
        named = F.when(k == alias, name).otherwise(named)
    return F.when(F.coalesce(k, F.lit("")) == "", "usable").otherwise(named)


def category_of(parameters: Column, code: Column) -> Column:
    """Category of a generator by the names of its parameters, else by its own name."""
    lower = F.transform(parameters, lambda p: F.lower(p))
    has = lambda names: F.arrays_overlap(lower, F.array(*map(F.lit, names)))
    family = F.lower(code).rlike("|".join(FAMILIES))
    return F.when(has(DATE_PARAMETERS), "date_based").when(has(SEED_PARAMETERS), "seed_based").when(family, "known_family")
