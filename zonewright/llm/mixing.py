"""A mixture of sources by target weights, in tokens.

Each source gets a budget, its share of the size of the whole mixture. As many whole passes over
the source as fit are taken; the last, partial pass is cut at the exact budget in a hash-random
order, by distributed prefix sums of the token counts. No source is passed more often than its cap;
what then is missing is reported. A document at the cut is taken if more than half of it fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import key_form
from ..operators import cuts
from ..session import materialize


def source_budgets(docs: DataFrame, targets: DataFrame, total: Column | None = None) -> DataFrame:
    """One row a target source: ``key, source, target_share, max_repeats, stock, budget, passes,
    rest, missing``.

    ``docs`` needs ``key`` and ``tokens``. ``total`` is the size of the mixture, by default that
    of all documents. Sources are compared by ``key_form``; targets of one key are added up. Null
    shares are 0, null caps are 1.
    """
    stock = docs.groupBy("key").agg(F.sum("tokens").alias("stock"))
    size = stock.agg(F.coalesce(F.sum("stock"), F.lit(0)).alias("s")).scalar() if total is None else total
    wanted = targets.select(key_form("source").alias("key"), "source", "target_share", "max_repeats").where("key is not null")
    wanted = wanted.groupBy("key").agg(
        F.min("source").alias("source"), F.coalesce(F.sum("target_share"), F.lit(0.0)).alias("target_share"),
        F.greatest(F.coalesce(F.max("max_repeats"), F.lit(1)), F.lit(0)).alias("max_repeats"),
    )
    rows = wanted.join(stock, "key", "left").withColumn("stock", F.coalesce("stock", F.lit(0)))
    rows = rows.withColumn("budget", F.col("target_share") * size)
    whole = F.when(F.col("stock") > 0, F.floor(F.col("budget") / F.col("stock"))).otherwise(0)
    rows = rows.withColumn("passes", F.least(whole, F.col("max_repeats")))
    rest = F.when((F.col("stock") > 0) & (F.col("passes") < F.col("max_repeats")), F.col("budget") - F.col("passes") * F.col("stock")).otherwise(0.0)
    return rows.withColumn("rest", rest).withColumn("missing", F.greatest(F.col("budget") - F.col("max_repeats") * F.col("stock"), F.lit(0.0)))


def mix(docs: DataFrame, targets: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """The mixture ``doc_id, source, tokens, copies`` and the report of each source.

    ``docs`` has ``doc_id, source, tokens``. The report gives ``source, target_share, max_repeats,
    stock_tokens, budget_tokens, drawn_tokens, actual_share, missing_tokens, reached``; a source is not ``reached`` if
    the mixture holds all that it may give and still less than its budget; ``actual_share``
    is of the mixture drawn. Documents of sources without a target, of null or blank sources, and
    without tokens are not drawn. Without documents every source with a share is not reached.
    """
    sized = materialize(docs.select("doc_id", key_form("source").alias("key"), F.coalesce("tokens", F.lit(0)).alias("tokens")), "sized")
    budgets = materialize(source_budgets(sized, targets), "budgets")
    # a source that needs no partial pass needs no order
    asked = sized.where("tokens > 0").join(budgets.select("key", "source", "passes", "rest"), "key")
    place = asked.select("doc_id", "key", "source", "passes", "rest", "tokens", cuts.unit_hash(F.col("doc_id"), seed=seed).alias("place_"))
    placed = cuts.prefix_sums(place, ["key"], "place_", "doc_id", F.col("tokens"))
    copies = F.col("passes") + F.when(F.col("before_") + F.col("tokens") / 2 <= F.col("rest"), 1).otherwise(0)
    drawn = placed.select("doc_id", "key", "source", "tokens", copies.cast("int").alias("copies")).where("copies > 0")
    drawn = materialize(drawn, "mixture")
    got = drawn.groupBy("key").agg(F.sum(F.col("tokens") * F.col("copies")).alias("drawn"))
    whole = got.agg(F.sum("drawn")).scalar()
    used = F.coalesce("drawn", F.lit(0))
    short = (used < F.col("budget")) & (used >= F.col("max_repeats") * F.col("stock"))
    report = budgets.join(got, "key", "left").select(
        "source", "target_share", "max_repeats", F.col("stock").alias("stock_tokens"), F.col("budget").alias("budget_tokens"),
        used.alias("drawn_tokens"), F.coalesce(F.col("drawn") / whole, F.lit(0.0)).alias("actual_share"),
        F.col("missing").alias("missing_tokens"), (~short).alias("reached"),
    )
    return drawn.select("doc_id", "source", "tokens", "copies"), report
