"""Per-key results where a few keys hold most rows.

Every statistic here is algebraic: a task folds its rows into one state per key in a bounded hash
table (Spark's hash aggregate, which sorts and spills when the table is full), and only those
states are shuffled. A key that holds a third of all rows so costs one state a task, however many
rows it has; no key is salted, split or handled apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import key_form


def combine_by_key(rows: DataFrame, key: Column, states: dict[str, Column]) -> DataFrame:
    """``key_value`` and the given mergeable aggregates of each key.

    ``states`` maps a column name to an aggregate whose partial state is of bounded size (count,
    sum, min, max, min_by, sketches); ``collect_*`` and exact distinct counts are not. Rows whose
    key is null are one group with a null ``key_value``. An empty table gives no rows.
    """
    return rows.groupBy(key.alias("key_value")).agg(*[a.alias(n) for n, a in states.items()])


def key_shares(rows: DataFrame, field: str) -> DataFrame:
    """``(field, key_value, n_rows, total_rows)`` for each key of a column; a key is compared
    trimmed and in lower case, null and blank values are one group without a key.

    ``total_rows`` is a scalar subquery that reads no column.
    """
    counts = combine_by_key(rows, key_form(F.col(field)), {"n_rows": F.count("*")})
    total = rows.agg(F.count("*")).scalar()
    return counts.select(F.lit(field).alias("field"), "key_value", "n_rows", total.alias("total_rows"))


def heavy_keys(rows: DataFrame, field: str, percent: int = 4) -> DataFrame:
    """``key_shares`` of the keys that hold at least ``percent`` of all rows."""
    shares = key_shares(rows, field)
    return shares.where(F.col("key_value").isNotNull() & (F.col("n_rows") * 100 >= F.col("total_rows") * percent))
