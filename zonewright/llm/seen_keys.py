"""Has this key been seen before? A log-structured store of sorted key runs.

A run is an immutable bucketed Parquet table of ``(key_hash, key, origin)``. Rows are placed by
the hash of ``(key_hash, key)`` and sorted by it inside each bucket file, so

* a probe is a merge join that shuffles and sorts the batch alone: the history is neither moved nor
  sorted again, each bucket being one sorted file;
* the minimum and maximum of ``key_hash`` that Parquet keeps for each block of a file are the
  block fences: a probe of at most ``POINT_KEYS`` keys pushes their hashes down to them and reads the
  blocks that may hold one; a larger probe touches nearly every block, as hashes lie evenly;
* a hit needs the full key to be equal, not just its hash. How often the hash alone would have been wrong
  is counted by ``hash_only_errors``, and answers are checked without the store by ``audit``.

Runs of one level are merged into one run of the next when there are ``fanout`` of them. Memory
holds a merge-join window, never the keys. All runs lie below the session's shared folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import name_key
from ..session import drop_path, scratch_path, scratch_table, shuffle_partitions, sorted_scans

#: Most keys that a probe pushes down to the block fences.
POINT_KEYS = 1000
#: An audit asks again for every row whose id this divides.
AUDITED = 50


def key_hash(key: Column, bits: int = 64) -> Column:
    """xxHash64 of the key, its upper ``bits`` only where fewer are wanted."""
    h = F.xxhash64(key)
    return h if bits == 64 else F.shiftright(h, 64 - bits)


def _any_of(tests: list[Column]) -> Column:
    """Or of many tests, as a balanced tree; an ``isin`` of more than ten values would reach the fences as one range."""
    while len(tests) > 1:
        tests = [a if b is None else a | b for a, b in zip(tests[::2], [*tests[1::2], None], strict=False)]
    return tests[0] if tests else F.lit(False)


class SortedRunStore:
    """Sorted runs of keys in levels.

    ``buckets`` files make up a run; ``fanout`` runs of a level are merged into the next level;
    ``hash_bits`` (64) may be narrowed to study collisions, results stay exact.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, fanout: int = 3, hash_bits: int = 64):
        self.spark = spark
        self.lasting = path is not None
        self.path = path or scratch_path(spark, "runs")
        self.buckets = buckets or shuffle_partitions(spark)
        sorted_scans(spark)
        self.fanout = max(2, fanout)
        self.hash_bits = hash_bits
        self.runs: list[dict] = []

    # -- keys -------------------------------------------------------------------------------

    def keys(self, rows: DataFrame, key: str, origin: Column | None = None) -> DataFrame:
        """Distinct keys of ``rows`` with the smallest origin of each, combined before the shuffle,
        so that one key in a third of all rows costs one row a task. Null keys are left out."""
        src = rows.select(F.col(key).alias("key"), (F.lit(None) if origin is None else origin).cast("bigint").alias("origin"))
        src = src.where(F.col("key").isNotNull()).select(key_hash(F.col("key"), self.hash_bits).alias("key_hash"), "key", "origin")
        return src.groupBy("key_hash", "key").agg(F.min("origin").alias("origin"))

    def unseen(self, keys: DataFrame, few: bool = False) -> DataFrame:
        """The keys that no run holds: one merge join a run, newest first, on one shuffle. Where the caller
        knows that they are ``few`` (at most ``POINT_KEYS``), runs are read between the fences only."""
        fence = None
        if few and self.runs:
            hashes = [r[0] for r in keys.select("key_hash").limit(POINT_KEYS + 1).collect()]
            fence = _any_of([F.col("key_hash") == h for h in set(hashes)]) if len(hashes) <= POINT_KEYS else None
        for run in reversed(self.runs):
            held = self._read(run).select("key_hash", "key")
            held = held if fence is None else held.where(fence)
            keys = keys.join(held.hint("merge"), ["key_hash", "key"], "left_anti")
        return keys

    def append(self, keys: DataFrame, level: int = 0) -> None:
        """Write distinct keys as a new run, then merge the levels that are full."""
        self.runs.append(self._write(keys, level))
        self._compact(level)

    def absorb(self, keys: DataFrame, few: bool = False) -> None:
        """Append those of the keys that are new."""
        self.append(self.unseen(keys, few))

    def all_keys(self) -> DataFrame:
        parts = [self._read(r) for r in self.runs]
        if not parts:
            return self.spark.createDataFrame([], "key_hash bigint, key string, origin bigint")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def contains(self, keys: list[str]) -> DataFrame:
        """Point look-up of at most ``POINT_KEYS`` keys through the block fences."""
        if len(keys) > POINT_KEYS:
            raise ValueError(f"more than {POINT_KEYS} keys; use unseen()")
        wanted = self.spark.createDataFrame([(k,) for k in dict.fromkeys(keys) if k is not None], "key string")
        hashes = [r[0] for r in wanted.select(key_hash(F.col("key"), self.hash_bits)).collect()]
        held = self.all_keys().where(_any_of([F.col("key_hash") == h for h in set(hashes)])).select("key")
        return wanted.join(held.withColumn("held", F.lit(True)), "key", "left").select("key", F.coalesce("held", F.lit(False)).alias("seen"))

    def hash_only_errors(self) -> DataFrame:
        """One row: ``keys`` held, and ``wrong`` answers had the hash alone decided. A key that an attempt
        brought would have been called seen if another key of its hash was there before."""
        before = F.coalesce("origin", F.lit(-1))
        same = self.all_keys().groupBy("key_hash").agg(F.count("*").alias("n"), F.count("origin").alias("brought"), F.min(before).alias("first"))
        wrong = F.col("brought") - F.when(F.col("first") >= 0, 1).otherwise(0)
        return same.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("keys"), F.coalesce(F.sum(wrong), F.lit(0)).alias("wrong"))

    # -- runs -------------------------------------------------------------------------------

    def _create(self, table: str, path: str) -> None:
        self.spark.sql(
            f"CREATE TABLE {table} (key_hash BIGINT, key STRING, origin BIGINT) USING parquet "
            f"CLUSTERED BY (key_hash, key) SORTED BY (key_hash, key) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def _write(self, keys: DataFrame, level: int) -> dict:
        table = f"zonewright_run_{uuid.uuid4().hex}" if self.lasting else scratch_table(self.spark, "run")
        path = f"{self.path}/level={level}/{table}"
        rows = keys.select("key_hash", "key", "origin")
        if self.buckets != shuffle_partitions(self.spark):
            rows = rows.repartition(self.buckets, "key_hash", "key")  # else they come placed like this: one file a bucket
        (
            rows.write.format("parquet")
            .bucketBy(self.buckets, "key_hash", "key").sortBy("key_hash", "key")
            .option("path", path).option("parquet.block.size", str(8 << 20)).saveAsTable(table)
        )
        return {"level": level, "table": table, "path": path}

    def _read(self, run: dict) -> DataFrame:
        return self.spark.table(run["table"])

    def _compact(self, level: int) -> None:
        same = [r for r in self.runs if r["level"] == level]
        if len(same) < self.fanout:
            return
        merged = self._read(same[0])
        for r in same[1:]:
            merged = merged.unionByName(self._read(r))
        # keys are distinct across runs, so a merge is a placement, not an aggregation
        if self.buckets == shuffle_partitions(self.spark):
            merged = merged.repartition(self.buckets, "key_hash", "key")
        new = self._write(merged, level + 1)
        self.runs = [r for r in self.runs if r["level"] != level]
        at = sum(r["level"] > level + 1 for r in self.runs)
        self.runs.insert(at + sum(r["level"] == level + 1 for r in self.runs), new)
        for r in same:
            self._drop(r)
        self._compact(level + 1)

    def _drop(self, run: dict) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {run['table']}")
        drop_path(self.spark, run["path"])

    # -- life -------------------------------------------------------------------------------

    def manifest(self) -> str:
        """What ``attach`` needs, to be kept beside the runs."""
        return json.dumps({"path": self.path, "buckets": self.buckets, "fanout": self.fanout, "hash_bits": self.hash_bits, "runs": self.runs})

    @classmethod
    def attach(cls, spark: SparkSession, manifest: str) -> SortedRunStore:
        """The store of an earlier session."""
        m = json.loads(manifest)
        store = cls(spark, m["path"], m["buckets"], m["fanout"], m["hash_bits"])
        store.runs = m["runs"]
        for r in store.runs:
            if not spark.catalog.tableExists(r["table"]):
                store._create(r["table"], r["path"])
        return store

    def drop(self) -> None:
        for r in self.runs:
            self._drop(r)
        self.runs = []
        drop_path(self.spark, self.path)


def id_cuts(rows: DataFrame, order: str, steps: int) -> list[tuple[int | None, int | None]]:
    """Half-open id ranges that cut the rows into ``steps`` of about the same size."""
    shares = [i / steps for i in range(1, steps)]
    inner = rows.agg(F.percentile_approx(order, shares, 1000)).first()[0] if shares else []
    edges = sorted(set(inner or []))
    return list(zip([None, *edges], [*edges, None], strict=True))


def seen_before(
    accepted: DataFrame, attempts: DataFrame, key: str, order: str,
    steps: int = 3, normal: Callable[[Column], Column] = name_key, store: SortedRunStore | None = None,
) -> tuple[DataFrame, SortedRunStore]:
    """Ids of the attempts whose key is in ``accepted`` or in an earlier attempt, and the store.

    Attempts are taken in ``steps`` ranges of ``order`` (unique and not null), each probed
    against all runs and appended as a new run. Every run row names the attempt that brought its
    key, so an attempt was seen before exactly if its key is not null and it brought no key: an
    anti join on unique ids, which no frequent key can skew.

    Null, empty and blank keys are never seen. Repeated attempts with one id count as one.
    Other columns of either table do not matter, whatever their names. Empty tables give no rows.
    """
    spark = attempts.sparkSession
    store = store or SortedRunStore(spark)
    store.append(store.keys(accepted.select(normal(F.col(key)).alias("key")), "key"), level=1)
    tries = attempts.select(F.col(order).cast("bigint").alias("id"), F.col(key).alias("raw")).where("id is not null")
    few = tries.limit(POINT_KEYS + 1).count() <= POINT_KEYS
    for lo, hi in id_cuts(tries, "id", steps):
        part = tries
        if lo is not None:
            part = part.where(F.col("id") >= lo)
        if hi is not None:
            part = part.where(F.col("id") < hi)
        part = part.select("id", normal(F.col("raw")).alias("key"))
        store.absorb(store.keys(part, "key", F.col("id")), few)
    brought = store.all_keys().select(F.col("origin").alias("id")).where("id is not null")
    ids = tries.where(normal(F.col("raw")).isNotNull()).select("id")
    return ids.join(brought, "id", "left_anti").distinct(), store


def audit(
    accepted: DataFrame, attempts: DataFrame, key: str, order: str, seen: DataFrame,
    every: int = AUDITED, normal: Callable[[Column], Column] = name_key,
) -> DataFrame:
    """One row, ``asked, wrong``: the answers ``seen`` (ids) for every row whose id ``every`` divides,
    beside what all rows of both tables say. No run and no hash is used, the names themselves are joined.
    Rows without a name are not asked."""
    tries = attempts.select(F.col(order).cast("bigint").alias("id"), normal(F.col(key)).alias("key")).where("id IS NOT NULL AND key IS NOT NULL")
    first = tries.groupBy("key").agg(F.min("id").alias("first"))
    held = accepted.select(normal(F.col(key)).alias("key")).where("key IS NOT NULL").distinct().withColumn("held", F.lit(True))
    asked = tries.where(F.col("id") % every == 0).distinct().join(first, "key").join(held, "key", "left")
    told = asked.join(seen.select("id", F.lit(True).alias("told")), "id", "left")
    exact = F.col("held").isNotNull() | (F.col("first") < F.col("id"))
    return told.agg(F.count("*").alias("asked"), F.count_if(F.col("told").isNotNull() != exact).alias("wrong"))
