"""Batches against all history: equal and nearly equal names by an incremental inverted index.

Two names are near if at most ``EDITS`` insertions, deletions or replacements of one character
turn one into the other. A name is cut into positional q-grams of its padded form. An edit spoils
at most ``Q`` of them, so of the ``EDITS * Q + 1`` first grams in any fixed order at least one is
unspoilt, and the first unspoilt one lies in that prefix of both names: two near names share a
prefix gram, with at most ``EDITS`` edits split between its left and its right side. The order is
by rarity, so that shared prefix grams are few.

The index is three families of tables below one folder, each appended to batch by batch and merged
when a level has ``fanout`` tables. Every table is bucketed and sorted, one file a bucket, so a batch
is shuffled and sorted to it while history is neither moved nor sorted again:

* ``postings`` (gram, length, part, left, name), the rare prefixes of the distinct names. A probe looks
  up its prefix grams at each length within ``EDITS``, keeps postings whose left and right shift allow
  it, and verifies the edit distance. A frequent gram is split into parts by the hash of the name;
* ``names``, the distinct names, which tell what a batch adds;
* ``members`` (name, part, id, fresh), the rows of each name, in ``COPY_PARTS`` parts by id, so that the
  copies of one name are no hot spot.

Rarity comes from a sketch: counts of grams by hash in ``SKETCH`` cells. It is fixed when the index is
made, of bounded size, and any order gives the same pairs; a stale one only costs time. Names too short
for a full prefix are indexed by what is left of them after up to ``EDITS`` deletions, which near short
names share. ``save`` writes what ``attach`` needs to go on in another session: then only the batch is
read beside the tables of the index.
"""

from __future__ import annotations

import base64
import json
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.names import name_key
from ..session import drop_path, materialize, scratch_path, scratch_table, ship_package, shuffle_partitions, sorted_scans
from .seen_keys import id_cuts

EDITS = 2
Q = 4
PREFIX = EDITS * Q + 1
#: Names of up to so many characters may have too few grams for a prefix.
SHORT = PREFIX - Q
SKETCH = 1 << 16
#: A gram of more names than this is split into parts, of which there are ``MOST_PARTS`` at most.
NAMES_PER_PART, MOST_PARTS = 200_000, 64
COPY_PARTS = 8
_GRAM_BITS = 40
FAMILIES = {
    "postings": ("gram bigint, length int, part int, left int, name string", ("gram", "length", "part")),
    "names": ("name string", ("name",)),
    "members": ("name string, part int, id bigint, fresh boolean", ("name", "part")),
}


def _grams(names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, 40-bit hash and start (from 1) of every q-gram of the padded names, over whole batches."""
    texts = [n or "" for n in names.to_pylist()]
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    pad = "\x01" * (Q - 1), "\x02" * (Q - 1)
    code = np.frombuffer("".join(f"{pad[0]}{t}{pad[1]}" for t in texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = np.fromiter(map(len, texts), np.int64, len(texts)) + Q - 1  # grams of each name
    owner = np.repeat(np.arange(len(texts)), n)
    begin = np.r_[0, np.cumsum(n)[:-1]] if len(n) else n
    start = np.arange(len(owner)) - np.repeat(begin, n) + 1
    at = np.arange(len(owner)) + owner * (Q - 1)
    h = np.zeros(len(owner), np.uint64)
    for i in range(Q):
        h = (h ^ code[at + i]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return owner, h >> np.uint64(64 - _GRAM_BITS), start


def _count_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SKETCH, np.int64)
    for b in batches:
        total += np.bincount((_grams(b.column(0))[1] % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
    cells = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(total[cells])], names=["cell", "n"])


def gram_sketch(names: DataFrame) -> bytes:
    """Counts of the grams of ``name`` in ``SKETCH`` cells, a byte each: 0 for none, then steps of
    a tenth in the logarithm to base 2. It has this size for any input; a task sends at most one count a cell."""
    ship_package(names.sparkSession)
    counts = np.zeros(SKETCH, np.int64)
    for cell, n in names.select("name").mapInArrow(_count_cells, "cell int, n bigint").groupBy("cell").agg(F.sum("n")).collect():
        counts[cell] = n
    steps = 1 + 10 * np.log2(np.maximum(counts, 1))
    return np.where(counts > 0, np.minimum(steps, 255), 0).astype(np.uint8).tobytes()


def _rare_prefix(sketch: bytes) -> Callable[[Column], Column]:
    """The rarest grams of a name, each as ``gram << 16 | start``; 0 for a start that 16 bits do not hold."""
    rarity = np.frombuffer(sketch, np.uint8)

    @F.arrow_udf("array<bigint>")
    def prefix(names: pa.Array) -> pa.Array:
        values, sizes = [], []
        for at in range(0, len(names), 1 << 16):  # the owner has 16 bits of a sort key
            part = names.slice(at, 1 << 16)
            owner, gram, start = _grams(part)
            rare = rarity[(gram % np.uint64(SKETCH)).astype(np.int64)].astype(np.uint64)
            order = np.argsort(owner.astype(np.uint64) << np.uint64(48) | rare << np.uint64(_GRAM_BITS) | gram, kind="stable")
            n = np.bincount(owner, minlength=len(part))
            place = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
            kept = order[place < PREFIX]
            left = np.where(start[kept] < 1 << 16, start[kept], 0)
            values.append(gram[kept].astype(np.int64) << 16 | left)
            sizes.append(np.minimum(n, PREFIX))
        ends = np.r_[0, np.cumsum(np.concatenate(sizes))] if sizes else np.zeros(1)
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))

    return prefix


def _deletions(name: Column) -> Column:
    """What is left of a name after up to ``EDITS`` deletions, hashed; as grams without a start."""
    drop = lambda v: F.transform(F.sequence(F.lit(1), F.greatest(F.length(v), F.lit(1))), lambda i: F.concat(F.substring(v, F.lit(1), i - 1), F.substring(v, i + 1, F.length(v))))
    one = drop(name)
    hashed = lambda v: F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.lit("short"), v), 64 - _GRAM_BITS), 16)
    return F.array_distinct(F.transform(F.concat(F.array(name), one, F.flatten(F.transform(one, drop))), hashed))


class NearKeyIndex:
    """Inverted index of the rare-gram prefixes of distinct names, with the rows of each name.

    ``path`` makes it a lasting one, to be attached to later; else it goes with the scope that it is made in.
    """

    def __init__(self, spark: SparkSession, sketch: bytes, path: str | None = None, buckets: int | None = None, fanout: int = 4):
        self.spark, self.sketch, self.lasting = spark, sketch, path is not None
        self.path = path or scratch_path(spark, "index")
        self.buckets, self.fanout = buckets or shuffle_partitions(spark), max(2, fanout)
        self.tables: dict[str, list[dict]] = {f: [] for f in FAMILIES}
        sorted_scans(spark)
        ship_package(spark)

    # -- tables -----------------------------------------------------------------------------

    def _read(self, family: str) -> list[DataFrame]:
        return [self.spark.table(t["table"]) for t in self.tables[family]]

    def _write(self, family: str, rows: DataFrame, level: int = 0) -> None:
        schema, by = FAMILIES[family]
        table = f"zonewright_{family}_{uuid.uuid4().hex}" if self.lasting else scratch_table(self.spark, family)
        columns = [c.split()[0] for c in schema.split(", ")]
        placed = rows.select(*columns).repartition(self.buckets, *by)
        placed.write.format("parquet").bucketBy(self.buckets, *by).sortBy(*by).option("path", f"{self.path}/{table}").saveAsTable(table)
        self.tables[family].append({"level": level, "table": table})
        same = [t for t in self.tables[family] if t["level"] == level]
        if len(same) >= self.fanout:
            merged = self.spark.table(same[0]["table"])
            for t in same[1:]:
                merged = merged.unionByName(self.spark.table(t["table"]))
            self.tables[family] = [t for t in self.tables[family] if t["level"] != level]
            self._write(family, merged, level + 1)
            for t in same:
                self._drop(t)

    def _drop(self, t: dict) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {t['table']}")
        drop_path(self.spark, f"{self.path}/{t['table']}")

    # -- tokens -----------------------------------------------------------------------------

    def tokens(self, names: DataFrame) -> DataFrame:
        """The columns of ``names`` and ``tokens``, what each name is found by."""
        size, short = F.length("name"), _deletions(F.col("name"))
        full = names.select("*", _rare_prefix(self.sketch)(F.col("name")).alias("full"))
        tokens = F.when(size > SHORT + EDITS, F.col("full")).when(size > SHORT, F.concat("full", short)).otherwise(short)
        return full.select(*names.columns, tokens.alias("tokens"))

    def _parts(self, gram: Column) -> Column:
        """Into how many parts a gram is split, by its count in the sketch."""
        cell = F.pmod(gram, F.lit(SKETCH)).cast("int") + 1
        step = F.conv(F.hex(F.substring(F.lit(self.sketch), cell, F.lit(1))), 16, 10).cast("int")
        return F.least(F.ceil(F.pow(F.lit(2.0), (step - 1) / 10) / NAMES_PER_PART), F.lit(MOST_PARTS)).cast("int")

    def _splits(self) -> bool:
        """Whether any gram is frequent enough to be split."""
        return max(self.sketch, default=0) > 1 + 10 * np.log2(NAMES_PER_PART)

    def _exploded(self, tokens: DataFrame) -> DataFrame:
        each = tokens.select("name", F.length("name").alias("length"), F.explode("tokens").alias("t"))
        return each.select(F.shiftright("t", 16).alias("gram"), "length", F.col("t").bitwiseAND(0xFFFF).cast("int").alias("left"), "name")

    # -- batches ----------------------------------------------------------------------------

    def take(self, rows: DataFrame) -> DataFrame:
        """Add the rows ``id, name, fresh`` of a batch, and give ``tokens`` of its distinct names."""
        asked, new = rows.select("name").distinct(), F.lit(True)
        for i, held in enumerate(self._read("names")):
            asked = asked.join(held.withColumn(f"in{i}", F.lit(True)).hint("merge"), "name", "left")
            new = new & F.col(f"in{i}").isNull()
        tokens = materialize(self.tokens(asked.select("name", new.alias("new"))), "tokens")
        fresh = tokens.where("new")
        part = F.pmod(F.xxhash64("name"), self._parts(F.col("gram"))).cast("int") if self._splits() else F.lit(0)
        self._write("postings", self._exploded(fresh).withColumn("part", part))
        self._write("names", fresh)
        self._write("members", rows.withColumn("part", F.pmod("id", F.lit(COPY_PARTS)).cast("int")))
        return tokens

    def near(self, tokens: DataFrame) -> DataFrame:
        """``name, other``: pairs with the distinct names held that differ and are near."""
        probe = self._exploded(tokens).withColumnsRenamed({"left": "p_left", "length": "p_length", "name": "p_name"})
        # 0 where nothing is split, but no literal: the optimizer would take it out of the join's keys, and history would move
        part = F.explode(F.sequence(F.lit(0), self._parts(F.col("gram")) - 1)) if self._splits() else (F.col("p_left") < 0).cast("int")
        probe = probe.select("*", part.alias("part"))
        shifts = F.array(*[F.lit(i) for i in range(-EDITS, EDITS + 1)])
        probe = probe.select("*", F.explode(shifts).alias("shift")).withColumn("length", F.col("p_length") + F.col("shift"))
        probe = probe.where("length > 0")
        # edits to the left of the shared gram plus edits to its right
        left = F.col("left") - F.col("p_left")
        fits = (F.col("left") == 0) | (F.col("p_left") == 0) | (F.abs(left) + F.abs(F.col("shift") - left) <= EDITS)
        pairs = None
        for table in self._read("postings"):
            hits = probe.join(table.hint("merge"), ["gram", "length", "part"]).where(fits & (F.col("name") != F.col("p_name")))
            hits = hits.where(F.levenshtein("name", "p_name", EDITS) >= 0).select(F.col("p_name").alias("name"), F.col("name").alias("other"))
            pairs = hits if pairs is None else pairs.unionByName(hits)
        return pairs.distinct()

    def check(self, rows: DataFrame) -> DataFrame:
        """Add a batch of rows ``id, name, fresh`` and give ``name, other`` for each of its names: the names
        held, of the batch itself too, that are near."""
        return materialize(self.near(self.take(rows)), "links")

    def pairs(self, rows: DataFrame, links: DataFrame) -> DataFrame:
        """``id_a, id_b``, smaller id first, the larger one fresh: rows of the batch with rows held of equal
        names and of the names that ``links`` gives for theirs. The rows held are not moved."""
        every = F.explode(F.sequence(F.lit(0), F.lit(COPY_PARTS - 1))).alias("part")
        asked = rows.join(links, "name").select("id", "fresh", F.col("other").alias("name"))
        asked = asked.unionByName(rows.select("id", "fresh", "name")).withColumnsRenamed({"id": "a", "fresh": "fa"}).select("*", every)
        out = None
        for table in self._read("members"):
            both = asked.join(table.withColumnsRenamed({"id": "b", "fresh": "fb"}).hint("merge"), ["name", "part"]).where("a <> b")
            both = both.where(F.when(F.col("a") > F.col("b"), F.col("fa")).otherwise(F.col("fb"))).select(F.least("a", "b").alias("id_a"), F.greatest("a", "b").alias("id_b"))
            out = both if out is None else out.unionByName(both)
        return out.distinct()

    def classes(self) -> DataFrame:
        """``name, class_id``: each distinct name with the smallest id of its rows, copies combined before the shuffle."""
        out = None
        for table in self._read("members"):
            out = table if out is None else out.unionByName(table)
        return out.groupBy("name").agg(F.min("id").alias("class_id"))

    # -- life -------------------------------------------------------------------------------

    def save(self) -> None:
        """Write what ``attach`` needs beside the tables."""
        told = {"buckets": self.buckets, "fanout": self.fanout, "tables": self.tables, "sketch": base64.b64encode(self.sketch).decode()}
        storage.write_bytes(self.spark, f"{self.path}/manifest.json", json.dumps(told).encode())

    @classmethod
    def attach(cls, spark: SparkSession, path: str) -> NearKeyIndex:
        """The index that was saved at ``path``; no row of history is read for it."""
        told = json.loads(storage.read_bytes(spark, f"{path}/manifest.json"))
        index = cls(spark, base64.b64decode(told["sketch"]), path, told["buckets"], told["fanout"])
        index.tables = told["tables"]
        for family, tables in index.tables.items():
            schema, by = FAMILIES[family]
            for t in tables:
                if not spark.catalog.tableExists(t["table"]):
                    keys = ", ".join(by)
                    spark.sql(f"CREATE TABLE {t['table']} ({schema}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {index.buckets} BUCKETS LOCATION '{path}/{t['table']}'")
        return index

    def drop(self) -> None:
        for tables in self.tables.values():
            for t in tables:
                self._drop(t)
        self.tables = {f: [] for f in FAMILIES}
        drop_path(self.spark, self.path)


def keyed_rows(rows: DataFrame, key: str, row_id: str, fresh: bool, normal: Callable[[Column], Column] = name_key) -> DataFrame:
    """``id, name, fresh`` of the rows that have both."""
    out = rows.select(F.col(row_id).cast("bigint").alias("id"), normal(F.col(key)).alias("name"), F.lit(fresh).alias("fresh"))
    return out.where("id IS NOT NULL AND name IS NOT NULL")


def index_of(accepted: DataFrame, key: str, row_id: str, normal: Callable[[Column], Column] = name_key, path: str | None = None) -> NearKeyIndex:
    """An index of all accepted rows, which later batches are checked against."""
    rows = keyed_rows(accepted, key, row_id, False, normal)
    index = NearKeyIndex(accepted.sparkSession, gram_sketch(rows), path)
    index.take(rows)
    return index


def checked_batches(
    accepted: DataFrame, batches: DataFrame, key: str, row_id: str, batch: str,
    steps: int = 2, normal: Callable[[Column], Column] = name_key,
) -> tuple[NearKeyIndex, list[tuple[DataFrame, DataFrame]]]:
    """The index after all batches, and the rows and links of each step.

    The accepted rows are indexed once. The batches are then taken in ``steps`` ranges of ``batch``: each is
    probed against the index, which holds all before it and its own new names, since they are appended first.
    """
    index = index_of(accepted, key, row_id, normal)
    rows = batches.select(F.coalesce(F.col(batch), F.lit(0)).cast("bigint").alias("at"), F.col(row_id).cast("bigint").alias("id"), normal(F.col(key)).alias("name"))
    rows = materialize(rows.where("id IS NOT NULL AND name IS NOT NULL").withColumn("fresh", F.lit(True)), "batches")
    found = []
    for lo, hi in id_cuts(rows, "at", steps):
        part = rows
        if lo is not None:
            part = part.where(F.col("at") >= lo)
        if hi is not None:
            part = part.where(F.col("at") < hi)
        part = part.drop("at")
        found.append((part, index.check(part)))
    return index, found


def near_pairs(accepted: DataFrame, batches: DataFrame, key: str, row_id: str, batch: str, steps: int = 2, normal: Callable[[Column], Column] = name_key) -> DataFrame:
    """``(id_a, id_b)``, smaller id first: rows of ``batches`` with rows of ``accepted`` or of
    ``batches`` whose names are equal or near.

    Ids of both tables share one space; rows with null ids are left out, rows with null or empty names are
    near to nothing. Copies of a name cost one probe; their pairs are made by one join at the end. Where the
    pairs of many copies are not wanted, ``near_classes`` gives the same in one row a record.
    """
    index, found = checked_batches(accepted, batches, key, row_id, batch, steps, normal)
    out = None
    for rows, links in found:
        pairs = index.pairs(rows, links)
        out = pairs if out is None else out.unionByName(pairs)
    return out.distinct()


def near_classes(accepted: DataFrame, batches: DataFrame, key: str, row_id: str, batch: str, steps: int = 2, normal: Callable[[Column], Column] = name_key) -> tuple[DataFrame, DataFrame]:
    """Members and links of the classes of equal names.

    Members: ``id, fresh, class_id, copies, links``, one row a record of either table with an id and a name; a
    class is told by its smallest id, ``links`` are the other names of any class that are near, if one of the
    two came with a batch. Links: ``class_a, class_b``, smaller first, one row for two near names. No link
    between different names is lost, and copies are not expanded into pairs.
    """
    index, found = checked_batches(accepted, batches, key, row_id, batch, steps, normal)
    both = None
    for _, links in found:
        both = links if both is None else both.unionByName(links)
    named = index.classes()
    once = both.select(F.least("name", "other").alias("name"), F.greatest("name", "other").alias("other")).distinct()
    ends = once.unionByName(once.select(F.col("other").alias("name"), F.col("name").alias("other")))
    degree = ends.groupBy("name").agg(F.count("*").alias("links"))
    rows = None
    for table in index._read("members"):
        rows = table if rows is None else rows.unionByName(table)
    rows = rows.select("id", "name", "fresh").distinct()
    sizes = rows.groupBy("name").agg(F.min("id").alias("class_id"), F.count_distinct("id").alias("copies"))
    members = rows.join(sizes, "name").join(degree, "name", "left").select("id", "fresh", "class_id", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    a = once.join(named, "name").select("other", F.col("class_id").alias("x"))
    pairs = a.join(named.withColumnRenamed("name", "other"), "other")
    return members, pairs.select(F.least("x", "class_id").alias("class_a"), F.greatest("x", "class_id").alias("class_b"))
