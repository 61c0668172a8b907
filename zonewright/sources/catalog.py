"""A cached catalogue of row counts of list files."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators import rejects
from . import lists

SCHEMA = "path string, length bigint, modified bigint, signature string, physical_rows bigint, raw_rows bigint"


@dataclass(frozen=True)
class Reading:
    """How lists are read; counts made under another reading are not reused."""

    delimiter: str | None = None
    domain_column: str | None = None
    header_auto_detect: bool = True
    strictness: str = "balanced"

    def signature(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


def _status(spark: SparkSession, path: str) -> tuple[int, int]:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    s = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(where)
    return s.getLen(), s.getModificationTime()


def counted(spark: SparkSession, paths: list[str], reading: Reading, cache: str | None = None) -> DataFrame:
    """``path, length, modified, signature, physical_rows, raw_rows``, by path.

    Only files whose length, time or reading changed since they were counted are read, all in one
    job; the cache is then written anew beside the old one and swapped in.
    """
    sign = reading.signature()
    now = spark.createDataFrame([(p, *_status(spark, p), sign) for p in paths], "path string, length bigint, modified bigint, signature string")
    known = spark.createDataFrame([], SCHEMA)
    if cache and storage.exists(spark, cache):
        known = spark.read.schema(SCHEMA).parquet(cache)
    hits = now.join(known, ["path", "length", "modified", "signature"])
    todo = [r.path for r in now.join(known, ["path", "length", "modified", "signature"], "left_anti").orderBy("path").collect()]
    out = hits
    if todo:
        lines = lists.read_lines(spark, todo)
        rows = [(i, reading.delimiter, reading.domain_column, reading.header_auto_detect, reading.strictness) for i in range(len(todo))]
        config = spark.createDataFrame(rows, "file_id bigint, delimiter string, domain_column string, header_auto_detect boolean, validation_strictness string")
        ids = spark.createDataFrame(list(enumerate(todo)), "file_id bigint, path string")
        counts = ids.join(lists.raw_counts(lines, rejects.file_schemas(lines, config)), "file_id", "left")
        fresh = now.join(counts.drop("file_id"), "path").select(*[c for c in hits.columns if c not in ("physical_rows", "raw_rows")], F.coalesce("physical_rows", F.lit(0)).alias("physical_rows"), F.coalesce("raw_rows", F.lit(0)).alias("raw_rows"))
        out = hits.unionByName(fresh)
        if cache:
            out.write.mode("overwrite").parquet(f"{cache}.new")
            storage.replace(spark, f"{cache}.new", cache)
            out = spark.read.schema(SCHEMA).parquet(cache).join(now, ["path", "length", "modified", "signature"], "left_semi")
    return out.orderBy("path")
