"""Writers of the finished data set and of the documents that describe it."""

from __future__ import annotations

import gzip
import hashlib
import json
import re
from collections.abc import Iterator
from datetime import UTC, datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import storage
from ..functions.hashing import row_digest
from ..functions.registry import FeatureSet
from ..operators import cuts
from ..session import materialize, ship_package

#: Size estimate of a stored row: its name, 8 bytes a column, and 64 more, 128 at least.
LEAST_ROW, ROW_EXTRA = 128, 64


def refuse_existing(spark: SparkSession, paths: list[str], overwrite: bool) -> None:
    """Outputs that exist are refused, or removed if they may be."""
    there = [p for p in paths if storage.exists(spark, p)]
    if there and not overwrite:
        raise FileExistsError(f"exists: {', '.join(there)}")
    for p in there:
        storage.delete(spark, p)


def final_schema(registry: FeatureSet) -> T.StructType:
    """DOMAIN, the features, CLASS, LABEL; no column may be null."""
    doubles = [T.StructField(n, T.DoubleType(), False) for n in registry.names]
    ends = [T.StructField("CLASS", T.StringType(), False), T.StructField("LABEL", T.ByteType(), False)]
    return T.StructType([T.StructField("DOMAIN", T.StringType(), False), *doubles, *ends])


def final_rows(featured: DataFrame, registry: FeatureSet) -> DataFrame:
    """Columns in their final order, spelling and type."""
    return featured.select(F.col("domain").alias("DOMAIN"), *[F.col(n) for n in registry.names], F.col("class_value").alias("CLASS"), F.col("label").cast("tinyint").alias("LABEL"))


def row_estimate(name: Column, columns: int) -> Column:
    return F.greatest(F.lit(LEAST_ROW), F.length(name) + 8 * columns + ROW_EXTRA)


def write_parts(data: DataFrame, path: str, part_bytes: int = 1_900_000_000, mode: str = "errorifexists") -> None:
    """Parquet files of about ``part_bytes`` by estimate: files end by row count, with the mean row."""
    mean = data.agg(F.avg(row_estimate(F.col(data.columns[0]), len(data.columns)))).first()[0] or LEAST_ROW
    data.write.option("maxRecordsPerFile", max(int(part_bytes // mean), 1)).mode(mode).parquet(path)


def part_numbers(data: DataFrame, order: str, name: str, part_bytes: int) -> DataFrame:
    """``data`` with ``part``: which file each row belongs to if a file is closed before the row that
    would bring its estimated size to ``part_bytes``.

    Rows are placed in ranges of about ``cuts.ROWS_PER_RANGE`` rows by sampled quantiles of the order, sizes are
    cumulated over the ranges and parts cut by the cumulated size; the estimate
    of one row (tiny beside a part) is all by which a part may differ from closing row by row.
    """
    size = row_estimate(F.col(name), len(data.columns))
    n = max(-(-data.count() // cuts.ROWS_PER_RANGE), 1)
    ranged = data.repartitionByRange(n, order).withColumn("range_", F.spark_partition_id()).withColumn("size_", size)
    ranged = materialize(ranged, "ranges")
    sums = ranged.groupBy("range_").agg(F.sum("size_").alias("s"))  # one row a range
    all_before = Window.partitionBy(F.lit(0)).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("range_", F.coalesce(F.sum("s").over(all_before), F.lit(0)).alias("offset_"))
    inside = F.sum("size_").over(Window.partitionBy("range_").orderBy(order))
    placed = ranged.withColumn("inside_", inside).join(offsets, "range_")
    part = F.floor((F.col("offset_") + F.col("inside_") - F.col("size_")) / part_bytes).cast("int")
    return placed.withColumn("part", part).drop("range_", "size_", "inside_", "offset_")


def write_splits(data: DataFrame, path: str, split: str = "split", mode: str = "errorifexists") -> None:
    """One directory a split, so that reading one prunes the others. A task keeps the files of a few splits open
    at once instead of sorting by split, so rows stay in their order."""
    conf, key = data.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, "16")
    try:
        data.write.partitionBy(split).mode(mode).parquet(path)
    finally:
        conf.set(key, before)


def write_csv(rows: DataFrame, path: str, order: str | None = None, mode: str = "errorifexists", null_text: str = "") -> None:
    """CSV with a header; in an order, that column is left out. With a ``null_text`` of its own, nulls
    and empty texts can be told apart again."""
    out = rows.orderBy(order).drop(order) if order else rows
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    out.write.options(header=True, nullValue=null_text, **keep).mode(mode).csv(path)


# -- ARFF -------------------------------------------------------------------------------------


def arff_text(c: Column) -> Column:
    escaped = F.regexp_replace(F.regexp_replace(c, r"\\", r"\\\\"), "'", r"\\'")
    return F.concat(F.lit("'"), F.translate(escaped, "\r\n\t", "   "), F.lit("'"))


def arff_number(c: Column) -> Column:
    broken = c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when(broken, "?").otherwise(c.cast("string"))


def arff_header(relation: str, features: list[str]) -> str:
    lines = [f"@RELATION {relation}", "", "@ATTRIBUTE DOMAIN STRING", *[f"@ATTRIBUTE {n} NUMERIC" for n in features]]
    return "\n".join([*lines, "@ATTRIBUTE CLASS STRING", "@ATTRIBUTE LABEL {0,1}", "", "@DATA"]) + "\n"


def arff_rows(data: DataFrame, features: list[str]) -> DataFrame:
    """One text line a row."""
    cells = [arff_text(F.col("DOMAIN")), *[arff_number(F.col(n).cast("double")) for n in features], arff_text(F.col("CLASS")), F.col("LABEL").cast("string")]
    return data.select(F.concat_ws(",", *cells).alias("value"))


def write_arff(data: DataFrame, path: str, relation: str, features: list[str]) -> None:
    """A directory of text files: the header's file comes first by name."""
    spark: SparkSession = data.sparkSession
    head = spark.createDataFrame([(x,) for x in arff_header(relation, features).splitlines()], "value string").coalesce(1)
    head.write.mode("overwrite").text(f"{path}/part=header")
    arff_rows(data, features).write.mode("overwrite").text(f"{path}/part=rows")


def arff_attributes(spark: SparkSession, path: str) -> list[str]:
    """Attribute names in front of @DATA, in file order."""
    rows = spark.read.text(f"{path}/part=header")
    found = rows.select(F.regexp_extract("value", r"(?i)\A@ATTRIBUTE\s+(\S+)", 1).alias("a")).where("a <> ''")
    return [r.a for r in found.collect()]


def arff_field_errors(spark: SparkSession, path: str, fields: int) -> int:
    """Data lines without exactly ``fields`` fields."""
    one = r"(?:'(?:[^'\\]|\\.)*+'|[^',]*+)"
    return spark.read.text(f"{path}/part=rows").where(~F.col("value").rlike(rf"\A{one}(?:,{one}){{{fields - 1}}}\z")).count()


# -- documents --------------------------------------------------------------------------------


def _opened(path: str):
    """A file of any file system that Arrow knows, as a stream."""
    from pyarrow import fs

    where, at = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
    return where.open_input_stream(at)


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, length, sha256`` of files, each read in blocks by one task, however long it is."""
    ship_package(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for path in b["path"]:
                h, n = hashlib.sha256(), 0
                with _opened(path) as f:
                    while block := f.read(1 << 20):
                        h.update(block)
                        n += len(block)
                out.append((path, n, h.hexdigest()))
            yield pd.DataFrame(out, columns=["path", "length", "sha256"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(len(paths), 1))
    return listed.mapInPandas(run, "path string, length bigint, sha256 string")


def part_columns(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``path, columns`` of Parquet files, from their footers."""
    ship_package(spark)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs, parquet

        for b in batches:
            out = []
            for path in b["path"]:
                where, at = fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
                out.append((path, parquet.read_schema(where.open_input_file(at)).names))
            yield pd.DataFrame(out, columns=["path", "columns"])

    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(len(paths), 1)).mapInPandas(run, "path string, columns array<string>")


def part_report(stored: DataFrame) -> DataFrame:
    """``path, size_bytes, rows, listed, generated`` of each file of a stored data set."""
    named = stored.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size_bytes"), "LABEL")
    return named.groupBy("path", "size_bytes").agg(F.count("*").alias("rows"), F.count_if(F.col("LABEL") == 0).alias("listed"), F.count_if(F.col("LABEL") == 1).alias("generated"))


def utc_now() -> str:
    return datetime.now(UTC).isoformat(timespec="seconds")


def portable_path(path: str, anchor: str) -> str:
    """A path relative to a folder that it lies below, else its last piece."""
    bare = lambda p: re.sub("^file:/+", "/", p).rstrip("/")
    at, root = bare(path), bare(anchor) + "/"
    return at.removeprefix(root) if at.startswith(root) else at.rsplit("/", 1)[-1]


def integrity_rows(data: DataFrame, split: Column) -> DataFrame:
    """``domain, label, split, sha256`` of each row."""
    return data.select(F.col("DOMAIN").alias("domain"), F.col("LABEL").alias("label"), split.alias("split"), row_digest(F.col("DOMAIN"), F.col("LABEL"), split).alias("sha256"))


def schema_description(registry: FeatureSet) -> dict:
    fields = [{"name": "DOMAIN", "type": "string", "description": "Normalised name."}]
    fields += [{"name": f.name, "type": f.dtype, "description": f.told} for f in registry.values()]
    fields += [{"name": "CLASS", "type": "string", "description": "TLD or generator code."}, {"name": "LABEL", "type": "int8", "description": "1 generated, 0 listed."}]
    return {"fields": fields, "feature_count": len(registry)}


def manifest(registry: FeatureSet, counts: dict, arguments: dict, **more) -> dict:
    return {
        "generated_at": utc_now(), "columns": ["DOMAIN", *registry.names, "CLASS", "LABEL"], "counts": counts, "arguments": arguments,
        "feature_name_order_checksum": registry.name_checksum(), "feature_definition_checksum": registry.definition_checksum(), **more,
    }


def write_json(spark: SparkSession, document: dict, path: str) -> None:
    """Sorted keys, replaced in one step."""
    storage.write_bytes(spark, path, (json.dumps(document, indent=2, sort_keys=True, default=str) + "\n").encode())


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads(storage.read_bytes(spark, path))


def gzip_verified(path: str) -> str:
    """Compress a local file and read it back; the digest must be that of the original."""
    out, original = f"{path}.gz", hashlib.sha256()
    with open(path, "rb") as src, gzip.open(out, "wb") as dst:
        while block := src.read(1 << 20):
            original.update(block)
            dst.write(block)
    h = hashlib.sha256()
    with gzip.open(out, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    if h.digest() != original.digest():
        raise OSError(f"{out} does not hold what {path} holds")
    return out
