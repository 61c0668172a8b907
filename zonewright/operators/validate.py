"""Checks of a finished data set: schema, labels, classes, balance, overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.names import suffix
from ..functions.registry import FeatureSet

#: Offending rows that an error names.
EXAMPLES = 5


def schema_errors(columns: list[str], registry: FeatureSet) -> list[str]:
    """Column order must be DOMAIN, the features, CLASS, LABEL, in this spelling."""
    want = ["DOMAIN", *registry.names, "CLASS", "LABEL"]
    if columns == want:
        return []
    if "class" in columns:
        return ["old column name: class"]
    return [f"columns differ from the registry: {sorted(set(columns) ^ set(want)) or 'order'}"]


def rollup(data: DataFrame) -> DataFrame:
    """One row: rows, rows a label, and rows that break a rule. Names are unique in a data set, so
    overlap is counted by name over both labels."""
    d, c, label = F.col("DOMAIN"), F.col("CLASS"), F.col("LABEL")
    per_name = data.groupBy("DOMAIN").agg(F.count_if(label == 0).alias("n0"), F.count_if(label == 1).alias("n1"))
    twice = per_name.agg(F.count_if((F.col("n0") > 0) & (F.col("n1") > 0)).alias("overlap"), F.count_if(F.col("n0") + F.col("n1") > 1).alias("repeated"))
    wrong = (label == 0) & ~c.eqNullSafe(suffix(d)) | (label == 1) & (F.coalesce(F.trim(c), F.lit("")) == "")
    one = data.agg(
        F.count("*").alias("rows"), F.count_if(label == 0).alias("listed"), F.count_if(label == 1).alias("generated"),
        F.count_if(~F.coalesce(label.isin(0, 1), F.lit(False))).alias("bad_labels"), F.count_if(wrong).alias("bad_classes"),
    )
    return one.withColumn("k", F.lit(1)).join(twice.withColumn("k", F.lit(1)), "k").drop("k").withColumn("balanced", F.col("listed") == F.col("generated"))


def part_errors(parts: list[tuple[str, list[str]]], registry: FeatureSet) -> list[str]:
    """Files whose columns are not those of the data set, in their order."""
    return [f"{path}: {e}" for path, columns in parts for e in schema_errors([c for c in columns if c != "split"], registry)]


def arff_errors(attributes: list[str], broken_rows: int, registry: FeatureSet) -> list[str]:
    """Faults of a sample file: other attributes than the columns, or rows with another number of fields."""
    want = ["DOMAIN", *registry.names, "CLASS", "LABEL"]
    out = [] if attributes == want else [f"attributes of the sample differ: {sorted(set(attributes) ^ set(want)) or 'order'}"]
    return out + ([f"{broken_rows} rows of the sample do not have {len(want)} fields"] if broken_rows else [])


def validate(data: DataFrame, registry: FeatureSet, manifest: dict | None = None) -> list[str]:
    """All errors of a data set, an empty list if it is sound."""
    errors = schema_errors(data.columns, registry)
    if manifest:
        if manifest.get("feature_name_order_checksum") != registry.name_checksum():
            errors.append("checksum of the feature names differs from the manifest")
        if manifest.get("feature_definition_checksum") != registry.definition_checksum():
            errors.append("checksum of the feature definitions differs from the manifest")
    if errors:
        return errors
    r = rollup(data).first()
    if r["bad_labels"]:
        some = [x[0] for x in data.where(~F.coalesce(F.col("LABEL").isin(0, 1), F.lit(False))).select("LABEL").limit(EXAMPLES).collect()]
        errors.append(f"labels other than 0 and 1 in {r['bad_labels']} rows: {some}")
    if r["bad_classes"]:
        errors.append(f"class does not fit the name or is blank in {r['bad_classes']} rows")
    if r["overlap"]:
        errors.append(f"{r['overlap']} names have both labels")
    if not r["balanced"]:
        errors.append(f"labels are not balanced: {r['listed']} and {r['generated']}")
    return errors
