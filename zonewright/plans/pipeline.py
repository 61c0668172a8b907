"""The two batch pipelines end to end: an aggregated list, and the finished data set on disk."""

from __future__ import annotations

import re
import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import storage
from ..functions import hashing, registry
from ..operators import balance, cuts, dedup, quota, rejects, sampling, stats, validate
from ..session import Scope, materialize, shuffle_partitions
from ..sinks import files
from ..sources import catalog, lists

#: Buckets of each measure and label in ``stats.json``; the table ``distributions`` has all.
TOP_BUCKETS = 1000
#: Added to the seed for draws that refill a shortfall.
REFILL_SEED = 10_000_019


@dataclass
class ListOptions:
    target: int = 15_000_000
    seed: int = 42
    delimiter: str | None = None
    domain_column: str | None = None
    header_auto_detect: bool = True
    strictness: str = "balanced"
    unique_per_file: bool = False
    unique: bool = False
    shortfall: str = "refill"  # or "allow", or "error"
    count_cache: str | None = None


def aggregate_lists(spark: SparkSession, paths: Sequence[str], opt: ListOptions) -> tuple[DataFrame, dict]:
    """``domain`` of ``opt.target`` names from list files, by quota of their rows, and a report.

    Quotas are floors and largest remainders of the raw rows; what a file cannot deliver goes to the
    others; what then is missing is drawn again with replacement, unless that is refused. Names of a
    file are taken in their line order (plain lists: in the order of a coprime walk).
    """
    lines = lists.read_lines(spark, list(paths))
    rows = [(i, opt.delimiter, opt.domain_column, opt.header_auto_detect, opt.strictness) for i in range(len(paths))]
    config = spark.createDataFrame(rows, "file_id bigint, delimiter string, domain_column string, header_auto_detect boolean, validation_strictness string")
    schemas = materialize(rejects.file_schemas(lines, config), "schemas")
    if opt.count_cache:
        reading = catalog.Reading(opt.delimiter, opt.domain_column, opt.header_auto_detect, opt.strictness)
        ids_of = {p: i for i, p in enumerate(paths)}
        counts = {ids_of[r.path]: (r.raw_rows, r.physical_rows) for r in catalog.counted(spark, list(paths), reading, opt.count_cache).collect()}
    else:
        counts = {r.file_id: (r.raw_rows, r.physical_rows) for r in lists.raw_counts(lines, schemas).collect()}  # one row a file
    offered = materialize(lists.list_candidates(lines, config), "offered")
    report = {r.file_id: r.asDict() for r in lists.file_report(offered).collect()}
    plain = {r.file_id for r in schemas.where("delim IS NULL").collect() if str(paths[r.file_id]).lower().endswith(".txt")}
    ids = list(range(len(paths)))
    walks = []
    for i in ids:
        n = counts.get(i, (0, 0))[1]
        start, step = sampling.stride(n, sampling.seed_of(opt.seed, str(paths[i]))) if i in plain else (0, 1)
        walks.append((i, max(n, 1), start, pow(step, -1, n) if n > 1 else 0))
    table = spark.createDataFrame(walks, "file_id bigint, lines bigint, start bigint, inverse bigint")
    turn = F.pmod((F.col("line_no") - 1 - F.col("start")).cast("decimal(19,0)") * F.col("inverse").cast("decimal(19,0)"), F.col("lines").cast("decimal(19,0)")).cast("bigint")
    usable = offered.where("valid").join(table, "file_id").select("file_id", "name", turn.alias("turn"), (turn / F.col("lines")).alias("place"))
    usable = usable.withColumn("pos", F.col("file_id") * (1 << 40) + F.col("turn")).drop("turn")
    if opt.unique:
        usable = dedup.first_wins(usable, "name", "pos", ties=False)
    elif opt.unique_per_file:
        usable = dedup.first_wins(usable.withColumn("k", F.struct("file_id", "name")), "k", "pos", ties=False).drop("k")
    usable = materialize(usable, "usable")
    capacity = {r.file_id: r["count"] for r in usable.groupBy("file_id").count().collect()}
    raw = [counts.get(i, (0, 0))[0] for i in ids]
    taken, missing = quota.fill_quotas([capacity.get(i, 0) for i in ids], raw, opt.target)
    limits = spark.createDataFrame(list(zip(ids, taken, strict=True)), "file_id bigint, taken bigint")
    placed = cuts.prefix_sums(usable, ["file_id"], "place", "pos", F.lit(1))
    out = placed.join(limits, "file_id").where("before_ < taken").select("name")
    if missing and opt.shortfall == "error":
        raise ValueError(f"{missing} of {opt.target} names are missing")
    if missing and opt.shortfall == "refill" and not opt.unique:
        weights = spark.createDataFrame([(i, raw[i]) for i in ids], "file_id bigint, weight bigint")
        out = out.unionByName(sampling.refill(usable.select("file_id", "name").distinct(), "file_id", "name", weights, missing, opt.seed + REFILL_SEED).select("name"))
        missing = 0 if capacity else missing
    shares = quota.allocate_details(raw, opt.target)
    told = {"target": opt.target, "missing": missing, "files": [report.get(i, {}) | {"path": str(paths[i]), "raw_rows": raw[i], "quota": shares[i].quota, "taken": taken[i]} for i in ids]}
    return out.select(F.col("name").alias("domain")), told


@dataclass
class DatasetOptions:
    seed: int = 42
    train: float = 0.8
    validation: float = 0.1
    test: float = 0.1
    part_bytes: int = 1_900_000_000
    sample: int = 1000
    audit: int = 100
    overwrite: bool = False
    splits: bool = True


def build_dataset(spark: SparkSession, listed: str, generated: str, out: str, opt: DatasetOptions, reg: registry.FeatureSet = registry.DEFAULT) -> dict:
    """Read both CSV inputs, balance, compute the features, and write the data set below ``out``:
    ``data`` (one directory a split), ``integrity``, ``sample_arff``, ``audit``, ``distributions`` (all buckets of
    each measure, by label and in all), and the documents ``manifest.json``, ``schema.json`` and ``stats.json``. Returns the manifest.

    Statistics of a run that fails are written with ``status: failed`` before the error goes on.
    """
    hashing.split_of("domain", opt.seed, opt.train, opt.validation, opt.test)  # refuses bad ratios
    at = lambda *parts: storage.join(out, *parts)
    files.refuse_existing(spark, [at(f) for f in ("manifest.json", "schema.json", "stats.json")], opt.overwrite)
    mode, began = "overwrite" if opt.overwrite else "errorifexists", time.time()
    try:
        with Scope(spark):
            listed, generated = lists.resolve_input(spark, listed), lists.resolve_input(spark, generated)
            list_rows, gen_rows = lists.read_pairs(spark, listed, False), lists.read_pairs(spark, generated, True)
            gen = materialize(balance.generated_names(gen_rows, "domain", "code", "pos"), "generated")
            bare = materialize(balance.listed_names(list_rows, "domain", "pos", gen), "listed")
            chosen = balance.balanced(gen, bare, opt.seed, ordered=True)
            # sorted while the rows are narrow; the features are computed where a row lies, so files keep the order
            place = [F.col(c).asc_nulls_first() for c in balance.ORDER]
            ranges = max(spark.sparkContext.defaultParallelism, shuffle_partitions(spark))
            chosen = chosen.repartitionByRange(ranges, *place).sortWithinPartitions(*place).select("domain", "class_value", "label")
            data = files.final_rows(registry.with_features(chosen, "domain", reg), reg)
            split = hashing.split_of("DOMAIN", opt.seed, opt.train, opt.validation, opt.test)
            if opt.splits:
                files.write_splits(data.withColumn("split", split), at("data"), mode=mode)
            else:
                files.write_parts(data, at("data"), opt.part_bytes, mode)
            on_disk = spark.read.schema(data.schema).parquet(at("data"))
            stored = on_disk.select(*data.columns)
            errors = validate.validate(stored, reg)
            if errors:
                raise ValueError("; ".join(errors))
            files.integrity_rows(stored, split).write.mode(mode).parquet(at("integrity"))
            files.write_arff(sampling.bottom_k(stored, "DOMAIN", opt.sample, opt.seed), at("sample_arff"), "names", list(reg.names))
            for label in (0, 1):
                mine = sampling.bottom_k(stored.where(F.col("LABEL") == label).select("DOMAIN", "CLASS", "LABEL"), "DOMAIN", opt.audit, opt.seed + label)
                files.write_csv(mine.orderBy("DOMAIN").coalesce(1), at("audit", f"label={label}"), mode=mode)
            counts = {f"{r.split}/{r.LABEL}": r["count"] for r in stored.groupBy(split.alias("split"), "LABEL").count().collect()}
            counters = balance.selection_counts(gen_rows, list_rows, "domain", "code", "pos", gen, bare).first().asDict()
            per_class = sum(counts.values()) // 2
            counters |= {
                "invalid_rows": counters["generated_invalid"] + counters["listed_invalid"], "generated_reduced": gen.count() - per_class, "rows_of_each_class": per_class,
                "rows_written": 2 * per_class, "listed_written": per_class, "generated_written": per_class,
            }
            inputs = {name: [{"path": files.portable_path(r.path, out), "bytes": r.length, "sha256": r.sha256} for r in files.file_digests(spark, lists.files_of(spark, path)).collect()] for name, path in (("listed", listed), ("generated", generated))}
            sums = {r.path: r.sha256 for r in files.file_digests(spark, stored.inputFiles()).collect()}
            bare_path = lambda p: re.sub("^file:/+", "/", p)
            sums = {bare_path(p): h for p, h in sums.items()}
            parts = [{"path": files.portable_path(r.path, out), "rows": r.rows, "listed": r.listed, "generated": r.generated, "bytes": r.size_bytes, "sha256": sums.get(bare_path(r.path))} for r in files.part_report(on_disk).orderBy("path").collect()]
            files.write_json(spark, files.schema_description(reg), at("schema.json"))
            told = files.manifest(reg, counts, vars(opt), inputs=inputs, parts=parts, counters=counters)
            files.write_json(spark, told, at("manifest.json"))
            shapes = stats.distributions(stored.select(F.col("DOMAIN").alias("d"), F.col("LABEL").alias("l")), "d", "l")
            shapes.orderBy("measure", "label", F.desc("n"), "bucket").write.mode(mode).parquet(at("distributions"))
            kept = spark.read.schema(shapes.schema).parquet(at("distributions"))
            place = F.row_number().over(Window.partitionBy("measure", "label").orderBy(F.desc("n"), "bucket"))
            top: dict[str, dict] = {}
            for r in kept.withColumn("place_", place).where(F.col("place_") <= TOP_BUCKETS).orderBy("measure", "label", "place_").collect():
                top.setdefault(r.measure, {}).setdefault("all" if r.label is None else str(r.label), {})[r.bucket] = r.n
            told_shapes = {"table": "distributions", "buckets": kept.count(), "top_buckets_of_each_measure_and_label": TOP_BUCKETS, "top": top}
            runtime = {"started_unix": began, "seconds": time.time() - began}
            files.write_json(spark, {"status": "ok", "generated_at": files.utc_now(), "counts": counts, "counters": counters, "parts": parts, "runtime": runtime, "distributions": told_shapes}, at("stats.json"))
            return told
    except Exception as e:
        files.write_json(spark, {"status": "failed", "generated_at": files.utc_now(), "reason": str(e)[:500]}, at("stats.json"))
        raise


def validate_dataset(spark: SparkSession, out: str) -> list[str]:
    """All faults of a data set on disk: its rows, the columns of each file, its sample, and its manifest."""
    told = files.read_json(spark, storage.join(out, "manifest.json"))
    reg = registry.FeatureSet(map(registry.Feature, told["columns"][1:-2]))
    stored = spark.read.parquet(storage.join(out, "data"))
    errors = validate.validate(stored.select(*[c for c in stored.columns if c != "split"]), reg, told)
    errors += validate.part_errors([(r.path, r.columns) for r in files.part_columns(spark, stored.inputFiles()).orderBy("path").collect()], reg)
    sample = storage.join(out, "sample_arff")
    if storage.exists(spark, sample):
        errors += validate.arff_errors(files.arff_attributes(spark, sample), files.arff_field_errors(spark, sample, len(reg) + 3), reg)
    return errors
