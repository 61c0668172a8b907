"""Queries of this package: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import key_form, list_name, name_key, suffix
from ..operators import rejects
from ..session import materialize, tidy
from . import mixing, nearkeys, packing, raking, reading, seen_keys
from .tokens import token_count


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _list_key(c):
    """The form of list files (no IDNA), which SQL can make too."""
    n = list_name(c)
    return F.when(n != "", n)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Attempts whose name was seen before."""
    ids, _ = seen_keys.seen_before(_t(spark, d, "domains"), _t(spark, d, "insert_attempts"), "domain", "attempt_id")
    return ids.select(F.col("id").alias("attempt_id"))


def _insert_report(spark: SparkSession, d: str, normal) -> DataFrame:
    accepted, attempts = _t(spark, d, "domains"), _t(spark, d, "insert_attempts")
    seen, store = seen_keys.seen_before(accepted, attempts, "domain", "attempt_id", normal=normal)
    seen = materialize(seen, "seen")
    named = attempts.select("attempt_id", "batch_id", normal(F.col("domain")).isNotNull().alias("named"))
    flagged = named.join(seen.select(F.lit(1).alias("seen"), F.col("id").alias("attempt_id")), "attempt_id", "left")
    per_batch = flagged.groupBy("batch_id").agg(
        F.count("*").alias("attempted"),
        F.count_if(F.col("named") & F.col("seen").isNull()).alias("inserted"),
        F.count_if("named").alias("answers"),
    )
    told = _t(spark, d, "insert_stats").groupBy("batch_id").agg(F.min_by("inserted", "committed_at").alias("reported_inserted"))
    answers = per_batch.agg(F.greatest(F.sum("answers"), F.lit(1))).scalar()
    by_hash = store.hash_only_errors().select("wrong").scalar()
    checked = seen_keys.audit(accepted, attempts, "domain", "attempt_id", seen, normal=normal)
    return per_batch.join(told, "batch_id", "left").select(
        "batch_id", "attempted", "inserted", "reported_inserted",
        (F.col("reported_inserted") - F.col("inserted")).alias("difference"),
        (by_hash / answers).alias("hash_only_wrong_rate"),
        checked.select("asked").scalar().alias("audited"), checked.select(F.try_divide("wrong", "asked")).scalar().alias("wrong_rate"),
    )


def p1_insert_report(spark: SparkSession, d: str) -> DataFrame:
    """Rows and new names of each batch beside the reported ones; the share of all answers that the hash alone would
    have got wrong, and of the audited answers (ids divisible by 50, asked again without the store) that are wrong."""
    return _insert_report(spark, d, name_key)


def p1_list_form_report(spark: SparkSession, d: str) -> DataFrame:
    """As ``p1_insert_report``, names compared in the form of list files."""
    return _insert_report(spark, d, _list_key)


def _code_sample(spark: SparkSession, d: str) -> raking.Drawn:
    rows = _t(spark, d, "domains").select("run_id", "record_id", key_form("algorithm_code").alias("category"), suffix(F.lower("domain")).alias("tld"))
    plans = _t(spark, d, "algorithm_plan").select("run_id", key_form("algorithm_code").alias("category"), "planned_quota", "updated_at")
    targets = plans.groupBy("run_id", "category").agg(F.max_by("planned_quota", "updated_at").alias("target"))
    return raking.draw(rows, targets, "run_id", "category", "record_id", ["tld"])


def _line_sample(spark: SparkSession, d: str) -> raking.Drawn:
    files = _t(spark, d, "file_stats").groupBy("file_id", "run_id", F.col("path").alias("category")).agg(F.max("quota").alias("target"))
    lines = rejects.loaded_lines(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config"))
    rows = lines.join(files.select("file_id", "run_id", "category"), "file_id").select(
        "run_id", "category", F.struct("file_id", "line_no").alias("line"), suffix("name").alias("tld")
    )
    targets = files.groupBy("run_id", "category").agg(F.max("target").alias("target"))
    return raking.draw(rows, targets, "run_id", "category", "line", ["tld"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Codes and files whose sample stays short of its target."""
    codes, files = _code_sample(spark, d).report, _line_sample(spark, d).report
    return codes.unionByName(files).where("gap > 0").select("run_id", "category")


def p3_code_sample(spark: SparkSession, d: str) -> DataFrame:
    """Accepted names drawn by the plans of their run."""
    return _code_sample(spark, d).sample


def p3_line_sample(spark: SparkSession, d: str) -> DataFrame:
    """Loaded list-file lines drawn by the quotas of their files."""
    return _line_sample(spark, d).sample.select("run_id", "category", "line.file_id", "line.line_no", "tld", "weight", "repaired")


def _both_kinds(codes: DataFrame, files: DataFrame) -> DataFrame:
    return codes.select(F.lit("code").alias("kind"), "*").unionByName(files.select(F.lit("file").alias("kind"), "*"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    """Target, stock, sample and gap of every code and file."""
    return _both_kinds(_code_sample(spark, d).report, _line_sample(spark, d).report)


def p3_margins(spark: SparkSession, d: str) -> DataFrame:
    """What raking aimed at and reached, and what the sample holds, for every value of every margin."""
    return _both_kinds(_code_sample(spark, d).margins, _line_sample(spark, d).margins)


def p3_code_tlds(spark: SparkSession, d: str) -> DataFrame:
    """Targets of the TLD margin of each run."""
    return _code_sample(spark, d).margins.where("margin = 'tld'").select("run_id", F.col("value").alias("tld"), F.round("target", 6).alias("target"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a new row and an accepted or new row with equal or nearly equal names."""
    pairs = nearkeys.near_pairs(_t(spark, d, "domains"), _t(spark, d, "new_batch"), "domain", "record_id", "batch_id")
    return pairs.select(F.col("id_a").alias("record_id_a"), F.col("id_b").alias("record_id_b"))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """Every row with a name: its class of equal names, and how many other names are near."""
    members, _ = nearkeys.near_classes(_t(spark, d, "domains"), _t(spark, d, "new_batch"), "domain", "record_id", "batch_id")
    return members.withColumnRenamed("id", "record_id")


def p5_class_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of classes whose names are near, each told by its smallest record_id."""
    return nearkeys.near_classes(_t(spark, d, "domains"), _t(spark, d, "new_batch"), "domain", "record_id", "batch_id")[1]


def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents").select("doc_id", "source", token_count(F.col("text")).alias("tokens"))
    return materialize(docs, "tokens")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that no container holds whole: the packed result has them in more than one."""
    packed, _ = packing.pack(_sized(spark, d), "doc_id", "tokens")
    return packed.groupBy("doc_id").agg(F.min("container").alias("a"), F.max("container").alias("b")).where("a < b").select("doc_id")


def p6_containers(spark: SparkSession, d: str) -> DataFrame:
    """Container of every piece."""
    return packing.pack(_sized(spark, d), "doc_id", "tokens")[0]


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Containers: how many hold a whole piece of a long document, how many dominance fixed as sets of one, two or
    three, and their fill; what best-fit alone would need, and proven and by volume the fewest possible."""
    packed, plan = packing.pack(_sized(spark, d), "doc_id", "tokens")
    total = packed.agg(F.sum("tokens").alias("tokens"), F.count_distinct("container").alias("containers"))
    return total.select(
        "containers", F.lit(plan.counts.get(packing.CAPACITY, 0)).alias("full_pieces"),
        *[F.lit(plan.fixed_sets.get(n, 0)).alias(f"fixed_sets_of_{n}") for n in (1, 2, 3)],
        F.lit(packing.plain_best_fit(plan.counts)).alias("best_fit_alone"), F.lit(packing.fewest_containers(plan.counts)).alias("fewest_proven"),
        F.ceil(F.col("tokens") / packing.CAPACITY).alias("fewest_by_volume"), "tokens",
        F.try_divide(F.col("tokens"), F.col("containers") * packing.CAPACITY).alias("fill"),
    )


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Sources that stay short of their share although used as often as they may be."""
    return mixing.mix(_sized(spark, d), _t(spark, d, "mix_targets"))[1].where("not reached").select("source")


def p7_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Documents of the mixture with their number of copies."""
    return mixing.mix(_sized(spark, d), _t(spark, d, "mix_targets"))[0]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    """Target and actual share of every source."""
    return mixing.mix(_sized(spark, d), _t(spark, d, "mix_targets"))[1]


def _levels(spark: SparkSession, d: str) -> DataFrame:
    return _propagated(spark, d).rows


def _propagated(spark: SparkSession, d: str) -> reading.Levels:
    grades = _t(spark, d, "doc_labels").select("doc_id", F.col("reading_band").alias("grade"))
    return reading.propagate(_t(spark, d, "documents"), grades, english=F.lower("lang") == "en")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """English documents for readers beyond school."""
    english = _t(spark, d, "documents").where(F.lower("lang") == "en").select("doc_id")
    return _levels(spark, d).where("band >= 4").select("doc_id").join(english, "doc_id", "left_semi")


def p8_levels(spark: SparkSession, d: str) -> DataFrame:
    """Reading level of every document, null without running English."""
    return _levels(spark, d)


def p8_report(spark: SparkSession, d: str) -> DataFrame:
    """One row: iterations, the last change and whether they settled; graded documents, each told from the others
    only, and how many fall into their band and on their side of band 4."""
    out = _propagated(spark, d)
    row = (out.iterations, out.change, out.settled, out.graded, out.same_band, out.sides[2] if out.sides else 0)
    return spark.createDataFrame([row], "iterations int, change double, settled boolean, graded bigint, in_own_band bigint, on_own_side_of_band_4 bigint")


def p8_profile(spark: SparkSession, d: str) -> DataFrame:
    """Documents of each source and band, with their mean level."""
    levels = _levels(spark, d).join(_t(spark, d, "documents").select("doc_id", key_form("source").alias("source")), "doc_id")
    return levels.groupBy("source", "band").agg(F.count("*").alias("documents"), F.avg("level").alias("mean_level"))


# The same operators with names and sizes that SQL can make too, so that whole tables can be compared.


def p1_list_form_seen(spark: SparkSession, d: str) -> DataFrame:
    """Attempts seen before, names compared in the form of list files (no IDNA)."""
    ids, _ = seen_keys.seen_before(_t(spark, d, "domains"), _t(spark, d, "insert_attempts"), "domain", "attempt_id", normal=_list_key)
    return ids.select(F.col("id").alias("attempt_id"))


def p3_code_report(spark: SparkSession, d: str) -> DataFrame:
    """Target, stock, sample and gap of every code."""
    return _code_sample(spark, d).report


def _ascii_key(c):
    return F.regexp_replace(_list_key(c), "[^ -~]", "?")


def p5_list_form_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Near pairs, names compared in the form of list files (no IDNA), other than ASCII as ``?``."""
    pairs = nearkeys.near_pairs(_t(spark, d, "domains"), _t(spark, d, "new_batch"), "domain", "record_id", "batch_id", normal=_ascii_key)
    return pairs.select(F.col("id_a").alias("record_id_a"), F.col("id_b").alias("record_id_b"))


def p5_list_form_classes(spark: SparkSession, d: str) -> DataFrame:
    """As ``p5_classes``, names compared as in ``p5_list_form_pairs``."""
    members, _ = nearkeys.near_classes(_t(spark, d, "domains"), _t(spark, d, "new_batch"), "domain", "record_id", "batch_id", normal=_ascii_key)
    return members.withColumnRenamed("id", "record_id")


def _chars(spark: SparkSession, d: str) -> DataFrame:
    docs = _t(spark, d, "documents").select("doc_id", "source", F.coalesce(F.length("text"), F.lit(0)).alias("tokens"))
    return materialize(docs, "chars")


def p6_char_pieces(spark: SparkSession, d: str) -> DataFrame:
    """Pieces and packed characters of each document, in containers of 8,192 characters."""
    packed, _ = packing.pack(_chars(spark, d), "doc_id", "tokens", 8192)
    return packed.groupBy("doc_id").agg(F.count("*").alias("n_pieces"), F.sum("tokens").alias("chars"), F.count("container").alias("n_containers"))


def p7_char_report(spark: SparkSession, d: str) -> DataFrame:
    """Stock, budget and shortfall of each source in characters."""
    report = mixing.mix(_chars(spark, d), _t(spark, d, "mix_targets"))[1]
    return report.select("source", "stock_tokens", F.round("budget_tokens", 4).alias("budget"), F.round("missing_tokens", 4).alias("missing"), "reached")


def p7_char_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Documents and characters that each source gave, against its budget, and the most copies of a document."""
    docs = _chars(spark, d)
    drawn, report = mixing.mix(docs, _t(spark, d, "mix_targets"))
    got = drawn.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("drawn"), F.max("copies").alias("most"))
    longest = docs.groupBy(key_form("source").alias("key")).agg(F.max("tokens").alias("longest"))
    rows = report.join(got, "source", "left").withColumn("key", key_form("source")).join(longest, "key", "left")
    least = F.least("budget_tokens", F.col("max_repeats") * F.col("stock_tokens"))
    return rows.select(
        "source", (F.coalesce("drawn", F.lit(0)) == F.col("drawn_tokens")).alias("told"), (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within_cap"),
        (F.abs(F.coalesce("drawn", F.lit(0)) - least) <= F.coalesce("longest", F.lit(0)) / 2 + 1).alias("within_half_a_document"),
    )


def p6_char_containers(spark: SparkSession, d: str) -> DataFrame:
    """What holds of any packing of the documents by characters in containers of 8,192."""
    packed, _ = packing.pack(_chars(spark, d), "doc_id", "tokens", 8192)
    fill = packed.where("container IS NOT NULL").groupBy("container").agg(F.sum("tokens").alias("n"), F.max("n_pieces").alias("split"))
    whole = fill.agg(F.max("n").alias("fullest"), F.count("*").alias("containers"), F.max("container").alias("last"), F.sum("n").alias("chars"))
    return whole.select((F.col("fullest") <= 8192).alias("within_capacity"), (F.col("last") + 1 == F.col("containers")).alias("numbered"), "chars")


def queries() -> dict:
    return {k: tidy(v) for k, v in globals().items() if k.startswith("p") and k[1].isdigit()}
