"""The general data problems as queries over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import BLANKS, key_form
from ..operators import combine, rejects
from .sqllines import line_ctes, told_cte


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Codes and classes that hold at least 4 percent of their table."""
    codes = combine.heavy_keys(_t(spark, d, "domains"), "algorithm_code")
    classes = combine.heavy_keys(_t(spark, d, "sample_records"), "class_value")
    return codes.unionByName(classes).select("field", "key_value")


def p2_code_stats(spark: SparkSession, d: str) -> DataFrame:
    """Store statistics of every code."""
    return combine.combine_by_key(
        _t(spark, d, "domains"), key_form("algorithm_code"),
        {
            "n_rows": F.count("*"), "first_run": F.min("run_id"), "last_run": F.max("run_id"),
            "first_created": F.min("created_at"), "last_created": F.max("created_at"),
            "name_chars": F.sum(F.length("domain")),
        },
    )


def p2_class_stats(spark: SparkSession, d: str) -> DataFrame:
    """Sample statistics of every class; NaN and infinite features are counted, not summed."""
    x = F.col("feature_values")[0]
    finite = x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return combine.combine_by_key(
        _t(spark, d, "sample_records"), key_form("class_value"),
        {
            "n_rows": F.count("*"), "n_generated": F.count_if(F.col("label") == 1), "n_unlabelled": F.count_if(F.col("label").isNull()),
            "n_finite": F.count_if(finite), "sum_first": F.round(F.sum(F.when(finite, x)), 4),
        },
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """List-file lines that fail, with their reason."""
    return rejects.rejected_lines(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config")).select("file_id", "line_no", "reason")


def p4_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Failing lines with the first field that breaks the pattern of their file."""
    return rejects.rejected_lines(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config"))


def p4_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Names of the list-file lines that load."""
    return rejects.loaded_lines(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config"))


def _line_kinds(lines: DataFrame) -> DataFrame:
    return lines.groupBy("file_id").agg(
        F.count("*").alias("raw_rows"), F.count_if(F.col("kind") == "valid").alias("valid_rows"),
        F.count_if(F.col("kind") == "invalid").alias("invalid_rows"), F.count_if(F.col("kind") == "blank").alias("blank_rows"),
    )


def p4_file_report(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each kind in every list file."""
    return _line_kinds(rejects.classify_lines(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config")))


# The same without IDNA, which SQL does not have: names other than ASCII hold invalid characters then.


def p4_plain_rejects(spark: SparkSession, d: str) -> DataFrame:
    """Failing lines with their reason, and the first broken field unless its quoting is what is broken."""
    rows = rejects.rejected_lines(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config"), convert=False)
    return rows.withColumn("broken_field", F.when(F.col("reason") != "broken_quoting", F.col("broken_field")))


def p4_plain_loaded(spark: SparkSession, d: str) -> DataFrame:
    """Names of the list-file lines that load."""
    return rejects.loaded_lines(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config"), convert=False)


def p4_plain_file_report(spark: SparkSession, d: str) -> DataFrame:
    """Lines of each kind in every list file."""
    return _line_kinds(rejects.classify_lines(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config"), convert=False))


_KEY = "nullif(lower(regexp_replace({0}, '^[\\s\\p{{Z}}]+|[\\s\\p{{Z}}]+$', '', 'g')), '')"


def _heavy_sql(table: str, field: str) -> str:
    return (
        f"SELECT '{field}' AS field, k AS key_value FROM (SELECT {_KEY.format(field)} AS k, count(*) AS n FROM {table} GROUP BY 1) "
        f"WHERE k IS NOT NULL AND n * 100 >= (SELECT count(*) FROM {table}) * 4"
    )


def queries() -> dict:
    return {k: v for k, v in globals().items() if k.startswith("p") and k[1].isdigit()}


_STRIPPED = f"lower(trim({{0}}, '{BLANKS}'))"
_PLAIN = f"CASE WHEN ends_with({_STRIPPED}, '.') THEN left({_STRIPPED}, -1) ELSE {_STRIPPED} END"
_TOLD = f"WITH {line_ctes()}, {told_cte(_PLAIN)}"


def oracle_sql() -> dict[str, str]:
    return {
        "p4_plain_rejects": f"""{_TOLD} SELECT file_id, line_no, reason, CASE WHEN row_reason IS NULL THEN name_index + 1 WHEN row_reason = 'column_count' THEN least(len(fields), columns + 1) END::INT AS broken_field
            FROM told WHERE reason IS NOT NULL""",
        "p4_plain_loaded": f"{_TOLD} SELECT file_id, line_no, x AS name FROM told WHERE line_kind = 'data' AND reason IS NULL",
        "p4_plain_file_report": f"""{_TOLD} SELECT file_id, count(*) AS raw_rows, count(*) FILTER (line_kind = 'data' AND reason IS NULL) AS valid_rows,
            count(*) FILTER (reason IS NOT NULL) AS invalid_rows, count(*) FILTER (line_kind = 'blank') AS blank_rows FROM told GROUP BY file_id""",
        "p2_found": _heavy_sql("domains", "algorithm_code") + " UNION ALL " + _heavy_sql("sample_records", "class_value"),
        "p2_code_stats": f"""
            SELECT {_KEY.format("algorithm_code")} AS key_value, count(*) AS n_rows, min(run_id) AS first_run, max(run_id) AS last_run,
                   min(created_at) AS first_created, max(created_at) AS last_created, sum(length(domain))::BIGINT AS name_chars
            FROM domains GROUP BY 1""",
        "p2_class_stats": f"""
            SELECT {_KEY.format("class_value")} AS key_value, count(*) AS n_rows, count(*) FILTER (label = 1) AS n_generated,
                   count(*) FILTER (label IS NULL) AS n_unlabelled, count(*) FILTER (isfinite(feature_values[1])) AS n_finite,
                   round(sum(feature_values[1]) FILTER (isfinite(feature_values[1])), 4) AS sum_first
            FROM sample_records GROUP BY 1""",
    }
