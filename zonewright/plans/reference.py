"""Every operator of the library as a query over the test tables, with its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import hashing, lexical, registry
from ..functions import names as nm
from ..operators import balance, dedup, quota, rejects, sampling, space, stats, validate
from ..session import materialize, scratch_path, spread
from ..sinks import files
from ..sources import generators, lists
from ..streaming import store
from .sqlfeatures import catalogue_names, feature_ctes
from .sqllines import line_ctes

_QUERIES: dict[str, Callable] = {}
_SQL: dict[str, str] = {}
#: Digits to which doubles are rounded for comparison.
DIGITS = 9


def query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _r(c) -> F.Column:
    return F.round(c, DIGITS) + 0.0


# SQL of the name policies; the tables they are used on need no IDNA
_STRIP = "trim({0}, '" + nm.BLANKS + "')"
_LABEL = "[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?"
_LIST = "rtrim(lower(" + _STRIP.format("replace({0}, chr(65279), '')") + "), '.')"
_KEY = "nullif(lower(" + _STRIP + "), '')"
_FINAL0 = "rtrim(lower(" + _STRIP + "), '.')"
_FINAL = f"CASE WHEN length({_FINAL0}) <= 253 AND regexp_full_match({_FINAL0}, '{_LABEL}(?:\\.{_LABEL})*') THEN {_FINAL0} END".replace("{0,61}", "{{0,61}}")
_U64 = "('0x' || substr(sha256({0}), 1, 16))::UBIGINT"


def _list_ok(name: str, suffix: str) -> str:
    return f"(length({name}) <= 253 AND regexp_full_match({name}, '(?:{_LABEL}\\.)+{suffix}'))"


# -- names -------------------------------------------------------------------------------------


@query(f"SELECT file_id, line_no, {_LIST.format('raw_line')} AS name FROM raw_lines")
def list_names(spark: SparkSession, d: str) -> DataFrame:
    """Normal form of list lines."""
    return _t(spark, d, "raw_lines").select("file_id", "line_no", nm.list_name("raw_line").alias("name"))


@query(
    f"WITH n AS (SELECT file_id, {_LIST.format('raw_line')} AS x FROM raw_lines) SELECT file_id, count(*) AS n_rows, "
    + ", ".join(f"count(*) FILTER ({_list_ok('x', s)}) AS {k}" for k, s in nm.LIST_SUFFIX.items())
    + " FROM n GROUP BY file_id"
)
def list_strictness(spark: SparkSession, d: str) -> DataFrame:
    """Valid list lines under each of the three strictness policies."""
    n = _t(spark, d, "raw_lines").select("file_id", nm.list_name("raw_line").alias("x"))
    return n.groupBy("file_id").agg(F.count("*").alias("n_rows"), *[F.count_if(nm.list_valid("x", k)).alias(k) for k in nm.LIST_SUFFIX])


@query(f"SELECT sample_id, {_FINAL.format('domain')} AS name FROM sample_records")
def final_names(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "sample_records").select("sample_id", nm.final_name("domain").alias("name"))


@query(
    """WITH n AS (SELECT sample_id, domain, CASE WHEN ends_with(lower(trim(domain)), '.') THEN left(lower(trim(domain)), -1) ELSE lower(trim(domain)) END AS x FROM sample_records)
    SELECT sample_id, x AS normalized, CASE WHEN x = '' THEN 'empty' WHEN length(x) > 253 THEN 'too_long' WHEN contains(x, '..') THEN 'double_dot'
      WHEN NOT contains(x, '.') THEN 'invalid_suffix'
      WHEN len(list_filter(string_split(x, '.'), lambda l: NOT regexp_full_match(l, '[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?'))) > 0 THEN 'label'
      WHEN NOT regexp_full_match(string_split(x, '.')[-1], '[a-z]{2,63}') THEN 'invalid_suffix' END AS reason FROM n"""
)
def strict_names(spark: SparkSession, d: str) -> DataFrame:
    """Normal form and reason of generated names."""
    v = nm.strict_validate("domain")
    reason = F.when(v["reason"].isin("empty_label", "label_too_long", "invalid_character"), "label").otherwise(v["reason"])
    return _t(spark, d, "sample_records").select("sample_id", nm.strict_name("domain").alias("normalized"), reason.alias("reason"))


@query()
def strict_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Attempts by code and reason of refusal, with the check in front of the validation."""
    a = _t(spark, d, "insert_attempts").select(nm.key_form("algorithm_code").alias("code"), F.coalesce(nm.precheck_reason("domain"), nm.strict_reason("domain"), F.lit("valid")).alias("reason"))
    return a.groupBy("code", "reason").agg(F.count("*").alias("n"))


_PLAIN_NAME = f"CASE WHEN ends_with(lower({_STRIP.format('domain')}), '.') THEN left(lower({_STRIP.format('domain')}), -1) ELSE lower({_STRIP.format('domain')}) END"


@query(
    f"""WITH n AS (SELECT {_KEY.format('algorithm_code')} AS code, domain, regexp_replace(lower({_STRIP.format('domain')}), '\\.+$', '') AS p, {_PLAIN_NAME} AS x FROM insert_attempts),
    l AS (SELECT *, list_filter(list_transform(string_split(x, '.'), lambda l: CASE WHEN l = '' THEN 'empty_label' WHEN length(l) > 63 THEN 'label_too_long' WHEN NOT regexp_full_match(l, '[a-z0-9](?:[a-z0-9-]*[a-z0-9])?') THEN 'invalid_character' END), lambda r: r IS NOT NULL) AS bad FROM n)
    SELECT code, CASE WHEN domain IS NULL THEN 'none' WHEN p = '' THEN 'empty' WHEN contains(p, '..') THEN 'double_dot' WHEN starts_with(p, '.') THEN 'empty_label' WHEN x = '' THEN 'empty' WHEN length(x) > 253 THEN 'too_long'
      WHEN contains(x, '..') THEN 'double_dot' WHEN NOT contains(x, '.') THEN 'invalid_suffix' WHEN len(bad) > 0 THEN bad[1] WHEN NOT regexp_full_match(string_split(x, '.')[-1], '[a-z]{{2,63}}') THEN 'invalid_suffix' ELSE 'valid' END AS reason, count(*) AS n FROM l GROUP BY ALL"""
)
def plain_reasons(spark: SparkSession, d: str) -> DataFrame:
    """As ``strict_reasons``, names without IDNA."""
    reason = F.coalesce(nm.precheck_reason("domain"), nm.strict_reason("domain", nm.strict_name("domain", convert=False)), F.lit("valid"))
    return _t(spark, d, "insert_attempts").groupBy(nm.key_form("algorithm_code").alias("code"), reason.alias("reason")).agg(F.count("*").alias("n"))


_PRE = "regexp_replace(lower(" + _STRIP.format("domain") + "), '\\.+$', '')"


@query(
    f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN domain IS NULL THEN 'none' WHEN {_PRE} = '' THEN 'empty' WHEN contains({_PRE}, '..') THEN 'double_dot' "
    f"WHEN starts_with({_PRE}, '.') THEN 'empty_label' END AS reason FROM insert_attempts) GROUP BY reason"
)
def precheck_reasons(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "insert_attempts").groupBy(nm.precheck_reason("domain").alias("reason")).agg(F.count("*").alias("n"))


@query(
    """SELECT sample_id, CASE WHEN contains(domain, '.') THEN string_split(domain, '.')[-1] ELSE '' END AS tld, regexp_replace(lower(domain), '[^a-z0-9]', '', 'g') AS header,
      round(length(regexp_replace(domain, '[^0-9]', '', 'g'))::DOUBLE / length(domain), 9) AS digit_ratio,
      round(-list_sum(list_transform(list_distinct(string_split(domain, '')), lambda x: (length(domain) - length(replace(domain, x, '')))::DOUBLE / length(domain) * log2((length(domain) - length(replace(domain, x, '')))::DOUBLE / length(domain)))), 9) AS entropy
    FROM sample_records"""
)
def name_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Suffix, header form, digit ratio and entropy of names."""
    c = F.col("domain")
    return _t(spark, d, "sample_records").select(
        "sample_id", nm.suffix("domain").alias("tld"), nm.header_form("domain").alias("header"), _r(stats.digit_ratio(c)).alias("digit_ratio"), _r(lexical.entropy(c)).alias("entropy")
    )


@query(
    f"""SELECT sample_id, CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.8::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'test' END AS split, order_hash, int_seed, digest, chunks
    FROM (SELECT sample_id, {_U64.format("'42:' || domain")}::DOUBLE / 18446744073709551615::DOUBLE AS u, sha256('42:' || coalesce(class_value || ':', '') || domain) AS order_hash,
      ('0x' || substr(sha256(domain), 1, 8))::BIGINT AS int_seed, sha256(concat_ws(',', domain, label)) AS digest,
      [substr(md5(domain), 1, 8), substr(md5(domain), 9, 8), substr(md5(domain), 17, 8), substr(md5(domain), 25, 8)] AS chunks FROM sample_records)"""
)
def hash_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Split, order hash, seed, digest and hash pieces of names."""
    return _t(spark, d, "sample_records").select(
        "sample_id", hashing.split_of("domain").alias("split"), hashing.order_hash(42, "class_value", "domain").alias("order_hash"),
        hashing.int_seed(F.col("domain")).alias("int_seed"), hashing.row_digest(F.col("domain"), F.col("label")).alias("digest"), hashing.md5_chunks(F.col("domain")).alias("chunks"),
    )


@query(f"SELECT path, {_U64.format(chr(39) + '7:' + chr(39) + ' || path')}::DECIMAL(20,0) AS file_seed, {_U64.format(chr(39) + '7:' + chr(39) + ' || file_id || ' + chr(39) + ':salt' + chr(39))}::DECIMAL(20,0) AS derived_seed FROM (SELECT DISTINCT file_id, path FROM file_stats)")
def file_seeds(spark: SparkSession, d: str) -> DataFrame:
    """Stable seeds of files."""
    f = _t(spark, d, "file_stats").select("file_id", "path").distinct()
    return f.select("path", hashing.stable_seed(7, F.col("path")).alias("file_seed"), hashing.derived_seed(7, F.col("file_id"), "salt").alias("derived_seed"))


@query(
    f"""WITH x AS (SELECT label, CASE WHEN contains(domain, '.') THEN string_split(domain, '.')[-1] ELSE '' END AS tld, length(domain) AS len,
      length(regexp_replace(domain, '[^0-9]', '', 'g'))::DOUBLE / length(domain) AS dr,
      round(-list_sum(list_transform(list_distinct(string_split(domain, '')), lambda x: (length(domain) - length(replace(domain, x, '')))::DOUBLE / length(domain) * log2((length(domain) - length(replace(domain, x, '')))::DOUBLE / length(domain)))), 9) AS en
      FROM sample_records WHERE domain IS NOT NULL AND label IS NOT NULL),
    b AS (SELECT label, unnest([{{'measure': 'length', 'bucket': len::VARCHAR}}, {{'measure': 'tld', 'bucket': tld}},
      {{'measure': 'digit_ratio', 'bucket': printf('%.1f-%.1f', least(floor(dr * 10), 10) / 10, least((least(floor(dr * 10), 10) + 1) / 10, 1.0))}},
      {{'measure': 'entropy', 'bucket': printf('%.1f-%.1f', least(floor(en / 0.5), 20) * 0.5, least(floor(en / 0.5), 20) * 0.5 + 0.5)}}], recursive := true) FROM x)
    SELECT measure, label, bucket, count(*) AS n FROM b GROUP BY GROUPING SETS ((measure, label, bucket), (measure, bucket))"""
)
def distributions(spark: SparkSession, d: str) -> DataFrame:
    """Histograms of length, TLD, digit ratio and entropy, by label and in all."""
    return stats.distributions(_t(spark, d, "sample_records"), "domain", "label")


@query("SELECT * FROM (SELECT string_split(domain, '.')[-1] AS tld, count(*) AS n FROM sample_records WHERE contains(domain, '.') GROUP BY 1) ORDER BY n DESC, tld LIMIT 10")
def top_suffixes(spark: SparkSession, d: str) -> DataFrame:
    return stats.top_suffixes(_t(spark, d, "sample_records"), "domain")


@query(
    """WITH v AS (SELECT sample_id, unnest(feature_values) AS x FROM sample_records)
    SELECT sample_id, count(*) AS n_values, count(*) FILTER (x IS NULL) AS missing, count(*) FILTER (x IS NOT NULL AND NOT isfinite(x)) AS invalid,
      round(sum(CASE WHEN x IS NULL OR NOT isfinite(x) THEN 0 ELSE x END), 9) AS total FROM v GROUP BY sample_id"""
)
def coerced_features(spark: SparkSession, d: str) -> DataFrame:
    """Missing and non-finite feature values as 0, with counters."""
    v = _t(spark, d, "sample_records").select("sample_id", F.explode("feature_values").alias("x"))
    x = F.col("x")
    bad = x.isNotNull() & (F.isnan(x) | (F.abs(x) == float("inf")))
    return v.groupBy("sample_id").agg(F.count("*").alias("n_values"), F.count_if(x.isNull()).alias("missing"), F.count_if(bad).alias("invalid"), _r(F.sum(registry.finite(x))).alias("total"))


@query("SELECT doc_id, lower(unnest(regexp_extract_all(text, '[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+'))) AS name FROM documents")
def scraped_names(spark: SparkSession, d: str) -> DataFrame:
    """Names that stand in texts."""
    return lists.scraped_names(_t(spark, d, "documents"), "text", "doc_id")


@query(f"SELECT run_id, {_KEY.format('algorithm_code')} AS code, CASE WHEN coalesce(lower(status), '') = '' THEN 'usable' WHEN lower(status) = 'parcial' THEN 'partial' WHEN lower(status) = 'descartado' THEN 'discarded' ELSE lower(status) END AS status FROM algorithm_plan")
def statuses(spark: SparkSession, d: str) -> DataFrame:
    """Statuses in their usual spelling."""
    return _t(spark, d, "algorithm_plan").select("run_id", nm.key_form("algorithm_code").alias("code"), stats.status(F.col("status")).alias("status"))


@query("SELECT attempt_id, array_to_string(list_filter(string_split(domain, '.'), lambda x: x <> ''), '.') AS name, contains(domain, '..') AS double_dot FROM insert_attempts WHERE domain IS NOT NULL")
def sanitized_names(spark: SparkSession, d: str) -> DataFrame:
    """Empty labels collapsed, with a flag."""
    a = _t(spark, d, "insert_attempts").where("domain is not null")
    return a.select("attempt_id", nm.sanitized("domain").alias("name"), F.contains("domain", F.lit("..")).alias("double_dot"))


# -- sources -----------------------------------------------------------------------------------


@query(
    "SELECT file_id, CASE WHEN m = 0 THEN NULL WHEN a = m THEN ',' WHEN b = m THEN chr(9) WHEN c = m THEN ';' ELSE '|' END AS delimiter, m::BIGINT AS score FROM (SELECT *, greatest(a, b, c, e) AS m FROM ("
    + "SELECT file_id, "
    + ", ".join(f"sum(length(raw_line) - length(replace(raw_line, {c}, ''))) AS {n}" for n, c in (("a", "','"), ("b", "chr(9)"), ("c", "';'"), ("e", "'|'")))
    + " FROM raw_lines WHERE line_no <= 30 AND trim(raw_line) <> '' GROUP BY file_id))"
)
def delimiters(spark: SparkSession, d: str) -> DataFrame:
    """Delimiter of each list file by its first lines."""
    return lists.delimiter_scores(_t(spark, d, "raw_lines"))


@query(f"WITH {line_ctes()} SELECT file_id, delim, header_line, columns, column_missing FROM schemas")
def file_schemas(spark: SparkSession, d: str) -> DataFrame:
    """Delimiter, header and width of each list file."""
    return rejects.file_schemas(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config")).select("file_id", "delim", "header_line", "columns", "column_missing")


@query(f"WITH {line_ctes()} SELECT file_id, count(*) AS physical_rows, count(*) - count(DISTINCT header_line) AS raw_rows FROM lines JOIN schemas USING (file_id) GROUP BY file_id")
def raw_counts(spark: SparkSession, d: str) -> DataFrame:
    """Physical rows of each list file, and without its header."""
    lines = _t(spark, d, "raw_lines")
    return lists.raw_counts(lines, rejects.file_schemas(lines, _t(spark, d, "parse_config")))


_OFFERED = f"""{line_ctes()}, offered AS (SELECT file_id, line_no, name, CASE s WHEN 'lenient' THEN {_list_ok('name', nm.LIST_SUFFIX['lenient'])} WHEN 'strict' THEN {_list_ok('name', nm.LIST_SUFFIX['strict'])}
  ELSE {_list_ok('name', nm.LIST_SUFFIX['balanced'])} END AS valid FROM (SELECT file_id, line_no, {_LIST.format('cell')} AS name FROM celled_ WHERE line_kind = 'data' AND (delim IS NULL OR NOT column_missing) AND cell IS NOT NULL)
  LEFT JOIN (SELECT file_id, min(validation_strictness) AS s FROM parse_config GROUP BY file_id) USING (file_id) WHERE name <> '')"""


@query(f"WITH {_OFFERED} SELECT file_id, line_no, name, valid FROM offered")
def list_candidates(spark: SparkSession, d: str) -> DataFrame:
    """Names that the list files offer, valid or not under their strictness."""
    return lists.list_candidates(_t(spark, d, "raw_lines"), _t(spark, d, "parse_config"))


@query(
    f"""WITH {_OFFERED}, r AS (SELECT file_id, count(*) AS attempted, count(DISTINCT name) FILTER (valid) AS accepted, count(*) FILTER (NOT valid) AS rejected, count(*) FILTER (valid) - count(DISTINCT name) FILTER (valid) AS duplicates FROM offered GROUP BY file_id)
    SELECT *, accepted * 100.0::DOUBLE / attempted AS acceptance_rate FROM r"""
)
def list_file_report(spark: SparkSession, d: str) -> DataFrame:
    """Accepted, rejected and repeated names of each list file."""
    return lists.file_report(list_candidates(spark, d))


_BARE = r"regexp_replace(regexp_replace(lower(trim(raw_line)), '^[a-z][a-z0-9+.-]*://', ''), '[/?#:].*$', '')"
_TWO = r"regexp_extract(x, '^(?:www\.)?([a-z0-9-]+)\.([a-z]{2,})$', "


@query(f"SELECT DISTINCT {_TWO}1) AS label, {_TWO}2) AS tld FROM (SELECT {_BARE} AS x FROM raw_lines) WHERE length({_TWO}1)) >= 6")
def base_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labels to build names from: cells of two labels, the first at least six long."""
    return lists.base_labels(_t(spark, d, "raw_lines"), "raw_line", 6)


# -- duplicates, joins, sets -------------------------------------------------------------------


@query(f"SELECT sample_id, domain, class_value FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY sample_id) AS r FROM sample_records WHERE domain IS NOT NULL) WHERE r = 1")
def first_wins(spark: SparkSession, d: str) -> DataFrame:
    """First record of each name, with the class that brought it."""
    return dedup.first_wins(_t(spark, d, "sample_records").select("sample_id", "domain", "class_value"), "domain", "sample_id")


@query(
    f"""WITH s AS (SELECT {_LIST.format('domain')} AS name FROM domains), b AS (SELECT record_id, {_LIST.format('domain')} AS name FROM new_batch)
    SELECT min(record_id) AS record_id, name FROM b WHERE name NOT IN (SELECT name FROM s) GROUP BY name"""
)
def insert_or_ignore(spark: SparkSession, d: str) -> DataFrame:
    """New names that the store would take."""
    keyed = lambda t: _t(spark, d, t).select("record_id", nm.list_name("domain").alias("name"))
    return dedup.insert_or_ignore(keyed("domains"), keyed("new_batch"), "name", "record_id")


@query("SELECT sample_id, domain FROM sample_records WHERE label = 0 AND domain NOT IN (SELECT domain FROM domains WHERE domain IS NOT NULL)")
def without_overlap(spark: SparkSession, d: str) -> DataFrame:
    """Listed samples whose name is not in the store."""
    return dedup.without_overlap(_t(spark, d, "sample_records").where("label = 0").select("sample_id", "domain"), _t(spark, d, "domains"), "domain")


@query("SELECT domain FROM sample_records WHERE domain IS NOT NULL INTERSECT SELECT domain FROM domains")
def overlap(spark: SparkSession, d: str) -> DataFrame:
    return dedup.overlap(_t(spark, d, "sample_records"), _t(spark, d, "domains"), "domain")


@query("SELECT domain FROM new_batch EXCEPT SELECT domain FROM domains")
def names_except(spark: SparkSession, d: str) -> DataFrame:
    return _t(spark, d, "new_batch").select("domain").exceptAll(_t(spark, d, "domains").select("domain")).distinct()


@query(
    f"""SELECT batch_id, count(*) AS n_rows, count(DISTINCT nullif({_LIST.format('domain')}, '')) AS n_keys,
      count(nullif({_LIST.format('domain')}, '')) - count(DISTINCT nullif({_LIST.format('domain')}, '')) AS n_repeats, count(*) - count(nullif({_LIST.format('domain')}, '')) AS n_null FROM insert_attempts GROUP BY batch_id"""
)
def membership(spark: SparkSession, d: str) -> DataFrame:
    """Rows, names and repeats of each batch."""
    name = nm.list_name("domain")
    return dedup.membership_counts(_t(spark, d, "insert_attempts"), F.when(name != "", name), "attempt_id", ["batch_id"])


@query(
    f"""SELECT p.run_id, p.code, p.plans, coalesce(c.n, 0) AS stored FROM (SELECT run_id, {_KEY.format('algorithm_code')} AS code, count(*) AS plans FROM algorithm_plan GROUP BY ALL) p
    LEFT JOIN (SELECT run_id, {_KEY.format('algorithm_code')} AS code, count(*) AS n FROM domains GROUP BY ALL) c ON p.run_id = c.run_id AND p.code = c.code"""
)
def plans_with_counts(spark: SparkSession, d: str) -> DataFrame:
    """Plans beside what the store holds of their run and code."""
    code = nm.key_form("algorithm_code").alias("code")
    plans = _t(spark, d, "algorithm_plan").groupBy("run_id", code).agg(F.count("*").alias("plans"))
    held = _t(spark, d, "domains").groupBy("run_id", code).agg(F.count("*").alias("n"))
    return plans.join(held, ["run_id", "code"], "left").select("run_id", "code", "plans", F.coalesce("n", F.lit(0)).alias("stored"))


@query(
    f"""SELECT coalesce(a.code, b.code) AS code, coalesce(a.n, 0) AS stored, coalesce(b.n, 0) AS sampled FROM
    (SELECT {_KEY.format('algorithm_code')} AS code, count(*) AS n FROM domains GROUP BY 1) a FULL JOIN (SELECT {_KEY.format('class_value')} AS code, count(*) AS n FROM sample_records GROUP BY 1) b ON a.code = b.code"""
)
def codes_of_both(spark: SparkSession, d: str) -> DataFrame:
    """Codes of the store and of the samples, aligned."""
    a = _t(spark, d, "domains").groupBy(nm.key_form("algorithm_code").alias("code")).agg(F.count("*").alias("stored"))
    b = _t(spark, d, "sample_records").groupBy(nm.key_form("class_value").alias("code")).agg(F.count("*").alias("sampled"))
    return a.join(b, "code", "full_outer").select("code", F.coalesce("stored", F.lit(0)).alias("stored"), F.coalesce("sampled", F.lit(0)).alias("sampled"))


# -- quotas and sampling -----------------------------------------------------------------------


_REMAINDER = """t AS (SELECT *, 10000 * w / sum(w) OVER () AS raw_quota FROM f), a AS (SELECT *, floor(raw_quota)::BIGINT AS floor_quota FROM t),
 z AS (SELECT *, row_number() OVER (ORDER BY floor_quota - raw_quota, file_id) AS r, 10000 - sum(floor_quota) OVER () AS rest FROM a)"""


@query(
    f"WITH f AS (SELECT file_id, coalesce(max(raw_rows_seen), 0)::DOUBLE AS w FROM file_stats GROUP BY file_id), {_REMAINDER} "
    "SELECT file_id, round(raw_quota, 9) AS raw_quota, floor_quota, floor_quota + (CASE WHEN r <= rest THEN 1 ELSE 0 END) AS quota FROM z"
)
def file_quotas(spark: SparkSession, d: str) -> DataFrame:
    """10,000 names over the list files by their rows, by largest remainder."""
    f = _t(spark, d, "file_stats").groupBy("file_id").agg(F.max("raw_rows_seen").alias("w"))
    q = quota.largest_remainder(f, "w", 10_000, "file_id")
    return q.select("file_id", _r("raw_quota").alias("raw_quota"), "floor_quota", "quota")


_REDUCED = f"""g AS (SELECT domain, k, count(*) OVER (PARTITION BY k) AS n, count(*) OVER () AS total, row_number() OVER (PARTITION BY k ORDER BY sha256('42:' || k || ':' || domain)) AS place FROM gen),
 c AS (SELECT k, any_value(n)::DOUBLE AS n, TARGET * any_value(n)::DOUBLE / any_value(total) AS e FROM g GROUP BY k),
 z AS (SELECT k, least(floor(e) + (CASE WHEN row_number() OVER (ORDER BY floor(e) - e, k) <= TARGET - sum(floor(e)) OVER () THEN 1 ELSE 0 END), n) AS quota FROM c),
 reduced AS (SELECT g.domain, g.k FROM g JOIN z USING (k) WHERE place <= quota)"""
_GENERATED = f"""gen AS (SELECT domain, k FROM (SELECT {_FINAL.format('domain')} AS domain, {_KEY.format('class_value')} AS k, sample_id FROM sample_records WHERE label = 1)
  WHERE domain IS NOT NULL AND k IS NOT NULL QUALIFY row_number() OVER (PARTITION BY domain ORDER BY sample_id) = 1)"""


@query(f"WITH {_GENERATED}, {_REDUCED.replace('TARGET', '1000')} SELECT domain, k AS class_value FROM reduced")
def reduced_codes(spark: SparkSession, d: str) -> DataFrame:
    """1,000 generated names, each code in proportion, in hash order."""
    gen = balance.generated_names(_t(spark, d, "sample_records").where("label = 1"), "domain", "class_value", "sample_id")
    return quota.reduce_proportionally(materialize(gen.select("domain", "class_value"), "generated"), "class_value", "domain", 1000)


@query("SELECT record_id, domain FROM domains ORDER BY sha256('42:' || record_id) LIMIT 500")
def uniform_sample(spark: SparkSession, d: str) -> DataFrame:
    """A uniform sample of 500 stored names, the same in any order of the rows."""
    rows = _t(spark, d, "domains").select("record_id", "domain")
    return sampling.bottom_k(rows, "record_id", 500)


@query("SELECT file_id, line_no FROM (SELECT file_id, line_no, row_number() OVER (PARTITION BY file_id ORDER BY sha256('42:' || line_no)) AS r FROM raw_lines) WHERE r <= 20")
def sample_by_file(spark: SparkSession, d: str) -> DataFrame:
    """Exactly 20 lines of each file that has them."""
    return sampling.bottom_k(_t(spark, d, "raw_lines").select("file_id", "line_no"), "line_no", 20, group=["file_id"])


@query("SELECT attempt_id FROM insert_attempts ORDER BY attempt_id LIMIT 5000")
def first_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first 5,000 attempts, without sorting them in one task."""
    return sampling.first_n(_t(spark, d, "insert_attempts").select("attempt_id"), "attempt_id", 5000)


@query("SELECT file_id, line_no, (((line_no - 1 - 5) % 104729 + 104729) % 104729 * 41892) % 104729 AS visit FROM raw_lines")
def stride_walk(spark: SparkSession, d: str) -> DataFrame:
    """Order in which a coprime stride visits the lines (start 5, step 2.5 of 104,729): the arithmetic that
    SQL can make too. ``stride_walk_by_file`` has the walk of each file's own length."""
    step = pow(41892, -1, 104729)
    return _t(spark, d, "raw_lines").select("file_id", "line_no", sampling.stride_order(F.col("line_no") - 1, 104729, 5, step).alias("visit"))


@query(
    f"""WITH f AS (SELECT file_id, max(line_no) AS n, {_U64.format("'42:' || file_id")}::HUGEINT AS seed FROM raw_lines GROUP BY file_id),
    s AS (SELECT file_id, n, (seed % n)::BIGINT AS start, CASE WHEN n > 1 THEN (seed // n % (n - 1))::BIGINT ELSE 0 END AS base FROM f),
    w AS (SELECT file_id, n, start, CASE WHEN n > 1 THEN (base + list_filter(range(n - 1), lambda k: gcd((base + k) % (n - 1) + 1, n) = 1)[1]) % (n - 1) + 1 ELSE 1 END AS step FROM s),
    v AS (SELECT file_id, n, start, step, unnest(range(n)) AS visit FROM w)
    SELECT l.file_id, l.line_no, visit FROM raw_lines l JOIN v ON l.file_id = v.file_id AND l.line_no - 1 = (start + visit * step) % n"""
)
def stride_walk_by_file(spark: SparkSession, d: str) -> DataFrame:
    """Order in which each file's own walk, start and step from the seed, visits each of its lines once."""
    lines = _t(spark, d, "raw_lines").select("file_id", "line_no")
    longest = lines.groupBy("file_id").agg(F.max("line_no").alias("n")).collect()  # one row a file
    walks = spark.createDataFrame([sampling.walk_of(r.file_id, r.n, sampling.seed_of(42, str(r.file_id))) for r in longest], sampling.WALKS)
    return lines.join(walks, "file_id").select("file_id", "line_no", sampling.walk_turn(F.col("line_no") - 1).alias("visit"))


@query("SELECT 1000 AS slots, 1000 AS numbered, true AS from_the_pool, true AS by_weight")
def refill_invariants(spark: SparkSession, d: str) -> DataFrame:
    """What holds of any refill: every slot once, rows of the pool only, and sources within five deviations of their weight."""
    pool = materialize(_t(spark, d, "sample_records").where("label = 0").select(nm.key_form("class_value").alias("k"), "domain").where("k is not null").distinct(), "pool")
    drawn = materialize(refilled(spark, d), "drawn")
    stray = drawn.join(pool.select(F.col("k").alias("source"), F.col("domain").alias("name")), ["source", "name"], "left_anti").count()
    shares = pool.groupBy(F.col("k").alias("source")).agg(F.count("*").alias("w")).join(drawn.groupBy("source").agg(F.count("*").alias("n")), "source", "left")
    p = F.col("w") / pool.count()
    off = shares.where(F.abs(F.coalesce("n", F.lit(0)) - 1000 * p) > 5 * F.sqrt(1000 * p * (1 - p)) + 1).count()
    return drawn.agg(F.count("*").cast("int").alias("slots"), F.count_distinct("slot").cast("int").alias("numbered")).select("*", F.lit(stray == 0).alias("from_the_pool"), F.lit(off == 0).alias("by_weight"))


@query()
def refilled(spark: SparkSession, d: str) -> DataFrame:
    """1,000 draws with replacement from the classes, by their size."""
    pool = _t(spark, d, "sample_records").where("label = 0").select(nm.key_form("class_value").alias("k"), "domain").where("k is not null").distinct()
    pool = materialize(pool, "pool")
    return sampling.refill(pool, "k", "domain", pool.groupBy("k").agg(F.count("*").alias("weight")), 1000)


# -- features and the data set -----------------------------------------------------------------


def _rounded(df: DataFrame, names) -> DataFrame:
    return df.select(*[_r(F.col(c)).alias(c) if c in names else F.col(c) for c in df.columns])


@query(f"WITH src AS (SELECT sample_id AS id, domain FROM sample_records), {feature_ctes('src')} SELECT * RENAME (id AS sample_id) FROM featured")
def features54(spark: SparkSession, d: str) -> DataFrame:
    """The 54 default features of every sampled name."""
    rows = spread(_t(spark, d, "sample_records").select("sample_id", "domain"))
    return _rounded(registry.with_features(rows, "domain").drop("domain"), registry.DEFAULT_NAMES)


@query()
def features145(spark: SparkSession, d: str) -> DataFrame:
    """The whole feature catalogue for every stored name."""
    rows = spread(_t(spark, d, "domains").select("record_id", nm.final_name("domain").alias("domain")))
    return registry.with_features(rows, "domain", registry.catalogue())


@query(f"WITH src AS (SELECT sample_id AS id, domain FROM sample_records), {feature_ctes('src', DIGITS, catalogue_names())} SELECT * RENAME (id AS sample_id) FROM featured")
def features_all(spark: SparkSession, d: str) -> DataFrame:
    """The whole feature catalogue for every sampled name."""
    rows = spread(_t(spark, d, "sample_records").select("sample_id", "domain"))
    made = registry.with_features(rows, "domain", registry.catalogue()).drop("domain")
    return made.select("sample_id", *[_r(F.col(c)).alias(c) for c in made.columns[1:]])


@query("SELECT sample_id, (length(regexp_replace(domain, '[^a]', '', 'g')) ** 2)::DOUBLE AS \"A_SQUARED\" FROM sample_records")
def custom_feature(spark: SparkSession, d: str) -> DataFrame:
    """A registered feature of one's own."""
    mine = registry.FeatureSet([registry.Feature("A_SQUARED", lambda p: F.pow(F.length(F.regexp_replace(p["fqdn"], "[^a]", "")), F.lit(2.0)), "Square of the number of a.")])
    return registry.with_features(_t(spark, d, "sample_records").select("sample_id", "domain"), "domain", mine).drop("domain")


def selected(spark: SparkSession, d: str) -> DataFrame:
    """Balanced names of the samples, ``domain, class_value, label``."""
    rows = _t(spark, d, "sample_records").select("sample_id", "domain", "class_value", "label")
    gen = materialize(balance.generated_names(rows.where("label = 1"), "domain", "class_value", "sample_id"), "generated")
    listed = materialize(balance.listed_names(rows.where("label = 0"), "domain", "sample_id", gen), "listed")
    return balance.balanced(gen, listed)


_BALANCED = f"""{_GENERATED}, listed AS (SELECT domain, pos FROM (SELECT {_FINAL.format('domain')} AS domain, min(sample_id) AS pos FROM sample_records WHERE label = 0 GROUP BY 1)
   WHERE domain IS NOT NULL AND domain NOT IN (SELECT domain FROM gen)),
 {_REDUCED.replace('TARGET', '(SELECT least((SELECT count(*) FROM gen), (SELECT count(*) FROM listed)))')},
 chosen AS (SELECT domain, k AS class_value, 1 AS label FROM reduced UNION ALL
   (SELECT domain, CASE WHEN contains(domain, '.') THEN string_split(domain, '.')[-1] ELSE '' END, 0 FROM listed ORDER BY pos LIMIT (SELECT count(*) FROM gen)))"""


@query(f"WITH {_BALANCED} SELECT domain, class_value, label FROM chosen")
def balanced_names(spark: SparkSession, d: str) -> DataFrame:
    """As many generated as listed names, generated ones first in the choice."""
    return selected(spark, d).withColumn("label", F.col("label").cast("int"))


@query(
    f"WITH {_BALANCED}, src AS (SELECT domain AS id, domain FROM chosen), {feature_ctes('src')} "
    f"SELECT domain AS \"DOMAIN\", featured.* EXCLUDE (id), class_value AS \"CLASS\", label AS \"LABEL\", CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.8::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'test' END AS \"SPLIT\" "
    f"FROM (SELECT *, {_U64.format(chr(39) + '42:' + chr(39) + ' || domain')}::DOUBLE / 18446744073709551615::DOUBLE AS u FROM chosen) JOIN featured ON id = domain"
)
def build_dataset(spark: SparkSession, d: str) -> DataFrame:
    """The flagship: balanced names, their 54 features, class, label and split."""
    chosen = spread(materialize(selected(spark, d), "chosen"))
    data = files.final_rows(registry.with_features(chosen, "domain"), registry.DEFAULT)
    return _rounded(data, registry.DEFAULT_NAMES).withColumn("LABEL", F.col("LABEL").cast("int")).withColumn("SPLIT", hashing.split_of("DOMAIN"))


@query()
def build_from_lists(spark: SparkSession, d: str) -> DataFrame:
    """Balanced names of the list files and the insert attempts, through all name policies."""
    gen = materialize(balance.generated_names(_t(spark, d, "insert_attempts"), "domain", "algorithm_code", "attempt_id"), "generated")
    offered = list_candidates(spark, d).where("valid").select((F.col("file_id") * (1 << 32) + F.col("line_no")).alias("pos"), "name")
    listed = materialize(balance.listed_names(offered, "name", "pos", gen), "listed")
    return balance.balanced(gen, listed)


@query(
    f"""WITH g AS (SELECT {_FINAL.format('domain')} AS domain, {_KEY.format('class_value')} AS k FROM sample_records WHERE label = 1), v AS (SELECT domain FROM g WHERE domain IS NOT NULL AND k IS NOT NULL),
    l AS (SELECT sample_id, {_FINAL.format('domain')} AS domain FROM sample_records WHERE label = 0),
    u AS (SELECT domain, min(sample_id) AS pos FROM l WHERE domain IS NOT NULL AND domain NOT IN (SELECT domain FROM v) GROUP BY domain),
    n AS (SELECT count(DISTINCT domain) AS n FROM v), cut AS (SELECT CASE WHEN count(*) >= any_value(n) THEN max(pos) END AS last FROM (SELECT pos, n FROM u, n QUALIFY row_number() OVER (ORDER BY pos) <= n)),
    s AS (SELECT l.* FROM l, cut WHERE last IS NULL OR sample_id <= last)
    SELECT (SELECT count(*) FROM g) AS generated_rows_read, (SELECT count(*) FROM g) - (SELECT count(*) FROM v) AS generated_invalid,
      (SELECT count(*) - count(DISTINCT domain) FROM v) AS generated_duplicates, (SELECT n FROM n) AS generated_unique, count(*) AS listed_rows_read, count(*) FILTER (domain IS NULL) AS listed_invalid,
      count(*) FILTER (domain IN (SELECT domain FROM v)) AS listed_overlap,
      count(*) FILTER (domain IS NOT NULL AND domain NOT IN (SELECT domain FROM v)) - count(DISTINCT domain) FILTER (domain NOT IN (SELECT domain FROM v)) AS listed_duplicates,
      count(DISTINCT domain) FILTER (domain NOT IN (SELECT domain FROM v)) AS listed_unique FROM s"""
)
def selection_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counters of both scans, the listed one up to where its class was full."""
    rows = _t(spark, d, "sample_records")
    return balance.selection_counts(rows.where("label = 1"), rows.where("label = 0"), "domain", "class_value", "sample_id")


@query(
    f"""WITH {_BALANCED}, less AS (SELECT (SELECT count(*) FROM listed) < (SELECT count(*) FROM gen) AS reduced)
    SELECT c.domain, CASE WHEN label = 1 THEN 0 ELSE 1 END AS part, CASE WHEN label = 1 AND reduced THEN class_value END AS code, CASE WHEN label = 1 AND reduced THEN sha256('42:' || class_value || ':' || c.domain) END AS hash,
      CASE WHEN label = 1 AND reduced THEN 0 WHEN label = 1 THEN g.pos ELSE l.pos END AS pos FROM chosen c, less LEFT JOIN listed l ON l.domain = c.domain AND label = 0
      LEFT JOIN (SELECT {_FINAL.format('domain')} AS domain, min(sample_id) AS pos FROM sample_records WHERE label = 1 AND {_KEY.format('class_value')} IS NOT NULL GROUP BY 1) g ON g.domain = c.domain AND label = 1"""
)
def dataset_order(spark: SparkSession, d: str) -> DataFrame:
    """By what the rows of the data set are ordered."""
    rows = _t(spark, d, "sample_records").select("sample_id", "domain", "class_value", "label")
    gen = materialize(balance.generated_names(rows.where("label = 1"), "domain", "class_value", "sample_id"), "generated")
    listed = materialize(balance.listed_names(rows.where("label = 0"), "domain", "sample_id", gen), "listed")
    return balance.balanced(gen, listed, ordered=True).select("domain", *[F.col(c).alias(c[:-1]) for c in balance.ORDER])


@query(f"WITH {_BALANCED} SELECT split, label, count(*) AS n FROM (SELECT label, CASE WHEN u < 0.8::DOUBLE THEN 'train' WHEN u < 0.8::DOUBLE + 0.1::DOUBLE THEN 'validation' ELSE 'test' END AS split FROM (SELECT label, {_U64.format(chr(39) + '42:' + chr(39) + ' || domain')}::DOUBLE / 18446744073709551615::DOUBLE AS u FROM chosen)) GROUP BY ALL")
def split_counts(spark: SparkSession, d: str) -> DataFrame:
    chosen = selected(spark, d)
    return chosen.groupBy(hashing.split_of("domain").alias("split"), F.col("label").cast("int").alias("label")).agg(F.count("*").alias("n"))


@query(
    """WITH n AS (SELECT domain, count(*) FILTER (label = 0) AS a, count(*) FILTER (label = 1) AS b FROM sample_records GROUP BY domain)
    SELECT count(*) AS rows, count(*) FILTER (label = 0) AS listed, count(*) FILTER (label = 1) AS generated, count(*) FILTER (coalesce(label NOT IN (0, 1), true)) AS bad_labels,
      count(*) FILTER ((label = 0 AND class_value IS DISTINCT FROM string_split(domain, '.')[-1]) OR (label = 1 AND coalesce(trim(class_value), '') = '')) AS bad_classes,
      (SELECT count(*) FROM n WHERE a > 0 AND b > 0) AS overlap, (SELECT count(*) FROM n WHERE a + b > 1) AS repeated, count(*) FILTER (label = 0) = count(*) FILTER (label = 1) AS balanced FROM sample_records"""
)
def validation_rollup(spark: SparkSession, d: str) -> DataFrame:
    """What a validator finds in the raw samples."""
    rows = _t(spark, d, "sample_records").select(F.col("domain").alias("DOMAIN"), F.col("class_value").alias("CLASS"), F.col("label").alias("LABEL"))
    return validate.rollup(rows)


# -- statistics of generation ------------------------------------------------------------------


@query(
    """WITH v AS (SELECT run_id, algorithm_code, updated_at, h, unnest(batch_yield_history) AS x, unnest(range(len(batch_yield_history))) AS step FROM (SELECT run_id, algorithm_code, updated_at, row_number() OVER (ORDER BY run_id, algorithm_code, updated_at, generated_count) AS h, batch_yield_history FROM (SELECT DISTINCT run_id, algorithm_code, updated_at, generated_count, batch_yield_history FROM algorithm_plan)))
    SELECT run_id, algorithm_code, updated_at, step, x AS yield_now, round(sum(x) OVER w, 9) AS yield_sum, round(avg(x) OVER w, 9) AS yield_mean, round(median(x) OVER w, 9) AS yield_median
    FROM v WHERE x IS NOT NULL AND NOT isnan(x) WINDOW w AS (PARTITION BY h ORDER BY step ROWS BETWEEN 7 PRECEDING AND CURRENT ROW)"""
)
def rolling_yields(spark: SparkSession, d: str) -> DataFrame:
    """Sum, mean and median yield over the last eight batches of each plan."""
    keys = ["run_id", "algorithm_code", "updated_at", "generated_count"]
    rows = _t(spark, d, "algorithm_plan").select(*keys, "batch_yield_history").distinct().withColumn("h", F.xxhash64("batch_yield_history"))
    y = stats.rolling_yields(rows, [*keys, "h"], "batch_yield_history").drop("generated_count", "h")
    return y.withColumns({c: _r(c) for c in ("yield_sum", "yield_mean", "yield_median")})


@query(
    """WITH p AS (SELECT *, row_number() OVER (ORDER BY run_id, algorithm_code, updated_at) AS id FROM (SELECT DISTINCT run_id, algorithm_code, updated_at, batch_yield_history AS h FROM algorithm_plan)),
    v AS (SELECT id, run_id, algorithm_code, updated_at, unnest(h) AS x, unnest(range(len(h))) AS step FROM p), l AS (SELECT *, coalesce(x < 0.3 AND NOT isnan(x), false) AS low FROM v),
    i AS (SELECT *, sum(CASE WHEN low THEN 0 ELSE 1 END) OVER (PARTITION BY id ORDER BY step) AS island, max(step) OVER (PARTITION BY id) AS last FROM l),
    r AS (SELECT id, run_id, algorithm_code, updated_at, island, count(*) FILTER (low) AS n, max(step) = max(last) AS open FROM i GROUP BY ALL)
    SELECT run_id, algorithm_code, updated_at, max(n) AS longest_low, max(CASE WHEN open THEN n ELSE 0 END) AS current_low FROM r GROUP BY id, run_id, algorithm_code, updated_at"""
)
def low_streaks(spark: SparkSession, d: str) -> DataFrame:
    """Longest and current run of low yields of each plan."""
    keys = ["run_id", "algorithm_code", "updated_at", "h"]
    rows = _t(spark, d, "algorithm_plan").withColumn("h", F.xxhash64("batch_yield_history")).select(*keys, "batch_yield_history").distinct()
    return stats.streaks(rows, keys, "batch_yield_history", 0.3).drop("h")


@query(
    f"""WITH k AS (SELECT attempt_id, nullif({_LIST.format('domain')}, '') AS x FROM insert_attempts), f AS (SELECT min(attempt_id) AS attempt_id FROM k WHERE x IS NOT NULL GROUP BY x),
    s AS (SELECT ceil(attempt_id / 5000)::BIGINT AS b, count(*) AS n FROM k GROUP BY 1), u AS (SELECT ceil(attempt_id / 5000)::BIGINT AS b, count(*) AS u FROM f GROUP BY 1)
    SELECT b * 5000 AS checkpoint, sum(n) OVER (ORDER BY b)::BIGINT AS rows_seen, sum(coalesce(u, 0)) OVER (ORDER BY b)::BIGINT AS unique_seen, round(coalesce(u, 0) / n, 9) AS marginal_yield FROM s LEFT JOIN u USING (b)"""
)
def collision_curve(spark: SparkSession, d: str) -> DataFrame:
    """How fast new names run out over the attempts."""
    name = nm.list_name("domain")
    rows = _t(spark, d, "insert_attempts").select("attempt_id", F.when(name != "", name).alias("name"))
    return stats.collision_curve(rows, "name", "attempt_id", 5000).withColumn("marginal_yield", _r("marginal_yield"))


@query(
    f"""WITH x AS (SELECT {_KEY.format('class_value')} AS code, domain FROM sample_records WHERE domain IS NOT NULL), ch AS (SELECT code, i AS pos, substr(domain, i, 1) AS ch, count(*) AS n FROM (SELECT code, domain, unnest(range(1, length(domain) + 1)) AS i FROM x) GROUP BY ALL),
    p AS (SELECT code, pos, count(*) AS k FROM ch GROUP BY ALL), s AS (SELECT code, count(*) AS positions, count(*) FILTER (k > 1) AS variable_positions, round(sum(log10(k)), 9) AS log10_capacity FROM p GROUP BY code),
    e AS (SELECT code, round(log2(sum(n)) - sum(n * log2(n)) / sum(n), 9) AS pooled_entropy FROM (SELECT code, ch, sum(n)::DOUBLE AS n FROM ch GROUP BY ALL) GROUP BY code), t AS (SELECT code, count(*) AS n_texts FROM x GROUP BY code)
    SELECT t.code, n_texts, positions, variable_positions, log10_capacity, pooled_entropy FROM t JOIN s ON t.code IS NOT DISTINCT FROM s.code JOIN e ON t.code IS NOT DISTINCT FROM e.code WHERE t.code IS NOT NULL"""
)
def name_structure(spark: SparkSession, d: str) -> DataFrame:
    """Structural variability of the names of each class."""
    rows = _t(spark, d, "sample_records").select(nm.key_form("class_value").alias("code"), "domain").where("code is not null")
    return stats.structure(rows, "code", "domain").withColumns({c: _r(c) for c in ("log10_capacity", "pooled_entropy")})


@query(
    f"""SELECT code, reverse(left(a, list_max(list_filter(range(0, least(length(a), length(b)) + 1), lambda i: left(a, i) = left(b, i))))) AS common_suffix
    FROM (SELECT {_KEY.format('class_value')} AS code, min(reverse(domain)) AS a, max(reverse(domain)) AS b FROM sample_records GROUP BY 1)"""
)
def common_suffixes(spark: SparkSession, d: str) -> DataFrame:
    """Longest common suffix of the names of each class."""
    return stats.common_suffix(_t(spark, d, "sample_records").select(nm.key_form("class_value").alias("code"), "domain"), "code", "domain")


@query("SELECT run_id, e.key AS reason, sum(e.value)::BIGINT AS n FROM (SELECT run_id, unnest(map_entries(invalid_reason_counts)) AS e FROM algorithm_plan) GROUP BY ALL")
def merged_reasons(spark: SparkSession, d: str) -> DataFrame:
    """Reason counts of all plans of a run added up."""
    return stats.merged_counts(_t(spark, d, "algorithm_plan"), "run_id", "invalid_reason_counts")


@query(
    f"""SELECT {_KEY.format('category')} AS category, sum(unique_valid_count)::BIGINT AS uniques, round(sum(unique_valid_count) / nullif(sum(generated_count), 0), 9) AS unique_ratio,
    round((sum(generated_count) - sum(invalid_count)) / nullif(sum(generated_count), 0), 9) AS valid_ratio FROM algorithm_plan GROUP BY 1"""
)
def category_ratios(spark: SparkSession, d: str) -> DataFrame:
    """Unique names and ratios of each category."""
    g = _t(spark, d, "algorithm_plan").groupBy(nm.key_form("category").alias("category")).agg(F.sum("unique_valid_count").alias("uniques"), F.sum("generated_count").alias("g"), F.sum("invalid_count").alias("i"))
    return g.select("category", "uniques", _r(F.try_divide("uniques", "g")).alias("unique_ratio"), _r(F.try_divide(F.col("g") - F.col("i"), F.col("g"))).alias("valid_ratio"))


# -- parameter spaces --------------------------------------------------------------------------


@query(
    f"""SELECT slot, slot + 100 AS incremental, ('0x' || substr(sha256('code:' || slot), 1, 8))::BIGINT AS hashed, (DATE '2024-01-31' + slot::INT)::DATE AS daily, (DATE '2024-01-31' + (slot % 31)::INT)::DATE AS daily_window,
    (date_trunc('month', DATE '2024-01-31') + to_months((slot % 24)::INT))::DATE AS monthly, least(DATE '2024-06-30', (DATE '2024-01-31' + slot::INT))::DATE AS clamped,
    (DATE '2024-01-01' + ((date_diff('day', DATE '2024-01-01', DATE '2024-01-31' + slot::INT)) % 182)::INT)::DATE AS wrapped, (slot // 12) % 5 AS digit0, (slot // 4) % 3 AS digit1, slot % 4 AS digit2, (slot * 7 + 3) % 1000 AS strided
    FROM (SELECT unnest(range(1000)) AS slot)"""
)
def parameter_space(spark: SparkSession, d: str) -> DataFrame:
    """Seeds, dates and mixed-radix digits of 1,000 requests."""
    s = F.col("slot")
    lo, hi = space.date_bounds("2024-01-01", "2024-06-30", "2024-01-31")
    day = space.date_axis(s, "daily_forward", "2024-01-31")
    digits = space.mixed_radix(s, {"digit0": 5, "digit1": 3, "digit2": 4})
    return space.slots(spark, 1000).select(
        "slot", space.seed_axis(s, "incremental", 100).alias("incremental"), space.seed_axis(s, "hashed_round_robin", code="code").alias("hashed"), day.alias("daily"),
        space.date_axis(s, "daily_window", "2024-01-31").alias("daily_window"), space.date_axis(s, "monthly_window", "2024-01-31").alias("monthly"),
        space.bounded(day, lo, hi, "clamp").alias("clamped"), space.bounded(day, lo, hi, "wrap").alias("wrapped"), *[c.alias(n) for n, c in digits.items()], space.strided(s, 1000, 7, 3).alias("strided"),
    )


_H = "('0x' || substr(sha256('42:' || label || ':{0}'), 1, 16))::UBIGINT::HUGEINT"
_CHANGED = "left({0}, ({1} % length(label))::INT) || substr('abcdefghijklmnopqrstuvwxyz', ({1} // 256 % 26)::INT + 1, 1) || substr({0}, ({1} % length(label))::INT + 2)"


@query(
    f"""WITH b AS (SELECT DISTINCT {_TWO}1) AS label FROM (SELECT {_BARE} AS x FROM raw_lines) WHERE length({_TWO}1)) >= 6), c AS (SELECT label, {_CHANGED.format('label', _H.format('change0'))} AS one FROM b)
    SELECT label, label AS slot, {_CHANGED.format('one', _H.format('change1'))} || '.' || ['comx', 'netzo', 'orgo'][({_H.format('suffix')} % 3)::INT + 1] AS domain FROM c"""
)
def mutated_names(spark: SparkSession, d: str) -> DataFrame:
    """Listed labels with two letters changed, one a label."""
    base = lists.base_labels(_t(spark, d, "raw_lines"), "raw_line", 6).select("label").distinct().withColumn("slot", F.col("label"))
    return space.mutated(base, "label", "slot", ["comx", "netzo", "orgo"])


@query(
    "SELECT o_orderkey AS slot, tld_chunk AS domain FROM (SELECT o_orderkey, c || '.' || t AS tld_chunk FROM (SELECT o_orderkey, unnest([substr(h, 1, 8), substr(h, 9, 8), substr(h, 17, 8), substr(h, 25, 8)]) AS c FROM (SELECT o_orderkey, md5(o_orderkey::VARCHAR) AS h FROM orders)), (SELECT unnest(['comx', 'netzo']) AS t))"
)
def hash_chunk_names(spark: SparkSession, d: str) -> DataFrame:
    """Names from the pieces of hashes under every suffix."""
    rows = _t(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("text"))
    return space.hash_chunks(rows, "text", ["comx", "netzo"]).select(F.col("text").cast("bigint").alias("slot"), "domain")


@query("SELECT o_orderkey, make_date(year(m), month(m), least(day(o_orderdate), 28)) AS month_later, strftime(o_orderdate, '%Y-%m-%d') AS iso FROM (SELECT o_orderkey, o_orderdate, date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS m FROM orders)")
def month_arithmetic(spark: SparkSession, d: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    return _t(spark, d, "orders").select("o_orderkey", space.clamped_month(day, 1).alias("month_later"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("iso"))


@query(
    """SELECT s AS slot, s AS seed, CASE WHEN s & 4294967295 = 0 THEN 1 ELSE s & 4294967295 END AS magic, (DATE '2024-01-01' + s::INT)::DATE AS "when", year(DATE '2024-01-01' + s::INT)::INT AS year, month(DATE '2024-01-01' + s::INT)::INT AS month,
    s AS nr, s % 3 + 1 AS config_nr, 'v' || (s % 7 + 1) AS version, CASE WHEN s % 2 = 0 THEN 'sn' ELSE 'al' END AS prefix, ['com', 'net', 'org', 'biz', 'info', 'ru'] AS tlds, 'example' || (s % 1000) || '.com' AS domain, md5(s::VARCHAR) AS md5, s % 8 + 16 AS loops, 1 AS other
    FROM (SELECT unnest(range(2000)) AS s)"""
)
def bound_parameters(spark: SparkSession, d: str) -> DataFrame:
    """What parameters of generators are given by their names, at 2,000 requests."""
    names = ("seed", "magic", "when", "year", "month", "nr", "config_nr", "version", "prefix", "tlds", "domain", "md5", "loops", "other")
    return space.slots(spark, 2000).select("slot", *[generators.bound(n, F.col("slot"), "code").alias(n) for n in names])


# -- sinks and streams -------------------------------------------------------------------------


_SAMPLES = "SELECT domain AS \"DOMAIN\", feature_values[1] AS \"F1\", class_value AS \"CLASS\", label AS \"LABEL\" FROM sample_records WHERE label IS NOT NULL AND class_value IS NOT NULL"


def _samples(spark: SparkSession, d: str) -> DataFrame:
    rows = _t(spark, d, "sample_records").where("label is not null and class_value is not null")
    return rows.select(F.col("domain").alias("DOMAIN"), F.col("feature_values")[0].alias("F1"), F.col("class_value").alias("CLASS"), F.col("label").alias("LABEL"))


@query(_SAMPLES)
def parquet_parts(spark: SparkSession, d: str) -> DataFrame:
    """Written in parts by size and read back."""
    path = scratch_path(spark, "parts")
    files.write_parts(_samples(spark, d), path, 100_000)
    return spark.read.parquet(path)


@query("SELECT sample_id, floor((sum(size) OVER (ORDER BY sample_id) - size) / 100000)::INT AS part FROM (SELECT sample_id, greatest(128, length(domain) + 8 * 4 + 64) AS size FROM sample_records)")
def part_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Which part of 100 kB by estimate each sample belongs to."""
    return files.part_numbers(_t(spark, d, "sample_records").select("sample_id", "domain", "class_value", "label"), "sample_id", "domain", 100_000).select("sample_id", "part")


@query("SELECT domain AS \"DOMAIN\", label AS \"LABEL\" FROM sample_records WHERE label = 1 AND class_value IS NOT NULL")
def split_directories(spark: SparkSession, d: str) -> DataFrame:
    """One directory a label; reading one prunes the others."""
    path = scratch_path(spark, "splits")
    files.write_splits(_samples(spark, d), path, "LABEL")
    return spark.read.parquet(path).where("LABEL = 1").select("DOMAIN", "LABEL")


@query("SELECT domain, algorithm_code FROM domains")
def csv_export(spark: SparkSession, d: str) -> DataFrame:
    """Store exported to CSV in insertion order and read back."""
    path = scratch_path(spark, "export")
    files.write_csv(_t(spark, d, "domains").select("record_id", "domain", "algorithm_code"), path, "record_id", null_text="\\N")
    return spark.read.options(header=True, nullValue="\\N").schema("domain string, algorithm_code string").csv(path)


@query("SELECT '''' || replace(replace(domain, '\\', '\\\\'), '''', '\\''') || ''',' || (CASE WHEN x IS NULL OR NOT isfinite(x) THEN '?' ELSE x::VARCHAR END) || ',''' || replace(replace(replace(class_value, '\\', '\\\\'), '''', '\\'''), chr(9), ' ') || ''',' || label AS value FROM (SELECT domain, round(feature_values[1]) AS x, class_value, label FROM sample_records) WHERE label IS NOT NULL AND class_value IS NOT NULL")
def arff_rows(spark: SparkSession, d: str) -> DataFrame:
    """ARFF lines of the samples."""
    return files.arff_rows(_samples(spark, d).withColumn("F1", F.round("F1")), ["F1"])


@query("SELECT domain, label, CASE WHEN label = 1 THEN 'a' ELSE 'b' END AS split, sha256(concat_ws(',', domain, label, CASE WHEN label = 1 THEN 'a' ELSE 'b' END)) AS sha256 FROM sample_records WHERE label IS NOT NULL AND class_value IS NOT NULL")
def integrity(spark: SparkSession, d: str) -> DataFrame:
    """Integrity hash of each row."""
    return files.integrity_rows(_samples(spark, d), F.when(F.col("LABEL") == 1, "a").otherwise("b"))


@query(
    f"""SELECT name AS domain, algorithm_code, seq FROM (SELECT {_LIST.format('domain')} AS name, algorithm_code, attempt_id AS seq, row_number() OVER (PARTITION BY {_LIST.format('domain')} ORDER BY attempt_id) AS r
    FROM insert_attempts) WHERE r = 1 AND name <> ''"""
)
def streamed_list_store(spark: SparkSession, d: str) -> DataFrame:
    """As ``streamed_store``, names in the form of list files."""
    rows, base = _t(spark, d, "insert_attempts"), scratch_path(spark, "stream")
    form = lambda c: F.when(nm.list_name(c) != "", nm.list_name(c))
    return store.insert_stream(spark, f"{d}/insert_attempts.parque[t]", rows.schema, f"{base}/store", f"{base}/checkpoint", "domain", "algorithm_code", "attempt_id", normal=form).select("domain", "algorithm_code", "seq")


@query()
def streamed_store(spark: SparkSession, d: str) -> DataFrame:
    """Attempts run through the store as a stream of micro-batches."""
    rows = _t(spark, d, "insert_attempts")
    base = scratch_path(spark, "stream")
    return store.insert_stream(spark, f"{d}/insert_attempts.parque[t]", rows.schema, f"{base}/store", f"{base}/checkpoint", "domain", "algorithm_code", "attempt_id").select("domain", "algorithm_code", "seq")


@query("SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type AS kind, count(*) AS n FROM events GROUP BY ALL")
def windowed_events(spark: SparkSession, d: str) -> DataFrame:
    """Events of each day and kind."""
    return store.windowed_counts(_t(spark, d, "events"), "ts", "event_type")


def queries() -> dict:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
