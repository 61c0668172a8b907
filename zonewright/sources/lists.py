"""Reading directories of list files, plain or delimited, into lines with an explicit order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import storage
from ..functions.names import header_form, list_name, list_valid
from ..operators import rejects
from ..session import materialize

# Kinds of list files, spellings of the code column.
SUFFIXES = (".txt", ".csv")
CODE_COLUMNS = ("algorithmcode", "algorithcode", "algorithm", "algorithmname", "algocode", "dgafamily")


def discover(spark: SparkSession, directory: str) -> list[str]:
    """Sorted paths of the visible list files of a directory, not below it; none is an error."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(directory)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for s in fs.listStatus(where) if fs.exists(where) else []:
        name = s.getPath().getName()
        if s.isFile() and not name.startswith(".") and name.lower().endswith(SUFFIXES):
            found.append(s.getPath().toString())
    if not found:
        raise FileNotFoundError(f"no list files in {directory}")
    return sorted(found)


def resolve_input(spark: SparkSession, path: str) -> str:
    """The path, or that with its name in the singular or plural instead, if only that is there."""
    folder, _, name = path.rpartition("/")
    stem, dot, kind = name.rpartition(".") if "." in name else (name, "", "")
    other = f"{stem.removesuffix('s') if stem.endswith('s') else stem + 's'}{dot}{kind}"
    for candidate in (path, f"{folder}/{other}" if folder else other):
        if storage.exists(spark, candidate):
            return candidate
    raise FileNotFoundError(f"no input {path}")


def files_of(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the visible files of a folder by name."""
    if storage.is_file(spark, path):
        return [path]
    return [storage.join(path, n) for n in storage.names_in(spark, path) if n[0] not in "._"]


def in_file_order(raw: DataFrame, by_file: bool = False) -> DataFrame:
    """Rows just read from files, with ``path`` and ``pos``: their place from 0 in all files by path, or
    in their own file.

    A file is read in blocks by many tasks, a block's rows in a row. So a row's place is that of its block, from the
    rows counted in front of it, and its distance from the block's first row. The window holds one row a block.
    """
    marked = raw.select("*", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block_"), F.monotonically_increasing_id().alias("seq_"))
    blocks = marked.groupBy("path", "block_").agg(F.min("seq_").alias("first_"), F.count("*").alias("n_"))
    over = Window.partitionBy("path").orderBy("block_") if by_file else Window.partitionBy(F.lit(0)).orderBy("path", "block_")
    before = F.coalesce(F.sum("n_").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # written, so that its size is known: while it is below Spark's threshold it is broadcast, and the rows stay where they are
    starts = materialize(blocks.select("path", "block_", (before - F.col("first_")).alias("start_")), "blocks")
    return marked.join(starts, ["path", "block_"]).select(*raw.columns, "path", (F.col("start_") + F.col("seq_")).alias("pos"))


def read_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``file_id, path, line_no, raw_line`` of the files, in the order of ``paths`` from 0."""
    raw = in_file_order(spark.read.text(paths), by_file=True)
    ids = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "file_id bigint, wanted string")
    tail = lambda c: F.regexp_replace(F.url_decode(F.regexp_replace(c, "[+]", "%2B")), "^file:/+", "/")
    named = raw.join(ids, tail(F.col("path")) == tail(F.regexp_replace("wanted", "%", "%25")))
    return named.select("file_id", F.col("wanted").alias("path"), (F.col("pos") + 1).alias("line_no"), F.col("value").alias("raw_line"))


def raw_counts(lines: DataFrame, schemas: DataFrame) -> DataFrame:
    """``file_id, physical_rows, raw_rows``: rows of each file, blank ones too, without the header."""
    counts = lines.groupBy("file_id").agg(F.count("*").alias("physical_rows"))
    return counts.join(schemas.select("file_id", "header_line"), "file_id", "left").select(
        "file_id", "physical_rows", (F.col("physical_rows") - F.col("header_line").isNotNull().cast("int")).alias("raw_rows")
    )


def delimiter_scores(lines: DataFrame) -> DataFrame:
    """``file_id, delimiter, score``: each file's delimiter, null if none of them occurs."""
    sample = lines.where(F.col("line_no") <= rejects.SNIFF_LINES)
    scores = [F.sum(F.length("raw_line") - F.length(F.replace("raw_line", F.lit(d), F.lit("")))).alias(f"n{i}") for i, d in enumerate(rejects.DELIMITERS)]
    counted = sample.where(F.trim("raw_line") != "").groupBy("file_id").agg(*scores)
    best = F.greatest(*[F.col(f"n{i}") for i in range(len(rejects.DELIMITERS))])
    pick = F.coalesce(*[F.when((F.col(f"n{i}") == best) & (best > 0), F.lit(d)) for i, d in enumerate(rejects.DELIMITERS)])
    return counted.select("file_id", pick.alias("delimiter"), best.alias("score"))


def list_candidates(lines: DataFrame, config: DataFrame) -> DataFrame:
    """``file_id, line_no, name, valid``: normalised names of the list files, valid or not under
    the file's own strictness. Blank, header and unreadable lines and empty names give no row."""
    cells = rejects.cells(lines, config)
    strict = config.groupBy("file_id").agg(F.min("validation_strictness").alias("strictness"))
    named = cells.withColumn("name", list_name("cell")).where("name <> ''").join(strict, "file_id", "left")
    return named.select("file_id", "line_no", "name", list_valid("name", F.col("strictness")).alias("valid"))


def file_report(candidates: DataFrame) -> DataFrame:
    """``file_id, attempted, accepted, rejected, duplicates, acceptance_rate`` (percent, 0 without
    attempts); repeats within a file are duplicates."""
    per_name = candidates.groupBy("file_id", "name", "valid").agg(F.count("*").alias("n"))
    out = per_name.groupBy("file_id").agg(
        F.sum("n").alias("attempted"), F.count_if("valid").alias("accepted"),
        F.coalesce(F.sum(F.when(~F.col("valid"), F.col("n"))), F.lit(0)).alias("rejected"),
        F.coalesce(F.sum(F.when(F.col("valid"), F.col("n") - 1)), F.lit(0)).alias("duplicates"),
    )
    return out.withColumn("acceptance_rate", F.coalesce(F.try_divide(F.col("accepted") * 100.0, F.col("attempted")), F.lit(0.0)))


def name_column(columns: list[str]) -> str | None:
    """The header cell that names the domain."""
    return next((c for c in columns if "".join(filter(str.isalnum, c.lower())) == "domain"), None)


def code_column(columns: list[str]) -> str | None:
    """The header cell that names the generator, in any of its spellings."""
    return next((c for c in columns if "".join(filter(str.isalnum, c.lower())) in CODE_COLUMNS), None)


def read_pairs(spark: SparkSession, path: str, code: bool) -> DataFrame:
    """``pos, domain[, code]`` of a CSV of names, one file or a folder of them, with or without header; ``pos`` goes
    through the files by name. Header-like rows of a file without header are skipped wherever they stand."""
    plain = spark.read.option("header", False).option("encoding", "UTF-8").csv(path)
    raw, cols = in_file_order(plain), plain.columns
    first = raw.orderBy("pos").limit(1).collect()
    head = [str(first[0][c] or "") for c in cols] if first else []
    named, coded = name_column(head), code_column(head)
    if named is not None and (not code or coded is not None):
        d, k = cols[head.index(named)], cols[head.index(coded)] if code else None
    else:
        if code and len(cols) < 2:
            raise ValueError("a file of generated names needs a name and a code column")
        d, k = cols[0], cols[1] if code else None
    rows = raw.where(F.coalesce(header_form(d), F.lit("")) != "domain")
    return rows.select("pos", F.col(d).alias("domain"), *([F.col(k).alias("code")] if code else []))


def base_labels(rows: DataFrame, cell: str, least: int = 1) -> DataFrame:
    """``label, tld`` of cells that hold a name or URL of two labels, each once, the label at least
    ``least`` long."""
    bare = F.regexp_replace(F.lower(F.trim(cell)), r"\A[a-z][a-z0-9+.-]*://|[/?#:].*\z", "")
    m: Column = F.regexp_extract(bare, r"\A(?:www\.)?([a-z0-9-]+)\.([a-z]{2,})\z", 1)
    t = F.regexp_extract(bare, r"\A(?:www\.)?([a-z0-9-]+)\.([a-z]{2,})\z", 2)
    return rows.select(m.alias("label"), t.alias("tld")).where((F.col("label") != "") & (F.length("label") >= least)).distinct()


def scraped_names(rows: DataFrame, text: str, key: str) -> DataFrame:
    """``key, name``: everything in a text that looks like a name, in lower case."""
    pattern = r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
    return rows.select(key, F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))).alias("n")).select(key, F.lower("n").alias("name"))


def json_members(rows: DataFrame, text: str, number: str) -> DataFrame:
    """``member, value`` of JSON objects of objects, by ``number``, a whole number in each member;
    members that are no objects or lack it are left out."""
    each = rows.select(F.explode(F.from_json(text, "map<string,string>")).alias("member", "value"))
    return each.withColumn(number, F.get_json_object("value", f"$.{number}").try_cast("bigint")).where(F.col(number).isNotNull()).orderBy(number, "member")
