"""Rows that fail to parse: load the sound lines of list files, and name the reason of the others.

Facts of each file (delimiter, header, columns) come from small aggregates over its lines. For each
file's schema an anchored pattern for whole rows is generated. A line that the pattern does not
match goes through the field-prefix pattern, which grows field by field as far as the fields are
sound; where it stops is the first broken field, and what stands there tells the reason: no sound field, or
sound fields in the wrong number. All patterns are possessive, so they run in linear
time and constant stack on lines of any length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import strict_name, strict_reason, strip
from ..session import materialize

# Fixed values.
DELIMITERS = (",", "\t", ";", "|")
HEADER_CELLS = ("domain", "hostname", "fqdn", "host")
#: Lines of a file from which an unset delimiter is detected.
SNIFF_LINES = 30
LINE_REASONS = ("domain_column_missing", "broken_quoting", "column_count")


def quoted_literal(c: Column) -> Column:
    """A delimiter as a pattern that matches itself, wherever it stands in a pattern."""
    return F.regexp_replace(c, r"([\\\[\]^\-&.|?*+(){}$#])", r"\\$1")


def field_pattern(delim: Column) -> Column:
    """One sound field: enclosed with doubled inner quotes, or free of quotes and delimiters."""
    q = quoted_literal(delim)
    bare = F.when(F.length(delim) == 1, F.concat(F.lit('[^"'), q, F.lit("]*+"))).otherwise(F.concat(F.lit("(?:(?!"), q, F.lit(')[^"])*+')))
    return F.concat(F.lit('(?:"[^"]*+(?:""[^"]*+)*+"|(?!")'), bare, F.lit(")"))


def row_pattern(delim: Column, columns: Column) -> Column:
    """The whole row: exactly ``columns`` sound fields."""
    f, q = field_pattern(delim), quoted_literal(delim)
    return F.concat(
        F.lit(r"\A"), f, F.lit("(?:"), q, f, F.lit("){"), (columns - 1).cast("string"), F.lit(r"}+\z")
    )


def prefix_pattern(delim: Column) -> Column:
    """The longest run of sound fields that a delimiter ends."""
    return F.concat(F.lit(r"\A(?:"), field_pattern(delim), quoted_literal(delim), F.lit(")*+"))


def sound_pattern(delim: Column) -> Column:
    """A row of any number of sound fields."""
    f = field_pattern(delim)
    return F.concat(F.lit(r"\A"), f, F.lit("(?:"), quoted_literal(delim), f, F.lit(r")*+\z"))


def matches(text: Column, pattern: Column) -> Column:
    # regexp_replace keeps the last compiled pattern, rlike compiles a column's pattern for each row
    return F.regexp_replace(text, pattern, F.lit("")).eqNullSafe(F.lit("")) & (text != "")


def count_delimiters(text: Column, delim: Column) -> Column:
    """Delimiters outside enclosed fields of a sound text."""
    bare = F.regexp_replace(text, '"[^"]*+"', "")
    return ((F.length(bare) - F.length(F.replace(bare, delim, F.lit("")))) / F.length(delim)).cast("int")


def nth_pattern(delim: Column, index: Column) -> Column:
    """Field ``index`` (from 0) of a sound row, as its first group."""
    f, q = field_pattern(delim), quoted_literal(delim)
    return F.concat(F.lit(r"\A(?:"), f, q, F.lit("){"), index.cast("string"), F.lit("}+("), f, F.lit(")"))


def nth_field(text: Column, pattern: Column) -> Column:
    """Content of the field that an ``nth_pattern`` finds."""
    raw = F.call_function("regexp_extract", text, pattern, F.lit(1))
    inner = F.regexp_replace(F.regexp_replace(raw, r'\A"|"\z', ""), '""', '"')
    return F.when(raw.startswith('"'), inner).otherwise(raw)


def _header_cells(line: Column, delim: Column) -> Column:
    """Cells of a header line, trimmed and in lower case."""
    f, q = field_pattern(delim), quoted_literal(delim)
    cells = F.when(
        matches(line, sound_pattern(delim)),
        F.regexp_extract_all(F.concat(delim, line), F.concat(q, F.lit("("), f, F.lit(")")), F.lit(1)),
    ).otherwise(F.split(line, q))
    return F.transform(
        cells, lambda c: F.lower(strip(F.regexp_replace(F.regexp_replace(c, r'\A"|"\z', ""), '""', '"')))
    )


def _lines(raw_lines: DataFrame) -> DataFrame:
    text = F.when((F.col("line_no") == 1), F.regexp_replace("raw_line", "\\A\ufeff", "")).otherwise(F.col("raw_line"))
    return raw_lines.select("file_id", "line_no", F.coalesce(text, F.lit("")).alias("line")).withColumn("blank", strip("line") == "")


def file_schemas(raw_lines: DataFrame, parse_config: DataFrame) -> DataFrame:
    """One row a file: ``file_id, delim, header_line, columns, name_index, column_missing``.

    ``delim`` is null if the file has none, ``header_line`` if it has no header; ``columns`` is
    the header's width, else the commonest width of the sound lines (the smaller of two equally
    common). Lines of a file without a configuration are read with all of it unset.
    """
    lines = _lines(raw_lines)
    config = parse_config.groupBy("file_id").agg(
        F.min_by(F.struct("delimiter", "domain_column", "header_auto_detect"), F.coalesce("domain_column", F.lit(""))).alias("c")
    ).select("file_id", "c.*")
    counts = [F.sum(F.when(~F.col("blank") & (F.col("line_no") <= SNIFF_LINES), F.length("line") - F.length(F.replace("line", F.lit(x), F.lit("")))).otherwise(0)).alias(f"n{i}") for i, x in enumerate(DELIMITERS)]
    # numbers only, so that a hash table holds them; the text of the first lines is fetched afterwards
    first = F.min(F.when(~F.col("blank"), F.col("line_no"))).alias("first_no")
    seen = materialize(lines.groupBy("file_id").agg(*counts, first), "counted")
    heads = lines.join(seen.select("file_id", F.col("first_no").alias("line_no")), ["file_id", "line_no"]).groupBy("file_id", "line_no").agg(F.min("line").alias("line"))
    heads = heads.select("file_id", F.struct("line_no", "line").alias("first"))
    seen = seen.join(heads, "file_id", "left").join(config, "file_id", "left")
    best = F.greatest(*[F.col(f"n{i}") for i in range(len(DELIMITERS))])
    detected = F.when(best > 0, F.coalesce(*[F.when(F.col(f"n{i}") == best, F.lit(x)) for i, x in enumerate(DELIMITERS)]))
    delim = F.coalesce(F.when(F.col("delimiter") != "", F.col("delimiter")), detected)
    wanted = F.lower(strip("domain_column"))
    facts = (
        seen.select("file_id", "first", delim.alias("delim"), wanted.alias("wanted"), F.coalesce("header_auto_detect", F.lit(False)).alias("auto"))
        .withColumn("cells", F.when(F.col("delim").isNotNull() & F.col("first").isNotNull(), _header_cells(F.col("first.line"), F.col("delim"))))
        .withColumn("has_header", F.coalesce(F.col("cells").isNotNull() & (F.col("wanted").isNotNull() | (F.col("auto") & F.arrays_overlap("cells", F.array(*map(F.lit, HEADER_CELLS))))), F.lit(False)))
    )
    headed = facts.select(
        "file_id", "delim",
        F.when(F.col("has_header"), F.col("first.line_no")).alias("header_line"),
        F.when(F.col("has_header"), F.size("cells")).alias("header_columns"),
        F.when(F.col("has_header") & F.col("wanted").isNotNull(), F.array_position("cells", F.col("wanted")).cast("int") - 1).otherwise(0).alias("name_index"),
    )
    # written, so that its size is known when the next pass over the lines is planned
    headed = materialize(headed, "headed")
    # the commonest width, for files with a delimiter but no header
    loose = headed.where(F.col("delim").isNotNull() & F.col("header_line").isNull()).select("file_id", "delim")
    widths = (
        lines.where(~F.col("blank")).join(loose, "file_id")
        .where(matches(F.col("line"), sound_pattern(F.col("delim"))))
        .groupBy("file_id", (count_delimiters(F.col("line"), F.col("delim")) + 1).alias("width")).count()
        .groupBy("file_id").agg(F.max_by("width", F.struct("count", -F.col("width"))).alias("usual"))
    )
    schemas = headed.join(widths, "file_id", "left").select(
        "file_id", "delim", "header_line", F.coalesce("header_columns", "usual", F.lit(1)).alias("columns"),
        F.greatest("name_index", F.lit(0)).alias("name_index"), (F.col("name_index") < 0).alias("column_missing"),
    )
    return materialize(schemas, "schemas")


def schema_patterns(schemas: DataFrame) -> DataFrame:
    """``delim, columns, name_index, row_re, sound_re, prefix_re, field_re, name_re``: the patterns of every
    schema that occurs, made once for all files that share it."""
    delim, columns, at = F.col("delim"), F.col("columns"), F.col("name_index")
    kinds = schemas.where(delim.isNotNull()).select(delim, columns, at).distinct()
    made = kinds.select(
        delim, columns, at, row_pattern(delim, columns).alias("row_re"), sound_pattern(delim).alias("sound_re"),
        prefix_pattern(delim).alias("prefix_re"), F.concat(F.lit(r"\A"), field_pattern(delim), F.lit(r"\z")).alias("field_re"), nth_pattern(delim, at).alias("name_re"),
    )
    return materialize(made, "patterns")


def _with_schema(lines: DataFrame, raw_lines: DataFrame, parse_config: DataFrame) -> DataFrame:
    """Lines beside the schema of their file and its patterns (null without a delimiter)."""
    schemas = file_schemas(raw_lines, parse_config)
    return lines.join(schemas, "file_id").join(schema_patterns(schemas), ["delim", "columns", "name_index"], "left")


def classify_lines(raw_lines: DataFrame, parse_config: DataFrame, convert: bool = True) -> DataFrame:
    """Every line as ``file_id, line_no, kind, name, reason, broken_field``.

    ``kind`` is ``blank``, ``header``, ``valid`` or ``invalid``. ``name`` is the normal name of a
    valid line (IDNA unless ``convert`` is false); ``reason`` says why a line is invalid, ``broken_field`` (from 1) which
    field: where the field-prefix pattern stops, or the name's. A missing column is no field. Null lines are blank ones; repeated lines are all kept. The
    schemas are written first and joined by file: Spark broadcasts them if their size is below its
    threshold, and lines are not moved; otherwise the adaptive join splits a file that is too large.
    """
    lines = _with_schema(_lines(raw_lines), raw_lines, parse_config)
    line, delim, columns = F.col("line"), F.col("delim"), F.col("columns")
    lines = lines.withColumn(
        "kind", F.when(F.col("blank"), "blank").when(F.col("line_no").eqNullSafe(F.col("header_line")), "header").otherwise("data")
    )
    fits = delim.isNull() | matches(line, F.col("row_re"))
    lines = lines.withColumn("fits", F.when(F.col("kind") == "data", fits))
    # the sound fields in front, each with its delimiter; what follows is the last field, or the first broken one
    prefix = F.when(F.col("kind") == "data", F.when(~F.col("fits"), F.call_function("regexp_extract", line, F.col("prefix_re"), F.lit(0))))
    lines = lines.withColumn("prefix", prefix)
    rest = F.substring(line, F.length("prefix") + 1, F.length(line))
    broken = count_delimiters(F.col("prefix"), delim) + 1
    row_reason = (
        F.when(F.col("column_missing") & delim.isNotNull(), "domain_column_missing")
        .when(~F.col("fits") & (rest != "") & ~matches(rest, F.col("field_re")), "broken_quoting")
        .when(~F.col("fits"), "column_count")
    )
    lines = lines.withColumn("row_reason", F.when(F.col("kind") == "data", row_reason))
    cell = F.when(delim.isNull(), line).otherwise(nth_field(line, F.col("name_re")))
    lines = lines.withColumn("cell", F.when((F.col("kind") == "data") & F.col("row_reason").isNull(), cell))
    lines = lines.withColumn("normal", strict_name("cell", convert))
    name_reason = F.when(F.col("cell").isNotNull(), strict_reason(F.col("cell"), F.col("normal")))
    lines = lines.withColumn("reason", F.coalesce("row_reason", name_reason))
    at = (
        F.when(F.col("row_reason") == "broken_quoting", broken).when(F.col("row_reason") == "column_count", F.least(broken, columns + 1))
        .when(F.col("row_reason").isNull() & F.col("reason").isNotNull(), F.col("name_index") + 1)
    )
    return lines.select(
        "file_id", "line_no",
        F.when(F.col("kind") != "data", F.col("kind")).when(F.col("reason").isNull(), "valid").otherwise("invalid").alias("kind"),
        F.when(F.col("reason").isNull(), F.col("normal")).alias("name"),
        "reason", at.alias("broken_field"),
    )


def cells(raw_lines: DataFrame, parse_config: DataFrame) -> DataFrame:
    """``file_id, line_no, cell``: the name cell of each data line with sound quoting that has that
    field, whatever its number of columns; lines of files without the named column have none."""
    lines = _with_schema(_lines(raw_lines).where(~F.col("blank")), raw_lines, parse_config)
    line, delim = F.col("line"), F.col("delim")
    data = lines.where(~F.col("line_no").eqNullSafe(F.col("header_line")) & (delim.isNull() | ~F.col("column_missing") & matches(line, F.col("sound_re"))))
    there = delim.isNull() | (F.call_function("regexp_instr", line, F.col("name_re")) > 0)
    return data.where(there).select("file_id", "line_no", F.when(delim.isNull(), line).otherwise(nth_field(line, F.col("name_re"))).alias("cell"))


def rejected_lines(raw_lines: DataFrame, parse_config: DataFrame, convert: bool = True) -> DataFrame:
    """``file_id, line_no, reason, broken_field`` of the data lines that fail."""
    return classify_lines(raw_lines, parse_config, convert).where("kind = 'invalid'").select("file_id", "line_no", "reason", "broken_field")


def loaded_lines(raw_lines: DataFrame, parse_config: DataFrame, convert: bool = True) -> DataFrame:
    """``file_id, line_no, name`` of the data lines that load."""
    return classify_lines(raw_lines, parse_config, convert).where("kind = 'valid'").select("file_id", "line_no", "name")
