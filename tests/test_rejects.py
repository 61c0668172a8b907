from plain import classify, fields
from zonewright.operators import rejects

LINES = "file_id long, line_no long, raw_line string"
CONFIG = "file_id long, delimiter string, domain_column string, header_auto_detect boolean, validation_strictness string"


def run(spark, lines, config):
    df = rejects.classify_lines(spark.createDataFrame(lines, LINES), spark.createDataFrame(config, CONFIG))
    return sorted((tuple(r)[:5] for r in df.collect()), key=str), df


def same(spark, lines, config):
    got, _ = run(spark, lines, config)
    want = sorted(classify(lines, {c[0]: c[1:4] for c in config}), key=str)
    assert got == want


def test_whole_table_equals_plain_reading(spark):
    d = "/root/testdata/sf0.01"
    lines, config = spark.read.parquet(f"{d}/raw_lines.parquet"), spark.read.parquet(f"{d}/parse_config.parquet")
    same(spark, [tuple(r) for r in lines.collect()], [tuple(r) for r in config.collect()])


def test_edges(spark):
    long = '"' + "x" * 200_000 + '""' * 50_000 + '"'
    files = [
        ["﻿domain,n", 'a.com,"x', 'b.com,"x"y', 'c.com,x"y', 'd.com, "x"', '"e.com","a""b"', '"f,f".com,1', ",", "  ", "", None, "g.com", "h.com,1,2"],
        ["", " \t ", "a.com", "bücher.de", "x..com", "A.COM.", "-", "." * 3],
        ["a;b", "c.com;d.com", long + ";d.com"],
        ['"Rank"|"Host Name"', "1|a.com", "2|b.com|"],
        ["a.com,1", "b.com,1", "c.com,1,2", "d.com,1,2"],
        [None, None],
        [",,,", "a.com,b,c,d"],
    ]
    lines = [(f, i + 1, x) for f, rows in enumerate(files) for i, x in enumerate(rows)]
    lines.append((9, 1, "a.com"))  # no configuration
    config = [(0, None, None, True, None), (1, None, "name", True, None), (2, ";", None, True, None), (3, "|", " host name ", False, "x"),
              (4, ",", None, False, None), (5, ",", "domain", True, None), (6, None, None, None, None)]
    same(spark, lines, config)


def test_any_delimiter_is_literal(spark):
    for delim in (".", "||", "^", "\\", "]", "-", "$", "a"):
        lines = [(1, 1, f"x{delim}y"), (1, 2, f'"q"{delim}z'), (1, 3, f'q"{delim}z'), (1, 4, "w")]
        same(spark, lines, [(1, delim, None, False, None)])


def test_first_broken_field(spark):
    _, df = run(spark, [(1, 1, "domain,b,c"), (1, 2, 'a.com,1,"x'), (1, 3, 'a.com,b"b,c'), (1, 4, "a.com"), (1, 5, "a.com,1,2,3")], [(1, ",", None, True, None)])
    assert {r.line_no: r.broken_field for r in df.collect() if r.reason} == {2: 3, 3: 2, 4: 1, 5: 4}


def test_empty_and_repeated(spark):
    assert run(spark, [], [])[0] == []
    got, _ = run(spark, [(1, 1, "a.com"), (1, 1, "a.com")], [(1, None, None, None, None)] * 2)
    assert [r[2] for r in got] == ["valid", "valid"]


def test_extra_columns(spark):
    lines = spark.createDataFrame([(1, 1, "a.com", "q", 5)], LINES + ", line string, delim int")
    config = spark.createDataFrame([(1, None, None, True, None, 7)], CONFIG + ", columns int")
    assert [r.name for r in rejects.loaded_lines(lines, config).collect()] == ["a.com"]


def test_plain_fields():
    assert fields('a,"b""c",', ",") == ["a", 'b"c', ""]
    assert fields('a,"b" ', ",") is None
