import hashlib
import json

import pytest
from zonewright.functions.registry import DEFAULT, Feature, FeatureSet
from zonewright.operators import rejects
from zonewright.plans import catalogue
from zonewright.sinks import files
from zonewright.sources import lists
from zonewright.streaming import store

D = "/root/testdata/sf0.001"


def test_directory_of_lists(spark, tmp_path):
    (tmp_path / "b b.txt").write_text("﻿Example.COM\n\nsub.example.org\njunk\n", encoding="utf-8")
    (tmp_path / "a.CSV").write_text("domain,extra\nx.com,1\ny.com,2\n")
    (tmp_path / ".hidden.txt").write_text("no.com\n")
    (tmp_path / "c.dat").write_text("no.com\n")
    paths = lists.discover(spark, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["a.CSV", "b b.txt"]
    lines = lists.read_lines(spark, paths)
    assert [(r.file_id, r.line_no, r.raw_line.strip("﻿")) for r in lines.orderBy("file_id", "line_no").collect()] == [
        (0, 1, "domain,extra"), (0, 2, "x.com,1"), (0, 3, "y.com,2"), (1, 1, "Example.COM"), (1, 2, ""), (1, 3, "sub.example.org"), (1, 4, "junk")]
    config = spark.createDataFrame([(0, None, None, True, "balanced"), (1, None, None, True, "balanced")], "file_id long, delimiter string, domain_column string, header_auto_detect boolean, validation_strictness string")
    got = {(r.file_id, r.name): r.valid for r in lists.list_candidates(lines, config).collect()}
    assert got == {(0, "x.com"): True, (0, "y.com"): True, (1, "example.com"): True, (1, "sub.example.org"): True, (1, "junk"): False}
    counts = {r.file_id: (r.physical_rows, r.raw_rows) for r in lists.raw_counts(lines, rejects.file_schemas(lines, config)).collect()}
    assert counts == {0: (3, 2), 1: (4, 4)}
    report = {r.file_id: r for r in lists.file_report(lists.list_candidates(lines, config)).collect()}
    assert report[1].rejected == 1 and report[1].accepted == 2 and report[0].acceptance_rate == 100
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        lists.discover(spark, str(tmp_path / "none"))


def test_lines_keep_their_numbers_over_blocks(spark, tmp_path):
    (tmp_path / "big.txt").write_text("".join(f"n{i}.com\n" for i in range(5000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = lists.read_lines(spark, lists.discover(spark, str(tmp_path))).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.line_no, r.raw_line) for r in rows) == [(i + 1, f"n{i}.com") for i in range(5000)]


def test_pairs_with_and_without_header(spark, tmp_path):
    a, b = tmp_path / "a.csv", tmp_path / "b.csv"
    a.write_text("x,Algo_Code,Domain\n1,k,a.com\n")
    b.write_text("a.com,k\ndomain,algorithm\nb.com,m\n")
    assert [(r.domain, r.code) for r in lists.read_pairs(spark, str(a), True).collect()] == [("a.com", "k")]
    assert [(r.domain, r.code) for r in lists.read_pairs(spark, str(b), True).orderBy("pos").collect()] == [("a.com", "k"), ("b.com", "m")]
    a.write_text("a.com\n")
    with pytest.raises(ValueError):
        lists.read_pairs(spark, str(a), True)


def test_base_labels_and_scraping(spark):
    df = spark.createDataFrame([("https://www.example.com/x?y", 1), ("abc.org", 2), ("a.b.c", 3), (None, 4), ("see A.b.Com, x", 5)], "t string, k int")
    assert {tuple(r) for r in lists.base_labels(df, "t", 4).collect()} == {("example", "com")}
    assert {(r.k, r.name) for r in lists.scraped_names(df.where("k = 5"), "t", "k").collect()} == {(5, "a.b.com")}


def test_arff(spark, tmp_path):
    df = spark.createDataFrame([("bad'domain\\name.com", 1.5, "c\td", 1), ("x.com", float("nan"), "com", 0), ("y.com", None, "com", 0)], "DOMAIN string, F double, CLASS string, LABEL int")
    rows = [r.value for r in files.arff_rows(df, ["F"]).collect()]
    assert rows == ["'bad\\'domain\\\\name.com',1.5,'c d',1", "'x.com',?,'com',0", "'y.com',?,'com',0"]
    files.write_arff(df, str(tmp_path / "out"), "names", ["F"])
    assert files.arff_attributes(spark, str(tmp_path / "out")) == ["DOMAIN", "F", "CLASS", "LABEL"]
    assert files.arff_field_errors(spark, str(tmp_path / "out"), 4) == 0 and files.arff_field_errors(spark, str(tmp_path / "out"), 3) == 3


def test_parts(spark, tmp_path):
    df = spark.range(400).selectExpr("concat('n', id, '.com') AS DOMAIN", "id AS pos")
    files.write_parts(df.coalesce(1), str(tmp_path / "p"), 128 * 100)
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 4 and spark.read.parquet(str(tmp_path / "p")).count() == 400
    parts = [r.part for r in files.part_numbers(df, "pos", "DOMAIN", 128 * 100).orderBy("pos").collect()]
    assert parts == [i // 100 for i in range(400)]


def test_documents(spark, tmp_path):
    m = files.manifest(DEFAULT, {"rows": 2}, {"seed": 42})
    assert len(m["columns"]) == 57 and m["feature_name_order_checksum"].startswith("fef951ea")
    files.write_json(spark, m, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text())["counts"] == {"rows": 2}
    assert files.read_json(spark, f"file://{tmp_path}/m.json")["counts"] == {"rows": 2} and m["generated_at"].endswith("+00:00")
    assert files.gzip_verified(str(tmp_path / "m.json")).endswith(".gz")
    assert len(files.schema_description(FeatureSet([Feature("L_ENTROPY", description="x")]))["fields"]) == 4
    assert [f.nullable for f in files.final_schema(DEFAULT).fields] == [False] * 57
    with pytest.raises(FileExistsError):
        files.refuse_existing(spark, [str(tmp_path / "m.json")], False)
    files.refuse_existing(spark, [str(tmp_path / "m.json")], True)
    assert not (tmp_path / "m.json").exists()
    (tmp_path / "i.txt").write_bytes(b"abc" * 1_000_000)
    told = files.file_digests(spark, [f"file:{tmp_path}/i.txt"]).first()
    assert (told.length, told.sha256) == (3_000_000, hashlib.sha256(b"abc" * 1_000_000).hexdigest())
    assert [files.portable_path(p, "file:///a/out") for p in ("file:/a/out/data/x", "/b/y")] == ["data/x", "y"]


def test_inputs_are_found_in_singular_or_plural(spark, tmp_path):
    (tmp_path / "name.csv").write_text("a.com\n")
    assert lists.resolve_input(spark, f"{tmp_path}/names.csv") == f"{tmp_path}/name.csv" == lists.resolve_input(spark, f"{tmp_path}/name.csv")
    with pytest.raises(FileNotFoundError):
        lists.resolve_input(spark, f"{tmp_path}/other.csv")


def test_pairs_of_many_files_are_in_file_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k, n in (("c", 30), ("a", 4000), ("b", 900)):
        (tmp_path / "in" / f"{k}.csv").write_text("".join(f"{k}{i}.com\n" for i in range(n)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        rows = lists.read_pairs(spark, str(tmp_path / "in"), False).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = [f"{k}{i}.com" for k, n in (("a", 4000), ("b", 900), ("c", 30)) for i in range(n)]
    assert [r.domain for r in sorted(rows, key=lambda r: r.pos)] == want and [r.pos for r in sorted(rows, key=lambda r: r.pos)] == list(range(len(want)))


def test_nothing_is_left_but_results(spark):
    from zonewright import session, storage

    folder = f"{session.shared_dir(spark)}/zonewright"
    before = set(storage.names_in(spark, folder))
    for q in ("p4_found", "build_dataset", "part_numbers", "csv_export"):
        assert catalogue.queries()[q](spark, D).count()
    assert {x.split("-")[0] for x in set(storage.names_in(spark, folder)) - before} == {"result"}


def test_stream_equals_batch_and_restarts(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"n{i % 40}.com" if i % 7 else None, "k") for i in range(200)], "attempt_id long, domain string, algorithm_code string")
    for lo in (0, 70, 140):
        rows.where(f"attempt_id >= {lo} AND attempt_id < {lo + 70}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    args = (str(tmp_path / "in"), rows.schema, str(tmp_path / "store"), str(tmp_path / "check"), "domain", "algorithm_code", "attempt_id")
    got = sorted((r.domain, r.seq) for r in store.insert_stream(spark, *args).collect())
    assert len(got) == len({d for d, _ in got}) == 40
    rows.where("attempt_id = 3").withColumn("attempt_id", rows.attempt_id + 1000).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    assert sorted((r.domain, r.seq) for r in store.insert_stream(spark, *args).collect()) == got


def test_store_of_the_test_table(spark):
    got = catalogue.queries()["streamed_store"](spark, D)
    assert got.count() == got.select("domain").distinct().count()


def test_windows(spark):
    e = spark.read.parquet(f"{D}/events.parquet")
    assert store.windowed_counts(e, "ts", "event_type", "1 hour").agg({"n": "sum"}).first()[0] == e.count()


def test_counts_are_cached(spark, tmp_path):
    from zonewright.sources import catalog

    (tmp_path / "a.txt").write_text("domain,x\na.com,1\n\n")
    (tmp_path / "b.txt").write_text("b.com\n")
    paths, cache = [str(tmp_path / f) for f in ("a.txt", "b.txt")], str(tmp_path / "cache")
    rows = lambda r: [(x.physical_rows, x.raw_rows) for x in catalog.counted(spark, paths, r, cache).collect()]
    plain = catalog.Reading()
    assert rows(plain) == [(3, 2), (1, 1)]
    (tmp_path / "b.txt").write_text("b.com\nc.com\n")
    assert rows(plain) == [(3, 2), (2, 2)] == rows(plain)
    assert rows(catalog.Reading(header_auto_detect=False)) == [(3, 3), (2, 2)]
    assert catalog.counted(spark, paths, plain).count() == 2


def test_json_members(spark):
    df = spark.createDataFrame([('{"b": {"balance": 2}, "a": {"balance": "x"}, "c": {"balance": 1}, "d": 5}',), (None,), ("junk",)], "t string")
    assert [(r.member, r.balance) for r in lists.json_members(df, "t", "balance").collect()] == [("c", 1), ("b", 2)]
