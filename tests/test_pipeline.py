import hashlib
import json

import pytest
from zonewright.functions import registry
from zonewright.operators import validate
from zonewright.plans import cli, pipeline
from zonewright.sources import lists


def make(tmp_path, **named):
    for name, rows in named.items():
        (tmp_path / f"{name}.txt").write_text("\n".join(rows) + "\n")
    return tmp_path


def run(spark, path, **kw):
    names, report = pipeline.aggregate_lists(spark, lists.discover(spark, str(path)), pipeline.ListOptions(**kw))
    return [r.domain for r in names.collect()], report


def test_deficit_goes_to_the_other_file(spark, tmp_path):
    make(tmp_path, a=["bad"] * 4, b=[f"g{i}.com" for i in range(6)])
    names, report = run(spark, tmp_path, target=6, shortfall="allow")
    assert sorted(names) == [f"g{i}.com" for i in range(6)] and report["missing"] == 0
    assert [f["quota"] for f in report["files"]] == [2, 4] and [f["taken"] for f in report["files"]] == [0, 6]


def test_refill_and_shortfall(spark, tmp_path):
    make(tmp_path, a=["a1.com", "a2.com", "a3.com"], b=["b1.com", "b2.com"])
    names, report = run(spark, tmp_path, target=10)
    assert len(names) == 10 and len(set(names)) == 5 and report["missing"] == 0
    names, report = run(spark, tmp_path, target=10, shortfall="allow")
    assert len(names) == 5 and report["missing"] == 5
    names, report = run(spark, tmp_path, target=10, unique=True)
    assert len(names) == 5 and report["missing"] == 5


def test_uniqueness(spark, tmp_path):
    make(tmp_path, a=["x.com", "x.com", "y.com"], b=["x.com", "z.com"])
    assert sorted(run(spark, tmp_path, target=5, shortfall="allow")[0]) == ["x.com", "x.com", "x.com", "y.com", "z.com"]
    assert sorted(run(spark, tmp_path, target=5, shortfall="allow", unique_per_file=True)[0]) == ["x.com", "x.com", "y.com", "z.com"]
    assert sorted(run(spark, tmp_path, target=5, shortfall="allow", unique=True)[0]) == ["x.com", "y.com", "z.com"]


def test_same_result_each_time(spark, tmp_path):
    make(tmp_path, a=[f"a{i}.com" for i in range(100)], b=[f"b{i}.com" for i in range(50)])
    one, two = (sorted(run(spark, tmp_path, target=30)[0]) for _ in range(2))
    assert one == two and len(set(one)) == 30
    assert one != sorted(run(spark, tmp_path, target=30, seed=7)[0])


def test_data_set_on_disk(spark, tmp_path):
    listed, generated, out = tmp_path / "l.csv", tmp_path / "g.csv", tmp_path / "out"
    listed.write_text("domain\n" + "\n".join(f"good{i}.com" for i in range(30)) + "\nover.com\n")
    generated.write_text("domain,algorithm_code\n" + "\n".join(f"xq{i}z.net,{'ab'[i % 2]}" for i in range(40)) + "\nover.com,a\n")
    argv = ["build-dataset", "--listed", str(listed), "--generated", str(generated), "--output", str(out), "--sample-size", "10", "--audit-size", "5"]
    assert cli.main(argv) == 0
    manifest = json.loads((out / "manifest.json").read_text())
    assert sum(manifest["counts"].values()) == 60 and len(manifest["columns"]) == 57
    stored = spark.read.parquet(str(out / "data"))
    assert stored.count() == 60 and stored.where("DOMAIN = 'over.com' AND LABEL = 0").count() == 0
    assert validate.validate(stored.drop("split"), registry.DEFAULT, manifest) == []
    assert spark.read.parquet(str(out / "integrity")).count() == 60
    assert json.loads((out / "stats.json").read_text())["status"] == "ok"
    assert cli.main(["validate-dataset", "--input", str(out)]) == 0
    assert cli.main(argv) == 1  # exists
    told = json.loads((out / "stats.json").read_text())
    assert told["counters"]["generated_rows_read"] == 41 and told["counters"]["listed_overlap"] == 1 and told["counters"]["generated_reduced"] == 11 and len(told["counters"]) == 15
    assert sum(p["rows"] for p in told["parts"]) == 60 and all(len(p["sha256"]) == 64 for p in manifest["parts"])
    assert manifest["inputs"]["listed"][0]["sha256"] == hashlib.sha256(listed.read_bytes()).hexdigest()
    assert all(f["description"] for f in json.loads((out / "schema.json").read_text())["fields"])
    (out / "sample_arff" / "part=rows" / "extra.txt").write_text("'x',1\n")
    assert cli.main(["validate-dataset", "--input", str(out)]) == 1
    generated.write_text("domain,algorithm_code\n-bad-,a\n")
    with pytest.raises(ValueError):
        pipeline.build_dataset(spark, str(listed), str(generated), str(tmp_path / "none"), pipeline.DatasetOptions())
    assert json.loads((tmp_path / "none" / "stats.json").read_text())["status"] == "failed"


def test_rows_are_in_order_and_paths_may_be_uris(spark, tmp_path):
    listed, generated, out = tmp_path / "l.csv", tmp_path / "g.csv", f"file://{tmp_path}/out"
    listed.write_text("domain\n" + "\n".join(f"good{i}.com" for i in range(300)) + "\n")
    generated.write_text("domain,algorithm_code\n" + "\n".join(f"xq{i}z.net,{'ba'[i % 2]}" for i in range(200)) + "\n")
    pipeline.build_dataset(spark, str(listed), str(generated), out, pipeline.DatasetOptions(sample=5, audit=5))
    read = lambda at: [n for f in sorted((tmp_path / "out" / "data" / at).glob("*.parquet")) for n in spark.read.parquet(str(f)).toPandas().DOMAIN]
    got = read("split=train")
    want = [f"xq{i}z.net" for i in range(200)] + [f"good{i}.com" for i in range(200)]
    assert len(got) > 250 and got == [n for n in want if n in set(got)]
    # reduced ones by code and hash
    listed.write_text("domain\n" + "\n".join(f"good{i}.com" for i in range(50)) + "\n")
    pipeline.build_dataset(spark, str(listed), str(generated), f"{out}2", pipeline.DatasetOptions(sample=5, audit=5, splits=False))
    stored = [r for f in sorted((tmp_path / "out2" / "data").glob("*.parquet")) for r in spark.read.parquet(str(f)).toPandas()[["DOMAIN", "CLASS", "LABEL"]].itertuples()]
    key = lambda r: (r.CLASS, hashlib.sha256(f"42:{r.CLASS}:{r.DOMAIN}".encode()).hexdigest())
    first = [r for r in stored if r.LABEL == 1]
    assert [r.LABEL for r in stored] == [1] * 50 + [0] * 50 and first == sorted(first, key=key) and [r.DOMAIN for r in stored[50:]] == [f"good{i}.com" for i in range(50)]


def test_shortfall_may_be_an_error(spark, tmp_path):
    make(tmp_path, a=["a1.com"])
    with pytest.raises(ValueError):
        run(spark, tmp_path, target=10, shortfall="error")
    names, _ = run(spark, tmp_path, target=3, count_cache=f"{tmp_path}/counts")
    assert names == ["a1.com"] * 3 and spark.read.parquet(f"{tmp_path}/counts").first().raw_rows == 1


def test_generation_from_the_command_line(spark, tmp_path, capsys):
    root = tmp_path / "gens"
    for code, text in (("one", "def dga(seed, nr):\n  return f'a{seed}-{nr}.com'"), ("two", "def dga(date):\n  return [f'b{date.isoformat()}.org']"), ("stub", "def dga():\n  'todo'")):
        (root / code).mkdir(parents=True)
        (root / code / "dga.py").write_text(text)
    (tmp_path / "c.json").write_text(json.dumps({"target_count": 90, "per_source_cap": 7, "batch_size": 100}))
    argv = ["generate", "--root", str(root), "--store", str(tmp_path / "store"), "--output", str(tmp_path / "o"), "--config", str(tmp_path / "c.json"), "--per-source-cap", "60", "--patience", "1"]
    assert cli.main(argv) == 0
    told = json.loads((tmp_path / "o" / "stats.json").read_text())
    assert told["held"] >= 90 and {r["code"]: r["status"] for r in told["sources"]} == {"one": "usable", "two": "usable", "stub": "invalid_stub"}
    rows = spark.read.option("header", True).csv(str(tmp_path / "o" / "names.csv"))
    assert rows.columns == ["domain", "algorithm_code"] and rows.count() == told["held"]
    assert cli.main([*argv, "--validate-only"]) == int(told["held"] != 90)
    order = ["--ordered-sources", "two,gone,one", "--store", str(tmp_path / "ordered"), "--output", str(tmp_path / "p")]
    assert cli.main([*argv, *order]) == 0
    sources = json.loads((tmp_path / "p" / "stats.json").read_text())["sources"]
    assert [(r["code"], r["stopped"]) for r in sources] == [("two", "cap_reached"), ("gone", "missing"), ("one", None), ("stub", "ignored")] or sources[2]["stopped"] == "cap_reached"
    (tmp_path / "c.json").write_text(json.dumps({"nonsense": 1}))
    assert cli.main(argv) == 1


def test_command_line_of_lists(spark, tmp_path, capsys):
    make(tmp_path, a=["a.com", "b.com", "c.com"])
    assert cli.main(["aggregate-lists", "--input-dir", str(tmp_path), "--output", str(tmp_path / "o"), "--report", str(tmp_path / "r.json"), "--target-size", "2"]) == 0
    assert spark.read.option("header", True).csv(str(tmp_path / "o")).count() == 2
    assert json.loads((tmp_path / "r.json").read_text())["target"] == 2
    assert cli.main(["inspect-generators", "--root", str(tmp_path)]) == 0 and "[]" in capsys.readouterr().out
    assert cli.main(["aggregate-lists", "--input-dir", str(tmp_path / "missing"), "--output", "x"]) in (1,)


def test_distributions_are_whole(spark, tmp_path):
    listed, generated, out = tmp_path / "l.csv", tmp_path / "g.csv", tmp_path / "out"
    tld = lambda i: chr(97 + i // 26 % 26) + chr(97 + i % 26) + "x" * (1 + i // 676)
    listed.write_text("domain\n" + "\n".join(f"good{i}.{tld(i)}" for i in range(1100)) + "\n")
    generated.write_text("domain,algorithm_code\n" + "\n".join(f"xq{i}z.net,a" for i in range(1100)) + "\n")
    pipeline.build_dataset(spark, str(listed), str(generated), str(out), pipeline.DatasetOptions(sample=5, audit=5))
    rows = spark.read.parquet(str(out / "distributions")).collect()
    for label, n in ((None, 2200), (0, 1100), (1, 1100)):
        for measure in ("length", "tld", "digit_ratio", "entropy"):
            assert sum(r.n for r in rows if r.label == label and r.measure == measure) == n
    told = json.loads((out / "stats.json").read_text())["distributions"]
    assert told["buckets"] == len(rows) and sum(told["top"]["length"]["all"].values()) == 2200
    assert len(told["top"]["tld"]["all"]) == pipeline.TOP_BUCKETS < sum(r.measure == "tld" and r.label is None for r in rows)
