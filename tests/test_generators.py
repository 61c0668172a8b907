import sys

import pytest
from pyspark.sql import functions as F
from zonewright.sources import generators as g


def test_discovery_reads_syntax_only(tmp_path):
    for name, files in {"b": {"dga.py": "import os\nos.abort()\ndef dga(seed, nr=5): return 'x'"}, "a": {"x.py": "def helper(): pass\ndef next_domain(date): yield 1"},
                        "c": {"main.py": "def dga():\n  'doc'\n  raise NotImplementedError"}, "d": {}, ".h": {}, "my-locky": {"z.py": "def f(q): return q"}, "broken": {"dga.py": "def ("}}.items():
        (tmp_path / name).mkdir()
        for f, text in files.items():
            (tmp_path / name / f).write_text(text)
    found = {f.code: f for f in g.discover(str(tmp_path))}
    assert list(found) == ["a", "b", "broken", "c", "d", "my-locky"]
    assert (found["b"].entry, found["b"].function, found["b"].parameters, found["b"].defaults, found["b"].category) == ("dga.py", "dga", ("seed",), ("nr",), "seed_based")
    assert found["a"].function == "next_domain" and found["a"].category == "date_based" and found["my-locky"].category == "known_family"
    assert [found[x].problem for x in ("a", "b", "c", "d", "broken")] == [None, None] + ["missing_implementation"] * 3
    assert g.discover(str(tmp_path / "none")) == []


def test_faults_of_entry_files():
    for text, function, fault in (
        ("def dga(seed):\n  return 'x'", "dga", None), ("print('a.com')", None, None), ("class A:\n  def f(self): return 1", None, None), ("if __name__ == '__main__':\n  print(1)", None, None),
        ("def (", None, "missing_implementation"), ("# moved to another place", None, "unresolved_redirect"), ("# https://x.org moved", None, "unresolved_redirect"), ("", None, "placeholder_module"),
        ("def dga():\n  'TODO'\n  pass", "dga", "invalid_stub"), ("def dga():\n  raise NotImplementedError('not implemented')", "dga", "invalid_stub"), ("def dga():\n  ...", "dga", "missing_implementation"),
        ("import os\nx = 1", None, "missing_implementation"), ("def dga():\n  pass\n# redirect", "dga", "unresolved_redirect"), ("def other():\n  return 1", "dga", "missing_implementation"),
        ("def dga():\n  raise ValueError('x')", "dga", None),
    ):
        assert g.fault_of(text, function) == fault, text


def test_emit_kinds(spark):
    def endless(slot):
        n = 0
        while True:
            yield f"n{n}.com"
            n += 1

    slots = spark.range(3).withColumnRenamed("id", "slot").withColumn("seed", F.col("slot") * 10)
    assert sorted(r.raw for r in g.emit(slots, lambda seed: f"s{seed}.com", ["seed"]).collect()) == ["s0.com", "s10.com", "s20.com"]
    assert g.emit(slots, endless, ["slot"]).count() == 3 * g.MOST_OF_A_CALL
    assert [r.raw for r in g.emit(slots.limit(1), lambda slot: print("p.com q.com"), ["slot"]).collect()] == ["p.com", "q.com"]
    bad = g.emit(slots, lambda slot: 1 // int(slot != 1) and "a.com" or "b.com", ["slot"]).collect()
    assert sum(r.error is not None for r in bad) == 1 and len(bad) == 3


def test_commands(spark):
    slots = spark.range(2).withColumnRenamed("id", "slot")
    code = "import sys; print('c' + sys.argv[1] + '.com')"
    assert sorted(r.raw for r in g.emit_commands(slots, [sys.executable, "-c", code], ["slot"]).collect()) == ["c0.com", "c1.com"]
    assert {r.error for r in g.emit_commands(slots, [sys.executable, "-c", "print('x.com'); exit(3)"], ["slot"]).collect()} == {"exit 3"}
    assert {r.error for r in g.emit_commands(slots.limit(1), [sys.executable, "-c", "import time; time.sleep(60)"], ["slot"], seconds=1).collect()} == {"timeout"}


def test_batches_of_commands_are_bounded(spark):
    slots = spark.range(0, 6, 1, 1).withColumnRenamed("id", "slot")
    told = [r.error for r in g.emit_commands(slots, [sys.executable, "-c", "print('a.com')"], ["slot"], batch_calls=4).collect()]
    assert told == [None] * 4 + ["not called"] * 2
    told = [r.error for r in g.emit_commands(slots, [sys.executable, "-c", "import time; time.sleep(60)"], ["slot"], batch_seconds=1).collect()]
    assert told == ["timeout"] + ["not called"] * 5


def test_table_function(spark):
    g.table_function(spark, "emit_names", lambda slot: [f"a{slot}.com", f"b{slot}.com"])
    rows = spark.sql("SELECT id, raw FROM range(2), LATERAL emit_names(id)").collect()
    assert sorted(r.raw for r in rows) == ["a0.com", "a1.com", "b0.com", "b1.com"]


def test_batch_sizes():
    assert [g.batch_size(5000, y, 10**6) for y in (None, 0.9, 0.4, 0.1, 0.0)] == [50, 5000, 2500, 500, 50]
    assert g.batch_size(5000, 0.9, 7) == 7 and g.batch_size(5000, 0.9, 0) == 0


def source(code, cap, text):
    return g.Source(code, lambda slots: slots.select("slot", F.expr(text).alias("raw")), cap)


def sources():
    return [source("one", 120, "concat('a', slot, '.com')"), source("two", 60, "concat('b', slot % 20, '.com')"), source("bad", 10, "concat('-', slot)")]


def test_run_fills_caps_and_gives_up(spark, tmp_path):
    run = g.Run(spark, str(tmp_path / "s"), sources(), full_batch=100, patience=2)
    assert run.run() == {"one": 120, "two": 20, "bad": 0}
    assert run.names().count() == run.names().select("domain").distinct().count() == 140
    assert run.sources[2].reasons == {"invalid_suffix": 20}


def test_resumed_run_equals_one_run(spark, tmp_path):
    g.Run(spark, str(tmp_path / "s"), sources(), full_batch=100, patience=2).run(epochs=4)
    again = g.Run(spark, str(tmp_path / "s"), sources(), full_batch=100, patience=2)
    assert again.epoch == 4 and again.run() == {"one": 120, "two": 20, "bad": 0}
    with pytest.raises(ValueError):
        g.Run(spark, str(tmp_path / "s"), sources()[:2])


def test_ordered_run(spark, tmp_path):
    run = g.Run(spark, str(tmp_path / "s"), sources()[:2], full_batch=100, patience=1, ordered=True)
    run.run()
    codes = [r.algorithm_code for r in run.names().orderBy("epoch", "seq").collect()]
    assert codes == sorted(codes, key=["one", "two"].index)


def test_finite_collections_are_taken_whole(spark):
    one = spark.range(1).withColumnRenamed("id", "slot")
    assert g.emit(one, lambda slot: [f"n{i}.com" for i in range(10_000)], ["slot"]).where("error IS NULL").count() == 10_000
    told = g.emit(one, lambda slot: (f"n{i}.com" for i in range(10_000)), ["slot"]).collect()
    assert len(told) == g.MOST_OF_A_CALL and [r.error for r in told if r.error] == ["CutOff: more than 4096 names"]
    assert all(r.error is None for r in g.emit(one, lambda slot: iter(["a.com"] * g.MOST_OF_A_CALL), ["slot"]).collect())
    both = g.emit(one, lambda slot: print("p.com") or [b"x", 7, "q.com"], ["slot"]).collect()
    assert [r.raw for r in both] == ["b'x'", "7", "q.com", "p.com"]
    g.table_function(spark, "emit_many", lambda slot: tuple(f"n{i}.com" for i in range(10_000)))
    assert spark.sql("SELECT raw FROM range(1), LATERAL emit_many(id)").count() == 10_000


def test_parameters_are_bound_by_name(spark):
    axes = g.Axes(base_seed=5, base_date="2024-01-31", first_date="2024-01-01", last_date="2024-02-01")
    names = ["seed", "magic", "Date", "year", "month", "day", "nr", "config_nr", "version", "prefix", "tlds", "domain", "md5", "length", "config", "whatever"]
    rows = spark.range(12).select(*[g.bound(n, F.col("id"), "x", axes).alias(n) for n in names]).collect()
    assert [r.seed for r in rows[:3]] == [5, 6, 7] and [str(r.Date) for r in rows[:3]] == ["2024-01-31", "2024-02-01", "2024-02-01"]
    assert tuple(rows[8])[3:] == (2024, 2, 1, 8, 3, "v2", "sn", ["com", "net", "org", "biz", "info", "ru"], "example8.com", "c9f0f895fb98ab9159f51fd0297e236d", 16, "c", 1)
    assert spark.range(1).select(g.bound("magic", F.col("id"), "x", g.Axes(base_seed=1 << 32))).first()[0] == 1


def test_plans():
    found = [g.Found(c, "", "dga.py", "dga", (), (), k, p) for c, k, p in (("a", "seed_based", None), ("b", "seed_based", None), ("c", None, None), ("d", None, "invalid_stub"))]
    assert {p.code: (p.cap, p.status) for p in g.plan_run(found, 100, 40)} == {"a": (25, "usable"), "b": (25, "usable"), "c": (40, "usable"), "d": (0, "invalid_stub")}
    assert [(p.code, p.cap, p.status) for p in g.plan_run(found, 100, 40, ["c", "x", "d"])] == [("c", 40, "usable"), ("x", 0, "missing"), ("d", 0, "invalid_stub"), ("a", 0, "ignored"), ("b", 0, "ignored")]


def test_stop_reasons_and_unique_share(spark, tmp_path):
    bad = g.Source("err", lambda slots: g.emit(slots, lambda slot: 1 // 0, ["slot"]), 10)
    run = g.Run(spark, str(tmp_path / "s"), [*sources(), bad], full_batch=100, patience=2, max_errors=2)
    run.run()
    assert [run.stop_reason(s) for s in run.sources] == ["cap_reached", "exhausted", "no_output", "errors"] and run.errors() == []
    told = run.report(target=999)
    assert told["held"] == 140 and [r["held"] for r in told["sources"]] == [120, 20, 0, 0]
    assert g.unique_share(spark.createDataFrame([(0, "a"), (1, "a"), (2, None), (3, "b")], "slot long, raw string")) == 2 / 3


def test_batches_double_while_names_are_new(spark, tmp_path):
    run = g.Run(spark, str(tmp_path / "s"), [source("one", 20_000, "concat('a', slot, '.com')")], full_batch=100)
    assert run.run() == {"one": 20_000} and run.epoch < 12


def test_target_ends_a_run(spark, tmp_path):
    run = g.Run(spark, str(tmp_path / "s"), sources(), full_batch=30)
    run.run(target=60)
    assert 60 <= sum(s.held for s in run.sources) < 140
