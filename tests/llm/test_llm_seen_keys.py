import pytest
from plain import strict_name
from pyspark.sql import functions as F

from zonewright.llm import queries, seen_keys

A = "record_id long, domain string"
T = "attempt_id long, domain string"


def plain(accepted, attempts):
    held, out = {strict_name(x) for _, x in accepted}, set()
    for i, x in sorted(attempts, key=lambda r: r[0]):
        n = strict_name(x)
        if not n:
            continue
        if n in held:
            out.add(i)
        held.add(n)
    return out


def found(spark, accepted, attempts, **kw):
    ids, store = seen_keys.seen_before(spark.createDataFrame(accepted, A), spark.createDataFrame(attempts, T), "domain", "attempt_id", **kw)
    got = sorted(r[0] for r in ids.collect())
    assert len(got) == len(set(got))
    return set(got), store


def test_whole_tables(spark):
    d = "/root/testdata/sf0.001"
    got = {r[0] for r in queries.p1_found(spark, d).collect()}
    acc = [tuple(r) for r in spark.read.parquet(f"{d}/domains.parquet").select("record_id", "domain").collect()]
    att = [tuple(r) for r in spark.read.parquet(f"{d}/insert_attempts.parquet").select("attempt_id", "domain").collect()]
    assert got == plain(acc, att)


def test_report_reproduces_first_reports(spark):
    d = "/root/testdata/sf0.001"
    rows = queries.p1_insert_report(spark, d).collect()
    assert rows and all(r.difference in (0, None) for r in rows)
    assert {(r.hash_only_wrong_rate, r.wrong_rate) for r in rows} == {(0.0, 0.0)} and rows[0].audited > 30


@pytest.mark.parametrize("steps", [1, 2, 5, 9])
def test_edges_at_any_number_of_steps(spark, steps):
    accepted = [(1, "a.com"), (2, None), (3, ""), (4, "BÜCHER.de"), (4, "BÜCHER.de")]
    names = ["A.com.", None, "", " ", ".", "xn--bcher-kva.de", "new.com", "new.com ", "other.com", "x" * 100_000, "x" * 100_000, "　a.com", "new.com"]
    attempts = [(i + 10, n) for i, n in enumerate(names)] + [(500, "late.com"), (499, "late.com")]
    got, _ = found(spark, accepted, attempts, steps=steps)
    assert got == plain(accepted, attempts)


def test_one_key_in_most_rows(spark):
    attempts = [(i, "hot.com" if i % 3 else f"n{i}.com") for i in range(1, 3001)]
    got, _ = found(spark, [], attempts, steps=4)
    assert got == plain([], attempts)


def test_empty_tables(spark):
    assert found(spark, [], [])[0] == set()
    assert found(spark, [(1, "a.com")], [])[0] == set()
    assert found(spark, [], [(1, "a.com"), (2, "a.com")])[0] == {2}


def test_narrow_hashes_stay_exact(spark):
    attempts = [(i, f"n{i % 700}.com") for i in range(1, 1501)]
    store = seen_keys.SortedRunStore(spark, hash_bits=8)
    got, store = found(spark, [(1, "n5.com")], attempts, store=store)
    assert got == plain([(1, "n5.com")], attempts)
    wrong = store.hash_only_errors().first()
    assert wrong["keys"] == 700 and 400 < wrong["wrong"] < 700


def test_levels_attach_and_point_look_up(spark):
    store = seen_keys.SortedRunStore(spark, fanout=2, buckets=3)
    for b in range(5):
        rows = spark.range(b * 50, b * 50 + 100).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id"))
        store.absorb(store.keys(rows, "k", F.col("id")))
    assert len(store.runs) < 5 and max(r["level"] for r in store.runs) >= 2
    assert store.all_keys().count() == 300 == store.all_keys().select("key").distinct().count()
    again = seen_keys.SortedRunStore.attach(spark, store.manifest())
    seen = {r.key: r.seen for r in again.contains(["k0", "k299", "k300", None]).collect()}
    assert seen == {"k0": True, "k299": True, "k300": False}
    with pytest.raises(ValueError):
        again.contains(["x"] * (seen_keys.POINT_KEYS + 1))
    store.drop()


def above_scan(plan, table):
    """Operators between a merge join and the scan of a table on its right."""
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if table in x and "Scan parquet" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :+-*"))
    out, d = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < d:
            d = depth(x)
            if "SortMergeJoin" in x:
                return out
            out.append(x.strip(" :+-*").split(" ")[0].split("(")[0])
    raise AssertionError(plan)


def test_probe_neither_moves_nor_sorts_history(spark):
    store = seen_keys.SortedRunStore(spark, buckets=4)
    for b in range(2):
        store.absorb(store.keys(spark.range(b * 500, 1000 + b * 500).select(F.col("id").cast("string").alias("k")), "k"))
    assert len(store.runs) == 2
    batch = store.keys(spark.range(100).select(F.col("id").cast("string").alias("k")), "k")
    plan = store.unseen(batch)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and plan.count("Exchange hashpartitioning") == 1
    for run in store.runs:
        assert not {"Sort", "Exchange"} & set(above_scan(plan, run["table"])), plan


def test_few_keys_are_looked_up_between_the_fences(spark):
    store = seen_keys.SortedRunStore(spark, buckets=2)
    store.append(store.keys(spark.range(5000).select(F.col("id").cast("string").alias("k")), "k"))
    batch = store.keys(spark.createDataFrame([("17",), ("x",), ("4999",), (None,)], "k string"), "k")
    out = store.unseen(batch, few=True)
    assert [r.key for r in out.collect()] == ["x"]
    assert "PushedFilters: [Or(" in out._jdf.queryExecution().executedPlan().toString()


def test_audit_finds_wrong_answers(spark):
    accepted = [(1, "a.com")]
    attempts = [(i, f"n{i % 70}.com" if i % 5 else "A.com.") for i in range(1, 301)] + [(300, None)]
    acc, att = spark.createDataFrame(accepted, A), spark.createDataFrame(attempts, T)
    right = spark.createDataFrame([(i,) for i in plain(accepted, attempts)], "id long")
    assert tuple(seen_keys.audit(acc, att, "domain", "attempt_id", right).first()) == (6, 0)
    assert tuple(seen_keys.audit(acc, att, "domain", "attempt_id", right.where("id <> 50")).first()) == (6, 1)
    assert tuple(seen_keys.audit(acc, att, "domain", "attempt_id", right, every=1).first()) == (300, 0)


def test_nothing_is_left_but_the_result(spark):
    from zonewright import session, storage

    folder = f"{session.shared_dir(spark)}/zonewright"
    before = set(storage.names_in(spark, folder))
    assert queries.queries()["p1_insert_report"](spark, "/root/testdata/sf0.001").count()
    assert {x.split("-")[0] for x in set(storage.names_in(spark, folder)) - before} <= {"result"}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("zonewright_run") and t.name in str(before)]


def test_extra_columns(spark):
    acc = spark.createDataFrame([(1, "a.com", "x", "y")], "record_id long, domain string, id string, key string")
    att = spark.createDataFrame([(1, "a.com", "x", 5)], "attempt_id long, domain string, key_hash string, origin int")
    ids, _ = seen_keys.seen_before(acc, att, "domain", "attempt_id")
    assert [r.id for r in ids.collect()] == [1]
