import hashlib
import random
from collections import Counter
from math import gcd

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from zonewright.functions import hashing, names, registry
from zonewright.operators import balance, combine, cuts, dedup, quota, sampling, space, stats, validate
from zonewright.plans import reference

COUNTS = st.lists(st.integers(0, 10**9), min_size=1, max_size=20).filter(sum)


# -- quotas


def test_allocation_goldens():
    assert quota.allocate([3, 2, 1], 10) == [5, 3, 2]
    assert quota.allocate([1, 1, 1], 2) == [1, 1, 0]
    assert quota.allocate([], 5) == [] and quota.split_even(10, 3) == [4, 3, 3]
    for bad in (lambda: quota.allocate([1], 0), lambda: quota.allocate([0, 0], 3)):
        with pytest.raises(ValueError):
            bad()


@given(COUNTS, st.integers(1, 10**6))
def test_allocation_adds_up(counts, target):
    got = quota.allocate(counts, target)
    assert sum(got) == target
    assert all(abs(q - target * c / sum(counts)) <= 1.0001 for q, c in zip(got, counts))


@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 50)), min_size=1, max_size=8).filter(lambda x: sum(a + b for a, b in x)), st.integers(1, 300))
def test_filling_reaches_what_there_is(sources, target):
    capacities, rows = [a for a, _ in sources], [a + b for a, b in sources]
    taken, short = quota.fill_quotas(capacities, rows, target)
    assert sum(taken) + short == target and all(t <= c for t, c in zip(taken, capacities))


def test_redistribution_fixture():
    assert quota.fill_quotas([0, 6], [4, 6], 6) == ([0, 6], 0)
    assert quota.redistribute(5, [0, 0]) == [3, 2] and quota.redistribute(0, [1]) == [0]


def test_even_plan():
    plan = quota.plan_evenly([("a", "c1", None), ("b", "c1", None), ("c", "c2", None)], 10)
    assert plan == {"a": 3, "b": 2, "c": 5} and quota.plan_evenly([("a", None, 3)], 10) == {"a": 3}


def test_window_allocation_equals_driver(spark):
    counts = [3, 2, 1, 0, 7, 7, None]
    df = spark.createDataFrame(list(enumerate(counts)), "i int, n int")
    got = [r.quota for r in quota.largest_remainder(df, "n", 11, "i").orderBy("i").collect()]
    assert got == quota.allocate([c or 0 for c in counts], 11)
    assert quota.largest_remainder(df.where("n = 0"), "n", 5, "i").first().quota is None
    assert quota.largest_remainder(df.limit(0), "n", 5, "i").count() == 0


def test_proportional_reduction(spark):
    rows = [(f"n{i}.com", "a" if i % 10 else "b") for i in range(1000)]
    got = quota.reduce_proportionally(spark.createDataFrame(rows, "domain string, k string"), "k", "domain", 101).collect()
    assert Counter(r.k for r in got) == {"a": 91, "b": 10}
    want = sorted((d for d, k in rows if k == "b"), key=lambda d: hashlib.sha256(f"42:b:{d}".encode()).hexdigest())[:10]
    assert sorted(r.domain for r in got if r.k == "b") == sorted(want)


# -- prefix sums and sampling


@pytest.mark.parametrize("per_range", [1, 7, 10_000])
def test_prefix_sums(spark, per_range):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "x", None]), rng.random(), i, rng.choice([None, 0, 3, 5])) for i in range(800)]
    df = spark.createDataFrame(rows, "g string, p double, i int, s int")
    got = {r.i: (r.before_, r.group_total_) for r in cuts.prefix_sums(df, ["g"], "p", "i", F.col("s"), per_range).collect()}
    assert len(got) == 800
    for g in {r[0] for r in rows}:
        run = 0
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        total = sum(r[3] or 0 for r in mine)
        for r in mine:
            assert got[r[2]] == (run, total)
            run += r[3] or 0


def test_first_n(spark):
    values = random.Random(2).sample(range(10**9), 3000)
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v long")
    for n in (0, 1, 1234, 3000, 9999):
        assert sorted(r.v for r in sampling.first_n(df, "v", n).collect()) == sorted(values)[:n]
    assert sampling.first_n(df.limit(0), "v", 5).count() == 0


def test_bottom_k(spark):
    df = spark.createDataFrame([(str(i), i % 3) for i in range(900)], "n string, g int")
    want = sorted(map(str, range(900)), key=lambda x: hashlib.sha256(f"42:{x}".encode()).hexdigest())[:50]
    assert sorted(r.n for r in sampling.bottom_k(df.repartition(5), "n", 50).collect()) == sorted(want)
    assert Counter(r.g for r in sampling.bottom_k(df, "n", 7, group=["g"]).collect()) == {0: 7, 1: 7, 2: 7}


@given(st.integers(1, 2000), st.integers(0, 2**64 - 1))
def test_stride_visits_every_line(total, seed):
    start, step = sampling.stride(total, seed)
    assert gcd(step, total) == 1 and len({(start + i * step) % total for i in range(total)}) == total


def test_walks_visit_each_line_of_a_file_once(spark):
    rows = reference.queries()["stride_walk_by_file"](spark, "/root/testdata/sf0.001").collect()
    of = {}
    for r in rows:
        of.setdefault(r.file_id, {})[r.line_no] = r.visit
    for file_id, visits in of.items():
        n = len(visits)
        start, step = sampling.stride(n, sampling.seed_of(42, str(file_id)))
        assert all(visits[(start + i * step) % n + 1] == i for i in range(n))


def test_stride_order(spark):
    total, start, step = 1000, 17, 333
    got = {r.id: r.o for r in spark.range(total).select("id", sampling.stride_order(F.col("id"), total, start, step).alias("o")).collect()}
    assert all(got[(start + i * step) % total] == i for i in range(total))


def test_refill(spark):
    pool = spark.createDataFrame([("a", f"a{i}") for i in range(3)] + [("b", f"b{i}") for i in range(30)], "k string, d string")
    weights = spark.createDataFrame([("a", 1), ("b", 9), ("gone", 50)], "k string, weight long")
    rows = sampling.refill(pool, "k", "d", weights, 2000).collect()
    assert sorted(r.slot for r in rows) == list(range(2000)) and 100 < sum(r.source == "a" for r in rows) < 320
    assert {r.name for r in rows} == {r.d for r in pool.collect()}
    assert sampling.refill(pool.limit(0), "k", "d", weights, 5).count() == 0


# -- hashing


def test_split(spark):
    rows = spark.range(10_000).select(F.concat(F.lit("domain-"), "id", F.lit(".example")).alias("d")).select("d", hashing.split_of("d").alias("s")).collect()
    for r in rows[:500]:
        u = int.from_bytes(hashlib.sha256(f"42:{r.d}".encode()).digest()[:8], "big") / (2**64 - 1)
        assert r.s == ("train" if u < 0.8 else "validation" if u < 0.9 else "test")
    n = Counter(r.s for r in rows)
    assert abs(n["train"] - 8000) < 300 and abs(n["test"] - 1000) < 200
    with pytest.raises(ValueError):
        hashing.split_of("d", 1, 0.9, 0.1, 0.1)


def test_seeds(spark):
    row = spark.range(1).select(hashing.stable_seed(42, F.lit("/a/b.txt")), hashing.int_seed(F.lit("x"))).first()
    assert int(row[0]) == sampling.seed_of(42, "/a/b.txt") and row[1] == int(hashlib.sha256(b"x").hexdigest()[:8], 16)


# -- duplicates and balance


def test_first_wins_and_store(spark):
    rows = [("a", 3, "late"), ("a", 1, "first"), ("b", 2, None), (None, 0, "x"), ("a", 1, "first")]
    df = spark.createDataFrame(rows, "d string, pos int, alg string")
    got = {r.d: tuple(r) for r in dedup.first_wins(df, "d", "pos").collect()}
    assert got == {"a": ("a", 1, "first"), "b": ("b", 2, None)}
    store = spark.createDataFrame([("a", 0, "old")], df.schema)
    assert [r.d for r in dedup.insert_or_ignore(store, df, "d", "pos").collect()] == ["b"]
    assert dedup.disjoint(df.where("d = 'b'"), store, "d") and not dedup.disjoint(df, store, "d")
    assert dedup.first_wins(df.limit(0), "d", "pos").count() == 0


def sets(spark, gen, listed):
    g = balance.generated_names(spark.createDataFrame(gen, "domain string, code string, pos long"), "domain", "code", "pos")
    b = balance.listed_names(spark.createDataFrame(listed, "domain string, pos long"), "domain", "pos", g)
    return g, b


def test_balance_with_overlap(spark):
    g, b = sets(spark, [("same.com", "kraken", 1), ("bad.com", "banjo", 2)], [("same.com", 1), ("good.com", 2), ("safe.com", 3)])
    rows = balance.balanced(g, b).collect()
    assert Counter(r.label for r in rows) == {1: 2, 0: 2} and {r.domain for r in rows if not r.label} == {"good.com", "safe.com"}


def test_balance_reduces_generated(spark):
    g, b = sets(spark, [("overlap.com", "a", 1), ("x1.com", "a", 2), ("x2.com", "b", 3), ("x3.com", "b", 4), ("", "a", 5), ("x4.com", " ", 6)], [("overlap.com", 1), ("only.com", 2), ("only.com.", 3)])
    rows = balance.balanced(g, b).collect()
    assert len(rows) == 2 and {r.class_value for r in rows if not r.label} == {"com"}
    with pytest.raises(ValueError):
        balance.balanced(g, b.limit(0))


def test_scan_counters_stop_where_the_class_is_full(spark):
    gen = spark.createDataFrame([("g1.com", "a", 1), ("g1.com", "b", 2), ("g2.com", "a", 3), ("bad..com", "a", 4)], "domain string, code string, pos long")
    listed = spark.createDataFrame([("g1.com", "", 1), ("g1.com", "", 2), ("l1.com", "", 3), ("l1.com", "", 4), ("", "", 5), ("l2.com", "", 6), ("l3.com", "", 7)], gen.schema)
    r = balance.selection_counts(gen, listed, "domain", "code", "pos").first()
    assert (r.generated_rows_read, r.generated_invalid, r.generated_duplicates, r.generated_unique) == (4, 1, 1, 2)
    assert (r.listed_rows_read, r.listed_invalid, r.listed_overlap, r.listed_duplicates, r.listed_unique) == (6, 1, 2, 1, 2)


# -- per-key results


def test_heavy_keys(spark):
    keys = ["Hot "] * 50 + ["hot"] * 46 + [None, " ", "x", "y"] + ["edge"] * 4
    df = spark.createDataFrame([(k, 1) for k in keys], "k string, total_rows int")
    got = {r.key_value: (r.n_rows, r.total_rows) for r in combine.key_shares(df, "k").collect()}
    assert got == {"hot": (96, 104), None: (2, 104), "x": (1, 104), "y": (1, 104), "edge": (4, 104)}
    assert [r.key_value for r in combine.heavy_keys(df, "k").collect()] == ["hot"]
    assert combine.heavy_keys(df.limit(0), "k").count() == 0


def test_heavy_key_at_the_threshold(spark):
    df = spark.createDataFrame([("a",)] * 4 + [(None,)] * 96, "k string")
    assert [r.key_value for r in combine.heavy_keys(df, "k").collect()] == ["a"]


def test_states_are_combined_before_the_shuffle(spark):
    plan = combine.key_shares(spark.range(10).select(F.lit("a").alias("k")), "k")._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "Window" not in plan


# -- statistics, spaces, validation


def test_streaks_and_curve(spark):
    df = spark.createDataFrame([(1, [0.1, 0.2, 0.9, 0.1]), (2, [0.9, float("nan")]), (3, [])], "k int, h array<double>")
    assert {r.k: (r.longest_low, r.current_low) for r in stats.streaks(df, ["k"], "h", 0.5).collect()} == {1: (2, 1), 2: (0, 0)}
    rows = spark.createDataFrame([(i, "a" if i > 3 else f"n{i}") for i in range(1, 11)], "i long, d string")
    assert [tuple(r) for r in stats.collision_curve(rows, "d", "i", 5).orderBy("checkpoint").collect()] == [(5, 5, 4, 0.8), (10, 10, 4, 0.0)]


def test_common_suffix(spark):
    df = spark.createDataFrame([("a", "x.net"), ("a", "y.net"), ("b", "only"), ("c", "ab"), ("c", "cd"), ("d", None)], "g string, t string")
    assert {r.g: r.common_suffix for r in stats.common_suffix(df, "g", "t").collect()} == {"a": ".net", "b": "only", "c": "", "d": None}


def test_statuses_and_categories(spark):
    df = spark.createDataFrame([("Parcial", ["Date"], "x"), (None, ["magic"], "x"), ("odd", [], "my-locky"), ("usable", [], "x")], "s string, p array<string>, c string")
    got = [tuple(r) for r in df.select(stats.status(F.col("s")), stats.category_of(F.col("p"), F.col("c"))).collect()]
    assert got == [("partial", "date_based"), ("usable", "seed_based"), ("odd", "known_family"), ("usable", None)]


def test_spaces(spark):
    s = space.slots(spark, 60)
    assert s.select(space.strided(F.col("slot"), 60, 6).alias("x")).distinct().count() == 60
    digits = space.mixed_radix(F.col("slot"), {"a": 5, "b": 3, "c": 4})
    assert s.select(*digits.values()).distinct().count() == 60
    lo, hi = space.date_bounds("2024-01-10", "2024-01-20", "2024-01-01")
    day = F.to_date(F.lit("2024-01-25"))
    got = s.limit(1).select(*[space.bounded(day, lo, hi, p).cast("string") for p in ("clamp", "wrap", "reset")]).first()
    assert tuple(got) == ("2024-01-20", "2024-01-14", "2024-01-10")
    assert s.limit(1).select(space.iso_date(F.lit("junk")).cast("string"), space.clamped_month(F.to_date(F.lit("2024-01-31")), 1).cast("string")).first() == ("2020-01-01", "2024-02-28")


def test_mutation_changes_letters_only(spark):
    df = spark.createDataFrame([("exampleword", i) for i in range(50)], "b string, slot long")
    rows = space.mutated(df, "b", "slot", ["net", "org"]).collect()
    assert all(len(r.domain) == 15 and r.domain[-3:] in ("net", "org") and sum(x != y for x, y in zip(r.domain, r.b)) <= 2 for r in rows)
    assert len({r.domain for r in rows}) > 40


def test_validation(spark):
    reg = registry.FeatureSet([registry.Feature("L_ENTROPY")])
    good = spark.createDataFrame([("a.com", 1.0, "com", 0), ("b.net", 1.0, "alg", 1)], "DOMAIN string, L_ENTROPY double, CLASS string, LABEL int")
    assert validate.validate(good, reg) == []
    bad = spark.createDataFrame([("a.com", 1.0, "net", 0), ("a.com", 1.0, " ", 1), ("c.com", 1.0, "x", 7), ("d.com", 1.0, "x", None)], good.schema)
    errors = " ".join(validate.validate(bad, reg))
    assert all(x in errors for x in ("labels other", "class does not", "both labels")) and "not balanced" not in errors
    assert "old column name" in validate.validate(good.withColumnRenamed("CLASS", "class"), reg)[0]
    assert "checksum" in validate.validate(good, reg, {"feature_name_order_checksum": "x", "feature_definition_checksum": reg.definition_checksum()})[0]


@settings(max_examples=30)
@given(st.text(max_size=20))
def test_python_blanks_are_ours(text):
    assert text.strip() == text.strip(names.BLANKS)


def test_sample_sources(spark):
    pool = spark.createDataFrame([("a", f"a{i}") for i in range(5)] + [("b", f"b{i}") for i in range(50)], "k string, n string")
    quotas = spark.createDataFrame([("a", 12), ("b", 20), ("c", 3)], "k string, quota int")
    assert Counter(r.source for r in sampling.sample_sources(pool, "k", "n", quotas).collect()) == {"a": 5, "b": 20}
    rows = sampling.sample_sources(pool, "k", "n", quotas, replacement=True).collect()
    assert Counter(r.source for r in rows) == {"a": 12, "b": 20} and max(Counter(r.name for r in rows).values()) == 3
