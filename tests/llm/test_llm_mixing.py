import pytest

from zonewright.llm import mixing, queries

D = "doc_id long, source string, tokens long"
T = "source string, target_share double, max_repeats int"


def mix(spark, docs, targets):
    drawn, report = mixing.mix(spark.createDataFrame(docs, D), spark.createDataFrame(targets, T))
    return drawn.collect(), {r.source: r for r in report.collect()}


def test_shares(spark):
    docs = [(i, "Hot " if i % 3 == 0 else f"s{i % 4}", 50 + i % 37) for i in range(4000)]
    total = sum(n for *_, n in docs)
    targets = [("hot", 0.1, 2), ("s0", 0.3, 3), ("s1", 0.35, 3), ("s2", 0.05, 1), ("s3", 0.1, 1), ("gone", 0.1, 9)]
    drawn, report = mix(spark, docs, targets)
    for s, share, cap in targets:
        r = report[s]
        if s == "gone":
            assert not r.reached and r.drawn_tokens == 0 and r.missing_tokens == pytest.approx(share * total)
        else:
            assert r.reached and abs(r.drawn_tokens - share * total) <= 50
        assert all(x.copies <= cap for x in drawn if x.source == s)
    sizes = dict((i, n) for i, _, n in docs)
    assert sum(r.drawn_tokens for r in report.values()) == sum(x.copies * sizes[x.doc_id] for x in drawn)
    assert sum(r.actual_share for r in report.values()) == pytest.approx(1)


def test_cap_and_passes(spark):
    docs = [(1, "a", 10), (2, "a", 10), (3, "b", 80)]
    drawn, report = mix(spark, docs, [("a", 0.5, 2), ("b", 0.5, 1)])
    assert {(x.doc_id, x.copies) for x in drawn} == {(1, 2), (2, 2), (3, 1)} and not report["a"].reached and report["a"].missing_tokens == 10


def test_edges(spark):
    docs = [(1, None, 5), (2, " ", 5), (3, "A　", None), (4, "a", 0), (5, "a", 90), (6, "unasked", 7), (5, "a", 90)]
    drawn, report = mix(spark, docs, [("A", 0.1, None), (None, 0.5, 1), ("z", None, 3), ("a ", 0.2, 2)])
    assert {x.doc_id for x in drawn} <= {5} and set(report) == {"A", "z"} and report["z"].reached
    drawn, report = mix(spark, [], [("a", 0.5, 1)])
    assert not drawn and report["a"].actual_share == 0
    assert mix(spark, [(1, "a", 5)], []) == ([], {})


def test_same_on_any_partitioning(spark):
    docs = spark.createDataFrame([(i, "a", 1 + i % 9) for i in range(999)], D)
    targets = spark.createDataFrame([("a", 0.4, 1)], T)
    one, two = (sorted(map(tuple, mixing.mix(docs.repartition(n), targets)[0].collect())) for n in (1, 6))
    assert one == two


def test_query(spark):
    d = "/root/testdata/sf0.001"
    report = {r.source: r for r in queries.p7_report(spark, d).collect()}
    assert {r.source for r in queries.p7_found(spark, d).collect()} == {s for s, r in report.items() if r.max_repeats * r.stock_tokens < r.budget_tokens}
