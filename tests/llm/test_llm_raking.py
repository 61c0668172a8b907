from collections import Counter

from pyspark.sql import functions as F

from zonewright.llm import queries, raking

ROWS = "run long, cat string, id long, tld string"


def draw(spark, rows, targets, **kw):
    out = raking.draw(spark.createDataFrame(rows, ROWS), spark.createDataFrame(targets, "run long, cat string, target long"), "run", "cat", "id", ["tld"], **kw)
    return out.sample, {(r.run, r.cat): r for r in out.report.collect()}


def population():
    rows = []
    for i in range(3000):
        cat = "hot" if i % 3 == 0 else f"c{i % 7}"
        rows.append((i % 2, cat, i, "com" if (i * 7919) % 10 < 6 else "org"))
    return rows


def test_quotas_are_met_and_gaps_reported(spark):
    rows = population()
    have = Counter((r[0], r[1]) for r in rows)
    targets = [(0, "hot", 100), (0, "c1", 10**6), (1, "c2", 0), (1, "none", 7), (1, "c3", None), (1, "hot", 60)]
    sample, report = draw(spark, rows, targets)
    got = Counter((r.run, r.cat) for r in sample.collect())
    for key, n in have.items():
        t = {(a, b): c for a, b, c in targets}.get(key) or 0
        assert got[key] == min(max(t, 1), n) == report[key].sampled
    assert report[0, "c1"].gap == 10**6 - have[0, "c1"] and report[1, "none"].gap == 7
    assert report[1, "c3"].gap is None and report[1, "c2"].gap == 0


def test_second_margin_follows_the_population(spark):
    rows = [(1, "a" if i < 9000 else "b", i, "x" if i % 10 < (8 if i < 9000 else 4) else "y") for i in range(10_000)]
    sample, _ = draw(spark, rows, [(1, "a", 200), (1, "b", 200)])
    share = 0.76  # of x in all rows; an unraked draw would have 0.6
    tld = {r[2]: r[3] for r in rows}
    got = Counter(tld[r.id] for r in sample.collect())
    assert sum(got.values()) == 400 and abs(got["x"] / 400 - share) < 0.06


def test_margins_that_cannot_be_met_together_are_told(spark):
    rows = [(1, "big", i, "x" if i < 100 else "y") for i in range(19_900)] + [(1, "small", 20_000 + i, "x") for i in range(100)]
    out = raking.draw(spark.createDataFrame(rows, ROWS), spark.createDataFrame([(1, "big", 200), (1, "small", 100)], "run long, cat string, target long"), "run", "cat", "id", ["tld"])
    told = {(r.margin, r.value): r for r in out.margins.collect()}
    x = told["tld", "x"]
    assert abs(x.target - 3) < 1e-9 and x.sampled >= 100 and x.residual >= 97 and not x.settled
    assert told["cat", "small"].settled and told["cat", "small"].residual == 0 == told["cat", "big"].residual
    assert sum(r.sampled for r in told.values()) == 600 and {r.gap for r in out.report.collect()} == {0}


def test_minimum_is_repaired_after_the_draw(spark):
    rows = population()
    sample, report = draw(spark, rows, [(0, "hot", 100), (1, "c2", 0)], minimum=3)
    got = [r for r in sample.collect() if r.repaired]
    assert {(r.run, r.cat) for r in got} == {k for k in report if k != (0, "hot")} and len(got) == 3 * (len(report) - 1)
    assert {r.gap for r in report.values() if r.target is not None} == {0}


def test_rake_fits_all_margins(spark):
    cells = spark.createDataFrame([("a", "x", 10, 30.0, 40.0), ("a", "y", 20, 30.0, 20.0), ("b", "x", 30, 30.0, 40.0), ("b", "y", 40, 30.0, 20.0)], "g string, h string, n long, tg double, th double")
    out = raking.rake(cells, [(["g"], "tg"), (["h"], "th")], rounds=6).collect()
    for col, i in (("g", "tg"), ("h", "th")):
        for v in {r[col] for r in out}:
            mine = [r for r in out if r[col] == v]
            assert abs(sum(r.n * r.weight for r in mine) - mine[0][i]) < 0.3


def test_edges(spark):
    rows = [(1, None, 1, "x"), (None, "a", 2, "x"), (1, "a", 3, None), (1, "a", 4, ""), (1, "t" * 5000, 5, "x"), (1, "a", 3, None)]
    sample, report = draw(spark, rows, [(1, "a", 2), (None, "a", 5), (1, None, 5)])
    assert set(report) == {(1, "a"), (1, "t" * 5000)}
    assert report[1, "a"].sampled == 2 and sample.count() == 3


def test_empty(spark):
    sample, report = draw(spark, [], [(1, "a", 2), (1, "b", None)])
    assert sample.count() == 0 and report[1, "a"].gap == 2 and report[1, "b"].gap is None
    sample, report = draw(spark, [], [])
    assert sample.count() == 0 and not report


def test_same_sample_on_any_partitioning(spark):
    rows = population()
    targets = spark.createDataFrame([(0, "hot", 50), (1, "c2", 20)], "run long, cat string, target long")
    ids = []
    for parts in (1, 7):
        df = spark.createDataFrame(rows, ROWS).repartition(parts)
        ids.append(sorted(r.id for r in raking.draw(df, targets, "run", "cat", "id", ["tld"]).sample.collect()))
    assert ids[0] == ids[1]


def test_query_equals_counting(spark):
    d = "/root/testdata/sf0.001"
    got = sorted(tuple(r) for r in queries.p3_found(spark, d).collect())
    spark.read.parquet(f"{d}/domains.parquet").createOrReplaceTempView("dom")
    spark.read.parquet(f"{d}/algorithm_plan.parquet").createOrReplaceTempView("plan")
    codes = spark.sql(
        """WITH p AS (SELECT run_id, lower(trim(algorithm_code)) k, max_by(planned_quota, updated_at) q FROM plan WHERE trim(algorithm_code) <> '' GROUP BY 1, 2),
        n AS (SELECT run_id, lower(trim(algorithm_code)) k, count(*) n FROM dom GROUP BY 1, 2) SELECT run_id, k FROM p LEFT JOIN n USING (run_id, k) WHERE q > coalesce(n, 0)"""
    )
    want = [tuple(r) for r in codes.collect()]
    loaded = spark.createDataFrame([], "file_id long")
    from zonewright.operators import rejects

    loaded = rejects.loaded_lines(spark.read.parquet(f"{d}/raw_lines.parquet"), spark.read.parquet(f"{d}/parse_config.parquet")).groupBy("file_id").count()
    quotas = spark.read.parquet(f"{d}/file_stats.parquet").select("run_id", "path", "file_id", "quota").distinct()
    want += [(r.run_id, r.path) for r in quotas.join(loaded, "file_id", "left").where(F.col("quota") > F.coalesce("count", F.lit(0))).collect()]
    assert got == sorted(want)
