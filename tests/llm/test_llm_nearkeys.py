import random
from collections import Counter

from plain import strict_name
from pyspark.sql import functions as F

from zonewright.llm import nearkeys, queries

S = "record_id long, domain string, batch_id long"


def near(a, b):
    """Whether at most two edits part two texts."""
    if abs(len(a) - len(b)) > 2:
        return False
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] <= 2


def plain(old, new):
    rows = [(i, strict_name(x), False) for i, x in old] + [(i, strict_name(x), True) for i, x, _ in new]
    rows = sorted({r for r in rows if r[1] and r[0] is not None})
    return {(a[0], b[0]) for k, a in enumerate(rows) for b in rows[k + 1 :] if b[2] and a[0] != b[0] and near(a[1], b[1])}


def pairs(spark, old, new, steps=2):
    a = spark.createDataFrame(old, "record_id long, domain string")
    got = [tuple(r) for r in nearkeys.near_pairs(a, spark.createDataFrame(new, S), "domain", "record_id", "batch_id", steps).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_random_names_of_any_length(spark):
    rng = random.Random(5)

    def name():
        return "".join(rng.choice("ab.") for _ in range(rng.randint(1, 14))).strip(".") or "a"

    def edit(x):
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(x) + 1)
            x = rng.choice([x[:at] + "b" + x[at:], x[:at] + x[at + 1 :], x[:at] + "c" + x[at + 1 :]]) or "a"
        return x

    old = [(i, name()) for i in range(120)]
    new = [(1000 + i, edit(rng.choice(old)[1]) if i % 2 else name(), i // 30) for i in range(120)]
    for steps in (1, 4):
        assert pairs(spark, old, new, steps) == plain(old, new)


def test_edges(spark):
    long = "ab" * 5000 + ".com"
    old = [(1, "example.com"), (2, None), (3, ""), (4, long), (5, "aaaaaaaaaaaaaaaaaaaa.com"), (None, "example.com"), (6, "BÜCHER.de")]
    new = [(11, "exomple.con", 1), (12, None, 1), (13, " ", 1), (14, long[:-1], None), (15, "aaaaaaaaaaaaaaaaaa.com", 2), (16, "EXAMPLE.COM.", 3), (17, "xn--bcher-kva.de", 3), (16, "EXAMPLE.COM.", 3), (18, "example.com", 4)]
    assert pairs(spark, old, new) == plain(old, new)


def test_group_of_copies(spark):
    old = [(1, "copy.example")]
    new = [(10 + i, "copy.example" if i % 3 else "copy.exampla", i // 10) for i in range(40)]
    got = pairs(spark, old, new)
    assert got == plain(old, new) and len(got) == 40 + 40 * 39 // 2


def test_empty(spark):
    assert pairs(spark, [], []) == set()
    assert pairs(spark, [(1, "a.com")], []) == set()
    assert pairs(spark, [], [(1, "a.com", 1), (2, "b.com", 1)]) == {(1, 2)}


def test_whole_tables(spark):
    d = "/root/testdata/sf0.001"
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{d}/{t}.parquet").select(*c).collect()]
    got = {tuple(r) for r in queries.p5_found(spark, d).collect()}
    assert got == plain(read("domains", "record_id", "domain"), read("new_batch", "record_id", "domain", "batch_id"))


def test_history_is_neither_moved_nor_sorted_again(spark):
    names = lambda a, b: spark.range(a, b).select(F.concat(F.lit("name"), "id", F.lit(".example")).alias("name"), "id", F.lit(False).alias("fresh"))
    index = nearkeys.NearKeyIndex(spark, nearkeys.gram_sketch(names(0, 500)), buckets=4)
    index.take(names(0, 500))
    batch = names(490, 520)
    tokens = index.take(batch)
    plan = index.near(tokens)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2
    # an exchange and a sort for the batch at each table, none for the table
    assert plan.count("Exchange hashpartitioning(gram") == plan.count("Sort [gram") <= 2
    links = spark.createDataFrame([("name1.example", "name2.example")], "name string, other string")
    plan = index.pairs(batch, links)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Sort [name#") - plan.count("Sort [name#") // 2 <= plan.count("SortMergeJoin")


def test_another_session_goes_on_from_the_tables(spark, tmp_path):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcd") for _ in range(rng.randint(4, 12))) + ".com"
    old = [(i, word()) for i in range(150)]
    new = [(1000 + i, (rng.choice(old)[1] if i % 2 else word()).replace("a", "b", 1), i // 10) for i in range(90)]
    path = f"file://{tmp_path}/index"
    first = nearkeys.index_of(spark.createDataFrame(old, "record_id long, domain string"), "domain", "record_id", path=path)
    first.save()
    got = set()
    for batch in range(9):
        index = nearkeys.NearKeyIndex.attach(spark, path)  # accepted rows are out of reach from here on
        rows = nearkeys.keyed_rows(spark.createDataFrame([r for r in new if r[2] == batch], S), "domain", "record_id", True)
        got |= {tuple(r) for r in index.pairs(rows, index.check(rows)).collect()}
        index.save()
    assert got == plain(old, new)
    assert all(len(t) < 8 for t in index.tables.values()) and max(t["level"] for t in index.tables["postings"]) >= 1
    index.drop()


def test_frequent_grams_are_split(spark, monkeypatch):
    monkeypatch.setattr(nearkeys, "NAMES_PER_PART", 20)
    old = [(i, f"commonstem{i:03d}.example") for i in range(150)]
    new = [(1000 + i, f"commonstem{i * 3:03d}.exampl", 1) for i in range(40)]
    assert pairs(spark, old, new) == plain(old, new)


def test_classes(spark):
    old = [(1, "copy.example"), (2, "copy.example"), (3, "other.test"), (4, None), (5, "xopy.example")]
    new = [(10 + i, "copy.example" if i % 3 else "copy.exampla", i // 10) for i in range(40)] + [(99, "lonely-name.org", 1), (98, "", 1), (10, "copy.exampla", 0)]
    members, links = nearkeys.near_classes(spark.createDataFrame(old, "record_id long, domain string"), spark.createDataFrame(new, S), "domain", "record_id", "batch_id")
    got = {r.id: r for r in members.collect()}
    names = {i: strict_name(x) for i, x in old} | {i: strict_name(x) for i, x, _ in new}
    names = {i: x for i, x in names.items() if x}
    size = Counter(names.values())
    assert got.keys() == names.keys()
    batch = {strict_name(x) for _, x, _ in new}
    for i, x in names.items():
        assert got[i].class_id == min(k for k, y in names.items() if y == x) and got[i].copies == size[x]
        assert got[i].links == sum(y != x and near(x, y) and (x in batch or y in batch) for y in size)
    assert sorted(map(tuple, links.collect())) == [(1, 5), (1, 10), (5, 10)]
