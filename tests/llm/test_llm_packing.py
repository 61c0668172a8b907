import random
from collections import Counter, defaultdict

from zonewright.llm import packing, queries
from zonewright.llm.tokens import VOCABULARY, _encoding

S = "doc_id long, tokens long"


def check(spark, sizes, capacity=100):
    packed, plan = packing.pack(spark.createDataFrame(list(enumerate(sizes)), S), "doc_id", "tokens", capacity)
    rows = packed.collect()
    load, whole, pieces = Counter(), Counter(), defaultdict(list)
    for r in rows:
        whole[r.doc_id] += r.tokens
        pieces[r.doc_id].append(r.tokens)
        if r.tokens:
            load[r.container] += r.tokens
        else:
            assert r.container is None
    assert all(whole[i] == (n or 0) for i, n in enumerate(sizes)) and len(whole) == len(sizes)
    assert all(len(pieces[i]) == max(1, -(-(n or 0) // capacity)) for i, n in enumerate(sizes))
    assert set(load) == set(range(plan.containers)) and max(load.values(), default=0) <= capacity
    return plan, load


def test_random_sizes_fill_well(spark):
    rng = random.Random(3)
    sizes = [rng.randint(1, 100) if rng.random() < 0.9 else rng.randint(100, 450) for _ in range(3000)]
    plan, _ = check(spark, sizes)
    assert plan.containers <= 1.02 * sum(sizes) / 100 + 1 and sum(plan.fixed_sets.values()) > 0


def test_edges(spark):
    plan, _ = check(spark, [0, None, 100, 101, 200, 1, 99, 50, 50, 51, 49] + [7] * 300)
    assert plan.containers <= 30
    check(spark, [])
    check(spark, [0, 0])
    check(spark, [60] * 9)
    check(spark, [34, 34, 34, 33, 33])


def test_dominance_is_optimal_where_it_decides(spark):
    for counts, best in (({60: 5, 40: 5}, 5), ({90: 3, 80: 2}, 5), ({50: 7}, 4), ({70: 2, 30: 1, 20: 1}, 2), ({51: 4, 49: 2, 25: 4}, 5)):
        plan = packing.plan_containers(counts, 100)
        assert plan.containers == best, (counts, plan.runs)


def fewest(items, capacity):
    best = len(items)

    def place(at, free):
        nonlocal best
        if len(free) >= best:
            return
        if at == len(items):
            best = len(free)
            return
        for room in {f for f in free if f >= items[at]}:
            rest = list(free)
            rest.remove(room)
            place(at + 1, [*rest, room - items[at]])
        place(at + 1, [*free, capacity - items[at]])

    items = sorted(items, reverse=True)
    place(0, [])
    return best


def test_fixed_sets_cost_no_container():
    rng = random.Random(1)
    sets = Counter()
    for _ in range(400):
        capacity = rng.choice([10, 20, 30])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        plan = packing._Plan(dict(Counter(items)))
        packing.reduce_instance(plan, capacity)
        rest = [s for s, n in plan.left.items() for _ in range(n)]
        assert plan.containers + fewest(rest, capacity) == fewest(items, capacity), (capacity, items)
        assert packing.fewest_containers(Counter(items), capacity) <= fewest(items, capacity)
        sets.update(plan.fixed_sets)
    assert all(sets[n] for n in (1, 2, 3))


def test_plan_never_overfills():
    rng = random.Random(9)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 12) for _ in range(rng.randint(1, 12))}
        plan = packing.plan_containers(counts, 30)
        load, placed = Counter(), Counter()
        for size, rank, n, first, each in plan.runs:
            assert rank == placed[size]
            placed[size] += n
            for i in range(n):
                load[first + i // each] += size
        assert placed == Counter(counts) and max(load.values()) <= 30 and len(load) == plan.containers


def test_query(spark):
    d = "/root/testdata/sf0.001"
    enc = _encoding(VOCABULARY)
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id for r in docs if len(enc.encode_ordinary(r.text or "")) > 2048}
    assert {r.doc_id for r in queries.p6_found(spark, d).collect()} == want


def test_report(spark):
    r = queries.p6_report(spark, "/root/testdata/sf0.001").first()
    assert r.fewest_by_volume <= r.fewest_proven <= r.containers <= r.best_fit_alone
