"""Filling containers of fixed capacity with documents, little space left, none split needlessly.

Only sizes matter, and a size is a whole number up to the capacity, so the instance is a histogram
of at most ``capacity`` counts: it is aggregated by Spark, and planned on the driver, whatever the
number of documents. The plan names for each size which of its documents, by rank, go where:

1. A document longer than the capacity fills whole containers; its remainder joins the others.
2. Dominance reduction: a set {j, ...} dominates if the documents of any other set with j can be parted so
   that each part takes the place of one document of the dominating set. It is then fixed for good, for as
   many documents as there are of each, and the instance shrinks. Sets of up to three are tried for each
   size j: {j} if nothing fits beside it; {j, i} with i the largest partner, if no rest that fits holds more
   than i (decided exactly, by subset sums); {j, i, k} if at most two fit beside j, i is the largest
   partner, k the largest beside both, and in no pair beside j both are larger than k. Sizes that were not decided are tried again
   whenever something was fixed, until nothing is.
3. The remainder is packed best-fit by falling size, on groups of containers with equal free space.

Ranks of equal sizes come from distributed prefix sums, so a frequent size is no hot spot.
"""

from __future__ import annotations

from bisect import bisect_right, insort

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cuts
from ..session import materialize

CAPACITY = 2048


class _Plan:
    """Runs of containers and which ranks of a size they take."""

    def __init__(self, counts: dict[int, int]):
        self.left = dict(counts)
        self.used = dict.fromkeys(counts, 0)
        self.containers = 0
        self.fixed_sets: dict[int, int] = {}  # containers fixed by dominance, by the size of their set; full pieces need none
        self.runs: list[tuple[int, int, int, int, int]] = []  # size, first rank, documents, first container, documents a container

    def open(self, n: int) -> int:
        self.containers += n
        return self.containers - n

    def put(self, size: int, first: int, n: int, each: int = 1) -> None:
        """``each`` documents of ``size`` into each of ``n`` containers from ``first``."""
        self.runs.append((size, self.used[size], n * each, first, each))
        self.used[size] += n * each
        self.left[size] -= n * each


def _taken_greedily(sizes: list[int], left: dict[int, int], room: int, j: int) -> int:
    """A sum of documents at hand beside one of ``j`` that fits: largest first."""
    total = 0
    for s in reversed(sizes[: bisect_right(sizes, room)]):
        total += min(left[s] - (s == j), (room - total) // s) * s
    return total


def _fullest_rest(sizes: list[int], left: dict[int, int], room: int, j: int) -> int:
    """Largest sum of the documents at hand, beside one of size ``j``, that is at most ``room``:
    subset sums as the bits of one number, counts doubled up."""
    sums, mask = 1, (1 << (room + 1)) - 1
    for s in reversed(sizes[: bisect_right(sizes, room)]):
        n, step = min(left[s] - (s == j), room // s), 1
        while n > 0:
            take = min(step, n)
            sums |= (sums << (s * take)) & mask
            n, step = n - take, step * 2
        if sums >> room & 1:
            return room
    return sums.bit_length() - 1


class _Stock:
    """Documents that are left beside some that are taken."""

    def __init__(self, sizes: list[int], left: dict[int, int], taken: list[int]):
        self.sizes, self.n = sizes, lambda s: left[s] - taken.count(s)

    def largest(self, room: int) -> int:
        """The largest size of at most ``room``, 0 if there is none."""
        at = bisect_right(self.sizes, room)
        while at and not self.n(self.sizes[at - 1]):
            at -= 1
        return self.sizes[at - 1] if at else 0

    def smallest(self, k: int) -> list[int]:
        out: list[int] = []
        for s in self.sizes:
            out += [s] * min(self.n(s), k - len(out))
            if len(out) == k:
                break
        return out

    def best_pair(self, room: int) -> int:
        """The largest smaller half of a pair that fits, 0 if no pair does."""
        for s in reversed(self.sizes[: bisect_right(self.sizes, room // 2)]):
            if self.n(s) > 1 or self.n(s) and self._above(s, room - s):
                return s
        return 0

    def _above(self, s: int, most: int) -> bool:
        return any(self.n(x) for x in self.sizes[bisect_right(self.sizes, s) : bisect_right(self.sizes, most)])


def dominating_set(sizes: list[int], left: dict[int, int], j: int, capacity: int) -> list[int] | None:
    """Up to three sizes, ``j`` first, that dominate every other set with ``j``; None if none is found."""
    room = capacity - j
    partner = _Stock(sizes, left, [j]).largest(room)
    if not partner:
        return [j]
    if _taken_greedily(sizes, left, room, j) <= partner and _fullest_rest(sizes, left, room, j) <= partner:
        return [j, partner]
    beside = _Stock(sizes, left, [j])
    three = beside.smallest(3)
    if len(three) == 3 and sum(three) <= room:
        return None
    third = _Stock(sizes, left, [j, partner]).largest(room - partner)
    return [j, partner, third] if third and beside.best_pair(room) <= third else None


def reduce_instance(plan: _Plan, capacity: int) -> None:
    """Fix dominating sets, from the largest size down, until a pass over all sizes finds none."""
    while True:
        before = plan.containers
        for j in sorted((s for s, n in plan.left.items() if n), reverse=True):
            while plan.left[j]:
                sizes = sorted(s for s, n in plan.left.items() if n)
                chosen = dominating_set(sizes, plan.left, j, capacity)
                if chosen is None:
                    break
                each = {s: chosen.count(s) for s in chosen}
                n = min(plan.left[s] // k for s, k in each.items())
                first = plan.open(n)
                for s, k in each.items():
                    plan.put(s, first, n, k)
                plan.fixed_sets[len(chosen)] = plan.fixed_sets.get(len(chosen), 0) + (0 if j == capacity else n)
        if plan.containers == before:
            return


def best_fit(plan: _Plan, capacity: int) -> None:
    """Best-fit by falling size; containers with equal free space are one group of runs."""
    free: dict[int, list[tuple[int, int]]] = {}  # free space -> runs of (first container, containers)
    rooms: list[int] = []

    def give(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in free:
                free[room] = []
                insort(rooms, room)
            free[room].append((first, n))

    for size in sorted((s for s, n in plan.left.items() if n), reverse=True):
        while plan.left[size]:
            at = bisect_right(rooms, size - 1)
            if at == len(rooms):
                each = capacity // size
                n, rest = divmod(plan.left[size], each)
                if n:
                    first = plan.open(n)
                    plan.put(size, first, n, each)
                    give(capacity - size * each, first, n)
                if rest:
                    first = plan.open(1)
                    plan.put(size, first, 1, rest)
                    give(capacity - size * rest, first, 1)
                continue
            room = rooms[at]
            first, n = free[room].pop()
            if not free[room]:
                del free[room], rooms[at]
            each = min(room // size, plan.left[size])
            take = min(n, plan.left[size] // each)
            plan.put(size, first, take, each)
            give(room - size * each, first, take)
            give(room, first + take, n - take)


def plan_containers(counts: dict[int, int], capacity: int = CAPACITY) -> _Plan:
    """Plan for documents of sizes 1 to ``capacity``, given how many there are of each."""
    plan = _Plan(counts)
    reduce_instance(plan, capacity)
    best_fit(plan, capacity)
    return plan


def plain_best_fit(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """Containers that best-fit alone would need."""
    plan = _Plan(counts)
    best_fit(plan, capacity)
    return plan.containers


def fewest_containers(counts: dict[int, int], capacity: int = CAPACITY) -> int:
    """A proven lower bound: for each a up to half the capacity, documents above capacity - a need a container each,
    as do those above half, and what the free space of the latter cannot hold of the sizes from a on needs more."""
    best, half = 0, capacity // 2
    for a in {0, *(s for s in counts if s <= half)}:
        alone = sum(n for s, n in counts.items() if s > capacity - a)
        big = {s: n for s, n in counts.items() if half < s <= capacity - a}
        middle = sum(s * n for s, n in counts.items() if a <= s <= half)
        free = sum((capacity - s) * n for s, n in big.items())
        best = max(best, alone + sum(big.values()) + max(0, -(-(middle - free) // capacity)))
    return best


def pieces(docs: DataFrame, doc_id: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, n_pieces, tokens``: one piece a document, more only if it exceeds the capacity."""
    whole = F.coalesce(F.col(size), F.lit(0))
    n = F.greatest(F.ceil(whole / capacity), F.lit(1)).cast("int")
    part = docs.select(F.col(doc_id).alias("doc_id"), whole.alias("all_"), n.alias("n_pieces"))
    part = part.select("*", F.explode(F.sequence(F.lit(0), F.col("n_pieces") - 1)).alias("piece"))
    return part.select("doc_id", "piece", "n_pieces", F.least(F.col("all_") - F.col("piece") * capacity, F.lit(capacity)).alias("tokens"))


def pack(docs: DataFrame, doc_id: str, size: str, capacity: int = CAPACITY) -> tuple[DataFrame, _Plan]:
    """``doc_id, piece, n_pieces, tokens, container`` of every piece, and the plan.

    ``doc_id`` must be unique. Documents without tokens (null counts as 0) need no
    container: theirs is null. No
    documents give no rows. Containers are numbered from 0 without gaps.
    """
    spark: SparkSession = docs.sparkSession
    parts = materialize(pieces(docs, doc_id, size, capacity), "pieces")
    # at most `capacity` rows, whatever the number of documents
    counts = {r[0]: r[1] for r in parts.where("tokens > 0").groupBy("tokens").count().collect()}
    plan = plan_containers(counts, capacity)
    plan.counts = counts
    rows = parts.withColumn("place_", cuts.unit_hash(F.col("doc_id"), F.col("piece"))).withColumn("tie_", F.struct("doc_id", "piece"))
    ranked = cuts.prefix_sums(rows.where("tokens > 0"), ["tokens"], "place_", "tie_", F.lit(1))
    runs = spark.createDataFrame(plan.runs or [], "size_run int, rank0 bigint, n_run bigint, container0 bigint, each_run int")
    # the runs of a size: few, as each plan step makes one; bounded by the steps, not the documents
    inside = (F.col("tokens") == F.col("size_run")) & (F.col("before_") >= F.col("rank0")) & (F.col("before_") < F.col("rank0") + F.col("n_run"))
    placed = ranked.join(F.broadcast(runs) if len(plan.runs) <= 200 * capacity else runs, inside)
    container = F.col("container0") + ((F.col("before_") - F.col("rank0")) / F.col("each_run")).cast("bigint")
    columns = ["doc_id", "piece", "n_pieces", "tokens"]
    empty = parts.where("tokens = 0").select(*columns, F.lit(None).cast("bigint").alias("container"))
    return placed.select(*columns, container.alias("container")).unionByName(empty), plan
