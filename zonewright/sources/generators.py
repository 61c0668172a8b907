"""Generated names from user-supplied code, and the run that fills a store with them.

No generator is shipped. User code is trusted code: it runs only when it is passed in explicitly,
in Python workers (``emit``, ``emit_commands``) or as a table function (``table_function``).
"""

from __future__ import annotations

import ast
import io
import json
import logging
import subprocess
import sys
import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import redirect_stdout
from dataclasses import dataclass, field
from itertools import islice
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.names import strict_name, strict_reason
from ..operators import dedup, quota, sampling, space
from ..operators.stats import DATE_PARAMETERS, FAMILIES, SEED_PARAMETERS
from ..session import Scope, materialize, ship_package, shuffle_partitions

# Names by which an entry file and its function are recognised, in this order.
ENTRY_FILES = ("dga.py", "main.py", "generator.py", "dgav2.py", "dgav3.py", "dga_a.py", "dga_b.py")
ENTRY_FUNCTIONS = ("dga", "generate_domains", "get_domains", "create_domain", "next_domain")
# What in a text, in lower case, tells a redirect (the words only beside a URL), and what in its literals a placeholder.
REDIRECTS = ("moved to", "moved into", "implementation moved", "see ", "redirect", "use ")
REDIRECT_WORDS = ("moved",)
PLACEHOLDERS = ("placeholder", "todo", "stub", "not implemented", "coming soon")
# Names of parameters by what they are given, and the lists that some go through.
COUNTERS = ("nr", "n", "num", "count", "domain_nr", "sequence_nr", "day_index", "tld_index", "back", "number")
LENGTHS = ("length", "loops")
VERSIONS, PREFIXES, CONFIGS = ("v1", "v2", "v3", "v4", "v5", "v6", "v7"), ("sn", "al"), ("a", "b", "c")
TLDS, WORDS = ("com", "net", "org", "biz", "info", "ru"), ("alpha", "beta", "gamma", "delta")
#: Names taken from one call of an iterator, which may not end.
MOST_OF_A_CALL = 4096
# Fixed values, by falling yield: least share of new names in the last batch, part of a full batch to ask
# for, least number of names to ask for.
BATCH_STEPS = ((0.8, 1.0, 0), (0.3, 0.5, 500), (0.05, 0.1, 100), (0.0, 0.0, 50))
#: Epochs in a row without a new name that a run of few sources goes through.
LEAST_BARREN = 30
LOG = logging.getLogger(__name__)
EMITTED = "slot bigint, raw string, error string"


@dataclass(frozen=True)
class Found:
    """What a generator's directory tells without running it."""

    code: str
    path: str
    entry: str | None
    function: str | None
    parameters: tuple[str, ...]
    defaults: tuple[str, ...]
    category: str | None
    problem: str | None


def _tree(text: str) -> list[ast.stmt] | None:
    try:
        return ast.parse(text).body
    except (SyntaxError, ValueError):
        return None


def _functions(path: Path) -> dict[str, ast.FunctionDef]:
    body = _tree(path.read_text(encoding="utf-8", errors="replace")) or []
    return {n.name: n for n in body if isinstance(n, ast.FunctionDef)}


def _does_something(body: list[ast.stmt]) -> bool:
    """Whether there is more than texts, ``pass``, ``...`` and raising that it is not implemented."""
    idle = lambda n: (
        isinstance(n, ast.Pass) or isinstance(n, ast.Expr) and isinstance(n.value, ast.Constant)
        or isinstance(n, ast.Raise) and "NotImplementedError" in {getattr(x, "id", None) for x in ast.walk(n)}
    )
    return not all(map(idle, body))


def fault_of(text: str, function: str | None) -> str | None:
    """Why a file is no generator, None if it is one: it must parse, and the function, or else some function, class or
    statement besides imports and assignments, must do something. What does not is a redirect or a placeholder if
    its text says so, a stub if it has code and a missing implementation if it has none."""
    body = _tree(text)
    if body is None:
        return "missing_implementation"
    low = text.lower()
    redirect = any(m in low for m in REDIRECTS) or "://" in low and any(m in low for m in REDIRECT_WORDS)
    if not body:
        return "unresolved_redirect" if redirect else "placeholder_module"
    acts = {n.name for n in body if isinstance(n, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)) and _does_something(n.body)}
    passive = (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef, ast.Import, ast.ImportFrom, ast.Assign, ast.AnnAssign, ast.AugAssign)
    loose = [n for n in body if not isinstance(n, passive)]
    if function in acts if function else acts or _does_something(loose):
        return None
    literals = " ".join(n.value.lower() for n in ast.walk(ast.Module(body, [])) if isinstance(n, ast.Constant) and isinstance(n.value, str))
    stub = any(m in literals for m in PLACEHOLDERS)
    return "unresolved_redirect" if redirect else "invalid_stub" if stub else "missing_implementation"


def category_of(code: str, parameters: Sequence[str]) -> str | None:
    low = {p.lower() for p in parameters}
    if low & set(DATE_PARAMETERS):
        return "date_based"
    if low & set(SEED_PARAMETERS):
        return "seed_based"
    return "known_family" if any(f in code.lower() for f in FAMILIES) else None


def inspect_directory(path: Path) -> Found:
    """Entry file, function and parameters of one generator, read from its syntax tree only."""
    sources = {p.name: p for p in sorted(path.glob("*.py"))}
    known = {name: _functions(p) for name, p in sources.items()}
    entry = next((n for n in ENTRY_FILES if n in sources), None) or next((n for n in sources if "dga" in known[n]), None) or next(iter(sources), None)
    functions = known.get(entry, {})
    name = next((n for n in ENTRY_FUNCTIONS if n in functions), None) or next(iter(functions), None)
    args = functions[name].args if name else None
    every = [a.arg for a in (*args.posonlyargs, *args.args)] if args else []
    with_default = every[len(every) - len(args.defaults) :] if args else []
    required = [a for a in every if a not in with_default]
    problem = "missing_implementation" if not sources else fault_of(sources[entry].read_text(encoding="utf-8", errors="replace"), name)
    return Found(path.name, str(path), entry, name, tuple(required), tuple(with_default), category_of(path.name, every), problem)


def discover(root: str) -> list[Found]:
    """All generators below a directory, by name; one directory each."""
    base = Path(root)
    dirs = [p for p in sorted(base.iterdir()) if p.is_dir() and p.name[0] != "." and p.name != "__pycache__"] if base.exists() else []
    return [inspect_directory(p) for p in dirs]


def common_suffixes_of_examples(spark: SparkSession, paths: list[str], k: int = 10) -> list[str]:
    """The ``k`` commonest TLDs of example lists (a report limit)."""
    names = spark.read.text(paths).select(F.regexp_replace(F.lower(F.trim("value")), r"\.+\z", "").alias("n")).where(F.contains("n", F.lit(".")))
    tld = names.select(F.concat(F.lit("."), F.substring_index("n", ".", -1)).alias("t")).where(F.length("t").between(2, 10))
    return [r.t for r in tld.groupBy("t").count().orderBy(F.desc("count"), "t").limit(k).collect()]


class CutOff(Exception):
    """A call went on after ``MOST_OF_A_CALL`` names."""


def _names_of(call: Callable, arguments: dict) -> Iterator[str]:
    """Names that one call returns or yields, then those it prints. Lists, tuples and sets are taken whole;
    of what may not end, ``MOST_OF_A_CALL`` names, then ``CutOff`` if there are more."""
    printed, more = io.StringIO(), False
    with redirect_stdout(printed):
        result = call(**arguments)
        if result is None:
            names = []
        elif isinstance(result, (list, tuple, set, frozenset)):
            names = [str(x) for x in result]
        elif isinstance(result, str) or not hasattr(result, "__iter__"):
            names = [str(result)]
        else:
            rest = iter(result)
            names = [str(x) for x in islice(rest, MOST_OF_A_CALL)]
            more = len(names) == MOST_OF_A_CALL and next(rest, rest) is not rest
    yield from names
    yield from printed.getvalue().split()
    if more:
        raise CutOff(f"more than {MOST_OF_A_CALL} names")


def emit(slots: DataFrame, call: Callable, arguments: Sequence[str]) -> DataFrame:
    """``slot, raw, error``: ``call`` once a row with the named columns as arguments. It may return
    a name, a collection or an iterator of names, print them, or both. Of an iterator at most
    ``MOST_OF_A_CALL`` are taken; of one that has more, the last row has
    an error too. A call that
    raises gives one row with the error and ends no other."""
    ship_package(slots.sparkSession)
    names = list(arguments)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for row in b.to_dict("records"):
                try:
                    for n in _names_of(call, {a: row[a] for a in names}):
                        out.append((row["slot"], n, None))
                except CutOff as e:
                    out[-1] = (*out[-1][:2], f"CutOff: {e}")
                except Exception as e:  # noqa: BLE001  user code
                    out.append((row["slot"], None, f"{type(e).__name__}: {e}"[:200]))
            yield pd.DataFrame(out, columns=["slot", "raw", "error"]).astype({"slot": "int64"})

    return slots.select("slot", *[n for n in names if n != "slot"]).mapInPandas(run, EMITTED)


def emit_commands(
    slots: DataFrame, command: Sequence[str], arguments: Sequence[str], seconds: float = 10, directory: str | None = None,
    batch_seconds: float | None = None, batch_calls: int | None = None,
) -> DataFrame:
    """As ``emit`` for a program, given the columns as further arguments. Its lines count only if it
    ends well and in time; it is killed when its time is up. No shell is involved. Rows of an Arrow batch that are
    not reached within ``batch_seconds`` or ``batch_calls`` have the error ``not called``."""
    ship_package(slots.sparkSession)
    argv, names = list(command), list(arguments)

    def call(row: dict, left: float) -> list[tuple]:
        try:
            done = subprocess.run([*argv, *[str(row[a]) for a in names]], capture_output=True, text=True, timeout=min(seconds, left), cwd=directory, stdin=subprocess.DEVNULL)
        except subprocess.TimeoutExpired:
            return [(row["slot"], None, "timeout")]
        if done.returncode:
            return [(row["slot"], None, f"exit {done.returncode}")]
        return [(row["slot"], n, None) for n in done.stdout.split()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out, end = [], time.monotonic() + (batch_seconds or float("inf"))
            for i, row in enumerate(b.to_dict("records")):
                left = end - time.monotonic()
                out += call(row, left) if left > 0 and (batch_calls is None or i < batch_calls) else [(row["slot"], None, "not called")]
            yield pd.DataFrame(out, columns=["slot", "raw", "error"]).astype({"slot": "int64"})

    return slots.select("slot", *[n for n in names if n != "slot"]).mapInPandas(run, EMITTED)


def table_function(spark: SparkSession, name: str, call: Callable) -> None:
    """Register ``call(slot)`` for SQL: ``SELECT ... FROM slots, LATERAL name(slot)``. Of a call that yields
    without end it gives ``MOST_OF_A_CALL`` names and no error; ``emit`` tells of the cut."""
    from pyspark.sql.functions import udtf

    ship_package(spark)

    class Emit:
        def eval(self, slot: int):
            try:
                for n in _names_of(lambda s: call(s), {"s": slot}):
                    yield (n,)
            except CutOff:
                pass  # the table has no column for it

    spark.udtf.register(name, udtf(Emit, returnType="raw string"))


def batch_size(full: int, last_yield: float | None, remaining: int) -> int:
    """Names to ask for next, by the share of new names in the last batch; the first is a probe."""
    share, least = next(step[1:] for step in BATCH_STEPS if (last_yield or 0.0) >= step[0])
    return min(max(int(full * share), least), full, max(remaining, 0))


# -- parameters ------------------------------------------------------------------------------


@dataclass(frozen=True)
class Axes:
    """How the seed and the date of a request follow from its slot."""

    seed: str = "sequential"
    date: str = "daily_forward"
    base_seed: int = 0
    base_date: str = "2024-01-01"
    first_date: str = "2018-01-01"
    last_date: str = "2030-12-31"
    policy: str = "clamp"

    def seed_of(self, slot: Column, code: str) -> Column:
        return space.seed_axis(slot, self.seed, self.base_seed, code)

    def date_of(self, slot: Column) -> Column:
        return space.bounded(space.date_axis(slot, self.date, self.base_date), *space.date_bounds(self.first_date, self.last_date, self.base_date), self.policy)


def bound(parameter: str, slot: Column, code: str, axes: Axes = Axes()) -> Column:  # noqa: B008
    """What a parameter of this name is given at a slot; 1 if its name says nothing."""
    n, seed, day = parameter.lower(), axes.seed_of(slot, code), axes.date_of(slot)
    turn = lambda values: F.get(F.array(*map(F.lit, values)), F.pmod(slot, F.lit(len(values))).cast("int"))
    low = seed.bitwiseAND(0xFFFFFFFF)
    known = {
        "seed": seed, "magic": F.when(low == 0, 1).otherwise(low), "year": F.year(day), "month": F.month(day), "day": F.dayofmonth(day),
        "config_nr": F.pmod(slot, F.lit(3)) + 1, "version": turn(VERSIONS), "prefix": turn(PREFIXES), "config": turn(CONFIGS),
        "tlds": F.array(*map(F.lit, TLDS)), "wordlist": F.array(*map(F.lit, WORDS)),
        "domain": F.format_string("example%d.com", F.pmod(slot, F.lit(1000))), "md5": F.md5(slot.cast("string")),
    }
    known |= dict.fromkeys(COUNTERS, slot) | dict.fromkeys(DATE_PARAMETERS, day) | dict.fromkeys(LENGTHS, F.pmod(slot, F.lit(8)) + 16)
    return known.get(n, F.lit(1))


class FromText:
    """A function of a source text, made in the worker that first calls it."""

    def __init__(self, text: str, function: str):
        self.text, self.function, self._made = text, function, None

    def __getstate__(self) -> dict:
        return {"text": self.text, "function": self.function, "_made": None}

    def __call__(self, **arguments):
        if self._made is None:
            space_: dict = {"__name__": "generator"}
            exec(compile(self.text, self.function, "exec"), space_)  # noqa: S102  trusted code, see the top
            self._made = space_[self.function]
        return self._made(**arguments)


def source_of(found: Found, cap: int, axes: Axes = Axes()) -> Source:  # noqa: B008
    """A source that calls a generator's function with its parameters bound by name; a generator without a function
    is run as a program, with the slot as its argument."""
    path = Path(found.path) / found.entry
    if found.function is None:
        return Source(found.code, lambda slots: emit_commands(slots, [sys.executable, str(path)], ["slot"], directory=found.path), cap)
    call, names = FromText(path.read_text(encoding="utf-8", errors="replace"), found.function), list(found.parameters)

    def make(slots: DataFrame) -> DataFrame:
        given = slots.select("slot", *[bound(n, F.col("slot"), found.code, axes).alias(f"in_{i}") for i, n in enumerate(names)])
        renamed = dict(zip([f"in_{i}" for i in range(len(names))], names, strict=True))
        return emit(given, lambda **a: call(**{renamed[k]: v for k, v in a.items()}), list(renamed))

    return Source(found.code, make, cap)


def unique_share(made: DataFrame) -> float:
    """Of the names that a sample of slots gave, the share of different ones; 0 without names."""
    n, different = made.where("raw IS NOT NULL").agg(F.count("raw"), F.count_distinct("raw")).first()
    return different / n if n else 0.0


# -- runs ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Planned:
    """A source in a plan: its cap, or why it is left out."""

    code: str
    cap: int
    status: str
    category: str | None = None
    found: Found | None = None

    def told(self) -> dict:
        return {"code": self.code, "cap": self.cap, "status": self.status, "category": self.category}


def plan_run(found: Sequence[Found], target: int, cap: int, ordered: Sequence[str] = ()) -> list[Planned]:
    """The target evenly over categories and their sound generators, each up to the cap. In an order that is
    given, each of its codes has the cap, those without a generator are ``missing``, and the others ``ignored``."""
    by_code = {f.code.lower(): f for f in found}
    if ordered:
        out = [Planned(c, cap if by_code[c].problem is None else 0, by_code[c].problem or "usable", by_code[c].category, by_code[c]) if c in by_code else Planned(c, 0, "missing") for c in ordered]
        return out + [Planned(f.code, 0, "ignored", f.category) for c, f in by_code.items() if c not in ordered]
    sound = [f for f in found if f.problem is None]
    quotas = quota.plan_evenly([(f.code, f.category, cap) for f in sound], target) if sound else {}
    return [Planned(f.code, quotas.get(f.code, 0), f.problem or "usable", f.category, f if f.problem is None else None) for f in found]


@dataclass
class Source:
    """A generator of a run: ``make(slots)`` gives ``slot, raw[, error]`` for rows of slots."""

    code: str
    make: Callable[[DataFrame], DataFrame]
    cap: int
    cursor: int = 0
    held: int = 0
    last_yield: float | None = None
    idle: int = 0
    width: int = 1
    broken: int = 0
    emitted: int = 0
    reasons: dict = field(default_factory=dict)

    def state(self) -> dict:
        return {k: v for k, v in vars(self).items() if k not in ("code", "make", "cap")}


class Run:
    """Fill a store from several sources, each up to its cap, in turns or strictly in order.

    An epoch asks one source for a batch, validates it, and appends what the store does not hold
    under ``epoch=<n>``. While a source gives mostly new names its batches double, so that the store is probed
    some ten times a source and not once every ``full_batch`` names. The state (cursors, counts, last yields) is written after each epoch in
    one step; a run with the same store goes on from it, and an epoch that was cut off is written
    again over its remains. A source ends at its cap, after ``patience`` batches without a new name, or after ``max_errors``
    batches of nothing but errors; the run ends when all have, when its target is reached, or when too many epochs in a
    row brought nothing.
    """

    def __init__(
        self, spark: SparkSession, store: str, sources: Sequence[Source], full_batch: int = 5000, patience: int = 4, ordered: bool = False,
        max_errors: int = 5, heartbeat: float = 15.0,
    ):
        self.spark, self.store, self.sources = spark, store, list(sources)
        self.full_batch, self.patience, self.ordered, self.epoch = full_batch, patience, ordered, 0
        self.max_errors, self.heartbeat, self._told, self.barren = max_errors, heartbeat, 0.0, 0
        self._load()

    def _state_path(self, epoch: int) -> str:
        return f"{self.store}/state/epoch={epoch}.json"

    def _load(self) -> None:
        done = [int(n.removeprefix("epoch=").removesuffix(".json")) for n in storage.names_in(self.spark, f"{self.store}/state") if n.endswith(".json")]
        if not done:
            return
        state = json.loads(storage.read_bytes(self.spark, self._state_path(max(done))))
        if state["ordered"] != self.ordered or state["codes"] != [s.code for s in self.sources] or state["caps"] != [s.cap for s in self.sources]:
            raise ValueError("the store belongs to a run with other sources, caps or order")
        self.epoch, self.barren = state["epoch"], state["barren"]
        for s, saved in zip(self.sources, state["sources"], strict=True):
            vars(s).update(saved)

    def _save(self) -> None:
        told = {"epoch": self.epoch, "barren": self.barren, "ordered": self.ordered, "codes": [s.code for s in self.sources], "caps": [s.cap for s in self.sources], "sources": [s.state() for s in self.sources]}
        storage.write_bytes(self.spark, self._state_path(self.epoch), json.dumps(told).encode())
        if self.epoch > 2:
            storage.delete(self.spark, self._state_path(self.epoch - 2))

    def names(self) -> DataFrame:
        """``domain, algorithm_code, seq, epoch`` of the store."""
        if not self.epoch:
            return self.spark.createDataFrame([], "domain string, algorithm_code string, seq bigint, epoch bigint")
        return self.spark.read.schema("domain string, algorithm_code string, seq bigint, epoch bigint").parquet(f"{self.store}/names").where(F.col("epoch") <= self.epoch)

    def _open(self, s: Source) -> bool:
        return s.held < s.cap and s.idle < self.patience and s.broken < self.max_errors

    def _step(self, s: Source) -> None:
        with Scope(self.spark):
            self._ask(s)
        self._save()

    def _ask(self, s: Source) -> None:
        n = min(batch_size(self.full_batch, s.last_yield, s.cap - s.held) * s.width, max(s.cap - s.held, 1))
        slots = self.spark.range(s.cursor, s.cursor + n, 1, min(shuffle_partitions(self.spark), max(n // 100, 1))).withColumnRenamed("id", "slot")
        made = s.make(slots)
        error = F.col("error") if "error" in made.columns else F.lit(None).cast("string")
        reason = F.when(F.col("raw").isNull() & error.isNotNull(), "error").otherwise(strict_reason("raw"))
        path = f"{self.store}/batch"
        made.select("slot", strict_name("raw").alias("domain"), reason.alias("reason")).write.mode("overwrite").parquet(path)
        batch = self.spark.read.schema("slot bigint, domain string, reason string").parquet(path)
        fresh = materialize(dedup.insert_or_ignore(self.names(), batch.where("reason IS NULL").select("domain", "slot"), "domain", "slot"), "fresh")
        new, room = fresh.count(), s.cap - s.held
        if new > room:  # up to the slot in which the cap is reached, and of that slot's names the first ones
            last = sampling.nth_smallest(fresh, "slot", room)
            whole = fresh.where(F.col("slot") < last)
            fresh = whole.unionByName(fresh.where(F.col("slot") == last).orderBy("domain").limit(room - whole.count()))
        self.epoch += 1
        fresh.select("domain", F.lit(s.code).alias("algorithm_code"), F.col("slot").alias("seq")).write.mode("overwrite").parquet(f"{self.store}/names/epoch={self.epoch}")
        told = {r["reason"]: r["count"] for r in batch.groupBy("reason").count().collect()}
        total, got = sum(told.values()), min(new, room)
        for reason, count in told.items():
            if reason is not None:
                s.reasons[reason] = s.reasons.get(reason, 0) + count
        s.cursor, s.held, s.emitted = s.cursor + n, s.held + got, s.emitted + total - told.get("error", 0)
        s.last_yield, s.idle = (got / total if total else 0.0), (0 if got else s.idle + 1)
        s.broken = s.broken + 1 if total and told.get("error", 0) == total else 0
        s.width = s.width * 2 if s.last_yield >= BATCH_STEPS[0][0] else 1
        self.barren = 0 if got else self.barren + 1

    def _beat(self) -> None:
        if time.monotonic() - self._told >= self.heartbeat:
            self._told = time.monotonic()
            LOG.info("epoch %d: %s", self.epoch, {s.code: s.held for s in self.sources})

    def run(self, epochs: int | None = None, target: int | None = None) -> dict[str, int]:
        """Names held of each source when all have ended or the target is reached, or after so many epochs."""
        left = epochs if epochs is not None else 10**9
        held = lambda: sum(s.held for s in self.sources)
        while left > 0 and (todo := [s for s in self.sources if self._open(s)]) and self.barren <= max(3 * len(self.sources), LEAST_BARREN):
            for s in todo[:1] if self.ordered else todo:
                if left > 0 and (target is None or held() < target):
                    self._step(s)
                    self._beat()
                    left -= 1
            if target is not None and held() >= target:
                break
        return {s.code: s.held for s in self.sources}

    def stop_reason(self, s: Source) -> str | None:
        """Why a source ended, None if it may go on."""
        if s.held >= s.cap:
            return "cap_reached"
        if s.broken >= self.max_errors:
            return "errors"
        if s.idle >= self.patience:
            return "exhausted" if s.held else "no_output"
        return None

    def errors(self) -> list[str]:
        """What does not hold of the store: its names are the sum of the sources', each within its cap, none twice."""
        per = {r.algorithm_code: r["count"] for r in self.names().groupBy("algorithm_code").count().collect()}
        out = [f"{s.code} holds {per.get(s.code, 0)} names, {s.held} were counted, {s.cap} is its cap" for s in self.sources if per.get(s.code, 0) != s.held or s.held > s.cap]
        twice = self.names().groupBy("domain").count().where("count > 1").count()
        return out + ([f"{twice} names are held twice"] if twice else [])

    def report(self, plan: Sequence[Planned] = (), target: int | None = None) -> dict:
        """Held, emitted and refused names of every source of a plan, in its order, with why it ended."""
        ran = {s.code: s for s in self.sources}
        rows = []
        for i, p in enumerate(plan or [Planned(s.code, s.cap, "usable") for s in self.sources]):
            s = ran.get(p.found.code if p.found else p.code)
            more = {"held": s.held, "emitted": s.emitted, "refused": s.reasons, "stopped": self.stop_reason(s)} if s else {"held": 0, "stopped": "missing" if p.status == "missing" else p.status}
            rows.append({"order": i} | p.told() | more)
        return {"held": sum(s.held for s in self.sources), "target": target, "epochs": self.epoch, "sources": rows}
