"""Reading level of documents by propagation on a document-word graph.

Documents and the features of their running text (words, pairs of words, sentence lengths) are the
two sides of a graph. Every sentence of a document has the same vote, shared among its features by
rarity, so that neither one long sentence nor frequent words decide. Graded documents are clamped
to their grade. An iteration is harmonic on both sides: a feature takes the weighted mean level of
its documents, a document the mean over its sentences; clamped documents weigh 1, others
``FREE_WEIGHT``. The means of means shrink towards the middle, so levels are mapped back by the
mean level of each grade among the graded documents (piecewise linear), in every iteration; at the
end, by the boundaries that part neighbouring grades best, each graded document told from the other
documents only, so that its own grade does not speak for it. ``propagate`` also tells whether the iterations
settled and how the graded documents come out then.

A feature is its 64-bit hash. Documents lie in blocks of at most ``BLOCK`` occurrences of features (or one
document) in a table of the shared folder, their features numbered within the block. The level and weight
of every feature are a table too, joined with the features of each block in every pass: no task holds
more than a block, and the driver holds no feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path, scratch_table, ship_package, shuffle_partitions

BLOCK = 1 << 21
FREE_WEIGHT = 0.05
ITERATIONS = 12
TOLERANCE = 0.01
BINS = 2000
GRADES = (1, 2, 3, 4, 5)
# Fixed values, in lower case: tags, entities, and abbreviations whose dot ends no sentence. The look-ahead names
# the characters that one of them may start with.
NOISE = r"(?=[<&eivc])(?:<[/!?a-z][^<>]*+>|&(?:[a-z][a-z0-9]*+|#[0-9]++|#x[0-9a-f]++);|\b(?:e\.g|i\.e|etc|vs|cf)\.)"
#: Within a line, what goes on after a mark; the first group is a sentence with its mark, a rest without one has none.
_INNER = r"""(?:[^\n.!?]++|[.!?]++(?!["')]*+(?:\s|\z)))"""
SENTENCE = rf"""({_INNER}*+[.!?]++["')]*+(?=\s|\z))|{_INNER}++"""
_ENDS = r"""[.,;:!?"'()*\[\]-]*+"""
#: What stands between blanks; its first group is a word: letters, but for marks at its ends and hyphens inside.
TOKEN = rf"(?:\A|(?<=\s))(?:{_ENDS}([a-z]++(?:['’-][a-z]++)*+){_ENDS}(?=\s|\z)|\S++)"


# Words of grammar that tell English from its neighbours, and those of Spanish, German, French,
# Italian, Portuguese and Dutch that no English sentence needs.
_ENGLISH = """the of and to is are that it for with this be by from or not have has had which we you they were been its their our your
 he she his her can could will would should may if when who what how these those than then there into because but at each about between after does did""".split()
_OTHER = """el la los las del de en que y un una es por con para su sus se al lo como pero sin este esta son ha der die das und ist nicht ein eine
 einen einem einer den dem des mit von zu auf im sich wird werden auch wir sie oder nur durch hat kam le les et est une du dans pour qui sur pas
 il di che non per sono della os um uma da em het een van""".split()


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once, however often it occurs there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def english_sentences(sentences: Column) -> Column:
    """Of the sentences of a text in an unknown or another language, those in English: with more words of
    English grammar than of others, and, if that holds for the text as a whole, those with as many."""
    held = lambda words, known: F.size(F.filter(words, lambda w: w.isin(known)))
    lead = F.transform(sentences, lambda s: F.struct(s.alias("s"), (held(s, _ENGLISH) - held(s, _OTHER)).alias("n")))
    least = lambda scored: F.when(F.aggregate(scored, F.lit(0), lambda a, x: a + x["n"]) > 0, 0).otherwise(1)
    return _let(lead, lambda scored: _let(least(scored), lambda n: F.transform(F.filter(scored, lambda x: x["n"] >= n), lambda x: x["s"])))


def running_sentences(text: Column) -> Column:
    """Sentences as arrays of lower-case words. Markup, entities, list and log lines, names and
    hashes are no running text: a sentence ends with a mark and consists of words by half or more."""
    clean = F.regexp_replace(F.lower(text), NOISE, " ")
    tokens = F.transform(F.regexp_extract_all(clean, F.lit(SENTENCE), F.lit(1)), lambda s: F.regexp_extract_all(s, F.lit(TOKEN), F.lit(1)))
    both = F.transform(tokens, lambda t: F.struct(F.size(t).alias("n"), F.filter(t, lambda w: w != "").alias("words")))
    kept = F.filter(both, lambda b: (F.size(b["words"]) >= 3) & (F.size(b["words"]) * 2 >= b["n"]))
    return F.transform(kept, lambda b: b["words"])


def _features(words: Column) -> Column:
    """Features of a sentence as numbers: its words, its pairs of words, its length class as often as
    a third of its words."""
    n = F.size(words)
    single = F.transform(words, lambda w: F.xxhash64(w))
    pairs = F.zip_with(F.slice(words, F.lit(1), n - 1), F.slice(words, F.lit(2), n - 1), lambda v, w: F.xxhash64(v, w))
    length = F.array_repeat(F.xxhash64(F.lit("length"), F.least((n / 4).cast("int"), F.lit(12))), F.greatest((n / 3).cast("int"), F.lit(1)))
    return F.concat(single, pairs, length)


BLOCKS = "block bigint, graded boolean, ids binary, grades binary, sents binary, lens binary, feats binary, terms binary, counts binary"


def _block(number: int, graded: bool, rows: pa.RecordBatch) -> pa.RecordBatch:
    """One row: documents with their numbers as bytes (lists would be converted number by number between
    the JVM and Python in every pass), and the features they hold, by their number in the block."""
    coded = rows.column("feats").flatten().dictionary_encode()
    terms, idx = coded.dictionary.to_numpy(zero_copy_only=False), coded.indices.to_numpy(zero_copy_only=False)
    lens = rows.column("lens")
    parts = [
        rows.column("doc_id").to_numpy(zero_copy_only=False).astype("<i8"), rows.column("grade").to_numpy(zero_copy_only=False).astype("<f8"),
        pc.list_value_length(lens).to_numpy(zero_copy_only=False).astype("<i4"), lens.flatten().to_numpy(zero_copy_only=False).astype("<i4"),
        idx.astype("<u2" if len(terms) <= 1 << 16 else "<u4"), terms.astype("<i8"), np.bincount(idx, minlength=len(terms)).astype("<i8"),
    ]
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([graded]), *[pa.array([p.tobytes()], pa.binary()) for p in parts]], names=names)


def _blocks(most: int):
    """Blocks of graded and of other documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            has_grade = b.column("grade").is_valid()
            for graded in (True, False):
                rows = b.filter(has_grade if graded else pc.invert(has_grade))
                ends = np.cumsum(pc.list_value_length(rows.column("feats")).to_numpy(zero_copy_only=False).astype("int64"))
                at = 0
                while at < rows.num_rows:
                    to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
                    yield _block(number, graded, rows.slice(at, to - at))
                    number, at = number + 1, to

    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``block, graded, pos, feature, n``: the features of each block with how often they occur in it."""
    for b in batches:
        for r in b.to_pylist():
            terms = np.frombuffer(r["terms"], "<i8")
            n = len(terms)
            arrays = [np.full(n, r["block"]), np.full(n, r["graded"]), np.arange(n, dtype="int32"), terms, np.frombuffer(r["counts"], "<i8")]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["block", "graded", "pos", "feature", "n"])


class _Graph:
    """Edges of one block. The weights of a document add up to 1: every sentence has the same share,
    divided among its features by their weight. ``at`` is where the features of ``values`` stand."""

    def __init__(self, block: pa.Table, values: pa.Table):
        r = block.to_pylist()[0]
        self.ids, self.grades, self.sents = np.frombuffer(r["ids"], "<i8"), np.frombuffer(r["grades"], "<f8"), np.frombuffer(r["sents"], "<i4")
        lens, self.at, self.n = np.frombuffer(r["lens"], "<i4"), values["pos"].to_numpy(), len(self.sents)
        self.idx = np.frombuffer(r["feats"], "<u2" if values.num_rows <= 1 << 16 else "<u4")
        doc = np.repeat(np.arange(self.n), self.sents)
        w = self.placed(values["weight"])[self.idx]
        share = 1.0 / (np.add.reduceat(w, np.r_[0, np.cumsum(lens)[:-1]]) * self.sents[doc]) if len(lens) else np.zeros(0)
        self.edge, self.doc = w * np.repeat(share, lens), np.repeat(doc, lens)

    def placed(self, column: pa.ChunkedArray) -> np.ndarray:
        out = np.empty(len(self.at))
        out[self.at] = column.to_numpy()
        return out

    def raw(self, score: pa.ChunkedArray) -> np.ndarray:
        """Level of each document before it is mapped back, NaN without a sentence."""
        return np.where(self.sents > 0, np.bincount(self.doc, self.edge * self.placed(score)[self.idx], minlength=self.n), np.nan)

    def raw_of_others(self, num: pa.ChunkedArray, den: pa.ChunkedArray) -> np.ndarray:
        """As ``raw`` of clamped documents, each without what its own grade gave to its features; NaN where no
        feature has another document."""
        _, pair = np.unique(self.doc * len(self.at) + self.idx, return_inverse=True)
        own = np.bincount(pair, self.edge)[pair] if len(pair) else np.zeros(0)
        left = self.placed(den)[self.idx] - own
        there = left > 1e-6 * own
        score = np.where(there, (self.placed(num)[self.idx] - own * self.grades[self.doc]) / np.where(there, left, 1.0), 0.0)
        weight = np.where(there, self.edge, 0.0)
        total = np.bincount(self.doc, weight, minlength=self.n)
        return np.divide(np.bincount(self.doc, weight * score, minlength=self.n), total, out=np.full(self.n, np.nan), where=total > 0)


def _spread(knots, free: float):
    """Per block: sums of ``mass * level`` and of ``mass`` for each feature. Without ``knots`` the level
    is the grade."""

    def run(block: pa.Table, values: pa.Table) -> pa.Table:
        g = _Graph(block, values)
        level = g.grades if knots is None else np.interp(g.raw(values["score"]), *knots)
        num, den = (np.bincount(g.idx, x, minlength=len(g.at))[g.at] * free for x in (g.edge * level[g.doc], g.edge))
        return pa.table({"feature": values["feature"], "num": num, "den": den})

    return run


def _read(knots):
    """``doc_id, grade, raw, level`` of each document; no level without a sentence."""

    def run(block: pa.Table, values: pa.Table) -> pa.Table:
        g = _Graph(block, values)
        raw = g.raw(values["score"])
        level = np.interp(raw, *knots) if knots else raw
        return pa.table({"doc_id": g.ids, "grade": pa.array(g.grades, from_pandas=True), "raw": pa.array(raw, from_pandas=True), "level": pa.array(level, from_pandas=True)})

    return run


def _read_others(block: pa.Table, values: pa.Table) -> pa.Table:
    """``grade, raw`` of clamped documents, each told from the others only."""
    g = _Graph(block, values)
    return pa.table({"grade": g.grades, "raw": pa.array(g.raw_of_others(values["num"], values["den"]), from_pandas=True)})


def _bucketed(rows: DataFrame, name: str, key: str) -> DataFrame:
    """As ``materialize``, placed by ``key``: joins by it do not move the table again."""
    spark = rows.sparkSession
    n, table = shuffle_partitions(spark), scratch_table(spark, name)
    rows.repartition(n, key).write.format("parquet").bucketBy(n, key).option("path", scratch_path(spark, name)).saveAsTable(table)
    return spark.table(table)


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for ids in b.column("ids").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(ids, "<i8"))], names=["doc_id"])


class _Corpus:
    """Blocks, the features in them, and passes over both."""

    def __init__(self, rows: DataFrame):
        packed = materialize(rows.mapInArrow(_blocks(BLOCK), BLOCKS), "packed")
        self.blocks = _bucketed(packed.drop("terms", "counts"), "blocks", "block")
        self.terms = _bucketed(packed.mapInArrow(_terms, "block bigint, graded boolean, pos int, feature bigint, n bigint"), "terms", "feature")

    def each(self, graded: bool | None, state: DataFrame, step, schema: str, of: tuple[str, ...] = ("weight", "score")) -> DataFrame:
        """``step`` on each block (graded, not graded, all) beside the weights and scores of its features."""
        kind = F.lit(True) if graded is None else F.col("graded") == graded
        values = self.terms.where(kind).join(state.select("feature", *of), "feature").select("block", "pos", "feature", *of)
        return self.blocks.where(kind).groupBy("block").cogroup(values.groupBy("block")).applyInArrow(step, schema)

    def sums(self, graded: bool, state: DataFrame, step) -> DataFrame:
        return self.each(graded, state, step, "feature bigint, num double, den double").groupBy("feature").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))

    def levels(self, graded: bool | None, state: DataFrame, knots) -> DataFrame:
        return self.each(graded, state, _read(knots), "doc_id bigint, grade double, raw double, level double")


    def of_others(self, state: DataFrame) -> DataFrame:
        return self.each(True, state, _read_others, "grade double, raw double", ("weight", "num", "den"))


def _knots(rows: DataFrame) -> tuple[list[float], list[float]]:
    """Mean raw level of each grade, rising; the map from raw levels to grades."""
    means = dict(rows.where("raw is not null").groupBy(F.round("grade").cast("int").alias("g")).agg(F.avg("raw")).collect())
    xs, ys = [], []
    for g in sorted(means):
        if not xs or means[g] > xs[-1] + 1e-9:
            xs.append(means[g])
            ys.append(float(g))
    return xs, ys


def _boundaries(rows: DataFrame) -> tuple[list[float], list[float]]:
    """The map from raw levels to grades by which bands are told: between two neighbouring grades, the
    raw level that parts the graded documents with the fewest errors (the middle of the widest such
    range). Raw levels are counted in ``BINS`` ranges by grade, so the driver gets a table of fixed size."""
    low, width = float(GRADES[0]), (GRADES[-1] - GRADES[0]) / BINS
    at = F.least(F.greatest(F.floor((F.col("raw") - low) / width), F.lit(0)), F.lit(BINS - 1)).cast("int")
    counts = np.zeros((GRADES[-1] + 1, BINS))
    for g, b, n in rows.where("raw is not null").groupBy(F.floor(F.col("grade") + 0.5).cast("int").alias("g"), at.alias("b")).count().collect():
        counts[g, b] = n
    middle = low + (np.arange(BINS) + 0.5) * width
    found = [(float(middle @ counts[g] / counts[g].sum()), float(g)) for g in (GRADES[0], GRADES[-1]) if counts[g].any()]
    for g in GRADES[:-1]:
        below, above = counts[: g + 1].sum(axis=0), counts[g + 1 :].sum(axis=0)
        if below.any() and above.any():
            errors = np.r_[0, np.cumsum(above)] + below.sum() - np.r_[0, np.cumsum(below)]
            best = np.flatnonzero(errors == errors.min())
            widest = max(np.split(best, np.flatnonzero(np.diff(best) > 1) + 1), key=len)
            found.append((low + (widest[0] + widest[-1]) / 2 * width, g + 0.5))
    xs, ys = [], []
    for x, y in sorted(found, key=lambda k: k[1]):
        if not xs or x > xs[-1] + 1e-9:
            xs.append(x)
            ys.append(y)
    return xs, ys


@dataclass(frozen=True)
class Levels:
    """Levels of all documents, and how propagation went: iterations, the largest change of a feature's score in the
    last one, whether that is below the tolerance, and the graded documents told from the others only, with how many
    of them fall into their own band, and on their own side of each boundary between bands."""

    rows: DataFrame
    iterations: int = 0
    change: float | None = None
    settled: bool = False
    graded: int = 0
    same_band: int = 0
    sides: tuple[int, ...] = ()


def propagate(docs: DataFrame, grades: DataFrame, doc_id: str = "doc_id", text: str = "text", english: Column | None = None) -> Levels:
    """The levels of ``reading_levels``, with figures of the run."""
    ship_package(docs.sparkSession)
    told = grades.where(F.col("grade").between(GRADES[0], GRADES[-1])).groupBy("doc_id").agg(F.avg("grade").cast("double").alias("grade"))
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), running_sentences(F.col(text)).alias("s"), (F.lit(True) if english is None else F.coalesce(english, F.lit(False))).alias("told"))
    english_only = lambda s: F.when(F.col("told"), s).otherwise(english_sentences(s))
    sentences = read.select("doc_id", _let(F.col("s"), lambda s: F.transform(english_only(s), _features)).alias("s"))
    rows = sentences.join(told, "doc_id", "left").select(
        "doc_id", "grade", F.coalesce(F.transform("s", lambda f: F.size(f)), F.array().cast("array<int>")).alias("lens"), F.coalesce(F.flatten("s"), F.array().cast("array<bigint>")).alias("feats")
    )
    corpus = _Corpus(rows)
    counts = corpus.terms.groupBy("feature").agg((1 / F.sqrt(F.sum("n") + 1)).alias("weight"))
    state = materialize(counts.select("feature", "weight", F.lit(0.0).alias("score")), "weights")
    told = corpus.sums(True, state, _spread(None, 1.0)).withColumnsRenamed({"num": "num0", "den": "den0"})
    told = materialize(state.join(told, "feature", "left").select("feature", "weight", F.coalesce("num0", F.lit(0.0)).alias("num0"), F.coalesce("den0", F.lit(0.0)).alias("den0")), "told")
    num0, den0 = told.agg(F.sum("num0"), F.sum("den0")).first()
    if not den0:
        return Levels(corpus.blocks.mapInArrow(_ids, "doc_id bigint").select("doc_id", F.lit(None).cast("double").alias("level"), F.lit(None).cast("int").alias("band")))
    middle = F.lit(num0 / den0)
    state = told.withColumn("score", F.when(F.col("den0") > 0, F.col("num0") / F.col("den0")).otherwise(middle))
    done, change = 0, float("inf")
    for done in range(1, ITERATIONS + 1):
        knots = _knots(corpus.levels(True, state, None))
        sums = corpus.sums(False, state, _spread(knots, FREE_WEIGHT))
        old = state.select("feature", "weight", "num0", "den0", F.col("score").alias("old"))
        both = old.join(sums, "feature", "left").withColumns({c: F.col(c + "0") + F.coalesce(c, F.lit(0.0)) for c in ("num", "den")})
        state = materialize(both.withColumn("score", F.when(F.col("den") > 0, F.col("num") / F.col("den")).otherwise(middle)), "state")
        change = state.agg(F.max(F.abs(F.col("score") - F.col("old")))).first()[0]
        if change < TOLERANCE:
            break
    others = materialize(corpus.of_others(state), "others")
    grade = F.floor(F.col("grade") + 0.5).cast("int")
    alone = [g for g, n in others.groupBy(grade.alias("g")).agg(F.count("raw")).collect() if not n]
    known = others.select("grade", "raw")
    if alone:  # grades whose documents share no feature with others can only be told by themselves
        known = known.unionByName(corpus.levels(True, state, None).where(grade.isin(alone)).select("grade", "raw"))
    boundaries = _boundaries(known)
    levels = corpus.levels(None, state, boundaries)
    return Levels(levels.select("doc_id", "level", F.floor(F.col("level") + 0.5).cast("int").alias("band")), done, change, change < TOLERANCE, *_told_right(others, boundaries))


def _told_right(others: DataFrame, boundaries: tuple[list[float], list[float]]) -> tuple[int, int, tuple[int, ...]]:
    """Graded documents, those in their own band and those on their own side of each boundary, by the raw levels that
    the other documents give them: counted in a table of fixed size."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((len(GRADES) + 1, len(GRADES) + 1), np.int64)
        for b in batches:
            grade, raw = (b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in ("grade", "raw"))
            some = ~np.isnan(raw)
            got = np.floor(np.interp(raw[some], *boundaries) + 0.5).astype(int)
            np.add.at(seen, (np.floor(grade[some] + 0.5).astype(int), got), 1)
        at = np.argwhere(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at[:, 0]), pa.array(at[:, 1]), pa.array(seen[tuple(at.T)])], names=["grade", "band", "n"])

    if not boundaries[0]:
        return 0, 0, ()
    table = [tuple(r) for r in others.mapInArrow(count, "grade bigint, band bigint, n bigint").groupBy("grade", "band").agg(F.sum("n")).collect()]
    return sum(n for *_, n in table), sum(n for g, b, n in table if g == b), tuple(sum(n for g, b, n in table if (g > edge) == (b > edge)) for edge in GRADES[:-1])


def reading_levels(docs: DataFrame, grades: DataFrame, doc_id: str = "doc_id", text: str = "text", english: Column | None = None) -> DataFrame:
    """``doc_id, level, band`` of each document with running text; ``level`` is continuous from 1
    to 5, ``band`` the nearest whole grade (halves upwards).

    ``grades`` has ``doc_id, grade``; several grades of a document are averaged, grades outside 1
    to 5 and null grades do not count. Where ``english`` is not true, the text may be in any language and
    only its English sentences count; without it all texts are English. Documents without running English
    (null, empty, lists only, other languages) get null. Without any graded document with text all levels are null.
    """
    return propagate(docs, grades, doc_id, text, english).rows
