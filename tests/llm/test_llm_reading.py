from pyspark.sql import functions as F
from zonewright.llm import queries, reading

EASY = ["The cat sat on the mat.", "We see a red dog.", "It is a big box.", "The sun is hot today.", "You can run and play.", "A bird sits in the tree."]
HARD = [
    "Notwithstanding considerable heterogeneity, institutional accountability necessitates comprehensive reconsideration.",
    "Methodological uncertainty substantially complicates longitudinal generalization of experimental observations.",
    "Contemporary epistemological frameworks presuppose computationally intractable representations.",
    "Interdisciplinary harmonization, although consequential, destabilizes established administrative categorization.",
]


def corpus():
    docs, grades = [], []
    for i in range(60):
        pool, grade = (EASY, 1) if i % 2 else (HARD, 5)
        docs.append((i, " ".join(pool[(i // 2 + j) % len(pool)] for j in range(3))))
        if i < 20:
            grades.append((i, grade))
    return docs, grades


def levels(spark, docs, grades):
    rows = reading.reading_levels(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(grades, "doc_id long, grade int")).collect()
    return {r.doc_id: r for r in rows}


def test_propagation_reaches_ungraded_documents(spark):
    docs, grades = corpus()
    got = levels(spark, docs, grades)
    assert len(got) == 60 and all(got[i].band == (1 if i % 2 else 5) for i in range(60))


def test_whole_text_decides(spark):
    docs, grades = corpus()
    docs += [(100, " ".join(EASY * 2 + HARD[:1])), (101, " ".join(HARD * 2 + EASY[:1])), (102, HARD[0] + "\n- a1b2c3.example.com\n* deadbeef01.net\n" * 50)]
    got = levels(spark, docs, grades)
    assert got[100].level < 3 < got[101].level and got[102].band == 5


def test_edges(spark):
    docs, grades = corpus()
    docs += [(200, None), (201, ""), (202, "a.com\nb.com\n"), (203, "<p>" * 50_000), (204, " ".join(EASY) * 20_000), (205, "Wholly unknown vocabulary appears here.")]
    grades += [(0, None), (1, 9), (2, 4), (2, 5), (999, 3), (200, 5)]
    got = levels(spark, docs, grades)
    assert all(got[i].level is None and got[i].band is None for i in (200, 201, 202, 203))
    assert got[204].band == 1 and got[205].level is not None
    assert len(got) == len(docs)


def test_empty(spark):
    assert levels(spark, [], []) == {}
    docs, _ = corpus()
    assert all(r.level is None for r in levels(spark, docs, []).values())


def test_sentences(spark):
    text = "He said <b>so</b>, e.g. twice &amp; more. Is it true?\nHeading\n2025-01-01 INFO x=1 y=2 z=3.\nSee a.example.com, b.example.com or c.example.com."
    rows = spark.createDataFrame([(text,)], "t string").select(reading.running_sentences(reading.F.col("t")).alias("s")).first().s
    assert rows == [["he", "said", "so", "twice", "more"], ["is", "it", "true"]]


def test_held_out_grades(spark):
    d = "/root/testdata/sf0.1"
    told = [tuple(r) for r in spark.read.parquet(f"{d}/doc_labels.parquet").where("reading_band is not null").select("doc_id", "reading_band").collect()]
    held = {i for i, _ in told if i % 5 == 0}
    docs = spark.read.parquet(f"{d}/documents.parquet")
    known = spark.createDataFrame([r for r in told if r[0] not in held], "doc_id long, grade int")
    got = {r.doc_id: r.band for r in reading.reading_levels(docs, known, english=F.lower("lang") == "en").collect()}
    both = [(got[i] >= 4, g >= 4) for i, g in told if i in held and got.get(i) is not None]
    hits = sum(a and b for a, b in both)
    assert len(both) > 150 and hits >= 0.95 * sum(b for _, b in both) and hits >= 0.95 * sum(a for a, _ in both)


def test_report_tells_graded_documents_from_the_others(spark):
    docs, grades = corpus()
    rows = lambda t: spark.createDataFrame(t, "doc_id long, grade int")
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    right = reading.propagate(texts, rows(grades))
    assert right.settled and 0 < right.iterations <= reading.ITERATIONS and right.change < reading.TOLERANCE
    assert (right.graded, right.same_band, right.sides) == (20, 20, (20,) * 4)
    wrong = reading.propagate(texts, rows([(i, 6 - g if i < 2 else g) for i, g in grades]))
    assert wrong.graded == 20 and wrong.same_band == 18  # a document's own grade does not speak for it
    alone = reading.propagate(spark.createDataFrame([(1, EASY[0]), (2, HARD[0]), (3, EASY[0])], "doc_id long, text string"), rows([(1, 1), (2, 5)]))
    assert {r.doc_id: r.band for r in alone.rows.collect()} == {1: 1, 2: 5, 3: 1}


def test_long_tags_and_entities(spark):
    text = "It <a href='" + "x" * 5000 + "'>is</a> one &CounterClockwiseContourIntegral; line. If a < b then so it is."
    rows = spark.createDataFrame([(text,)], "t string").select(reading.running_sentences(F.col("t")).alias("s")).first().s
    assert rows == [["it", "is", "one", "line"], ["if", "a", "b", "then", "so", "it", "is"]]


def test_query_agrees_with_levels(spark):
    d = "/root/testdata/sf0.001"
    rows = queries.p8_levels(spark, d).collect()
    assert {r.doc_id for r in queries.p8_found(spark, d).collect()} == {r.doc_id for r in rows if r.band and r.band >= 4}


def test_every_document_has_a_row(spark):
    d = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    got = {r.doc_id: r.level for r in queries.p8_levels(spark, d).collect()}
    assert got.keys() == docs.keys()
    assert got[306] is not None and got[521] is not None  # English prose without a language, and und
    assert all(got[i] is None for i, lang in docs.items() if lang in ("es", "de"))
    assert sum(r.documents for r in queries.p8_profile(spark, d).collect()) == len(docs)
    assert {docs[r.doc_id] for r in queries.p8_found(spark, d).collect()} == {"en"}


def test_sentences_of_other_languages(spark):
    docs, grades = corpus()
    rows = [(i, t, True) for i, t in docs] + [(300, " ".join(HARD), None), (301, "El registro busca otro nombre. Vimos en la lista. El aviso es corto.", None), (302, "El aviso es corto. " + EASY[0], False)]
    got = reading.reading_levels(spark.createDataFrame(rows, "doc_id long, text string, en boolean"), spark.createDataFrame(grades, "doc_id long, grade int"), english=reading.F.col("en"))
    got = {r.doc_id: r.band for r in got.collect()}
    assert (got[300], got[301], got[302]) == (5, None, 1)


def test_features_do_not_collide(spark):
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    docs = [(i, " ".join(name(6 * i + k) for k in range(6)).capitalize() + ".") for i in range(50_000)]
    rows = spark.createDataFrame(docs, "doc_id long, text string").select(F.explode(F.flatten(F.transform(reading.running_sentences(F.col("text")), reading._features))).alias("f"))
    assert rows.select("f").distinct().count() == 50_000 * 11 + 1  # words, pairs, and one length class
    got = levels(spark, [*docs[:3000], (60_000, docs[0][1]), (60_001, docs[1][1])], [(0, 1), (1, 5)])
    assert (got[60_000].band, got[60_001].band) == (1, 5)


def test_small_blocks_give_the_same_levels(spark, monkeypatch):
    docs, grades = corpus()
    whole = levels(spark, docs, grades)
    monkeypatch.setattr(reading, "BLOCK", 40)
    assert all(abs(r.level - whole[i].level) < 1e-9 for i, r in levels(spark, docs, grades).items())
