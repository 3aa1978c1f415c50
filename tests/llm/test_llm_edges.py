"""Every operator over the same awkward rows: nulls, empty and long texts, ties, repeats, no rows, odd columns."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import chat, decontamination, language_id, lattice_lm, mih, queries, sentencepieces, sharding, simhash, toxicity, url_trust
from tidemark.llm.common import prepare

LONG = "lorem ipsum dolor " * 20_000
# One word, as a base64 run has it.
WORD = "".join(random.Random(1).choices("abcdefghijklmnopqrstuvwxyzABCDEFGH0123456789+/=", k=100_000))
PASSAGE = "the quick red fox that never sleeps runs over forty lazy grey dogs each night"
TEXTS = [
    (1, "a plain text of some words"), (2, None), (3, ""), (4, LONG), (5, "a plain text of some words"),
    (5, "a plain text of some words"), (None, "no id here"), (6, "\u2581 odd \x00 \U0001f600 e\u0301"), (7, "   "),
    (8, f"before {PASSAGE} after"), (None, None), (9, WORD),
]
# Columns that operators use as names of their own.
ODD = ("fp", "node", "component_id", "digest", "block", "shard", "size", "row", "word", "host", "toxic", "v", "logs", "_row_key", "_ROW_KEY_", "id", "hash", "key", "piece", "spans", "vector", "place")


def with_odd(df):
    return df.withColumns({c: F.lit("x") for c in ODD if c not in df.columns})


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "src0", len(t or "")) for i, t in TEXTS]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return with_odd(prepare(spark).createDataFrame(rows, schema))


def operators(spark, docs):
    path = queries.model_path()
    benchmark = spark.createDataFrame([(1, PASSAGE), (2, None), (3, "")], "item_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int")
    return {
        "sharding": lambda d: sharding.shard_by_bytes(d, 4),
        "simhash": lambda d: simhash.near_duplicates(d),
        "sentencepiece": lambda d: sentencepieces.digests(sentencepieces.encode_documents(d, path)),
        "decontamination": lambda d: decontamination.leaks(d, benchmark),
        "lattice": lambda d: lattice_lm.score_documents(d, path),
        "toxicity": lambda d: toxicity.score(d, toxicity.fit(d, labels, queries.severity_grade())),
        "language": lambda d: language_id.identify(language_id.document_evidence(d).withColumnRenamed("id", "doc_id"), ["doc_id"]),
    }


NAMES = ["sharding", "simhash", "sentencepiece", "decontamination", "lattice", "toxicity", "language"]


@pytest.mark.parametrize("name", NAMES)
def test_awkward_rows(spark, docs, name):
    got = operators(spark, docs)[name](docs).collect()
    if name == "decontamination":
        assert [(r["doc_id"], r["item_id"], r["edits"]) for r in got] == [(8, 1, 0)]
    else:
        assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == sorted((i is None, i or 0) for i, _ in TEXTS)


@pytest.mark.parametrize("name", NAMES)
def test_no_rows(spark, docs, name):
    assert operators(spark, docs)[name](docs.limit(0)).collect() == []


def test_defined_results(spark, docs):
    found = operators(spark, docs)
    shards = {(r["doc_id"], r["shard"]) for r in found["sharding"](docs).collect() if r["doc_id"] in (1, 5)}
    assert len({s for _, s in shards}) == 1
    components = {(r["doc_id"], r["component_id"]) for r in found["simhash"](docs).collect()}
    assert {(1, 1), (5, 1), (2, 2), (3, 2), (7, 2)} <= components
    none = hashlib.sha256(b"").hexdigest()
    assert {r["decoded_sha256"] for r in found["sentencepiece"](docs).where("doc_id IN (2, 3)").collect()} == {none}
    kept = {r["doc_id"]: r["kept"] for r in found["language"](docs).collect()}
    assert not kept[2] and not kept[3] and not kept[7]


def test_pages(spark):
    prepare(spark)
    rows = [(1, "HTTP://A.Example.COM/en/x?y", None), (2, None, "<html lang='fr'>"), (3, "no scheme", ""), (4, "http://b.org", "x"), (4, "http://b.org", "x")]
    pages = with_odd(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r["page_id"]: r for r in url_trust.judge_urls(pages, queries.URL_RULES).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("a.example.com", "/en/x", "example.com/en/", "block")
    assert (got[2]["host"], got[2]["path"], got[2]["verdict"]) == ("", "", "allow") and got[3]["host"] == ""
    assert (got[4]["host"], got[4]["path"], got[4]["rule"]) == ("b.org", "", None)
    assert url_trust.judge_urls(pages.limit(0), queries.URL_RULES).collect() == []
    assert language_id.identify(language_id.web_evidence(pages), ["id"]).count() == 5


def test_vectors(spark):
    prepare(spark)
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.1]), (2, [1.0, 0.1]), (2, [1.0, 0.1]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (8, []), (9, [1.0]), (None, [1.0, 1.0]), (10, [-1.0, 0.0])]
    vectors = with_odd(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in mih.nearest(vectors, F.col("vec_id") % 100 == 0, k=10).orderBy("rank").collect()]
    # The short vector has zeros behind it.
    assert got == [(0, 1, 9), (0, 2, 1), (0, 3, 2), (0, 4, 10)]
    assert mih.nearest(vectors.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_repeated_rows_keep_no_other_id_from_the_index(spark):
    prepare(spark)
    same = [1.0, 0.0, 0.5]
    rows = [(0, same)] * 12 + [(1, same)] * 12 + [(i, same) for i in (2, 3)] + [(4, [1.0, 0.1, 0.5]), (5, [-1.0, 0.0, 0.2])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = mih.nearest(vectors, F.col("vec_id") % 100 == 0, k=10).orderBy("rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 3), (0, 4, 4), (0, 5, 5)]
    assert [r["score"] for r in got[:3]] == [0, 0, 0]


def brute_neighbours(rows, k):
    """Padded vectors, an id at its smallest distance, ties to the smaller id."""
    width = max(len(v) for _, v in rows)
    points = [(i, [*v, *[0.0] * (width - len(v))]) for i, v in rows if any(v)]
    found = {}
    for query in sorted({i for i, _ in points if i % 100 == 0}):
        best = {}
        for _, asked in (p for p in points if p[0] == query):
            for other, vector in points:
                if other != query:
                    best[other] = min(best.get(other, 1e9), sum((a - b) ** 2 for a, b in zip(asked, vector)) ** 0.5)
        found[query] = sorted((d, i) for i, d in best.items())[:k]
    return found


@pytest.mark.parametrize("ids, lengths", [(400, (6,)), (30, (6,)), (400, (6, 6, 6, 2, 9, 40))])
def test_neighbours_of_repeated_ids_and_uneven_vectors(spark, ids, lengths):
    prepare(spark)
    rng = random.Random(ids)
    rows = [(i % ids, [float(rng.randrange(-3, 4)) for _ in range(rng.choice(lengths))]) for i in range(400)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in mih.nearest(vectors, F.col("vec_id") % 100 == 0, k=5, slack=99).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
    expected = brute_neighbours(rows, 5)
    assert {q: [i for _, i in f] for q, f in got.items()} == {q: [i for _, i in f] for q, f in expected.items()}
    assert all(abs(a - b) < 1e-9 for q in got for (a, _), (b, _) in zip(got[q], expected[q]))


def test_an_id_of_many_rows_hides_no_other(spark):
    prepare(spark)
    rng = random.Random(5)
    rows = [(0, [1.0] * 8)] + [(1, [1 + rng.random() / 99 for _ in range(8)]) for _ in range(3000)] + [(i, [-1.0, *[float(i)] * 7]) for i in range(2, 9)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = mih.nearest(vectors, F.col("vec_id") == 0, k=10).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == list(range(1, 9))


def test_neighbours_of_huge_vectors(spark):
    prepare(spark)
    rows = [(0, [1e300, 1.0]), (1, [1e300, 2.0]), (2, [-1e308, 1e308]), (3, [1e-300, 0.0]), (4, [1.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = mih.nearest(vectors, F.col("vec_id") == 0, k=10).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [1, 2, 3, 4] and got[0]["score"] == 1.0


def test_declared_languages_are_read_from_the_whole_page(spark):
    prepare(spark)
    far = "x" * 10_000
    rows = [(1, f"<!-- {far} -->\n<!doctype html><html class=a lang='fr-CA'><p>a"), (2, "\n" * 10_000 + "<HTML LANG=De>"),
            (3, f"<!-- <html lang='es'> {far} --><html lang=en>"), (4, f"{far}<html><p>{far}<html lang='fr'>"), (5, far), (6, None)]
    pages = spark.createDataFrame(rows, "page_id long, html string").withColumn("url", F.lit("http://a.org/"))
    got = {r["id"]: r["declared"] for r in language_id.web_evidence(pages).collect()}
    assert got == {1: "fr", 2: "de", 3: "en", 4: None, 5: None, 6: None}


def test_conversations(spark):
    prepare(spark)
    path = queries.model_path()
    rows = [(1, 2, "assistant", "</s>[INST] \\</s> <|text|> \u2581 [|_|] "), (1, 1, None, None), (1, 1, "user", LONG), (None, None, "user", "x"), (2, 0, "user", "")]
    talks = with_odd(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r["conv_id"]: r for r in chat.digests(chat.format_turns(talks, path), path).collect()}
    spoken = "".join(f"{r}\n{t}\n" for r, t in (("", ""), ("user", LONG), ("assistant", rows[0][3])))
    assert got[1]["n_turns"] == 3 and got[1]["turns_sha256"] == hashlib.sha256(spoken.encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(rows[0][3].encode()).hexdigest() and got[1]["loss_chars"] == len(rows[0][3])
    assert got[2]["loss_chars"] == 0 and got[None]["n_turns"] == 1
    assert chat.digests(chat.format_turns(talks.limit(0), path), path).collect() == []


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=lambda f: f.__name__)
def test_stages_keep_rows_as_they_are_and_run_on_nothing(spark, docs, sf_dir, stage):
    last = stage is corpus_pipeline.STAGES[-1][1]
    for rows in (docs, docs.limit(0)):
        left = stage(spark, rows, sf_dir)
        if last:
            assert left.count() == rows.count()
        else:
            # Also the columns whose names the stages would use.
            assert left.columns == docs.columns
            assert left.exceptAll(rows).count() == 0


def test_a_few_labels_accuse_nobody(spark, docs):
    schema = "doc_id long, quality int, toxic int"
    for rows in ([(1, 1, 0), (4, 1, 1)], [(1, 1, 1), (4, 1, 1), (8, 0, 1)], []):
        model = toxicity.fit(docs, spark.createDataFrame(rows, schema), queries.severity_grade())
        assert {(r["severity"], r["toxic"]) for r in toxicity.score(docs, model).collect()} == {(0.0, False)}


def test_documents_of_one_id_stay_within_the_bound(spark):
    prepare(spark)
    docs = spark.createDataFrame([(i % 2, f"word{i} bad" if i % 2 else f"word{i} good") for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1, 0), (1, 1, 1)], "doc_id long, quality int, toxic int")
    seen = []
    fit = toxicity.fit_ordinal
    try:
        toxicity.fit_ordinal = lambda rows, columns, n, grades: seen.append(len(grades)) or fit(rows, columns, n, grades)
        toxicity.fit(docs, labels, queries.severity_grade(), max_rows=200)
    finally:
        toxicity.fit_ordinal = fit
    assert seen == [200]


def test_stages_judge_rows_without_an_id_or_with_a_repeated_one(spark, sf_dir):
    prepare(spark)
    plain, other = "a plain text of some words in a row", "quite another text that has nothing in common with it"
    rows = [(None, "123 456"), (None, plain), (7, "0 1 2"), (7, plain), (9, plain), (7, other), (None, other), (None, "1" * 50)]
    rows += [(None, "a third text that only rows without any id have")] * 3
    docs = spark.createDataFrame([(i, t, "en", "src0", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")

    def left(stage):
        got = stage(spark, docs, sf_dir).collect()
        return sorted(((r["doc_id"], r["text"]) for r in got), key=str)

    assert left(corpus_pipeline.keep_identified) == sorted(((i, t) for i, t in rows if any(c.isalpha() for c in t)), key=str)
    left_once = left(corpus_pipeline.drop_near_duplicates)
    assert [t for _, t in left_once].count(rows[-1][1]) == 1
    assert {(7, plain), (7, other), (None, rows[-1][1])} <= set(left_once)
    assert all(i == 7 for i, t in left_once if t in (plain, other))
