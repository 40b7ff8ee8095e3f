import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.compression_quality import fit_quality, quality
from tidemark.llm.pu_toxicity import _train, fit_toxicity, toxicity, word_features
from tidemark.llm.queries import queries
from tidemark.llm.training import fit_logistic, labelled_sample, remainder, sigmoid, thinned

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, score string, label string, row string"


def test_labelled_sample(spark):
    rows = [(i, i % 2) for i in range(100)] + [(0, 0), (1, 0), (None, 1), (200, None), (201, 7)]
    labels = spark.createDataFrame(rows, "doc_id long, label int")
    got = labelled_sample(labels, 1000).collect()
    assert sorted(r.doc_id for r in got) == [0, *range(2, 100)]
    few = labelled_sample(labels, 10).collect()
    assert len(few) == 20 and sum(r.label for r in few) == 10


@pytest.mark.parametrize("n", [0, 1, 50, 3000, 10**6])
def test_thinned_keeps_those_of_least_hash(spark, n):
    """Few rows are left to sort, and the sample is that of all rows, copies included."""
    hashed = F.xxhash64("id")
    df = spark.range(20_000).unionByName(spark.range(3000).select((F.col("id") % 30).alias("id")))
    least = lambda rows: [r.id for r in rows.orderBy(hashed, "id").limit(n).collect()]
    left = thinned(df, hashed, n)
    assert least(left) == least(df)
    assert min(n, 23_000) <= left.count() <= n + 110  # a cell holds about one row in three, or a row and its copies
    assert thinned(df.limit(0), hashed, n).isEmpty()


def test_remainder(spark):
    got = spark.range(50).select("id", remainder("id", 5).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 5 for r in got)
    assert spark.sql("select cast(null as long) as id").select(remainder("id", 5)).first()[0] == -1


def test_logistic():
    pick = np.random.default_rng(1)
    x = pick.normal(size=(4000, 2))
    y = pick.random(4000) < sigmoid(2 * x[:, 0] - x[:, 1] + 0.5)
    assert np.allclose(fit_logistic(x, y.astype(float)), [2, -1, 0.5], atol=0.25)


def test_non_negative_risk_holds_the_prior():
    """Unlabelled data hold toxic rows as well; the classifier must find about the prior's share of them."""
    pick = np.random.default_rng(2)
    toxic = (pick.random((200, 40)) < np.r_[np.full(5, 0.5), np.full(35, 0.1)]).astype(np.float32)
    clean = (pick.random((1600, 40)) < np.r_[np.full(5, 0.01), np.full(35, 0.1)]).astype(np.float32)
    hidden = (pick.random((400, 40)) < np.r_[np.full(5, 0.5), np.full(35, 0.1)]).astype(np.float32)
    weights = _train(toxic, np.vstack([clean, hidden]), 0.2, 0, 600, 0.05)
    found = lambda rows: (rows @ weights[:-1] + weights[-1] >= 0).mean()
    # The best rule asks for two of the five signs, which 81 % of the hidden rows have.
    assert found(hidden) > 0.75 and found(clean) < 0.08


def accuracy(rows, labels, least):
    seen = [(r.score >= least) == bool(labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(seen) > 50
    return sum(seen) / len(seen)


@pytest.mark.parametrize(
    "name, column, least, rule, floor",
    [("op1_pu_toxicity", "toxic", 0.5, (5, 0), 0.95), ("op3_compression_quality", "quality", 0.7, (4, 2), 0.95)],
)
def test_queries(spark, name, column, least, rule, floor):
    rows = queries()[name](spark, SF).collect()
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= least)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % rule[0] == rule[1])
    assert accuracy(rows, labels, least) >= floor
    again = queries()[name](spark, SF).collect()
    assert {r.doc_id: r.score for r in again} == {r.doc_id: r.score for r in rows}


@pytest.fixture(scope="module")
def words():
    pick = random.Random(6)
    return ["".join(pick.choices("abcdefghij", k=pick.randint(2, 9))) for _ in range(300)]


def odd(text):
    return [(900, None, "", "", ""), (901, "", "", "", ""), (902, " 1 ", "", "", ""), (None, text, "", "", ""),
            (903, text, "", "", ""), (903, text, "", "", ""), (904, text * 300, "", "", "")]


def test_toxicity_of_odd_rows(spark, words):
    pick = random.Random(8)
    rows, toxic = [], []
    for i in range(800):
        text = pick.choices(words, k=pick.randint(20, 80))
        if i % 4 == 0:
            text[pick.randrange(len(text))] = pick.choice(["grobian", "wicht", "flegel"])
            toxic += [(i,)] if i % 8 == 0 else []
        rows.append((i, " ".join(text), "x", "y", "z"))
    docs = spark.createDataFrame(rows + odd("Der FLEGEL! " + rows[1][1] + " "), SCHEMA)
    ids = spark.createDataFrame(toxic, "doc_id long")
    model = fit_toxicity(docs, ids, prior=0.25)
    got = toxicity(docs, model).collect()
    assert len(got) == 807 and {r.score for r in got if r.doc_id in (900, 901, 902)} == {0.0}
    assert all((r.score >= 0.5) == (r.doc_id % 4 == 0) for r in got if r.doc_id is not None and r.doc_id < 800)
    assert all(r.score >= 0.5 for r in got if r.doc_id in (None, 903))
    assert toxicity(docs.where("false"), model).count() == 0
    assert fit_toxicity(docs, ids.where("false"), prior=0.1) is None
    assert fit_toxicity(docs.where("false"), ids, prior=0.1) is None
    assert {r.score for r in toxicity(docs, None).collect()} == {0.0}
    assert word_features("flegel") == ["flegel", "fleg-", "flege-", "flegel-"] and word_features("der") == ["der"]


def test_quality_of_odd_rows(spark, words):
    pick = random.Random(9)
    rows, labels = [], []
    for i in range(240):
        text = pick.choices(words, k=pick.randint(30, 120))
        rows.append((i, " ".join(text) if i % 2 else " >> ".join(w.upper() for w in text), "x", "y", "z"))
        labels.append((i, i % 2))
    docs = spark.createDataFrame(rows + odd(rows[1][1] + " "), SCHEMA)
    known = spark.createDataFrame(labels, "doc_id long, label int")
    model = fit_quality(docs, known)
    got = quality(docs, model).collect()
    assert len(got) == 247 and {r.score for r in got if r.doc_id in (900, 901)} == {0.0}
    good = [(r.score >= 0.7) == bool(r.doc_id % 2) for r in got if r.doc_id is not None and r.doc_id < 240]
    assert sum(good) / len(good) > 0.95
    assert all(r.score >= 0.7 for r in got if r.doc_id in (None, 903, 904))
    assert quality(docs.where("false"), model).count() == 0
    one = fit_quality(docs, known.where("label = 1"))
    assert {r.score for r in quality(docs, one).collect()} == {0.0, 1.0}
    assert {r.score for r in quality(docs, fit_quality(docs, known.where("false"))).collect()} == {0.0, 0.5}
