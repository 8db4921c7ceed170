"""The factorization machine: pairs without single signals, the pair sum, bounds, and the query on held-out rows."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, toxicity

SCHEMA = "doc_id bigint, text string, toxic int"


@pytest.mark.parametrize("vocabulary,length", [(60, 20), (1000, 30)])
def test_exclusive_or_of_two_words(vocabulary, length):
    """Toxic exactly if one of two words occurs: neither says anything alone."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(vocabulary)]
    docs, labels = [], []
    for _ in range(4000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        docs.append(toxicity.terms(" ".join(rng.choices(words, k=length) + ["alpha"] * a + ["beta"] * b)))
        labels.append(float(a != b))
    labels = np.array(labels)
    model = toxicity.train(docs[:3000], labels[:3000])
    found = model.scores(docs[3000:], model.table()) >= toxicity.THRESHOLD
    assert (found == labels[3000:]).mean() >= 0.95


def test_scores_equal_a_sum_over_all_pairs():
    rng = np.random.default_rng(1)
    texts = ["a b c", "a", "", "c d e f g", "zz"]
    docs = [toxicity.terms(t) for t in texts]
    buckets = np.unique(np.concatenate(docs[:4]))
    model = toxicity.Model(0.3, buckets, rng.normal(size=len(buckets)), rng.normal(size=(len(buckets), 3)))
    row = {b: i for i, b in enumerate(buckets.tolist())}
    for doc, got in zip(docs, model.scores(docs, model.table()), strict=True):
        known = [row[b] for b in doc.tolist() if b in row]
        raw = 0.3 + sum(model.w[i] for i in known)
        for x, i in enumerate(known):
            for j in known[x + 1 :]:
                raw += float(model.v[i] @ model.v[j])
        assert math.isclose(got, 1 / (1 + math.exp(-raw)), rel_tol=1e-9)


def test_no_signal_gives_no_alarms():
    rng = random.Random(4)
    docs = [toxicity.terms(" ".join(rng.choices([f"w{i}" for i in range(300)], k=25))) for _ in range(2000)]
    labels = np.array([float(rng.random() < 0.1) for _ in docs])
    model = toxicity.train(docs[:1500], labels[:1500])
    assert (model.scores(docs[1500:], model.table()) >= toxicity.THRESHOLD).mean() < 0.1


def test_bounds_rows_and_edges(spark):
    rng = random.Random(6)
    rows = []
    for i in range(800):
        bad = rng.random() < 0.4
        rows.append((i, " ".join(rng.choices([f"w{k}" for k in range(40)], k=10) + ["scum"] * bad), int(bad)))
    rows += [(900, None, 1), (901, "", 0), (None, "scum", 1), (902, "scum scum", None), (5, "repeated", 1), (5, "repeated", 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("terms", "size", "label", "h", "id")})
    docs, labels = df.drop("toxic"), df.select("doc_id", "toxic", F.lit("x").alias("label"))
    model = toxicity.fit(docs, labels)
    scored = {r["doc_id"]: r for r in toxicity.score(docs, model).where("doc_id < 800").collect()}
    assert sum(scored[i]["tox_predicted"] == t for i, _, t in rows[:800]) >= 790
    # Fewer terms or rows give another model, none gives the constant one.
    assert toxicity.fit(docs, labels, max_terms=900).bias != model.bias != toxicity.fit(docs, labels, max_train=50).bias
    assert toxicity.fit(docs, labels, max_terms=5).buckets.size == 0
    assert toxicity.fit(docs.where("false"), labels).bias == toxicity.fit(docs, labels.where("false")).bias == -40.0


def test_query_learns_from_its_folds_only(spark, folder, tmp_path):
    """Columns and folds of the query; changing the held-out labels changes no score."""
    docs, labels = (queries.table(spark, folder, n) for n in ("documents", "labels"))
    for name, rows in (("a", labels), ("b", labels.withColumn("toxic", F.when(queries.bucket_of_id("doc_id", 4) == 2, 1 - F.col("toxic")).otherwise(F.col("toxic"))))):
        docs.write.parquet(f"file://{tmp_path}/{name}/documents.parquet")
        rows.write.parquet(f"file://{tmp_path}/{name}/labels.parquet")
    one, other = (
        sorted(map(tuple, queries.op9_toxicity(spark, f"file://{tmp_path}/{n}").select("doc_id", "held_out", "score", "predicted").collect()))
        for n in ("a", "b")
    )
    assert one == other and len(one) == docs.count()
    assert all(held == (zlib.crc32(str(d).encode()) % 4 == 2) and p == int(s >= 0.3) and 0 <= s <= 1 for d, held, s, p in one)
