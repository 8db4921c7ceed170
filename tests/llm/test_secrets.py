"""Secret scans: known kinds against the plain patterns, planted keys of no known kind, no alarms on words."""

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from millrace.llm import queries, secretscan

SCHEMA = "doc_id bigint, text string"
UPPER, LOWER, DIGITS = string.ascii_uppercase, string.ascii_lowercase, string.digits
KEYS = {
    "capitals": (UPPER + "234567", 20), "upper hex": (DIGITS + "ABCDEF", 32), "hex": (DIGITS + "abcdef", 20),
    "mixed": (UPPER + LOWER + DIGITS, 36), "short mixed": (UPPER + LOWER + DIGITS, 16), "base64": (UPPER + LOWER + DIGITS + "+/", 40),
    "lower": (LOWER + DIGITS, 24),
}


def plain_base(text):
    """The three patterns as they are asked for, one after the other."""
    out = []
    for m in re.finditer(r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.ASCII):
        if len(m.group(2)) >= 6:
            out.append((m.start(), m.end(), 0))
    out += [(m.start(), m.end(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 20]
    out += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 24]
    return sorted(out, key=lambda x: (x[0], x[2]))


def test_known_kinds_equal_the_plain_patterns():
    rng = random.Random(2)
    parts = [
        "password", "PassWD", "secret", "Token", "api_key", "APIKEY", "apikey", "\"", "'", " ", "  ", ":", "=", "hunter", "abc", "12345",
        "AKIA", "ABCDEFGHIJ234567", "0123456789abcdef", "é", "\n", ".", "-", "key", "İ", "ſecret",
    ]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert [(i, j, k) for i, j, k, _ in secretscan.base_spans(text)] == plain_base(text), text


def test_tokens_are_the_candidates():
    rng = random.Random(8)
    for _ in range(2000):
        text = "".join(rng.choices(["a", "B9", ".", "-", "..", " ", "=", "é", "/", "token=abcdefg", "x.y", "\n"], k=rng.randrange(12)))
        known = secretscan.base_spans(text)
        assert secretscan.tokens_of(text, known) == {c[2] for c in secretscan.candidates(text, known)}


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    return docs, secretscan.learn(docs)


def test_planted_keys_are_found_without_a_keyword(spark, corpus):
    """At least nine of ten keys of every kind that no pattern knows; figures are in the README."""
    docs, formats = corpus
    rng = random.Random(7)
    for name, (alphabet, length) in KEYS.items():
        keys = ["".join(rng.choices(alphabet, k=length)) for _ in range(200)]
        assert sum(map(formats.is_secret, keys)) >= 0.9 * len(keys), name
    planted = [(i, f"Das ist key {k}, und (mehr) Text.") for i, k in enumerate(keys)]
    found = secretscan.find(spark.createDataFrame(planted, SCHEMA), formats).collect()
    assert sum([(s["start"], s["end"]) for s in r["spans"]] == [(12, 12 + len(keys[r["doc_id"]]))] for r in found) >= 0.9 * len(keys)


def test_words_give_no_alarm(spark, corpus):
    docs, formats = corpus
    learnt = secretscan.find(docs, formats).select(F.explode("spans").alias("s")).where(F.col("s.kind") == secretscan.LEARNT)
    assert learnt.isEmpty()
    texts = docs.where("length(text) > 400").select("doc_id", F.upper(F.substring("text", 50, 300)).alias("text"))
    loud = secretscan.find(texts, formats).select(F.explode("spans").alias("s")).where(F.col("s.kind") == secretscan.LEARNT)
    assert loud.count() <= 0.001 * docs.count()
    for word in ("Donaudampfschifffahrtsgesellschaft".lower(), "internationally", "LAAITIONELLEELLE", "4929348385146306", "www.example.org/a/b"):
        assert not formats.is_secret(word), word


def test_examples_are_the_smallest_hashes_however_dealt(spark):
    rng = random.Random(1)
    values = ["".join(rng.choices(LOWER + DIGITS, k=12)) for _ in range(1500)]
    rows = [(i, f"password={v} secret: {v}") for i, v in enumerate(values)] + [(9000, "token=" + "x" * 200_000)] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    one, many = secretscan.learn(df.coalesce(1)), secretscan.learn(df.repartition(9))
    probe = ["".join(rng.choices(LOWER + DIGITS, k=12)) for _ in range(50)] + ["words", "x" * 40, "Q"]
    assert [one.score(p) for p in probe] == [many.score(p) for p in probe]
    ends, todo = {0}, [0]
    while todo:
        for to in one.kinds[0]._next[todo.pop()].values():
            if to not in ends:
                ends.add(to)
                todo.append(to)
    assert sum(one.kinds[0]._ends[s] for s in ends) == secretscan.MAX_EXAMPLES


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    empty = secretscan.learn(none)
    assert not empty.is_secret("a" * 50) and secretscan.find(none, empty).count() == 0
    rows = [(None, None), (1, ""), (1, ""), (2, "secret=abcdef ſecret=abcdef"), (2, None)]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("id", "spans", "kind", "value", "h", "n")})
    found = secretscan.find(odd, secretscan.learn(odd)).collect()
    assert sorted(len(r["spans"]) for r in found) == [0, 0, 0, 0, 1]


def test_query_columns(spark, folder):
    """The digest columns of the query, from the plain patterns; spans hold the base spans in order."""
    import hashlib

    texts = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, folder, "documents").collect()}
    names = secretscan.KINDS
    for r in queries.op4_secret_scan(spark, folder).collect():
        base = [f"{names[k]}:{i}:{j}" for i, j, k in plain_base(texts[r["doc_id"]])]
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [s for s in r["spans"].split(",") if s and not s.startswith("format")] == base
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(b.startswith(n + ":") for b in base) for n in names]
