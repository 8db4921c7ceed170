"""Ranked lexical search against scores of every document, and the interval method against full sums."""

import math
import random
import re
from collections import Counter

import numpy as np
import oracle
import pytest

from millrace.llm import lexical, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string"


def terms(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def plain(docs, items, k):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    lengths = [sum(b.values()) for _, b in bags]
    n, total = sum(x > 0 for x in lengths), sum(lengths)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scored = []
        for (d, bag), length in zip(bags, lengths):
            m = 25 + (75 * length * n) // total if total else 0
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m))
                for t in terms(text) if bag[t]
            )
            if score:
                scored.append((-score, d is not None, d or 0, d))
        out += [(item, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def test_nra_against_full_sums():
    rng = np.random.default_rng(4)
    stopped = 0
    for trial in range(300):
        n, k = int(rng.integers(1, 400)), int(rng.integers(1, 12))
        lists, full = [], np.zeros(n, np.int64)
        for _ in range(rng.integers(0, 7)):
            size = int(rng.integers(0, n + 1))
            places = rng.permutation(n)[:size]
            values = rng.integers(1, 4 if trial % 2 else 1000, size)
            order = np.argsort(-values, kind="stable")
            factor = int(rng.integers(1, 3))
            lists.append((factor, places[order], values[order]))
            full[places] += factor * values
        got = lexical.nra(lists, n, k, first_read=2)
        assert all(full[p] == s for p, s in got.tolist())
        want = sorted(((-s, p) for p, s in enumerate(full.tolist()) if s))[:k]
        assert sorted((-s, p) for p, s in got.tolist())[:k] == want
        stopped += len(got) < np.count_nonzero(full)
    assert stopped > 50


def test_reading_stops_early():
    class Counted(np.ndarray):
        read = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Counted.read += len(range(*key.indices(len(self))))
            return super().__getitem__(key)

    n = 100_000
    values = np.sort(np.random.default_rng(1).pareto(1.0, n) * 1000).astype(np.int64)[::-1].copy() + 1
    best = lexical.nra([(1, np.arange(n).view(Counted), values), (2, np.arange(n).view(Counted), values)], n, 10)
    assert Counted.read < n // 10 and set(range(10)) <= set(best[:, 0].tolist())


@pytest.mark.parametrize("chunk_docs,block_queries", [(8192, 256), (7, 3), (1, 1)])
def test_search_against_all_documents(spark, chunk_docs, block_queries):
    rng = random.Random(chunk_docs)
    words = ["the", "The", "a", "été", "ÉTÉ", "x1", "中文", "b_c", "rare", "İ"] + [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(40)))) for i in range(120)]
    docs += [(500, None), (501, ""), (502, "-- !"), (503, "the " * 5000), (None, "rare"), (None, "été rare"), (7, "the the")]
    docs += [(600 + i, "same text here") for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=12))) for i in range(12)] + [(90, None), (91, "nowhere"), (92, "same text rare rare"), (None, "the")]
    df = spark.createDataFrame(docs, SCHEMA).selectExpr("*", "1 AS chunk", "'t' AS term", "2 AS id").repartition(3)
    asked = spark.createDataFrame([*items, items[0]], "item_id bigint, text string").selectExpr("*", "3 AS query", "4 AS n")
    found = lexical.search(lexical.index(df, chunk_docs=chunk_docs), asked, block_queries=block_queries)
    got = sorted(map(tuple, found.collect()), key=repr)
    assert [g[:2] + g[3:] for g in got] == [w[:2] + w[3:] for w in plain(docs, items, 10)]
    assert sorted(got, key=repr) == plain(docs, items, 10)


def test_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    some = spark.createDataFrame([(1, "a"), (2, None)], SCHEMA)
    asked = spark.createDataFrame([("q", "a b")], "item_id string, text string")
    assert lexical.search(lexical.index(none), asked).count() == 0
    assert lexical.search(lexical.index(some), asked.where("false")).count() == 0
    text_ids = spark.createDataFrame([("b", "a b"), ("", "a b"), (None, "a b"), ("c", "z")], "doc_id string, text string")
    got = lexical.search(lexical.index(text_ids), asked, k=2).orderBy("rank").collect()
    assert [r["doc_id"] for r in got] == [None, ""]


def test_query_against_sql(spark, folder):
    assert oracle.differences(queries.op13_lexical_search(spark, folder), oracle.connect(folder), queries._OP13_SQL) is None
