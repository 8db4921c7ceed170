"""Language-model scores from a sharded Elias-Fano trie.

A bigram model with absolute discounting: P(w | u) = max(c(u w) - D, 0) / c(u) +
D * followers(u) / c(u) * P(w), with P(w) = (c(w) + 1) / (N + V + 1), and P(w)
alone after a context never seen in training. Every text is read after a start
mark and closed by one end token.

The words of a chunk get their ids and counts from word shards (see
``chunks``). Its distinct bigrams, with their counts in training texts, go to
gram shards: each builds its part of the trie from all counts and answers the
same bigrams with quantised probabilities. The successors of a frequent context
are spread over several shards, so no context is a hot group. What is shuffled
grows with the distinct bigrams of the chunks, never with the square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.chunks import (
    HEADER,
    TEXT,
    by_number,
    chunked,
    pack_ints,
    shard_count,
    unpack_bytes,
    unpack_ints,
)
from millrace.llm.common import staged, words_of
from millrace.llm.eliasfano import Trie, share_of

# No word holds white space, so the end token cannot be one.
END = b"\n"
DISCOUNT = 0.75
# Occurrences of a context that one gram shard takes; more are spread.
SPREAD = 1 << 18
_START = 0  # id of the start mark; word ids begin at 1
_U8 = "<u8"


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 62-bit hashes of ids."""
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(2)).astype(np.int64)


class Grams:
    """The distinct bigrams of a chunk, and how they are dealt to gram shards."""

    def __init__(self, texts: list[np.ndarray], flags: np.ndarray, ids: np.ndarray, counts: np.ndarray, starts: int, shards: int):
        n = len(ids)  # local number of the start mark
        self.width = n + 1
        self.ids, self.counts = np.append(ids, _START), np.append(counts, starts)
        keys = [np.append(n, t[:-1]).astype(np.int64) * self.width + t for t in texts]
        marked = np.concatenate(keys) * 2 + np.repeat(flags.astype(np.int64), [len(k) for k in keys])
        found, times = np.unique(marked, return_counts=True)
        self.keys, at = np.unique(found >> 1, return_inverse=True)
        self.train = np.bincount(at, np.where(found & 1, times, 0), len(self.keys)).astype(np.int64)
        u, w = self.keys // self.width, self.keys % self.width
        spread = np.minimum(1 + self.counts // SPREAD, shards)
        home = _mixed(self.ids) % shards
        shard = (home[u] + _mixed(self.ids)[w] % spread[u]) % shards
        # Each shard of a spread context is asked for its followers, even without a word.
        seen = np.unique(u)
        wide = seen[spread[seen] > 1]
        turn = np.concatenate([np.arange(s) for s in spread[wide].tolist()]) if len(wide) else np.zeros(0, np.int64)
        asked = np.repeat(wide, spread[wide])
        context = np.concatenate([u, asked])
        shard = np.concatenate([shard, (home[asked] + turn) % shards])
        word = np.concatenate([self.ids[w], np.full(len(asked), -1)])
        # Order of all rows: by shard, context, word; rows without a word come first.
        self.order = np.lexsort((word, self.ids[context], shard))
        self.context, self.word, self.shard = context[self.order], word[self.order], shard[self.order]
        self.is_gram = self.word >= 0

    def groups(self) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(shard, first places of its contexts, their numbers of words, places of its words)."""
        change = np.nonzero(np.diff(self.shard, prepend=-1))[0].tolist()
        for i, j in zip(change, [*change[1:], len(self.shard)], strict=True):
            context = self.context[i:j]
            first = np.nonzero(np.diff(context, prepend=-1))[0]
            size = np.add.reduceat(self.is_gram[i:j].astype(np.int64), first)
            yield int(self.shard[i]), first + i, size, np.nonzero(self.is_gram[i:j])[0] + i

    def packed(self) -> Iterator[tuple[int, bytes]]:
        for shard, first, size, places in self.groups():
            context = self.context[first]
            arrays = (self.ids[context], self.counts[context], size, self.word[places], self.train[self.order[places]])
            cells = [pack_ints(a, _U8) for a in arrays]
            yield shard, np.array([len(c) for c in cells], "<u4").tobytes() + b"".join(cells)

    def answered(self, answers: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """Share of each distinct bigram, and followers of each local context."""
        share, followers = np.zeros(len(self.keys)), np.zeros(self.width)
        for shard, first, _, places in self.groups():
            codes, follow = answers[shard]
            share[self.order[places]] = share_of(codes)
            np.add.at(followers, self.context[first], follow)
        return share, followers


def _unpack_grams(data: bytes) -> list[np.ndarray]:
    ends = 20 + np.cumsum(np.frombuffer(data, "<u4", 5), dtype=np.int64)
    return [unpack_ints(data[i:j], _U8).astype(np.int64) for i, j in zip([20, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _vocabulary(key: tuple, words: pa.Table, shards: int) -> pa.Table:
    """Ids and counts of a shard's words, for each chunk; a row of chunk -1 has the sums."""
    part = key[0].as_py()
    lists = [unpack_bytes(d.as_py()) for d in words.column("data")]
    times = [unpack_ints(c.as_py()) for c in words.column("counts")]
    number: dict[bytes, int] = {}
    at = [np.fromiter((number.setdefault(w, len(number)) for w in ws), np.int64, len(ws)) for ws in lists]
    total = np.bincount(np.concatenate(at), np.concatenate(times), len(number)).astype(np.int64)
    # Frequent words get small ids; the tie goes by the word, so ids do not depend on the order of rows.
    names = list(number)
    order = sorted(range(len(names)), key=lambda i: (-total[i], names[i]))
    ids = np.empty(len(names), np.int64)
    ids[order] = 1 + part + shards * np.arange(len(names))
    end = int(total[number[END]]) if END in number else 0
    sums = np.array([total.sum(), (total > 0).sum(), end])
    return pa.table(
        {
            "chunk": pa.array([*words.column("chunk").to_pylist(), -1], pa.int64()),
            "part": pa.array([part] * (len(lists) + 1), pa.int32()),
            "data": pa.array([*[pack_ints(ids[a], _U8) for a in at], pack_ints(sums, _U8)], pa.binary()),
            "counts": pa.array([*[pack_ints(total[a], _U8) for a in at], None], pa.binary()),
        }
    )


def _answer(key: tuple, blobs: pa.Table) -> pa.Table:
    """Build a gram shard's trie from all chunks' counts and answer every chunk."""
    asked = [_unpack_grams(d.as_py()) for d in blobs.column("data")]
    # Chunks repeat each other's bigrams: each distinct one is looked up once.
    ids, at, context = np.unique(np.concatenate([a[0] for a in asked]), return_index=True, return_inverse=True)
    sizes, word = np.concatenate([a[2] for a in asked]), np.concatenate([a[3] for a in asked])
    span = int(word.max(initial=0)) + 1
    grams, place = np.unique(np.repeat(context, sizes) * span + word, return_inverse=True)
    times = np.bincount(place, np.concatenate([a[4] for a in asked]), len(grams))
    rank, word = grams // span, grams % span
    seen = times > 0
    totals = np.concatenate([a[1] for a in asked])[at]
    trie = Trie(ids[rank[seen]], word[seen], (times[seen] - DISCOUNT) / totals[rank[seen]])
    try:
        codes, followers = trie.query(ids, np.bincount(rank, minlength=len(ids)), word)
    finally:
        trie.close()
    codes = np.split(codes[place], np.cumsum([len(a[3]) for a in asked])[:-1])
    followers = np.split(followers[context], np.cumsum([len(a[0]) for a in asked])[:-1])
    return pa.table(
        {
            "chunk": blobs.column("chunk"),
            "part": pa.array([-1 - key[0].as_py()] * len(asked), pa.int32()),
            "data": pa.array([pack_ints(c, "<u2") for c in codes], pa.binary()),
            "counts": pa.array([pack_ints(f, _U8) for f in followers], pa.binary()),
        }
    )


def scores(docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, in_train, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs``.

    The model learns from the rows for which ``train`` is true. Null texts count
    as empty: their only token is the end. Without a training row every token has
    probability 1. Repeated rows count and are scored each; an empty table gives
    no rows. Other columns are not read.
    """
    shards = shard_count(docs.sparkSession)
    table = chunked(docs, lambda t: [*words_of(t), END], shards, id_col, text_col, train)
    words = table.where(F.col("part") >= 0).select("part", "chunk", "data", "counts")
    fields = "chunk bigint, part int, data binary, counts binary"
    vocabulary = staged(
        words.groupBy("part").applyInArrow(lambda key, rows: _vocabulary(key, rows, shards), fields), "vocabulary"
    )
    # One small row per word shard.
    sums = np.zeros(3, np.int64)
    for row in vocabulary.where("chunk = -1").select("data").toLocalIterator():
        sums += unpack_ints(bytes(row["data"]), _U8).astype(np.int64)
    tokens, kinds, starts = (int(x) for x in sums)
    answers = vocabulary.where("chunk >= 0")
    texts = table.where(F.col("part").isin(TEXT, HEADER)).select("chunk", "part", "id", "flag", "data")

    def opened(rows: pa.Table, found: pa.Table):
        """Rows and numbers of a chunk's texts, ids and counts of its words, and its grams."""
        parts = np.array(rows.column("part"))
        data = rows.column("data").to_pylist()
        header = unpack_ints(data[int(np.nonzero(parts == HEADER)[0][0])])
        by = {p: (d, c) for p, d, c in zip(*(found.column(k).to_pylist() for k in ("part", "data", "counts")), strict=True)}
        ids = by_number(header, {p: unpack_ints(d, _U8) for p, (d, _) in by.items() if p >= 0})
        counts = by_number(header, {p: unpack_ints(c, _U8) for p, (_, c) in by.items() if p >= 0})
        places = np.nonzero(parts == TEXT)[0]
        numbers = [unpack_ints(data[i]).astype(np.int64) for i in places.tolist()]
        flags = np.array([rows.column("flag")[i].as_py() for i in places.tolist()], bool)
        grams = Grams(numbers, flags, ids, counts, starts, shards)
        back = {-1 - p: (unpack_ints(d, "<u2"), unpack_ints(c, _U8)) for p, (d, c) in by.items() if p < 0}
        return places, numbers, counts, grams, back

    def ask(rows: pa.Table, found: pa.Table) -> pa.Table:
        chunk = rows.column("chunk")[0].as_py()
        packed = list(opened(rows, found)[3].packed())
        return pa.table(
            {
                "chunk": pa.array([chunk] * len(packed), pa.int64()),
                "part": pa.array([s for s, _ in packed], pa.int32()),
                "data": pa.array([d for _, d in packed], pa.binary()),
            }
        )

    grams = texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(ask, "chunk bigint, part int, data binary")
    replies = grams.groupBy("part").applyInArrow(_answer, fields)

    def total(rows: pa.Table, found: pa.Table) -> pa.Table:
        places, numbers, counts, grams, back = opened(rows, found)
        share, followers = grams.answered(back)
        alone = (counts + 1) / (tokens + kinds + 1)
        u, w = grams.keys // grams.width, grams.keys % grams.width
        context = grams.counts[u]
        rest = np.where(context > 0, DISCOUNT * followers[u] / np.maximum(context, 1), 1.0)
        gram_logs, word_logs = np.log10(share + rest * alone[w]), np.log10(alone)
        start = len(counts)
        base, score, known = [], [], []
        for t in numbers:
            keys = np.append(start, t[:-1]) * grams.width + t
            base.append(float(word_logs[t].sum()))
            score.append(float(gram_logs[np.searchsorted(grams.keys, keys)].sum()))
            known.append(int((counts[t] > 0).sum()))
        return pa.table(
            {
                "id": rows.column("id").take(pa.array(places)),
                "in_train": rows.column("flag").take(pa.array(places)),
                "n_tokens": pa.array([len(t) for t in numbers], pa.int64()),
                "n_known": pa.array(known, pa.int64()),
                "train_tokens": pa.array([tokens] * len(numbers), pa.int64()),
                "base_score": pa.array(base, pa.float64()),
                "score": pa.array(score, pa.float64()),
            }
        )

    kind = docs.schema[id_col].dataType.simpleString()
    out = f"id {kind}, in_train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    every = answers.select("chunk", "part", "data", "counts").unionByName(replies)
    scored = texts.groupBy("chunk").cogroup(every.groupBy("chunk")).applyInArrow(total, out)
    return scored.withColumnRenamed("id", id_col)
