"""Exact top-k inner products by ball-tree branch and bound.

Vectors become integers floor(scale * x). Candidates are dealt to shards of
bounded size by a hash, and each shard is searched through a ball tree: nodes
are visited in order of their upper bound q . centre + |q| radius, and the
search of a query ends when the best open node cannot reach its k-th score.
Queries, every row whose id a number divides, come in blocks.

The k-th score is shared: each query first searches one pilot shard; the score
it finds there bounds it from below in all other shards, which report only
vectors that reach it.

Ids may repeat: every different row has a number of its own, and equal rows
travel once, with how many there are.
"""

from __future__ import annotations

import heapq
import math
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from millrace.llm.common import staged

SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 8192, 4096, 256
_LONG, _DOUBLE = (1 << 63) - 1, sys.float_info.max


def whole_vectors(rows: DataFrame, vector_col: str, scale: float) -> DataFrame:
    """Rows whose vector has only finite components, with integers (as doubles) in column v."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    usable = rows.where(x.isNotNull() & ~bad)

    def whole(c: Column) -> Column:
        scaled = F.greatest(F.lit(-_DOUBLE), F.least(F.lit(_DOUBLE), c.cast("double") * scale))
        # floor gives a long; doubles from 2**53 on are whole and may lie beyond one.
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    return usable.withColumn("v", F.transform(x, whole))


class Balls:
    """Ball tree over integer vectors."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF_ROWS):
        self.x = x
        self.nodes: list[tuple[np.ndarray, float, float, np.ndarray | None, int, int]] = []
        self._build(np.arange(len(x)), leaf)

    def _build(self, rows: np.ndarray, leaf: int) -> int:
        at = len(self.nodes)
        part = self.x[rows]
        centre = part.mean(axis=0)
        radius = math.sqrt(float(((part - centre) ** 2).sum(axis=1).max()))
        reach = math.sqrt(float(centre @ centre)) + radius
        self.nodes.append((centre, radius, reach, rows, -1, -1))
        if len(rows) > leaf and radius > 0:
            # Split between two far points, in halves, so the depth is bounded.
            far = part[((part - centre) ** 2).sum(axis=1).argmax()]
            other = part[((part - far) ** 2).sum(axis=1).argmax()]
            order = rows[np.argsort(part @ (other - far), kind="stable")]
            left = self._build(order[: len(rows) // 2], leaf)
            right = self._build(order[len(rows) // 2 :], leaf)
            self.nodes[at] = (centre, radius, reach, None, left, right)
        return at

    def search(self, q: np.ndarray, copies: np.ndarray, k: int, least: float) -> list[tuple[int, int]]:
        """Up to k (score, place) of at least ``least``, best first, ties to earlier places; each as often as ``copies``."""
        norm = math.sqrt(float(q @ q))

        def bound(node: int) -> float:
            centre, radius, reach = self.nodes[node][:3]
            # Never below the true bound by rounding, also where large products cancel.
            return float(q @ centre) + norm * radius + 1e-9 * norm * reach + 1e-3

        best: list[tuple[int, int]] = []
        open_nodes = [(-bound(0), 0)]
        while open_nodes:
            top, node = heapq.heappop(open_nodes)
            floor = max(least, best[-1][0]) if len(best) == k else least
            if -top < floor:
                break
            *_, rows, left, right = self.nodes[node]
            if rows is None:
                for child in (left, right):
                    heapq.heappush(open_nodes, (-bound(child), child))
                continue
            scores = self.x[rows] @ q
            hit = np.nonzero((scores >= floor) & (copies[rows] > 0))[0]
            if len(hit):
                best = _best(scores[hit].astype(np.int64), rows[hit], copies, k, best)
        return best


def _best(scores: np.ndarray, places: np.ndarray, copies: np.ndarray, k: int, known: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The k best (score, place) of these and the known ones, ties to earlier places; each of these as often as ``copies``."""
    if len(scores) > k:
        first = np.lexsort((places, -scores))[:k]
        scores, places = scores[first], places[first]
    found = [p for p in zip(scores.tolist(), places.tolist(), strict=True) for _ in range(min(k, int(copies[p[1]])))]
    return sorted([*known, *found], key=lambda p: (-p[0], p[1]))[:k]


def _exact(x: np.ndarray, q: np.ndarray) -> bool:
    """Whether all sums of products stay whole in double precision."""
    return float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * x.shape[1] < 2**53


def _search_large(x: np.ndarray, q: np.ndarray, copies: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Like Balls.search, with whole numbers of any size, held to the range of a long.

    Doubles with a bound of their error say which rows may be among the k best.
    """
    places = np.nonzero(copies > 0)[0]
    with np.errstate(over="ignore", invalid="ignore"):
        about, error = x[places] @ q, 4e-16 * (x.shape[1] + 1) * (np.abs(x[places]) @ np.abs(q))
        low, high = np.clip(about - error, -_LONG, _LONG), np.clip(about + error, -_LONG, _LONG)
    if len(places) > k:
        places = places[~(high < np.partition(np.where(np.isnan(low), -np.inf, low), -k)[-k])]
    numbers = [int(c) for c in q]
    dots = (sum(int(a) * b for a, b in zip(x[p], numbers, strict=True)) for p in places)
    return _best(np.array([max(-_LONG, min(_LONG, s)) for s in dots], np.int64), places, copies, k, [])


def _search_shard(x: np.ndarray, copies: np.ndarray, qs: np.ndarray, own: list[int], least: list[float], k: int) -> list[tuple]:
    """(place of the query, place, score) of one shard for one block of queries, of which each is not its own candidate."""
    tree = Balls(x) if _exact(x, qs) else None
    out = []
    for at, (q, me, low) in enumerate(zip(qs, own, least, strict=True)):
        others = copies
        if me >= 0:
            others = copies.copy()
            others[me] -= 1
        found = tree.search(q, others, k, low) if tree else _search_large(x, q, others, k)
        out += [(at, place, score) for score, place in found]
    return out


def top_k(
    rows: DataFrame, divisor: int = 50, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id_col, score): the k best candidates of every query, ties to the smaller id.

    Queries are the rows whose id ``divisor`` divides, candidates all other
    rows. Every row counts: rows that repeat an id, with the same vector or
    another one, are queries and candidates of their own, and a row without an
    id is a candidate, after all ids among ties. Vectors that are null or hold
    null, NaN or infinite components take no part; vectors of different lengths
    never meet. Scores beyond a long are held to its range. An empty table gives
    no rows.
    """
    usable = whole_vectors(rows, vector_col, scale)
    points = usable.select(F.col(id_col).cast("bigint").alias("id"), "v", F.size("v").alias("d"))
    points = points.groupBy("id", "d", "v").agg(F.count("*").alias("copies"))
    points = staged(points.withColumn("point", F.monotonically_increasing_id()), "points")
    size, queries = points.agg(F.count("*"), F.count(F.when(F.col("id") % divisor == 0, 1))).first()
    shards, blocks = max(1, -(-size // SHARD_ROWS)), max(1, -(-queries // BLOCK_ROWS))
    points = points.withColumn("shard", F.pmod(F.xxhash64("point"), F.lit(shards)))
    asking = points.where(F.col("id") % divisor == 0).withColumn("block", F.pmod(F.xxhash64("point", F.lit(1)), F.lit(blocks)))

    def search(key: tuple, asked: pa.Table, stored: pa.Table) -> pa.Table:
        if not len(asked) or not len(stored):
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        stored = stored.sort_by("id")  # nulls last: an earlier place is a smaller id
        vectors = [np.array(t.column("v").combine_chunks().flatten()).reshape(len(t), -1) for t in (asked, stored)]
        least = [-math.inf if x is None else float(x) for x in asked.column("least").to_pylist()]
        places = {point: at for at, point in enumerate(stored.column("point").to_pylist())}
        own = [places.get(point, -1) for point in asked.column("point").to_pylist()]
        out = _search_shard(vectors[1], np.array(stored.column("copies")), vectors[0], own, least, k)
        query, place, score = (pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else ([], [], [])))
        told = [asked.column(c).take(query) for c in ("point", "id", "copies")]
        return pa.table(dict(zip(names, [*told, stored.column("id").take(place), score], strict=True)))

    names = ("point", "query_id", "copies", "id", "score")
    schema = T.StructType([T.StructField(n, T.LongType()) for n in names])

    def meet(asked: DataFrame, stored: DataFrame) -> DataFrame:
        """Every block of queries with every shard it names: the stated query set against all rows."""
        every = stored.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
        # Keys of one type on both sides: cogroup does not cast, and an int is dealt to another task than the same bigint.
        keys = ("d", "shard", "block")
        # Both sides come from one table; new names for the columns keep them apart.
        asked = asked.toDF(*asked.columns)
        return asked.groupBy(*keys).cogroup(every.groupBy(*keys)).applyInArrow(search, schema)

    pilot = asking.withColumn("shard", F.lit(0).cast("bigint")).withColumn("least", F.lit(None).cast("bigint"))
    first = staged(meet(pilot, points.where("shard = 0")), "pilot")
    kth = first.groupBy("point").agg(F.min("score").alias("least"), F.count("*").alias("n")).where(f"n = {k}").drop("n")
    if shards > 1:
        known = asking.drop("shard").join(kth, "point", "left")
        rest = known.withColumn("shard", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(shards - 1).cast("bigint"))))
        first = first.unionByName(meet(rest, points.where("shard > 0")))
    order = Window.partitionBy("point").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    ranked = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # Equal rows are queries with equal answers.
    ranked = ranked.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score")
