"""Near-duplicate vectors by sorted projection passes.

In each pass every vector gets a string of random hashes (the signs of random
projections, as the bits of a number) and all vectors are ordered by it. Vectors
close in angle tend to share a long prefix, so each one is compared with its
next neighbours in that order, and pairs whose cosine reaches the threshold are
linked. Passes are independent; their links are united.

A window is bounded, so a dense group can hold more links than windows show. The
exact way for these: the windows' links give components, and inside each
component of three vectors or more all vectors are compared, block by block, to
count the links; nothing is emitted but a count for each vector and block.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged
from millrace.llm.components import components
from millrace.operators.keys import ordered_positions

WINDOW, HASHES = 64, 48
# The share of pairs at the threshold that the passes are to meet; more passes than these at least.
RECALL, LEAST_PASSES = 0.99, 16
BLOCK_ROWS, TILE_ROWS = 2048, 1024
SEED = 20


def passes_for(n: int, threshold: float, window: int = WINDOW, recall: float = RECALL) -> int:
    """Passes after which a pair at the threshold was in one window with the wanted chance.

    A random hash agrees on the two with chance 1 - angle / pi. To stand within a
    window among ``n`` vectors in order they must agree on the first log2(n / window)
    hashes or so, the more the larger the table; passes are independent.
    """
    agree = 1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi
    met = agree ** max(0.0, math.log2(max(n, 1) / window))
    if met >= 1:
        return LEAST_PASSES
    return max(LEAST_PASSES, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def usable(column: str) -> Column:
    """Whether a vector is not null, not empty, all finite and not zero."""
    x = F.col(column)
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    some = F.exists(x, lambda c: c != 0)
    return F.coalesce(x.isNotNull() & ~bad & some, F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Unit vectors of a column of lists of one length, in double precision."""
    x = np.array(column.combine_chunks().flatten(), float).reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashes(points: DataFrame, passes: int) -> DataFrame:
    """(d, pass, hash, id): one narrow row per vector and pass."""

    def run(batches):
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            sizes = np.array(batch.column(1))
            for d in np.unique(sizes).tolist():
                part = batch.filter(pa.array(sizes == d))
                x = _matrix(pa.chunked_array([part.column(2)]))
                for p in range(passes):
                    if (p, d) not in planes:
                        planes[p, d] = np.random.default_rng((SEED, p, d)).normal(size=(d, HASHES))
                    bits = (x @ planes[p, d] > 0).astype(np.int64) << np.arange(HASHES - 1, -1, -1)
                    n = len(part)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(1), pa.array(np.full(n, p, np.int32)), pa.array(bits.sum(axis=1)), part.column(0)],
                        ["d", "pass", "hash", "id"],
                    )

    return points.select("id", "d", "v").mapInArrow(run, "d int, pass int, hash bigint, id bigint")


def window_links(points: DataFrame, threshold: float, passes: int, window: int) -> DataFrame:
    """(a, b): links among window neighbours that keep the components they form.

    Rows are numbered in the order of (length, pass, hash) and dealt to blocks of
    consecutive numbers; the first rows of a block are in the block before, too,
    so windows do not end at its border.
    """
    placed = ordered_positions(_hashes(points, passes), [F.col(c) for c in ("d", "pass", "hash", "id")], "place")
    block = F.floor(F.col("place") / BLOCK_ROWS)
    blocks = F.when((F.col("place") % BLOCK_ROWS < window) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("place")
        ids, d, turn = (np.array(rows.column(c)) for c in ("id", "d", "pass"))
        label = np.arange(len(ids))
        pairs = []
        for size in np.unique(d).tolist():
            at = np.nonzero(d == size)[0]  # consecutive, for the order begins with d
            x, own = _matrix(rows.column("v").take(pa.array(at))), turn[at]
            for step in range(1, min(window, len(at) - 1) + 1):
                close = (np.einsum("ij,ij->i", x[:-step], x[step:]) >= threshold) & (own[:-step] == own[step:])
                first = at[:-step][close]
                pairs.append(np.stack([first, first + step]))
        a, b = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        # Smallest row of each component of the block: one link per row is enough.
        while True:
            low = label.copy()
            np.minimum.at(low, a, label[b])
            np.minimum.at(low, b, label[a])
            low = low[low]
            if (low == label).all():
                break
            label = low
        moved = label != np.arange(len(ids))
        return pa.table({"a": pa.array(ids[label[moved]], pa.int64()), "b": pa.array(ids[moved], pa.int64())})

    # Only numbers are ordered and written; the vectors join on the way to the blocks.
    dealt = placed.withColumn("block", F.explode(blocks)).join(points.select("id", "v"), "id")
    dealt = dealt.select("block", "place", "d", "pass", "id", "v")
    return dealt.groupBy("block").applyInArrow(run, "a bigint, b bigint").where("a <> b").distinct()


def _tiles(members: DataFrame, threshold: float) -> DataFrame:
    """(id, links): for each vector of a component how many others of it are near enough, counting copies.

    Components are cut into tiles of bounded size, and every two tiles of one
    component meet in a group.
    """
    sizes = members.groupBy("root").agg(F.count("*").alias("m"))
    tiles = F.greatest(F.lit(1), F.ceil(F.col("m") / TILE_ROWS)).cast("int")
    tiled = members.join(sizes, "root").withColumn("tiles", tiles)
    tiled = tiled.withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    meets = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda t: F.struct(F.least("tile", t).alias("i"), F.greatest("tile", t).alias("j")),
    )
    # Small components share groups of about TILE_ROWS vectors; pairs of different components are masked.
    bundles = members.count() // TILE_ROWS + 1
    bundle = F.when(F.col("m") > 64, F.col("root")).otherwise(F.pmod(F.xxhash64("root"), F.lit(bundles)))
    dealt = tiled.withColumn("meet", F.explode(meets)).select(
        F.when(F.col("m") > 64, F.lit(1)).otherwise(F.lit(0)).alias("large"), bundle.alias("bundle"), "meet.i", "meet.j",
        "root", "tile", "id", "copies", "v",
    )

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        i, j = key[2].as_py(), key[3].as_py()
        tile, ids, root, copies = (np.array(rows.column(c)) for c in ("tile", "id", "root", "copies"))
        links = np.zeros(len(ids), np.int64)
        for r in np.unique(root):
            one, two = np.nonzero((root == r) & (tile == i))[0], np.nonzero((root == r) & (tile == j))[0]
            if not len(one) or not len(two):
                continue
            x = _matrix(rows.column("v").take(pa.array(one)))
            if i == j:
                near = x @ x.T >= threshold
                np.fill_diagonal(near, False)
                links[one] += near @ copies[one]
            else:
                near = x @ _matrix(rows.column("v").take(pa.array(two))).T >= threshold
                links[one] += near @ copies[two]
                links[two] += copies[one] @ near
        return pa.table({"id": pa.array(ids, pa.int64()), "links": pa.array(links, pa.int64())})

    counted = dealt.groupBy("large", "bundle", "i", "j").applyInArrow(run, "id bigint, links bigint")
    return counted.groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(
    rows: DataFrame,
    threshold: float = 0.95,
    passes: int | None = None,
    window: int = WINDOW,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(id_col, n_links, component_id, kept): one row per row of ``rows``.

    n_links counts the other rows linked directly, component_id is the smallest
    id that links reach, kept whether that is the row itself. Vectors that are
    null, empty, zero or hold null, NaN or infinite components link with nothing,
    nor do vectors of different lengths with each other. Equal vectors are one
    class from the start and link with each other; repeated rows are rows of
    their own. Rows without an id count as copies, and are never the smallest.
    An empty table gives no rows. Other columns are not read, whatever their names.

    Without ``passes`` there are as many as the number of different vectors needs
    for ``recall`` (see ``passes_for``). A pair that no window shows is still
    counted if other links put both into one component.
    """
    good = usable(vector_col)
    # Components keep their type (floats take half the room of doubles); -0.0 becomes 0.0.
    element = rows.schema[vector_col].dataType.elementType
    plain = F.transform(vector_col, lambda c: F.when(c == 0, F.lit(0).cast(element)).otherwise(c))
    marked = rows.select(F.col(id_col).alias("id"), F.when(good, plain).alias("v"))
    classes = marked.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    classes = staged(classes.withColumn("id", F.monotonically_increasing_id()).withColumn("d", F.size("v")), "vectors")
    passes = passes or passes_for(classes.count(), threshold, window, recall)
    links = staged(window_links(classes, threshold, passes, window), "links")
    # Roots carry the smallest id of a row; class numbers stand in during the contraction.
    roots = staged(components(links, "a", "b").withColumnRenamed("node", "id"), "roots")
    members = classes.join(roots, "id").select("root", "id", "copies", "v")
    counted = _tiles(members, threshold)
    of = classes.join(roots, "id", "left").join(counted, "id", "left").select(
        "v", "first", F.coalesce("root", "id").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    names = of.groupBy("root").agg(F.min("first").alias("component_id"))
    found = of.join(names, "root").select("v", "n_links", "component_id")
    linked = marked.where("v IS NOT NULL").join(found, "v").select("id", "n_links", "component_id")
    alone = marked.where("v IS NULL").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
