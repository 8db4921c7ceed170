"""Best-fit packing under conflicts.

Documents are cut into pieces of at most ``capacity`` words; whole pieces fill a
bin of their own, the last piece of each document is packed. A bin carries a
bitmap of its sources and one of its duplicate clusters, and takes a piece only
if neither bit is set: no bin holds two documents of one source or cluster. The
bins are ordered by free room; the search starts at the tightest bin with room
enough and goes on to the next larger one until a compatible bin is found, else
a new bin is opened. Pieces come in order of decreasing size.

Packing runs in shards of about ``shard_rows`` documents chosen by a hash, so
every task holds a bounded number of rows whatever the sources and clusters.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import WHITE, text_of

CAPACITY, SHARD_ROWS = 2048, 2048
# Bins of a shard are numbered below this.
SHARD_BINS = 1 << 40


def best_fit(items: list[tuple[int, object, object]], capacity: int) -> list[int]:
    """Bin number of each (size, source, cluster), sizes in decreasing order."""
    order: list[tuple[int, int]] = []  # (free room, bin)
    sources, clusters, names = [], [], {}
    placed = []
    for size, source, cluster in items:
        s = 1 << names.setdefault(("s", source), len(names))
        c = 1 << names.setdefault(("c", cluster), len(names))
        at = bisect_left(order, (size, -1))
        while at < len(order) and (sources[order[at][1]] & s or clusters[order[at][1]] & c):
            at += 1
        if at < len(order):
            room, bin_no = order.pop(at)
        else:
            room, bin_no = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        sources[bin_no] |= s
        clusters[bin_no] |= c
        insort(order, (room - size, bin_no))
        placed.append(bin_no)
    return placed


def pack(
    docs: DataFrame,
    cluster: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    capacity: int = CAPACITY,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(id_col, piece, first_word, n_words, bin_id): every word of every document in one bin.

    Null and blank texts are pieces of size 0 and are placed too. A null source
    or cluster conflicts with nothing. Repeated rows are packed each, spread over
    shards like others. An empty table gives no rows. Other columns are not read.
    """
    words = F.size(F.filter(F.split(text_of(text_col), WHITE), lambda x: x != ""))
    items = docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        cluster.cast("string").alias("cluster"),
        words.cast("bigint").alias("words"),
    )
    # Equal rows are counted and dealt by their number, so no group of them meets in one shard.
    items = items.groupBy(*items.columns).agg(F.count("*").alias("n"))
    items = items.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n")))).drop("n")
    shards = max(1, -(-docs.count() // shard_rows))
    spread = F.pmod(F.xxhash64("id", "source", "cluster", "words", "copy"), F.lit(shards))
    kind = docs.schema[id_col].dataType.simpleString()

    def known_first(value) -> tuple:
        # Ids may be of any type: a null is only compared by the flag.
        return (True,) if value is None else (False, value)

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        ids, sources, clusters, sizes = (rows.column(c).to_pylist() for c in ("id", "source", "cluster", "words"))
        order = sorted(
            range(len(ids)),
            key=lambda i: (-(sizes[i] % capacity), *map(known_first, (ids[i], sources[i], clusters[i]))),
        )
        # A document of whole pieces only has no rest to pack.
        rest = [i for i in order if sizes[i] % capacity or not sizes[i]]
        # Nulls become names of their own, so they conflict with nothing.
        bins = best_fit(
            [
                (sizes[i] % capacity, i if sources[i] is None else sources[i], i if clusters[i] is None else clusters[i])
                for i in rest
            ],
            capacity,
        )
        out = [(ids[i], sizes[i] // capacity, sizes[i] % capacity, b) for i, b in zip(rest, bins, strict=True)]
        fresh = max(bins, default=-1) + 1
        for i in order:
            for piece in range(sizes[i] // capacity):
                out.append((ids[i], piece, capacity, fresh))
                fresh += 1
        first = key[0].as_py() * SHARD_BINS
        return pa.table(
            {
                "id": pa.array([o[0] for o in out], rows.schema.field("id").type),
                "piece": pa.array([o[1] for o in out], pa.int32()),
                "first_word": pa.array([o[1] * capacity for o in out], pa.int64()),
                "n_words": pa.array([o[2] for o in out], pa.int64()),
                "bin_id": pa.array([first + o[3] for o in out], pa.int64()),
            }
        )

    packed = items.withColumn("shard", spread).groupBy("shard").applyInArrow(
        run, f"id {kind}, piece int, first_word bigint, n_words bigint, bin_id bigint"
    )
    return packed.withColumnRenamed("id", id_col)
