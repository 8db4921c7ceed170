"""Ranked lexical search by the NRA algorithm over impact-sorted lists.

The index holds, for chunks of documents, the places and frequencies of every
term; a task makes the chunks of the rows it reads, nothing is shuffled. A search
turns frequencies into integer impacts (weight of the term in the whole corpus,
length of the document), orders each list by impact, and reads the lists of a
query from the top, block after block. A document's score is at least what was
read of it, and at most that plus the next impacts of the lists in which it was
not met. Reading goes on until every document that could be among the k best, or
tie with the last of them, is known exactly. The best of all chunks are merged.

Queries come in blocks; a block meets a chunk through the terms they share.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged, text_of

# ASCII letters and digits and all bytes of other characters: terms as UTF-8.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
CHUNK_DOCS, CHUNK_CHARS = 8192, 16_000_000
# Queries that one task answers for one chunk; ids first read from each list.
BLOCK_QUERIES, FIRST_READ = 256, 64
# The scoring formula, in hundredths and thousandths.
LENGTH_SHARE, SATURATION, SCALE = 75, 8, 1_000_000_000


def terms_of(text: str) -> list[bytes]:
    """Terms of a text in order, A-Z lowered: bytes.lower knows ASCII only."""
    return TERM.findall(text.encode("utf-8").lower())


def _binary(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Pieces of an array, cut at the starts (the last one is its end), as binary values."""
    offsets = (starts * data.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_docs: int = CHUNK_DOCS) -> DataFrame:
    """Written index (chunk, term, df, places, frequencies, ids, lengths, n_docs, n_terms).

    A row per chunk and term, and one per chunk without a term, which holds the
    ids and lengths (terms with repeats) of its documents, how many of them have
    a term, and their terms. Null texts have no term. Repeated rows are documents
    of their own; an empty table gives an empty index; other columns are not read.
    """
    id_type = docs.schema[id_col].dataType
    picked = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, kind = TaskContext.get().partitionId() << 32, None
        numbers: dict[bytes, int] = {}
        ids, found, chars = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            lengths = np.fromiter(map(len, found), np.int64, len(found))
            n, terms = len(found), list(numbers)
            pairs = np.concatenate(found).astype(np.int64) * n + np.repeat(np.arange(n), lengths)
            pairs, counts = np.unique(pairs, return_counts=True)
            starts = np.searchsorted(pairs, np.arange(len(terms) + 1) * n)
            names = ["chunk", "term", "df", "places", "frequencies", "ids", "lengths", "n_docs", "n_terms"]

            def rows(count: int, *cells) -> pa.RecordBatch:
                types = [pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.list_(kind), pa.binary(), pa.int64(), pa.int64()]
                arrays = [pa.nulls(count, t) if c is None else pa.array(c, t) if isinstance(c, list) else c for c, t in zip(cells, types, strict=True)]
                return pa.RecordBatch.from_arrays(arrays, names)

            none = [None] * 4
            yield rows(1, [chunk], *none, [ids], [lengths.astype("<i8").tobytes()], [int((lengths > 0).sum())], [int(lengths.sum())])
            if terms:
                yield rows(
                    len(terms), [chunk] * len(terms), terms, np_array(np.diff(starts)),
                    _binary((pairs % n).astype("<u4"), starts), _binary(counts.astype("<u4"), starts), *none,
                )

        def np_array(values: np.ndarray) -> pa.Array:
            return pa.array(values.astype(np.int64))

        for batch in batches:
            kind = batch.schema.field(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                terms = terms_of(text)
                found.append(np.fromiter((numbers.setdefault(t, len(numbers)) for t in terms), np.uint32, len(terms)))
                ids.append(name)
                chars += len(text)
                if len(ids) >= chunk_docs or chars >= CHUNK_CHARS:
                    yield from flush()
                    chunk += 1
                    numbers.clear()
                    ids, found, chars = [], [], 0
        if ids:
            yield from flush()

    schema = (
        "chunk bigint, term string, df bigint, places binary, frequencies binary,"
        f" ids array<{id_type.simpleString()}>, lengths binary, n_docs bigint, n_terms bigint"
    )
    return staged(picked.mapInArrow(run, schema), "lexical-index")


def impacts(frequencies: np.ndarray, lengths: np.ndarray, weight: int, n: int, total: int) -> np.ndarray:
    """What a term adds to the score of documents; all integers, divisions rounded down."""
    norm = 100 - LENGTH_SHARE + (LENGTH_SHARE * lengths * n) // total
    return weight * ((SCALE * frequencies) // (1000 * frequencies + SATURATION * norm))


def nra(lists: list[tuple[int, np.ndarray, np.ndarray]], n_docs: int, k: int, first_read: int = FIRST_READ) -> np.ndarray:
    """Places of all documents that can be among the k best or tie with the last, and of no other with a lower score.

    ``lists``: (factor, places, impacts) with impacts decreasing. Returns rows
    (place, score), scores exact and above 0, in no order.
    """
    lists = [x for x in lists if len(x[1])]
    lower = np.zeros(n_docs, np.int64)
    met = np.zeros((len(lists), n_docs), bool)
    ahead = np.zeros(len(lists), np.int64)
    at, step = 0, first_read
    while True:
        for t, (factor, places, values) in enumerate(lists):
            read = places[at : at + step]
            lower[read] += factor * values[at : at + step]
            met[t, read] = True
            # The next impact bounds all that was not read of this list.
            ahead[t] = factor * values[at + step] if at + step < len(values) else 0
        at, step = at + step, step * 2
        rest = int(ahead.sum())
        seen = np.nonzero(lower)[0]
        if rest == 0:
            return np.stack([seen, lower[seen]], axis=1)
        if len(seen) < k:
            continue
        last = np.partition(lower[seen], len(seen) - k)[len(seen) - k]
        if rest >= last:
            continue  # a document not met so far could be among the best
        live = ahead > 0
        missing = rest - ahead[live] @ met[np.ix_(live, seen)]
        able = lower[seen] + missing >= last
        if not missing[able].any():
            return np.stack([seen[able], lower[seen[able]]], axis=1)


def search(
    found: DataFrame,
    queries: DataFrame,
    k: int = 10,
    query_col: str = "item_id",
    text_col: str = "text",
    id_col: str = "doc_id",
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_col, rank, id_col, score): the k best documents of an index for each query, scores above 0.

    Equal scores go by ascending id (null first). Texts of one query id are one
    query, each different text once; terms of a query count as often as they
    stand in it. Queries without a term and an empty index give no rows.
    """
    spark = found.sparkSession
    query_type = queries.schema[query_col].dataType.simpleString()
    id_type = found.schema["ids"].dataType.elementType.simpleString()
    totals = found.where("term IS NULL").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n, total = (int(x or 0) for x in totals)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, text in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                counted = Counter(terms_of(text))
                if counted:
                    cells = [pa.array([query.as_py()] * len(counted), batch.schema.field(0).type)]
                    cells += [pa.array(list(counted), pa.string()), pa.array(counted.values(), pa.int64())]
                    yield pa.RecordBatch.from_arrays(cells, ["query", "term", "n"])

    asked = queries.select(F.col(query_col).alias("query"), text_of(text_col).alias("text")).distinct()
    asked = staged(asked.mapInArrow(split, f"query {query_type}, term string, n bigint"), "query-terms")
    asked = asked.groupBy("query", "term").agg(F.sum("n").alias("n"))
    blocks = max(1, -(-asked.select("query").distinct().count() // block_queries))
    # Only two narrow columns of the index are read for the frequencies.
    lists = found.where("term IS NOT NULL")
    df = lists.select("term", "df").join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000) * F.log((2.0 * n + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    weights = staged(df.select("term", weight.alias("weight")), "weights")
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block")
    wanted = asked.join(weights, "term").groupBy(block, "term", "weight")
    wanted = staged(wanted.agg(F.collect_list(F.struct("query", "n")).alias("wanted")), "wanted")
    postings = lists.select("chunk", "term", "places", "frequencies").join(wanted, "term").drop("term")
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    heads = found.where("term IS NULL").select("chunk", every, "ids", "lengths")
    rows = postings.unionByName(heads, allowMissingColumns=True)

    def run(rows: pa.Table) -> pa.Table:
        held = rows.column("ids").is_valid()
        head = rows.filter(held)
        ids = head.column("ids").combine_chunks().flatten()
        lengths = np.frombuffer(head.column("lengths")[0].as_py(), "<i8")
        by_query: dict = {}
        for row in rows.filter(pc.invert(held)).select(["places", "frequencies", "weight", "wanted"]).to_pylist():
            places = np.frombuffer(row["places"], "<u4").astype(np.int64)
            often = np.frombuffer(row["frequencies"], "<u4").astype(np.int64)
            values = impacts(often, lengths[places], row["weight"], n, total)
            order = np.argsort(-values, kind="stable")
            places, values = places[order], values[order]
            for one in row["wanted"]:
                by_query.setdefault(one["query"], []).append((one["n"], places, values))
        by_id = np.empty(len(ids), np.int64)
        sorted_ids = pc.sort_indices(ids, null_placement="at_start").to_numpy()
        by_id[sorted_ids] = np.arange(len(ids))
        asked, places, scores = [], [], []
        for query, lists in by_query.items():
            best = nra(lists, len(ids), k)
            best = best[np.lexsort((by_id[best[:, 0]], -best[:, 1]))][:k]
            asked += [query] * len(best)
            places += best[:, 0].tolist()
            scores += best[:, 1].tolist()
        kind = rows.schema.field("wanted").type.value_type.field("query").type
        return pa.table({"query": pa.array(asked, kind), "doc": ids.take(pa.array(places, pa.int64())), "score": pa.array(scores, pa.int64())})

    best = rows.groupBy("chunk", "block").applyInArrow(run, f"query {query_type}, doc {id_type}, score bigint")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc").asc_nulls_first())
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("query").alias(query_col), "rank", F.col("doc").alias(id_col), "score")
