"""Documents as word numbers: the distinct words of a chunk of texts, and their positions.

Texts hold each word many times. A task therefore numbers the distinct words of
a chunk of texts and keeps every text as the sequence of numbers by position.
Only the distinct words travel: packed, one row per chunk and word shard, to the
task that looks after the shard (a hash of the word), whose answers go back to
the chunk. A chunk never has more such rows than words.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import text_of
from millrace.session import scratch, temporary

CHUNK_CHARS = 6_000_000
# Rows of a chunk table: part is a word shard, or one of these.
TEXT, HEADER = -1, -2
# Compression level of everything packed.
LEVEL = 6


def shard_count(spark: SparkSession) -> int:
    """Several word shards for each shuffle partition: they follow the cluster's choice."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def pack_ints(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Integers with their byte planes apart, compressed: high planes of small numbers take no room."""
    width = np.dtype(kind).itemsize
    return zstandard.compress(values.astype(kind).view(np.uint8).reshape(-1, width).T.tobytes(), LEVEL)


def unpack_ints(data: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def pack_bytes(words: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, words), np.uint32, len(words))
    return zstandard.compress(np.uint32(len(words)).tobytes() + sizes.tobytes() + b"".join(words), LEVEL)


def unpack_bytes(data: bytes) -> list[bytes]:
    raw = zstandard.decompress(data)
    n = int(np.frombuffer(raw, np.uint32, 1)[0])
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(raw, np.uint32, n, 4), dtype=np.int64)).tolist()
    return [raw[i:j] for i, j in zip([4 + 4 * n, *ends], ends)]


def chunked(
    docs: DataFrame,
    split: Callable[[str], list[bytes] | list[str]],
    shards: int,
    id_col: str,
    text_col: str,
    flag: Column | None = None,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """Written table (chunk, part, id, flag, data, counts), bucketed by chunk.

    part TEXT: a document, data its word numbers; part HEADER: data the shard of
    each word number; any other part: data the words of that shard in order of
    their numbers, counts how often each stands in texts whose flag is true.
    Numbers go by frequency in the chunk. A null text is an empty one. Words that
    ``split`` gives as text are stored in UTF-8.
    """
    kind = docs.schema[id_col].dataType
    flagged = F.lit(False) if flag is None else F.coalesce(flag, F.lit(False))
    picked = docs.select(F.col(id_col).alias("id"), flagged.alias("flag"), text_of(text_col).alias("text"))
    names = ["chunk", "part", "id", "flag", "data", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        numbers: dict[bytes | str, int] = {}
        ids, flags, texts, size = [], [], [], 0
        id_type = None

        def flush() -> pa.RecordBatch:
            words = [w if isinstance(w, bytes) else w.encode("utf-8") for w in numbers]
            lengths = [len(t) for t in texts]
            every = np.concatenate(texts) if texts else np.zeros(0, np.uint32)
            seen = np.bincount(every, minlength=len(words))
            by_rank = np.argsort(-seen, kind="stable")
            rank = np.empty(len(words), np.uint32)
            rank[by_rank] = np.arange(len(words), dtype=np.uint32)
            chosen = every[np.repeat(np.array(flags, bool), lengths)]
            counted = np.bincount(chosen, minlength=len(words))[by_rank]
            words = [words[i] for i in by_rank.tolist()]
            shard = np.fromiter((zlib.crc32(w) % shards for w in words), np.uint32, len(words))
            rows = [(chunk, TEXT, i, f, pack_ints(rank[t]), None) for i, f, t in zip(ids, flags, texts, strict=True)]
            rows.append((chunk, HEADER, None, None, pack_ints(shard), None))
            order = np.argsort(shard, kind="stable")
            starts = np.searchsorted(shard[order], np.arange(shards + 1)).tolist()
            for s, (i, j) in enumerate(zip(starts, starts[1:])):
                if i < j:
                    of = order[i:j]
                    packed = pack_bytes([words[k] for k in of.tolist()])
                    rows.append((chunk, s, None, None, packed, pack_ints(counted[of])))
            kinds = [pa.int64(), pa.int32(), id_type, pa.bool_(), pa.binary(), pa.binary()]
            cells = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(cells, names)

        for batch in batches:
            id_type = batch.schema.field(0).type
            for i, f, t in zip(*(batch.column(k) for k in range(3)), strict=True):
                text = t.as_py()
                found = split(text)
                texts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in found), np.uint32, len(found)))
                ids.append(i.as_py())
                flags.append(f.as_py())
                size += len(text)
                if size >= chunk_chars:
                    yield flush()
                    chunk += 1
                    numbers.clear()
                    ids, flags, texts, size = [], [], [], 0
        if ids:
            yield flush()

    schema = f"chunk bigint, part int, id {kind.simpleString()}, flag boolean, data binary, counts binary"
    # Bucketed, so that answers go to the chunks without shuffling the texts again.
    spark = docs.sparkSession
    name = temporary(spark, "TABLE", f"{spark.catalog.currentDatabase()}.chunks_{uuid.uuid4().hex}")
    path = scratch(spark, "chunks")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = picked.mapInArrow(run, schema).write.bucketBy(buckets, "chunk").option("path", path)
    writer.saveAsTable(name, format="parquet")
    return spark.table(name)


def by_number(header: np.ndarray, answers: dict[int, np.ndarray]) -> np.ndarray:
    """Answers of all shards of a chunk, one integer for each word, in order of the word numbers."""
    out = np.empty(len(header), np.int64)
    if len(header):
        out[np.argsort(header, kind="stable")] = np.concatenate([answers[s] for s in np.unique(header).tolist()])
    return out
