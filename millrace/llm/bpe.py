"""Byte-level BPE by a shuffle of distinct words.

Texts are exploded into pre-tokens with positions, chunk by chunk (see
``chunks``); each distinct pre-token goes to one word shard, where it is encoded
once, and its ids are joined back to the chunk, which puts them together by
position. Decoding looks the ids up in the token-byte table, which is as large
as the vocabulary and does not grow with the data.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

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


def ranks_of(vocabulary: bytes) -> dict[bytes, int]:
    """Token bytes and their ids, from a rank file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines()) if a}


def _splitter(pattern: str):
    import regex

    # White space is Unicode's property; this library's own class also holds four ASCII separators.
    for short, full in ((r"[^\s", r"[^\p{White_Space}"), (r"\s", r"\p{White_Space}"), (r"\S", r"\P{White_Space}")):
        pattern = pattern.replace(short, full)
    return regex.compile(pattern).findall


def encode(docs: DataFrame, vocabulary: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, ids): token ids of each text, as little-endian unsigned 32-bit integers.

    ``vocabulary`` is the content of a rank file. Null texts count as empty: no
    ids. Repeated rows give a row each, an empty table none; other columns are
    not read.
    """
    shards = shard_count(docs.sparkSession)
    split = None

    def pieces(text: str) -> list[str]:
        nonlocal split
        split = split or _splitter(pattern)
        return split(text)

    table = chunked(docs, pieces, shards, id_col, text_col)

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        # The whole input is one piece, so each word is merged by itself.
        bpe = tiktoken.Encoding("own", pat_str="(?s:.+)", mergeable_ranks=ranks_of(vocabulary), special_tokens={})
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            sizes, out = [], []
            for data in batch.column(2):
                found = []
                for word in unpack_bytes(data.as_py()):
                    if word not in known:
                        known[word] = bpe.encode_ordinary(word.decode("utf-8"))
                    found.append(known[word])
                sizes.append(pack_ints(np.fromiter(map(len, found), np.uint32, len(found))))
                out.append(pack_ints(np.fromiter(chain.from_iterable(found), np.uint32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.binary()), pa.array(out, pa.binary())],
                ["chunk", "part", "sizes", "data"],
            )

    words = table.where(F.col("part") >= 0).select("chunk", "part", "data")
    back = words.repartition(F.col("part")).mapInArrow(encode_words, "chunk bigint, part int, sizes binary, data binary")
    texts = table.where(F.col("part").isin(TEXT, HEADER)).select("chunk", "part", "id", "data")

    def reassemble(texts: pa.Table, words: pa.Table) -> pa.Table:
        parts = np.array(texts.column("part"))
        data = texts.column("data").to_pylist()
        header = unpack_ints(data[int(np.nonzero(parts == HEADER)[0][0])])
        shards = words.sort_by("part")
        lists = [unpack_ints(d) for d in shards.column("data").to_pylist()]
        sizes = dict(zip(shards.column("part").to_pylist(), map(unpack_ints, shards.column("sizes").to_pylist()), strict=True))
        flat = np.concatenate([np.zeros(0, np.uint32), *lists])
        size = by_number(header, sizes)
        # Ids lie by shard, and in a shard by number.
        order = np.argsort(header, kind="stable")
        start = np.empty(len(order), np.int64)
        start[order] = np.cumsum(size[order]) - size[order]
        rows = np.nonzero(parts == TEXT)[0]
        out = []
        for r in rows.tolist():
            numbers = unpack_ints(data[r])
            n = size[numbers]
            at = np.repeat(start[numbers] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            out.append(flat[at].tobytes())
        return pa.table({"id": texts.column("id").take(pa.array(rows)), "ids": pa.array(out, pa.binary())})

    kind = docs.schema[id_col].dataType.simpleString()
    joined = texts.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(reassemble, f"id {kind}, ids binary")
    return joined.withColumnRenamed("id", id_col)


def decode(tokens: DataFrame, vocabulary: bytes, ids_col: str = "ids", name: str = "decoded") -> DataFrame:
    """``tokens`` with one more column: the bytes its ids stand for. Null ids give null; an unknown id raises."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {i: b for b, i in ranks_of(vocabulary).items()}.__getitem__
        for batch in batches:
            cells = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            out = [None if c is None else b"".join(map(token, np.frombuffer(c, "<u4").tolist())) for c in cells]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, name])

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(name, T.BinaryType())]))
