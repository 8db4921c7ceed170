"""Token files: blocks round trip, ids equal the tokenizer library's on whole texts, the query against a plain version."""

import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import queries, tokenfiles

SCHEMA = "doc_id bigint, text string"
ODD = [
    "", " \t\n", "It's  ISN'T we'll 12345 x1y2 don’t", "ÀÉÎÕÜ ǅ ǈ ſ ß İstanbul ŉ", "ΣΟΦΟΣ Ὀδυσσεύς", "é Å Å ẛ̣",
    "中文字 テスト 한국어 \U0001f600\U0001f468‍\U0001f469", "a\x1cb\x1db\x85c\xa0d e　f\x00g\x7f", "<|endoftext|> a<|startoftext|>b <|x|>",
    "ﬁne ½ ² ٣٤", "x" * 5000, "ab " * 4000, "\r\n\x0b\x0c", "'s 'S s' 'Re're", "́ͅ ́a",
]


@pytest.fixture(scope="module")
def definition():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        return file.read()


@pytest.fixture(scope="module")
def library(definition):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def ours(encoder, text):
    return np.concatenate(list(encoder.parts(text))).tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(100, 131), min_size=1, max_size=700), st.integers(0, 100))
def test_blocks_round_trip(ids, percentile):
    for length in (1, 16, 700):
        blocks = tokenfiles.pack_blocks(np.array(ids, np.uint32), length, percentile)
        assert sum([tokenfiles.unpack_block(b"xyz" + b + b"w", 3).tolist() for b in blocks], []) == ids


def test_width_follows_the_percentile():
    ids = np.array([7] + [7 + i % 16 for i in range(98)] + [4_000_000_000], np.uint32)
    base, n, exceptions, width = struct.unpack_from(tokenfiles._HEAD, tokenfiles.pack_blocks(ids, 100, 95)[0])
    assert (base, n, exceptions, width) == (7, 100, 1, 4)
    assert len(tokenfiles.pack_blocks(ids, 100, 95)[0]) < len(tokenfiles.pack_blocks(ids, 100, 100)[0]) / 4


def test_encoder_equals_the_library(definition, library, monkeypatch):
    encoder = tokenfiles.Encoder(definition, tokenfiles.rules_of(definition))
    assert encoder._split
    every = [f"a{chr(c)}b {chr(c)} {chr(c)}1" for c in [*range(0x400), *range(0x1E00, 0x2100), *range(0xFB00, 0xFB10)]]
    texts = ODD + every + [" ".join(ODD), "".join(ODD)]
    for text in texts:
        assert ours(encoder, text) == library(text), repr(text[:40])
    # Pieces of long texts, and words that are forgotten, change nothing.
    monkeypatch.setattr(tokenfiles, "_PIECE_CHARS", 7)
    monkeypatch.setattr(tokenfiles, "_KNOWN_WORDS", 32)
    encoder = tokenfiles.Encoder(definition, tokenfiles.rules_of(definition))
    for text in [*ODD, " ".join(ODD)]:
        assert ours(encoder, text) == library(text), repr(text[:40])


@settings(max_examples=60, deadline=None)
@given(text=st.text(max_size=60))
def test_encoder_on_any_text(text, definition, library):
    assert ours(tokenfiles.Encoder(definition, tokenfiles.rules_of(definition)), text) == library(text)


def test_other_tokenizers_get_whole_texts(library):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        definition = file.read()
    from tokenizers import Tokenizer

    encoder = tokenfiles.Encoder(definition, tokenfiles.rules_of(definition))
    assert encoder._split is None
    for text in ODD:
        assert ours(encoder, text) == Tokenizer.from_str(definition).encode(text, add_special_tokens=False).ids


def plain(rows, library):
    """{(id, start, n, crc)} for rows in order."""
    out, start = [], 0
    for name, text in rows:
        ids = [*library(text or ""), queries.END_ID]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_against_the_library(spark, folder, library):
    docs = queries.table(spark, folder, "documents").select("doc_id", "text").collect()
    want = plain(sorted(map(tuple, docs)), library)
    got = queries.op12_token_files(spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_edges_and_ranges(spark, definition, library, path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(3, None), (None, "no id"), (None, None)] + [(5, "same")] * 40
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS id", "2 AS tie", "'y' AS place").coalesce(1)
    manifest = tokenfiles.write(df, definition, f"file://{path}", queries.END_ID, file_ids=500, block_ids=64)
    files = sorted(manifest.collect(), key=lambda r: r["base"])
    assert len(files) > 2 and sum(f["n_docs"] for f in files) == len(rows)
    got = sorted(map(tuple, tokenfiles.read(manifest, "bigint").collect()), key=lambda r: r[1])
    want = plain(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)), library)
    assert got == want
    # Any range of ids, through the index.
    every = [i for name, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)) for i in [*library(t or ""), queries.END_ID]]
    for row in files:
        file = tokenfiles.TokenFile(row["file"])
        for begin, end in [(0, file.n_ids), (63, 65), (64, 128), (1, 2), (5, 5), (file.n_ids - 1, file.n_ids)]:
            begin, end = min(begin, file.n_ids), min(end, file.n_ids)
            assert file.ids(begin, end).tolist() == every[row["base"] + begin : row["base"] + end]
        file.close()
    none = spark.createDataFrame([], SCHEMA)
    assert tokenfiles.read(tokenfiles.write(none, definition), "bigint").count() == 0
    text_ids = spark.createDataFrame([("b", "x"), ("", "y"), (None, "z")], "doc_id string, text string")
    found = tokenfiles.read(tokenfiles.write(text_ids, definition), "string").orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [None, "", "b"]


def test_files_of_other_kinds_are_refused(path):
    import os

    os.makedirs(path)
    with open(f"{path}/x", "wb") as file:
        file.write(b"\0" * 100)
    with pytest.raises(ValueError, match="no file of token ids"):
        tokenfiles.TokenFile(f"{path}/x")
    writer = tokenfiles.Writer(f"{path}/y", pa.int64())
    assert writer.close()["n_ids"] == 0
    assert tokenfiles.TokenFile(f"{path}/y").ids(0, 0).tolist() == []
