"""Token ids in binary files of patched frame-of-reference blocks.

A file holds the ids of documents, one after the other, in blocks of equal
length. Of each block the minimum is subtracted; the differences are packed at
the width that a chosen percentile of them needs. Those that need more bits are
exceptions: their places and high bits follow in a list. The index at the end
gives where each block begins, so a range of ids is read without reading the
blocks before it, and where each document ends.

Documents are range-partitioned by id; each task tokenizes its range and writes
its files, which no other attempt of the task shares. Which files count is what
the task returns, so a lost or repeated task leaves files that nothing names.
One row per file (the manifest) gives the order and the first id of each.

Layout, little-endian: ``MAGIC``; blocks (see ``pack_blocks``); index: block
starts as u64, document ends as u64, document ids as an Arrow stream; trailer
(see ``TRAILER``).
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged, text_of
from millrace.session import scratch

MAGIC = b"PFORIDS1"
BLOCK_IDS, PERCENTILE = 1024, 95
# A file is closed when it has this many ids; one document is never cut.
FILE_IDS = 8 << 20
# Places of index parts, numbers of ids and documents, block length, magic.
TRAILER = "<QQQQQI8s"
# Minimum, ids, exceptions, width.
_HEAD = "<IHHB"


def pack_blocks(ids: np.ndarray, length: int, percentile: float = PERCENTILE) -> list[bytes]:
    """Ids (unsigned 32-bit) as patched frame-of-reference blocks of ``length`` ids; the last may be shorter.

    A block: head; low bits of id - minimum, ``width`` each, first id in the lowest
    bits; places of the exceptions (u16); their bits above ``width`` (u32).
    """
    whole = len(ids) // length * length
    out: list[bytes] = []
    for rows in (ids[:whole].reshape(-1, length), ids[whole:].reshape(1, -1)):
        if not rows.size:
            continue
        n = rows.shape[1]
        base = rows.min(axis=1)
        left = (rows - base[:, None]).astype("<u4")
        # Bits that each difference needs; exact, as doubles hold 32-bit integers.
        bits = np.frexp(left.astype(np.float64))[1].astype(np.uint8)
        place = max(0, -int(-n * percentile // 100) - 1)
        widths = np.partition(bits, place, axis=1)[:, place]
        packed: list[bytes] = [b""] * len(rows)
        for width in np.unique(widths).tolist():
            of = np.nonzero(widths == width)[0]
            planes = np.unpackbits(left[of].view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
            low = np.packbits(planes.reshape(len(of), n * width), axis=1, bitorder="little")
            over = bits[of] > width
            for i, row in enumerate(of.tolist()):
                places = np.nonzero(over[i])[0]
                # Shifted as 64-bit integers: a width of 32 would be no shift of a 32-bit one.
                high = (left[row, places].astype(np.uint64) >> np.uint64(width)).astype("<u4")
                head = struct.pack(_HEAD, int(base[row]), n, len(places), width)
                packed[row] = head + low[i].tobytes() + places.astype("<u2").tobytes() + high.tobytes()
        out += packed
    return out


def unpack_block(data: bytes, at: int = 0) -> np.ndarray:
    """The ids of the block that begins at a place in ``data``."""
    base, n, exceptions, width = struct.unpack_from(_HEAD, data, at)
    at += struct.calcsize(_HEAD)
    size = (n * width + 7) // 8
    planes = np.zeros((n, 32), np.uint8)
    packed = np.frombuffer(data, np.uint8, size, at)
    planes[:, :width] = np.unpackbits(packed, count=n * width, bitorder="little").reshape(n, width)
    left = np.packbits(planes, axis=1, bitorder="little").view("<u4").ravel()
    at += size
    over = np.frombuffer(data, "<u2", exceptions, at)
    high = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    left[over] |= (high.astype(np.uint64) << np.uint64(width)).astype(np.uint32)
    return left + np.uint32(base)


class Writer:
    """One file; holds less than one block of ids and the index."""

    def __init__(self, path: str, id_type: pa.DataType, block_ids: int = BLOCK_IDS):
        system, place = pyarrow.fs.FileSystem.from_uri(path)
        system.create_dir(place.rpartition("/")[0], recursive=True)
        self.path, self._out = path, system.open_output_stream(place)
        self._block, self._type = block_ids, id_type
        self._at = self._out.write(MAGIC)
        self._waiting: list[np.ndarray] = []
        self._held = 0
        self._starts: list[int] = []
        self._ends: list[int] = []
        self._names: list = []
        self.ids = 0

    def add(self, ids: np.ndarray) -> None:
        """More ids of the document that ``end`` will close."""
        self._waiting.append(ids)
        self._held += len(ids)
        self.ids += len(ids)
        if self._held >= 64 * self._block:
            self._flush(self._held // self._block * self._block)

    def end(self, name) -> None:
        self._names.append(name)
        self._ends.append(self.ids)

    def _flush(self, number: int) -> None:
        every = np.concatenate([np.zeros(0, np.uint32), *self._waiting])
        for block in pack_blocks(every[:number], self._block):
            self._starts.append(self._at)
            self._at += self._out.write(block)
        self._waiting, self._held = [every[number:]], len(every) - number

    def close(self) -> dict:
        """Write the index; gives the file's row of the manifest."""
        self._flush(self._held)
        blocks = self._at
        self._at += self._out.write(np.array(self._starts, "<u8").tobytes())
        docs = self._at
        self._at += self._out.write(np.array(self._ends, "<u8").tobytes())
        names = self._at
        table = pa.table({"id": pa.array(self._names, self._type)})
        with pa.ipc.new_stream(self._out, table.schema) as stream:
            stream.write_table(table)
        self._out.write(struct.pack(TRAILER, blocks, docs, names, self.ids, len(self._ends), self._block, MAGIC))
        self._out.close()
        return {"file": self.path, "n_docs": len(self._ends), "n_ids": self.ids}


class TokenFile:
    """A file of token ids, read by ranges: only the blocks that hold a range are read."""

    def __init__(self, path: str):
        system, place = pyarrow.fs.FileSystem.from_uri(path)
        self._file = system.open_input_file(place)
        size = self._file.size()
        end = size - struct.calcsize(TRAILER)
        found = struct.unpack(TRAILER, self._read(end, size))
        self._index, docs, names, self.n_ids, self.n_docs, self._block, magic = found
        if magic != MAGIC:
            raise ValueError(f"{path} is no file of token ids")
        self._starts = np.append(np.frombuffer(self._read(self._index, docs), "<u8"), self._index).astype(np.int64)
        self.ends = np.frombuffer(self._read(docs, names), "<u8").astype(np.int64)
        self.names = pa.ipc.open_stream(self._read(names, end)).read_all().column("id")

    def _read(self, begin: int, end: int) -> bytes:
        return self._file.read_at(end - begin, begin)

    def ids(self, begin: int, end: int) -> np.ndarray:
        """The ids from one place of the file to another, end exclusive."""
        if begin >= end:
            return np.zeros(0, np.uint32)
        first, last = begin // self._block, (end - 1) // self._block + 1
        data, base = self._read(self._starts[first], self._starts[last]), self._starts[first]
        blocks = [unpack_block(data, int(s - base)) for s in self._starts[first:last]]
        return np.concatenate(blocks)[begin - first * self._block : end - first * self._block]

    def documents(self, ahead: int = 256) -> Iterator[tuple[int, int, Iterator[np.ndarray]]]:
        """(place among the documents, first id's place, parts of its ids) of each document, in order."""
        begin, held, at = 0, np.zeros(0, np.uint32), 0  # held: the ids from place ``at`` on
        step = ahead * self._block

        def parts(begin: int, end: int) -> Iterator[np.ndarray]:
            nonlocal held, at
            while begin < end:
                if begin >= at + len(held):
                    at = begin // self._block * self._block
                    held = self.ids(at, min(at + step, self.n_ids))
                part = held[begin - at : end - at]
                begin += len(part)
                yield part

        for i, end in enumerate(self.ends.tolist()):
            yield i, begin, parts(begin, end)
            begin = end

    def close(self) -> None:
        self._file.close()


# ---- the tokenizer ----------------------------------------------------------

# Lower-casing and composing leave these characters' words alone but for plain lower case.
_SIMPLE_END = 0x250
_PIECE_CHARS, _KNOWN_WORDS = 1 << 20, 1 << 19
_BREAKS = " \t\n\r"


def rules_of(definition: str) -> tuple[str, list[str]] | None:
    """(pattern, special tokens) of a tokenizer that lower-cases texts and encodes the matches one by one, else None.

    That is: composed (NFC), white space made single blanks, lower case; matches of
    the pattern kept, the rest dropped, each match shown by its bytes to the model.
    """
    config = json.loads(definition)
    steps = (config.get("normalizer") or {}).get("normalizers") or []
    replaced = [s for s in steps if s.get("type") == "Replace"]
    before = (config.get("pre_tokenizer") or {}).get("pretokenizers") or []
    fits = (
        [s.get("type") for s in steps] == ["NFC", "Replace", "Lowercase"]
        and replaced[0]["pattern"] == {"Regex": r"\s+"}
        and replaced[0]["content"] == " "
        and [s.get("type") for s in before] == ["Split", "ByteLevel"]
        and (before[0]["behavior"], before[0]["invert"]) == ("Removed", True)
        and (before[1]["add_prefix_space"], before[1]["use_regex"]) == (False, False)
        and not config.get("post_processor")
        and "Regex" in before[0]["pattern"]
    )
    return (before[0]["pattern"]["Regex"], [t["content"] for t in config.get("added_tokens") or []]) if fits else None


def _cut(text: str) -> Iterator[str]:
    """Pieces of a long text, cut at white space only."""
    at = 0
    while len(text) - at > _PIECE_CHARS:
        place = max(text.rfind(c, at, at + _PIECE_CHARS) for c in _BREAKS)
        if place <= at:
            found = [p for c in _BREAKS if (p := text.find(c, at + _PIECE_CHARS)) >= 0]
            place = min(found, default=len(text))
        yield text[at:place]
        at = place
    yield text[at:]


class _Remembered(dict):
    """Answers by key, worked out when first asked for and forgotten when there are too many."""

    def __init__(self, answer: Callable[[str], bytes], most: int):
        super().__init__()
        self._answer, self._most = answer, most

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self._most:
            self.clear()
        found = self[key] = self._answer(key)
        return found


class Encoder:
    """Ids of texts as the tokenizer library gives them, without special tokens added.

    For a tokenizer that splits texts into words which it encodes one by one, each
    distinct word goes through the library's model once a task: texts are cut at
    white space, and what stands between is looked up. Its rules for composing and
    lower-casing are only copied where they are plain: for texts of characters below
    U+0250. Other pieces, and those with a special token's text, are encoded by the
    library as they stand. Any other tokenizer gets whole texts.
    """

    def __init__(self, definition: str, rules: tuple[str, list[str]] | None):
        import regex
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(definition)
        self._split: Callable | None = None
        if rules:
            # White space is Unicode's property; this library's own class also holds four ASCII separators.
            self._split = regex.compile(rules[0].replace(r"\s", r"\p{White_Space}")).findall
            self._special = rules[1]
            # Four ASCII separators are white space to str.split, but not to the pattern.
            self._high = regex.compile(rf"[^\x00-\x1B\x20-\u{_SIMPLE_END - 1:04X}]").search
            # What the library makes of each simple character before its model sees it.
            simple = {c for code in range(_SIMPLE_END) for c in chr(code).lower()}
            shown = {ord(c): self._tokenizer.pre_tokenizer.pre_tokenize_str(c) for c in simple}
            self._shown = {c: found[0][0] for c, found in shown.items() if found}
        self._words = _Remembered(self._word, _KNOWN_WORDS)
        self._pieces = _Remembered(self._piece, _KNOWN_WORDS)
        self._odd_pieces = _Remembered(self._whole, _KNOWN_WORDS // 16)

    def _odd(self, text: str) -> bool:
        return any(s in text for s in self._special) or self._high(text) is not None

    def _whole(self, text: str) -> bytes:
        return np.array(self._tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        found = self._tokenizer.model.tokenize(word.translate(self._shown))
        return array("I", [t.id for t in found]).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of what stands between white space, lower-cased."""
        words = self._words
        if piece.isalpha():
            return words[piece]
        stem, last = piece[:-1], piece[-1]
        if stem.isalpha() and not last.isalnum():
            return words[stem] + words[last]
        return b"".join(map(words.__getitem__, self._split(piece)))

    def _simple(self, text: str) -> bytes:
        return b"".join(map(self._pieces.__getitem__, text.lower().split()))

    def parts(self, text: str) -> Iterator[np.ndarray]:
        if self._split is None:
            yield np.frombuffer(self._whole(text), "<u4")
            return
        for piece in _cut(text):
            if not self._odd(piece):
                yield np.frombuffer(self._simple(piece), "<u4")
                continue
            out = []
            for c in _BREAKS[1:]:
                piece = piece.replace(c, " ")
            for word in piece.split(" "):
                out.append(self._odd_pieces[word] if self._odd(word) else self._simple(word))
            yield np.frombuffer(b"".join(out), "<u4")


# ---- Spark ------------------------------------------------------------------

def write(
    docs: DataFrame,
    definition: str,
    folder: str | None = None,
    end_id: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_ids: int = FILE_IDS,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Tokenize texts and write their ids in ascending order of the id column; gives the manifest.

    ``definition`` is the tokenizer's JSON. Manifest: (file, n_docs, n_ids, base),
    ``base`` being the number of ids in the files before. Each document ends with
    ``end_id``, if given. Files go to ``folder``, by default one in the shared
    scratch folder. Null texts are empty; null ids come first; rows of one id stay
    in the order of the input, which also spreads a crowded id over tasks. An empty
    table gives an empty manifest. Other columns are not read.
    """
    spark = docs.sparkSession
    target = (folder or scratch(spark, "token-files")).rstrip("/")
    rows = docs.select(
        F.col(id_col).alias("id"), text_of(text_col).alias("text"), F.monotonically_increasing_id().alias("tie")
    )
    ordered = rows.repartitionByRange("id", "tie").sortWithinPartitions("id", "tie").select("id", "text")
    rules = rules_of(definition)
    ending = None if end_id is None else np.array([end_id], np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, writer, number = None, None, TaskContext.get().partitionId() << 32

        def row() -> pa.RecordBatch:
            nonlocal number
            done = {"place": number} | writer.close()
            number += 1
            return pa.RecordBatch.from_pylist([done], schema=manifest)

        manifest = pa.schema({"place": pa.int64(), "file": pa.string(), "n_docs": pa.int64(), "n_ids": pa.int64()})
        for batch in batches:
            encoder = encoder or Encoder(definition, rules)
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if writer is None:
                    path = f"{target}/{number:016x}-{uuid.uuid4().hex}.ids"
                    writer = Writer(path, batch.schema.field(0).type, block_ids)
                for part in encoder.parts(text.as_py()):
                    writer.add(part)
                if ending is not None:
                    writer.add(ending)
                writer.end(name)
                if writer.ids >= file_ids:
                    yield row()
                    writer = None
        if writer is not None:
            yield row()

    files = staged(ordered.mapInArrow(run, "place bigint, file string, n_docs bigint, n_ids bigint"), "manifest")
    # One row per file.
    before = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("file", "n_docs", "n_ids", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))


def read(manifest: DataFrame, id_type: str, id_col: str = "doc_id", files_per_task: int = 1) -> DataFrame:
    """(id_col, start, n_tokens, ids_crc32) of each document, from the files a manifest names.

    ``start`` counts the ids of all documents before it; ``ids_crc32`` is the CRC of
    its ids as little-endian unsigned 32-bit integers. Files are read block after
    block, whatever the length of a document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "start", "n_tokens", "ids_crc32"]
        for batch in batches:
            for row in batch.to_pylist():
                file = TokenFile(row["file"])
                starts, crcs = [], []
                for _, begin, parts in file.documents():
                    crc = 0
                    for part in parts:
                        crc = zlib.crc32(np.ascontiguousarray(part, "<u4"), crc)
                    starts.append(begin)
                    crcs.append(crc)
                begins = np.array(starts, np.int64)
                cells = [
                    file.names.combine_chunks(), pa.array(begins + row["base"]), pa.array(file.ends - begins),
                    pa.array(crcs, pa.int64()),
                ]
                file.close()
                yield pa.RecordBatch.from_arrays(cells, names)

    files = manifest.select("file", "base")
    tasks = max(1, manifest.count() // files_per_task)
    spread = files.repartition(tasks, "file")
    found = spread.mapInArrow(run, f"id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
    return found.withColumnRenamed("id", id_col)
