"""Secret scans: known patterns, and formats learnt by grammar inference.

Three patterns find credentials of known kinds. Their values are the labelled
examples from which a probabilistic automaton is inferred for each kind: a
prefix tree counts the examples, and states are merged as long as their
frequencies are statistically compatible (Hoeffding's bound, with alpha the
chance of refusing a right merge). Classes of characters cannot tell a word in
capitals from a key, so ordinary tokens are described by their letters: counts of
symbol triples and of the use of capitals over the distinct tokens of all texts. Every token outside the
known spans, of any length, is then scored by the log ratio of its likelihood under
the best credential format (or as characters at random, for keys of no known
format) and as an ordinary token; the ends of tokens count in both.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import staged, text_of

# The patterns of the known kinds, in the order kinds are listed.
ASSIGN = re.compile(
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
# A shorter run fails the length rule anyway, and runs cannot overlap.
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
LEARNT = "format"

# What may stand in a token; dots, dashes and the like at its ends belong to the sentence.
TOKEN, SENTENCE = re.compile(r"[A-Za-z0-9+/_.=-]+"), ".-"
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=](?:[A-Za-z0-9+/_.=-]*[A-Za-z0-9+/_=])?")
# Examples a format is learnt from, per kind, and the characters of all of them: documented bounds.
MAX_EXAMPLES, MAX_EXAMPLE_CHARS = 500, 100_000
ALPHA = 0.05
# Natural logarithm of how much likelier a credential format must be.
MARGIN = 10.0

# Character classes and how many characters each stands for.
CLASS_OF = {c: "x" for c in "abcdef"} | {c: "l" for c in "ghijklmnopqrstuvwxyz"}
CLASS_OF |= {c: "U" for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {c: "0" for c in "0123456789"}
CLASS_OF |= {c: "+" for c in "+/_.=-"}
CLASS_SIZE = {"x": 6, "l": 20, "U": 26, "0": 10, "+": 6}
_CLASSES = str.maketrans(CLASS_OF)
# Symbols of ordinary tokens: 0 for the ends, letters without case, one for all digits, marks.
_SYMBOLS = "abcdefghijklmnopqrstuvwxyz0+/_.=-"
SYMBOLS = len(_SYMBOLS) + 1
_TO_SYMBOL = bytes(
    _SYMBOLS.find("0" if chr(b).isdigit() else chr(b).lower()) + 1 if b < 128 and (chr(b).isalnum() or chr(b) in "+/_.=-") else 0
    for b in range(256)
)
CASES = ("lower", "capital", "upper", "mixed")
MIXED = 3
# Tokens whose verdict a task remembers.
_KNOWN_TOKENS = 1 << 17
# Credentials of no known format: characters at random, and a length spread as a gamma
# distribution of this shape and scale (32 characters in the mean, hardly any below 8).
ANY_SIZE, ANY_SHAPE, ANY_SCALE = 64, 4, 8
# Rows per kind that one task of the first merging step keeps at most: MAX_EXAMPLES; and the steps' width.
_BUCKETS = 64
# The kind of rows that hold tokens instead of examples.
_TOKEN = len(KINDS)


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, place of the kind, value) of the known kinds, in order."""
    found = [(m.start(), m.end(), 0, m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), m.end(), 1, m.group()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2, m.group()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, known: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Tokens that overlap no known span; ``known`` is ordered by start."""
    out, at, end = [], 0, 0
    for m in CANDIDATE.finditer(text):
        # The furthest end of the spans that begin before the token's end.
        while at < len(known) and known[at][0] < m.end():
            end = max(end, known[at][1])
            at += 1
        if end <= m.start():
            out.append((m.start(), m.end(), m.group()))
    return out


def tokens_of(text: str, known: list[tuple[int, int, int, str]]) -> set[str]:
    """The different candidates of a text; their places are only looked for where known spans may overlap them."""
    if known:
        return {token for _, _, token in candidates(text, known)}
    found = {token.strip(SENTENCE) for token in set(TOKEN.findall(text))}
    found.discard("")
    return found


class Automaton:
    """Probabilistic automaton over character classes, inferred by state merging."""

    def __init__(self, examples: list[str], alpha: float = ALPHA):
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._next: list[dict[str, int]] = [{}]
        self._count: list[dict[str, int]] = [defaultdict(int)]
        self._ends, self._visits = [0], [0]
        self._sizes = Counter(map(self._size, examples))
        for word in examples:
            self._add(word.translate(_CLASSES))
        self._merge_all()
        self._logs = self._weights()

    def _add(self, word: str) -> None:
        state = 0
        self._visits[0] += 1
        for c in word:
            self._count[state][c] += 1
            if c not in self._next[state]:
                self._next[state][c] = len(self._next)
                self._next.append({})
                self._count.append(defaultdict(int))
                self._ends.append(0)
                self._visits.append(0)
            state = self._next[state][c]
            self._visits[state] += 1
        self._ends[state] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return abs(f1 / n1 - f2 / n2) > self._bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        """Whether b's subtree looks like drawn from a's distribution."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self._visits[a], self._visits[b]
            if not n or not m:
                continue
            if self._differ(self._ends[a], n, self._ends[b], m):
                return False
            for c in self._next[a].keys() | self._next[b].keys():
                if self._differ(self._count[a].get(c, 0), n, self._count[b].get(c, 0), m):
                    return False
                if c in self._next[a] and c in self._next[b]:
                    todo.append((self._next[a][c], self._next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to the automaton from a on."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self._ends[a] += self._ends[b]
            self._visits[a] += self._visits[b]
            for c, below in self._next[b].items():
                self._count[a][c] += self._count[b][c]
                if c in self._next[a]:
                    todo.append((self._next[a][c], below))
                else:
                    self._next[a][c] = below

    def _merge_all(self) -> None:
        settled = [0]
        fringe = [(0, c) for c in sorted(self._next[0])]
        while fringe:
            source, c = fringe.pop(0)
            state = self._next[source][c]
            if state in settled:
                continue
            for known in settled:
                if self._compatible(known, state):
                    self._next[source][c] = known
                    self._fold(known, state)
                    break
            else:
                settled.append(state)
            seen = set(settled)
            fringe = [(s, c) for s in settled for c in sorted(self._next[s]) if self._next[s][c] not in seen]

    def _weights(self) -> list[dict[str, tuple[float, int]]]:
        """Log probability and target by state and class; '' is the end. One class more than seen keeps a share."""
        out = []
        for s in range(len(self._next)):
            total = self._visits[s] + 0.05 * (len(CLASS_SIZE) + 1)
            logs = {"": (math.log((self._ends[s] + 0.05) / total), s)}
            for c, size in CLASS_SIZE.items():
                chance = (self._count[s].get(c, 0) + 0.05) / total / size
                logs[c] = (math.log(chance), self._next[s].get(c, 0))
            out.append(logs)
        return out

    @staticmethod
    def _size(word: str) -> int:
        """Length in half octaves."""
        return round(2 * math.log2(max(len(word), 1)))

    def length_score(self, word: str) -> float:
        """Log likelihood of a length: merged states forget how long the examples were."""
        return math.log((self._sizes[self._size(word)] + 0.05) / (self._sizes.total() + 1))

    def score(self, classes: str) -> float:
        """Log likelihood of a string given as character classes."""
        logs, state, total = self._logs, 0, 0.0
        for c in classes:
            weight, state = logs[state][c]
            total += weight
        return total + logs[state][""][0]


def case_of(token: str) -> int:
    """Place in CASES: how a token uses capitals."""
    if token == token.lower():
        return 0
    if token == token.upper():
        return 2
    return 1 if token[1:] == token[1:].lower() else 3


class Plain:
    """Ordinary tokens: which symbol follows which two, and how capitals are used, counted over distinct tokens.

    What a single token shows is not counted: else a key would explain itself.
    """

    # A context's estimate weighs as much as that of the shorter one after so many occurrences.
    TRUST = 5.0
    # What no text shows is rare, not impossible: a word of another language is no key.
    SURPRISE, RAREST = 0.1, 0.01

    def __init__(self, triples: np.ndarray, cases: np.ndarray):
        counts = np.maximum(triples.reshape(SYMBOLS, SYMBOLS, SYMBOLS) - 1.0, 0)
        single = counts.sum(axis=(0, 1)) + 1.0
        single /= single.sum()
        double = counts.sum(axis=0)
        double = (double + self.TRUST * single) / (double.sum(axis=1, keepdims=True) + self.TRUST)
        chance = (counts + self.TRUST * double) / (counts.sum(axis=2, keepdims=True) + self.TRUST)
        chance = (1 - self.SURPRISE) * chance + self.SURPRISE / SYMBOLS
        chance[:, :, _TO_SYMBOL[ord("0")]] /= 10  # one symbol for ten digits
        self._logs = np.log(chance).ravel()
        share = (cases + 1.0) / (cases.sum() + len(CASES))
        self._cases = np.log(np.maximum(share, self.RAREST)).tolist()

    def scores(self, tokens: list[str]) -> np.ndarray:
        """Log likelihoods of tokens, none of them empty."""
        at, own = triples_of(tokens)
        values = np.where(own, self._logs[at], 0.0)
        starts = np.cumsum([0, *[len(t) + 2 for t in tokens[:-1]]])
        cases = np.array([case_of(t) for t in tokens])
        # In mixed tokens every letter's case is free.
        free = [sum(map(str.isalpha, t)) if c == MIXED else 0 for t, c in zip(tokens, cases.tolist(), strict=True)]
        return np.add.reduceat(values, starts) + np.array(self._cases)[cases] - math.log(2) * np.array(free)


def triples_of(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(places in a table of triples, which of them count) of tokens put one behind the other.

    A token gives a triple per character and one for its end; what follows its end
    before the next token does not count.
    """
    codes = ("\0\0" + "\0\0".join(tokens) + "\0\0").encode("ascii").translate(_TO_SYMBOL)
    c = np.frombuffer(codes, np.uint8).astype(np.int64)
    return (c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], (c[1:-1] > 0) | (c[2:] > 0)


class Formats:
    """Automata of the credential kinds, and ordinary tokens to tell them from."""

    def __init__(self, examples: dict[int, list[str]], plain: Plain):
        self.kinds = [Automaton(examples[k]) for k in range(len(KINDS)) if examples.get(k)]
        self.plain = plain
        self._known: dict[str, bool] = {}
        # No credential is likelier than this for each of its characters.
        weights = [w for a in self.kinds for logs in a._logs for c, (w, _) in logs.items() if c]
        self._most = max([-math.log(ANY_SIZE), *weights])

    def score(self, token: str) -> float:
        """By how much the likeliest credential format is likelier than an ordinary token."""
        return self._format(token) - float(self.plain.scores([token])[0])

    def _format(self, token: str) -> float:
        """Log likelihood under the likeliest credential format."""
        # A format written in capitals is the same format.
        forms = {token, token.lower()} if token == token.upper() else {token}
        shown = [form.translate(_CLASSES) for form in forms]
        n = len(token)
        length = (ANY_SHAPE - 1) * math.log(n) - n / ANY_SCALE - math.lgamma(ANY_SHAPE) - ANY_SHAPE * math.log(ANY_SCALE)
        any_format = length - n * math.log(ANY_SIZE)
        return max([any_format, *[a.score(x) + a.length_score(x) for a in self.kinds for x in shown]])

    def judge(self, tokens: Iterable[str]) -> None:
        """Work out the verdicts that are not known yet, all at once."""
        fresh = [t for t in set(tokens) if t not in self._known]
        if len(self._known) + len(fresh) > _KNOWN_TOKENS:
            self._known.clear()
        if not fresh or not self.kinds:
            self._known.update(dict.fromkeys(fresh, False))
            return
        for token, plain in zip(fresh, self.plain.scores(fresh).tolist(), strict=True):
            able = len(token) * self._most - plain > MARGIN
            self._known[token] = able and self._format(token) - plain > MARGIN

    def is_secret(self, token: str) -> bool:
        """Whether a token is a credential; without any known credential none is."""
        if token not in self._known:
            self.judge([token])
        return self._known[token]

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_known": {}}


def learn(docs: DataFrame, text_col: str = "text") -> Formats:
    """Formats from the known kinds' values, told from all other tokens of all texts.

    From each kind come the distinct values of the smallest hashes, at most
    MAX_EXAMPLES and MAX_EXAMPLE_CHARS characters: a bounded sample for learning
    only, taken by each task first and then in two steps. All other distinct tokens
    of all texts are counted, by a table of symbol triples. Kinds without a value
    get no format; without any, nothing but the known kinds is found. Null texts
    count as empty; repeated rows change nothing; an
    empty table teaches nothing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        kept: list[dict[str, int]] = [{} for _ in KINDS]
        tokens: set[str] = set()

        def smallest(values: dict[str, int]) -> dict[str, int]:
            return dict(sorted(values.items(), key=lambda x: (x[1], x[0]))[:MAX_EXAMPLES])

        def rows(cells: list[tuple]) -> pa.RecordBatch:
            types = [pa.int32(), pa.int64(), pa.string()]
            columns = zip(*cells, strict=True) if cells else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["kind", "h", "value"])

        for batch in batches:
            for cell in batch.column(0):
                text = cell.as_py()
                known = base_spans(text)
                for *_, kind, value in known:
                    if value not in kept[kind]:
                        kept[kind][value] = xxhash.xxh64_intdigest(value) >> 1
                tokens |= tokens_of(text, known)
                for k, values in enumerate(kept):
                    if len(values) > 4 * MAX_EXAMPLES:
                        kept[k] = smallest(values)
                if len(tokens) > _KNOWN_TOKENS:
                    yield rows([(_TOKEN, None, t) for t in tokens])
                    tokens.clear()
        yield rows([(_TOKEN, None, t) for t in tokens])
        yield rows([(k, h, v) for k, values in enumerate(kept) for v, h in smallest(values).items()])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triples, cases = np.zeros(SYMBOLS**3, np.int64), np.zeros(len(CASES), np.int64)
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            if tokens:
                at, own = triples_of(tokens)
                triples += np.bincount(at[own], minlength=len(triples))
                cases += np.bincount([case_of(t) for t in tokens], minlength=len(CASES))
        at = np.concatenate([np.nonzero(triples)[0], SYMBOLS**3 + np.nonzero(cases)[0]])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.concatenate([triples, cases])[at])], ["at", "n"])

    found = docs.select(text_of(text_col).alias("text")).mapInArrow(run, "kind int, h bigint, value string")
    found = staged(found, "tokens")
    distinct = found.where(F.col("kind") == _TOKEN).select("value").distinct()
    counts = distinct.mapInArrow(count, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n"))
    # One row per symbol triple and use of capitals at most, whatever the corpus.
    every = np.zeros(SYMBOLS**3 + len(CASES), np.int64)
    for row in counts.collect():
        every[row["at"]] = row["n"]
    triples, cases = every[: SYMBOLS**3], every[SYMBOLS**3 :]
    chosen = found.where(F.col("kind") < _TOKEN).select("kind", "h", "value").distinct()
    for by in (["kind", F.pmod("h", F.lit(_BUCKETS))], ["kind"]):
        order = Window.partitionBy(*by).orderBy("h", "value")
        chosen = chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= MAX_EXAMPLES).drop("rank")
    examples: dict[int, list[str]] = defaultdict(list)
    chars: dict[int, int] = defaultdict(int)
    for row in sorted(chosen.withColumn("size", F.length("value")).where(F.col("size") <= MAX_EXAMPLE_CHARS).drop("size").collect()):
        if chars[row["kind"]] + len(row["value"]) <= MAX_EXAMPLE_CHARS:
            chars[row["kind"]] += len(row["value"])
            examples[row["kind"]].append(row["value"])
    return Formats(examples, Plain(triples, cases))


def spans_of(text: str, formats: Formats) -> list[tuple[int, int, int]]:
    """(start, end, place of the kind) of all secrets of a text, in order; code points, end exclusive."""
    known = base_spans(text)
    found = [b[:3] for b in known]
    tokens = tokens_of(text, known)
    formats.judge(tokens)
    if not any(map(formats.is_secret, tokens)):
        return sorted(found, key=lambda x: (x[0], x[2], x[1]))
    found += [(c[0], c[1], len(KINDS)) for c in candidates(text, known) if formats.is_secret(c[2])]
    return sorted(found, key=lambda x: (x[0], x[2], x[1]))


def find(docs: DataFrame, formats: Formats, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, spans): one row per row of ``docs`` with an array of (kind, start, end).

    Ordered by start, then kind. Null texts count as empty: no spans. Spans of
    different kinds may overlap.
    """
    names = [*KINDS, LEARNT]
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [
                [{"kind": names[k], "start": i, "end": j} for i, j, k in spans_of(t.as_py(), formats)]
                for t in batch.column(1)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cells, pa.list_(span))], ["id", "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = picked.mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:int,end:int>>")
    return out.withColumnRenamed("id", id_col)


def redact(docs: DataFrame, formats: Formats, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret replaced by a mark; overlapping secrets get one. Null texts stay null."""

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for i, j, _ in spans_of(text, formats):
            if i >= at:
                out += [text[at:i], mark]
            at = max(at, j)
        return "".join([*out, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = pa.array([clean(t.as_py()) for t in batch.column(at)], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(
                [texts if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names
            )

    return docs.mapInArrow(run, docs.schema)
