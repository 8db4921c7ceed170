"""The queries of the operators against plain versions of what they promise, on the smallest tables."""

import base64
import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash

from millrace.llm import queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def texts(spark, folder):
    return {r["doc_id"]: r["text"] or "" for r in queries.table(spark, folder, "documents").collect()}


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text))


def classes(names, linked):
    root = {n: n for n in names}
    changed = True
    while changed:
        changed = False
        for a in names:
            for b in linked[a]:
                if root[b] < root[a]:
                    root[a], changed = root[b], True
    return root


def test_op1(spark, folder, texts):
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in queries.op1_byte_bpe(spark, folder).collect()}
    assert got.keys() == texts.keys()
    for d, text in texts.items():
        ids = own.encode_ordinary(text)
        assert (got[d]["n_tokens"], got[d]["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert got[d]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op2(spark, folder, texts):
    prints = {}
    for d, text in texts.items():
        found = words(text)
        shingles = [" ".join(found[i : i + 4]) for i in range(len(found) - 3)] or ([" ".join(found)] if found else [])
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    near = {a: [b for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4] for a in prints}
    root = classes(list(prints), near)
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in queries.op2_simhash_near_duplicates(spark, folder).collect()}
    assert got == {(d, f"{p:016x}", root[d]) for d, p in prints.items()}


def test_op3(spark, folder):
    turns = defaultdict(list)
    for r in queries.table(spark, folder, "conversations").collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"] or ""))
    turns[-7] = [(0, "user", r"\### Assistant: </turn> ok"), (1, "assistant", r"\### Assistant: </turn> ok")]
    got = {r["conv_id"]: r for r in queries.op3_chat_windows(spark, folder).collect()}
    assert got.keys() == turns.keys()
    for conv, rows in turns.items():
        rows.sort()
        body = "".join(f"{role}\n{text}\n" for _, role, text in rows)
        loss = "".join(text for _, role, text in rows if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(rows), len(loss))
        assert r["turns_sha256"] == hashlib.sha256(body.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest() and r["formatted_chars"] >= len(body)


def vectors(spark, folder):
    rows = queries.table(spark, folder, "embeddings").collect()
    return {r["vec_id"]: np.array(r["embedding"], float) for r in rows if r["embedding"] and np.isfinite(np.array(r["embedding"], float)).all()}


def test_op5(spark, folder):
    x = {i: np.floor(256 * v).astype(np.int64) for i, v in vectors(spark, folder).items()}
    want = set()
    for q in (i for i in x if i % 50 == 0):
        best = sorted((-int(x[q] @ x[i]), i) for i in x if i != q and len(x[i]) == len(x[q]))[:5]
        want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    got = queries.op5_top_k(spark, folder).select("query_id", "rank", "vec_id", "score").collect()
    assert set(map(tuple, got)) == want and len(got) == len(want)


def test_op6(spark, folder, texts):
    train = {d for d in texts if zlib.crc32(str(d).encode()) % 7 != 2}
    counts = Counter(w for d in train for w in words(texts[d]))
    counts[None] = len(train)  # the end of a document
    n, v = sum(counts.values()), len(counts)
    for r in queries.op6_ngram_scores(spark, folder).collect():
        tokens = [*words(texts[r["doc_id"]]), None]
        base = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (r["doc_id"] not in train, len(tokens), n)
        assert r["n_known"] == sum(counts[t] > 0 for t in tokens)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] <= 0


def test_op7(spark, folder):
    x = {i: v / np.linalg.norm(v) for i, v in vectors(spark, folder).items() if np.any(v)}
    near = {a: [b for b in x if len(x[a]) == len(x[b]) and float(x[a] @ x[b]) >= 0.95] for a in x}
    root = classes(list(x), near)
    for r in queries.op7_embedding_near_duplicates(spark, folder).collect():
        i = r["vec_id"]
        want = (len(near[i]) - 1, root[i]) if i in x else (0, i)
        assert (r["n_links"], r["component_id"]) == want and r["kept"] == (i == want[1])


def test_op10(spark, folder, texts):
    found = queries.op10_packing(spark, folder).collect()
    placed, room = Counter(), Counter()
    for r in found:
        placed[r["doc_id"]] += r["n_words"]
        room[r["bin_id"]] += r["n_words"]
    assert placed == Counter({d: len(WORD.findall(t)) for d, t in texts.items()}) and max(room.values()) <= 2048
    assert {r["doc_id"] for r in found} == texts.keys()
