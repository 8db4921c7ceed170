"""Each operator against a plain version on small fixtures, and its defined results at the edges."""

import base64
import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import (
    bpe,
    chat,
    eliasfano,
    lines,
    neighbours,
    ngrams,
    packing,
    secretscan,
    simhash,
    topk,
    toxicity,
)
from millrace.llm.components import components

TEXTS = [
    None, "", " \t\n", "one", "ONE", "one two three four five six", "One two  three\tfour five six",
    "a b c d e f g h i j k l m n o p", "it's  a   test\x1c\x85   12345 中文 \U0001f600!!\r\n\r\n", "x" * 3000, "word " * 3000,
]
SCHEMA = "doc_id bigint, text string, source string, fp int, id string, key string, v string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"s{i % 3}", 0, "x", "y", "z") for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, None, None, None, None, None, None), (50, TEXTS[5], None, 1, "", "", "")]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 70), (70, 70), (None, 3), (100, 70), (200, 199)]
    edges += [(500, i) for i in range(501, 900)]
    found = dict(components(spark.createDataFrame(edges, "a bigint, b bigint"), "a", "b").collect())
    assert found == {i: 1 for i in range(1, 61)} | {70: 70, 100: 70, 199: 199, 200: 199} | {i: 500 for i in range(500, 900)}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").count() == 0


def test_bpe_equals_the_library_and_round_trips(docs, none):
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        vocabulary = file.read()
    own = tiktoken.Encoding(
        "own",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())},
        special_tokens={},
    )
    rows = bpe.decode(bpe.encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary).collect()
    texts = [r["text"] or "" for r in docs.collect()]
    expected = sorted((np.array(own.encode_ordinary(t), "<u4").tobytes(), t.encode()) for t in texts)
    assert sorted((bytes(r["ids"]), bytes(r["decoded"])) for r in rows) == expected
    assert bpe.encode(none, vocabulary, public_tokenizers.PATTERN).count() == 0


def plain_fingerprint(text, k=4):
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_equal_the_definition(docs):
    for text in TEXTS:
        assert simhash.fingerprint(text or "", 4) == plain_fingerprint(text)


def test_golay_keys_are_shared_by_all_near_words():
    tables, rng = simhash.golay_tables(), random.Random(1)
    for _ in range(1500):
        a = rng.getrandbits(64)
        b = a
        for i in rng.sample(range(64), rng.randrange(5)):
            b ^= 1 << i
        found = [set(simhash.keys_of(np.array([x], np.uint64), tables)[1].tolist()) for x in (a, b)]
        assert found[0] & found[1]


def test_simhash_classes(docs, none, spark):
    rng = random.Random(3)
    prints = {0}
    for _ in range(40):
        x = rng.getrandbits(64)
        for _ in range(8):  # chains and stars of near prints
            prints.add(x)
            y = x
            for i in rng.sample(range(64), rng.randrange(1, 6)):
                y ^= 1 << i
            x = y if rng.random() < 0.5 else x
            prints.add(y)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    mask = (1 << 64) - 1
    for bits in (4, 2):
        want = plain_components(signed, lambda a, b, bits=bits: ((a ^ b) & mask).bit_count() <= bits)
        got = dict(simhash.linked(spark.createDataFrame([(p,) for p in signed], "fp bigint"), bits).collect())
        assert len({(want[p], got[p]) for p in signed}) == len(set(want.values())) == len(set(got.values()))
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    by = {r["doc_id"]: r["component_id"] for r in rows}
    assert by[None] == by[0] == by[1] == by[2] == 0  # no word: fingerprint zero
    assert by[3] == by[4] and by[5] == by[6] == by[50] == 5
    assert simhash.near_duplicates(none).count() == 0
    with pytest.raises(ValueError):
        simhash.linked(spark.createDataFrame([], "fp bigint"), 5)


def test_chat_windows_keep_every_turn(spark):
    rng = random.Random(5)
    odd = ["\\", "### assistant:\n", "</turn>\n", "a#b<c\\", None, "", "plain words here", "w " * 300]
    rows = [(c, t, "system" if not t and c == 1 else rng.choice(["user", "assistant", None, "a:b\n#"]), rng.choice(odd))
            for c in (1, 2, None) for t in range(40)]
    rows += [rows[3], (4, None, "assistant", "x"), (4, None, "assistant", "x")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = chat.windows(turns, budget=120, history=50).collect()
    windows = defaultdict(list)
    for w in found:
        windows[w["conv_id"]].append(w)
    plain = defaultdict(list)
    for c, t, r, x in rows:
        plain[c].append(((t is not None, t or 0), r or "", x or ""))
    for conv, turns_ in plain.items():
        expected = [t[1:] for t in sorted(turns_)]
        own = sorted(windows[conv], key=lambda w: (w["segment"], w["window"]))
        assert [t for w in own for t in chat.parse(w["text"][w["new_from"] :])] == expected
        loss = [chat.unescape(w["text"][s["start"] : s["end"]]) for w in own for s in w["loss"]]
        assert loss == [x for r, x in expected if r == "assistant"]
        for w in own:
            new = list(chat.parse(w["text"][w["new_from"] :]))
            repeated = list(chat.parse(w["text"][: w["new_from"]]))
            assert w["cost"] == len(w["text"]) and (w["cost"] <= 120 or len(new) == 1 and not repeated)
            system = len("".join(chat.formatted(*expected[0])))
            if expected[0][0] == "system" and w is not own[0] and system + len("".join(chat.formatted(*new[0]))) <= 120:
                assert repeated[0] == expected[0]
    digest = {r["conv_id"]: r for r in chat.read_back(chat.windows(turns, 120, 50)).collect()}
    body = "".join(f"{r}\n{x}\n" for r, x in [t[1:] for t in sorted(plain[1])])
    assert digest[1]["turns_sha256"] == hashlib.sha256(body.encode()).hexdigest() and digest[4]["n_turns"] == 2
    assert chat.windows(turns.limit(0)).count() == 0


def test_a_long_system_turn_and_text_without_blanks(spark):
    """A window never costs more than the budget unless its one new turn does; costs are tokens."""
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        vocabulary = file.read()
    tokens = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks_of(vocabulary), special_tokens={}
    )
    rows = [(1, 0, "system", "rule " * 120)] + [(1, t, ("user", "assistant")[t % 2], "word " * 30) for t in range(1, 40)]
    rows += [(2, t, "assistant", "中文字符" * 40) for t in range(30)] + [(3, 0, "system", "s " * 600), (3, 1, "user", "x")]
    # All turns of one number: spread over ranges all the same.
    rows += [(4, None, "user", f"turn {t}") for t in range(300)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    odd = turns.withColumns({c: F.lit(1) for c in ("conv", "cost", "segment", "range", "copies")})
    found = chat.windows(odd, 256, 64, vocabulary=vocabulary, pattern=public_tokenizers.PATTERN).collect()
    for w in found:
        turns_in = list(chat.parse(w["text"]))
        assert w["cost"] == sum(len(tokens.encode_ordinary("".join(chat.formatted(*t)))) for t in turns_in)
        assert w["cost"] <= 256 or len(turns_in) == 1
    by = defaultdict(list)
    for w in found:
        by[w["conv_id"]].append(w)
    assert len(by[2]) > 10 and all(w["text"].startswith("### system") for w in by[1])
    assert sum(len(list(chat.parse(w["text"][w["new_from"] :]))) for w in by[4]) == 300
    assert chat.windows(odd.where("conv_id = 3"), 256, 64).count() == 2


def test_known_secrets_and_learnt_formats(spark, docs, none):
    rng = random.Random(2)

    def key():
        return "AKIA" + "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", k=16))

    texts = [f"some ordinary words thatarequitelonghere {key()} password = 'hunter22' and {'%032x' % rng.getrandbits(128)}" for _ in range(60)]
    texts += ["Token: abc", "api_key=\"A1b2C3d4\" apikey:zzzzzz", f"export KEY {key()[4:]}X9Q7 end", None, ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    formats = secretscan.learn(rows)
    found = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["spans"]] for r in secretscan.find(rows, formats).collect()}
    assert [k for k, _, _ in found[0]] == ["access", "assign", "hex"]
    assert found[60] == [] and [k for k, _, _ in found[61]] == ["assign", "assign"]
    assert found[62] and found[62][0][0] == secretscan.LEARNT  # like a known key, without its mark
    assert found[63] == found[64] == []
    clean = {r["doc_id"]: r["text"] for r in secretscan.redact(rows, formats).collect()}
    assert "hunter22" not in clean[0] and "thatarequitelonghere" in clean[0] and clean[63] is None
    assert secretscan.redact(docs, formats).columns == docs.columns
    assert secretscan.find(none, secretscan.learn(none)).count() == 0


def test_candidates_overlap_no_known_span():
    rng = random.Random(11)
    for _ in range(300):
        text = "".join(rng.choice(["a" * 17, "token=abcdefg", " ", "AKIA" + "Z" * 20, "0f" * 13, "-", "secret:x"]) for _ in range(12))
        known = secretscan.base_spans(text)
        found = [(m.start(), m.end(), m.group()) for m in secretscan.CANDIDATE.finditer(text)]
        plain = [c for c in found if not any(c[0] < b[1] and b[0] < c[1] for b in known)]
        assert secretscan.candidates(text, known) == plain


def test_automaton_merges_states_and_sums_to_one():
    rng = random.Random(4)
    words = ["".join(rng.choices("ab01", k=rng.randrange(1, 9))) for _ in range(400)]
    machine = secretscan.Automaton(words)
    reachable, todo = {0}, [0]
    while todo:
        for to in machine._next[todo.pop()].values():
            if to not in reachable:
                reachable.add(to)
                todo.append(to)
    assert len(reachable) < 12
    for s in reachable:
        total = math.exp(machine._logs[s][""][0])
        total += sum(math.exp(machine._logs[s][c][0]) * n for c, n in secretscan.CLASS_SIZE.items())
        assert abs(total - 1) < 1e-9
    assert machine.score("x0x0") > machine.score("UUUU")


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 6)).round(1)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)] + [(3, [float(c) for c in x[3]])]
    rows += [(1000, None), (1001, [1.0, None] + [0.0] * 4), (1002, [float("nan")] * 6), (1003, []), (1050, [0.5, 0.5]), (1051, [1.0, -1.0])]
    rows += [(1100, [1e30] * 6)]
    whole = np.floor(x * 256)
    for limit in (8192, 100):
        topk_shard, topk.SHARD_ROWS = topk.SHARD_ROWS, limit
        try:
            got = topk.top_k(spark.createDataFrame(rows[:-1], "vec_id bigint, embedding array<double>")).collect()
        finally:
            topk.SHARD_ROWS = topk_shard
        for q in range(0, 700, 50):
            score = whole @ whole[q]
            best = sorted((i for i in range(700) if i != q), key=lambda i: (-score[i], i))[:5]
            mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in got if r["query_id"] == q)
            assert mine == [(n + 1, i, int(score[i])) for n, i in enumerate(best)]
        assert [(r["vec_id"], r["score"]) for r in got if r["query_id"] == 1050] == [(1051, 128 * 256 - 128 * 256)]
    huge = topk.top_k(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()
    assert max(r["score"] for r in huge if r["query_id"] == 1100) <= 2**63 - 1
    assert topk.top_k(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_top_k_counts_every_row(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 6)).round(1)
    rows = [(i, x[i]) for i in range(120)] + [(i, x[i]) for i in (0, 0, 50, 7, 7, 7, 7, 7, 7)]  # rows repeated
    rows += [(50, x[9]), (50, x[9] + 1e-3), (8, -x[8]), (None, x[0]), (None, x[3])]  # ids that repeat or are missing
    rows += [(150, []), (150, []), (151, []), (200, [1e16, 0.0, 1e-3]), (201, [2e17, 5.0, 0.0]), (202, [1e17, -1e17, 1e-3]), (250, [2e17, 2e17, 1.0])]
    points = [(i, [math.floor(256 * c) for c in v]) for i, v in rows]
    want = Counter()
    for own, (q, v) in enumerate(points):
        if q is None or q % 50:
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=True)), i) for n, (i, w) in enumerate(points) if n != own and len(v) == len(w)]
        scored = [(max(-(2**63) + 1, min(2**63 - 1, s)), i) for s, i in scored]
        best = sorted(scored, key=lambda p: (-p[0], p[1] is None, p[1]))[:5]
        want.update((q, n + 1, i, s) for n, (s, i) in enumerate(best))
    table = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "vec_id bigint, embedding array<double>")
    for shard, block in ((8192, 4096), (30, 2)):
        monkeypatch.setattr(topk, "SHARD_ROWS", shard)
        monkeypatch.setattr(topk, "BLOCK_ROWS", block)
        assert Counter(map(tuple, topk.top_k(table).collect())) == want


def test_top_k_whatever_tasks_the_shards_go_to(spark, monkeypatch):
    # Small partitions merge into one task; as many tasks as a large table has show what does not meet.
    rng = np.random.default_rng(7)
    x = rng.normal(size=(400, 6)).round(1)
    whole = np.floor(x * 256)
    table = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for shard, block in ((8192, 4096), (40, 3)):
            monkeypatch.setattr(topk, "SHARD_ROWS", shard)
            monkeypatch.setattr(topk, "BLOCK_ROWS", block)
            got = sorted(map(tuple, topk.top_k(table).collect()))
            want = []
            for q in range(0, 400, 50):
                score = whole @ whole[q]
                best = sorted((i for i in range(400) if i != q), key=lambda i: (-score[i], i))[:5]
                want += [(q, n + 1, i, int(score[i])) for n, i in enumerate(best)]
            assert got == want
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_top_k_bound_holds_where_large_products_cancel():
    rng = np.random.default_rng(6)
    sign = np.array([1.0, -1.0] * 32)
    for _ in range(200):
        q = sign * rng.integers(2**22, 2**23)
        near, far = rng.integers(2**22, 2**23, size=2)
        left = [near - step * sign for step in (0, *rng.integers(1, 4, size=2))]
        right = [-far - step * sign for step in (0, 3, 0)]  # its best is as good, but later
        assert topk.Balls(np.array(left + right), leaf=3).search(q, np.ones(6, int), 1, -math.inf) == [(0, 0)]


def test_elias_fano():
    rng = np.random.default_rng(2)
    for n, universe in ((1, 1), (5, 5), (1000, 1500), (1000, 1 << 40), (3000, 40)):
        values = np.sort(rng.integers(0, universe, n))
        coded = eliasfano.EliasFano(values, universe, lambda a: a)
        assert (coded.access(np.arange(n)) == values).all()
        asked = np.concatenate([values, rng.integers(0, universe + 3, 500)])
        found = coded.find(asked)
        present = np.isin(asked, values)
        assert ((found >= 0) == present).all() and (values[found[present]] == asked[present]).all()


def test_language_model(spark, docs, none, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choices("a b c d e F g ä".split(), k=rng.randrange(60))) for _ in range(80)] + TEXTS
    rows = spark.createDataFrame([(i, t, i % 5 != 2) for i, t in enumerate(texts)], "doc_id bigint, text string, train boolean")
    monkeypatch.setattr(ngrams, "SPREAD", 50)  # so that contexts are spread over shards
    got = {r["doc_id"]: r for r in ngrams.scores(rows, F.col("train")).collect()}
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for t in texts]
    c, ctx, grams = Counter(), Counter(), Counter()
    for i, t in enumerate(tokens):
        if i % 5 != 2:
            c.update(t)
            ctx.update([None, *t[:-1]])
            grams.update(zip([None, *t[:-1]], t, strict=True))
    n, v, follow = sum(c.values()), len(c), Counter(u for u, _ in grams)
    for i, t in enumerate(tokens):
        base = score = 0.0
        for u, w in zip([None, *t[:-1]], t, strict=True):
            alone = (c[w] + 1) / (n + v + 1)
            base += math.log10(alone)
            rest = ngrams.DISCOUNT * follow[u] / ctx[u] if ctx[u] else 1
            share = max(grams[u, w] - ngrams.DISCOUNT, 0) / ctx[u] if ctx[u] else 0
            score += math.log10(share + rest * alone)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert abs(r["base_score"] - base) < 1e-6 and abs(r["score"] - score) < 2e-4 * len(t)
    assert ngrams.scores(none, F.lit(True)).count() == 0
    assert all(r["score"] == 0 for r in ngrams.scores(docs, F.lit(False)).collect())


def test_embedding_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(30, 16))
    x = np.concatenate([centres[rng.integers(0, 30, 300)] + rng.normal(size=(300, 16)) * 0.12, rng.normal(size=(100, 16))])
    x = np.concatenate([x, x[:5], centres[:1] + rng.normal(size=(200, 16)) * 0.02])
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [None] * 16), (903, [float("inf")] * 16), (904, []), (905, [1.0, 2.0]), (906, [2.0, 4.0])]
    got = {r["vec_id"]: r for r in neighbours.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")).collect()}
    assert len(got) == len(rows)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    want = plain_components(range(len(x)), lambda a, b: near[a, b])
    missed = sum(got[i]["n_links"] != near[i].sum() for i in range(len(x)))
    assert missed <= 0.02 * len(x)
    assert sum(got[i]["component_id"] != want[i] for i in range(len(x))) <= 0.02 * len(x)
    assert [(got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) for i in range(900, 905)] == [(0, i, True) for i in range(900, 905)]
    assert got[906]["component_id"] == 905 and not got[906]["kept"]
    assert neighbours.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_passes_follow_the_size_of_the_table(spark):
    assert neighbours.passes_for(1000, 0.95) == neighbours.LEAST_PASSES
    wanted = [neighbours.passes_for(n, 0.95) for n in (10**7, 10**8, 10**9, 10**10)]
    assert wanted == sorted(set(wanted)) and wanted[0] > neighbours.LEAST_PASSES
    # A window of one place makes a small table as hard as a large one: pairs at the
    # threshold, strangers otherwise.
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 24))
    y = rng.normal(size=(3000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y = 0.9501 * x + np.sqrt(1 - 0.9501**2) * y / np.linalg.norm(y, axis=1, keepdims=True)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("id", F.lit(1)).withColumn("v", F.lit(2))
    assert neighbours.passes_for(6000, 0.95, 1, 0.999) > neighbours.LEAST_PASSES
    found = neighbours.near_duplicates(df, window=1, recall=0.999).where("n_links > 0").count()
    assert found >= 6000 * 0.985
    fewer = neighbours.near_duplicates(df, passes=4, window=1).where("n_links > 0").count()
    assert abs(fewer / 6000 - (1 - (1 - (1 - math.acos(0.95) / math.pi) ** math.log2(6000)) ** 4)) < 0.06


def test_boilerplate_lines(spark):
    rows = [(i, "h", f"menu\nbody {i}\n\nmenu\nfoot {i % 4}") for i in range(20)] + [(50 + i, "g", "menu\nx") for i in range(3)]
    rows += [(90, None, None), (91, None, ""), (92, "h", "menu")]
    pages = spark.createDataFrame(rows, "page_id bigint, host string, text string")
    found = lines.without_boilerplate(pages, F.col("host"), F.split("text", "\n"), ratio=0.3)
    kept = {r["page_id"]: r["line_kept"] for r in found.collect()}
    assert kept[3] == ["body 3", "", "foot 3"] and kept[51] == []  # both lines stand on all pages of host g
    assert kept[90] is None and kept[91] == [""] and kept[92] == []
    odd = pages.withColumns({c: F.lit(1) for c in ("bad", "line_host", "line_kept", "line_bad")})
    same = lines.without_boilerplate(odd, F.col("host"), F.split("text", "\n"), ratio=0.3)
    assert same.columns == [*odd.columns, "line_all", "line_kept_"]
    assert {r["page_id"]: r["line_kept_"] for r in same.collect()} == kept


def test_toxicity_learns_a_pair_that_single_terms_do_not_show(spark, docs, none):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    data = []
    for i in range(1200):
        text = rng.sample(words, 12)
        insult, group = rng.random() < 0.45, rng.random() < 0.45
        text += ["insult"] * insult + ["folk"] * group
        data.append((i, " ".join(text), int(insult and group)))
    rows = spark.createDataFrame(data, "doc_id bigint, text string, toxic int")
    model = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"), usable=F.col("doc_id") % 4 != 2)
    scored = toxicity.score(rows, model).where("doc_id % 4 = 2").collect()
    assert sum(r["tox_predicted"] == r["toxic"] for r in scored) >= 0.95 * len(scored)
    assert toxicity.score(docs, model).count() == docs.count() and toxicity.score(none, model).count() == 0
    few = toxicity.fit(rows.select("doc_id", "text"), rows.select("doc_id", "toxic"), max_train=100)
    assert few.bias != model.bias
    odd = toxicity.score(rows.withColumn("TOX_score", F.lit("x")), model)
    assert odd.columns[-2:] == ["tox_score_", "tox_predicted"] and odd.where("tox_score_ >= 0.3 AND tox_predicted = 0").isEmpty()
    empty = toxicity.fit(none, rows.select("doc_id", "toxic"))
    assert {r["tox_score"] for r in toxicity.score(docs, empty).collect()} == {float(1 / (1 + np.exp(40.0)))}


def test_best_fit_is_the_tightest_compatible_bin():
    rng = random.Random(9)
    items = sorted(((rng.randrange(100), rng.randrange(4), rng.randrange(30)) for _ in range(400)), key=lambda x: -x[0])
    bins: list[list] = []
    for size, source, cluster in items:
        fits = [b for b in range(len(bins)) if bins[b][0] >= size and source not in bins[b][1] and cluster not in bins[b][2]]
        if not fits:
            bins.append([100, set(), set(), []])
            fits = [len(bins) - 1]
        best = min(fits, key=lambda b: (bins[b][0], b))
        bins[best][0] -= size
        bins[best][1].add(source)
        bins[best][2].add(cluster)
        bins[best][3].append((size, source, cluster))
    placed = packing.best_fit(items, 100)
    mine = defaultdict(list)
    for item, b in zip(items, placed, strict=True):
        mine[b].append(item)
    assert [mine[b] for b in range(len(bins))] == [b[3] for b in bins]


def test_packing_keeps_all_words_without_conflicts(docs, none):
    found = packing.pack(docs, F.xxhash64("text"), capacity=100).collect()
    words = Counter()
    for r in found:
        words[r["doc_id"]] += r["n_words"]
    expected = Counter()
    for r in docs.collect():
        expected[r["doc_id"]] += len((r["text"] or "").encode().split())
    assert words == expected
    room = Counter()
    for r in found:
        room[r["bin_id"]] += r["n_words"]
    assert max(room.values()) <= 100
    sources = {r["doc_id"]: r["source"] for r in docs.collect()}
    shared = Counter((r["bin_id"], sources[r["doc_id"]]) for r in found if sources[r["doc_id"]])
    assert max(shared.values()) == 1
    assert packing.pack(none, F.xxhash64("text")).count() == 0


def test_equal_rows_are_dealt_to_many_shards(spark):
    rows = spark.createDataFrame([(1, "a b c", "s")] * 900, "doc_id bigint, text string, source string")
    found = packing.pack(rows, F.xxhash64("text"), shard_rows=100).collect()
    assert len(found) == 900 and len({r["bin_id"] for r in found}) == 900
    sizes = Counter(r["bin_id"] // packing.SHARD_BINS for r in found)
    assert len(sizes) == 9 and max(sizes.values()) < 200


def test_ids_of_any_type_are_packed(spark):
    """Equal sizes are decided by the id, whatever its type, and by source and cluster where ids are null."""
    for kind, ids in (("string", ["", "b", None, "a", None]), ("double", [1.5, None, 0.0, -1.0, None]), ("date", [None] * 5)):
        rows = [(i, "one two", s) for i, s in zip(ids, ["x", None, "y", "", "x"])]
        df = spark.createDataFrame(rows, f"doc_id {kind}, text string, source string")
        found = packing.pack(df, F.when(F.col("source") == "x", 1)).collect()
        assert len(found) == 5 and {r["n_words"] for r in found} == {2}
        assert sorted(map(repr, (r["doc_id"] for r in found))) == sorted(map(repr, ids))


def test_lines_of_small_hosts(spark):
    """A page is no witness against its own lines, so hosts need no least number of pages."""
    rows = [(1, "one", "a\nb"), (2, "two", "a\nb"), (3, "two", "a\nc"), (4, "three", "a"), (5, "three", "b"), (6, "three", "c")]
    pages = spark.createDataFrame(rows, "page_id int, host string, text string")
    found = lines.without_boilerplate(pages, F.col("host"), F.split("text", "\n"), ratio=0.1)
    assert {r["page_id"]: r["line_kept"] for r in found.collect()} == {
        1: ["a", "b"], 2: ["b"], 3: ["c"], 4: ["a"], 5: ["b"], 6: ["c"],
    }
