"""Structure repair against every possible repair, and the query against a plain version."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from millrace.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
AFTER = {"": "u", "s": "u", "u": "a", "a": "u"}  # by the last initial of the repaired text


def every_repair(rows):
    """(cost, letters, turns) of the best among all repairs of rows (role, text, fault), by trying them."""
    best = None

    def walk(i, end, cost, letters, turns):
        nonlocal best
        for inserted in range(4):
            if i == len(rows):
                if end in ("", "a") and (best is None or (cost, letters) < best[:2]):
                    best = cost, letters, turns
            else:
                role, text, fault = rows[i]
                walk(i + 1, end, cost + 3, letters + "D", turns)
                if fault not in ("blank", "duplicate"):
                    extra = fault == "truncated"
                    if role[:1] and (role[0] == AFTER[end] or role[0] == "s" and end == ""):
                        walk(i + 1, role[0], cost + extra, letters + "K", [*turns, (role, text)])
                    new = {"u": "user", "a": "assistant"}[AFTER[end]]
                    walk(i + 1, new[0], cost + extra + 2, letters + "R", [*turns, (new, text)])
            end = AFTER[end]
            turns = [*turns, ({"u": "user", "a": "assistant"}[end], "")]
            cost, letters = cost + 2, letters + "I"

    walk(0, "", 0, "", [])
    return best


def stepwise(rows):
    """The same by keeping the best (cost, letters, turns) of each last initial: for longer texts."""
    now = {"": (0, "", ())}
    names = {"u": "user", "a": "assistant"}
    for role, text, fault in rows:
        new = {}
        for end, (cost, letters, turns) in now.items():
            for _ in range(3):
                ways = [(end, cost + 3, letters + "D", turns)]
                if fault not in ("blank", "duplicate"):
                    extra = fault == "truncated"
                    if role[:1] and (role[0] == AFTER[end] or role[0] == "s" and end == ""):
                        ways.append((role[0], cost + extra, letters + "K", (*turns, (role, text))))
                    a = AFTER[end]
                    ways.append((a, cost + extra + 2, letters + "R", (*turns, (names[a], text))))
                for last, *way in ways:
                    new[last] = min(new.get(last, way), way)
                end = AFTER[end]
                cost, letters, turns = cost + 2, letters + "I", (*turns, (names[end], ""))
        now = new
    done = []
    for end, (cost, letters, turns) in now.items():
        while end not in ("", "a"):
            end = AFTER[end]
            cost, letters, turns = cost + 2, letters + "I", (*turns, (names[end], ""))
        done.append((cost, letters, turns))
    return min(done)


def plain(rows, solve):
    """What the query returns for rows (turn, role, text) of one conversation after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    faults, seen, marked = dict.fromkeys(("blank", "duplicate", "truncated"), 0), set(), []
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = (
            "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
        )
        seen.add((role, text))
        if fault:
            faults[fault] += 1
        marked.append((role, text, fault))
    turns = {r[0] for r in rows} - {None}
    initials = [r[1][:1] for r in rows]
    cost, letters, out = solve(marked)
    return {
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **faults,
        "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "cost": cost,
        "audit": letters,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest(),
    }


def damaged(rows):
    """{conv: rows after damage} of rows (conv, turn, role, text)."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        fold = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = "" if fold == 1 else re.sub("[.!?]", "", text) if fold == 2 else text
        kept += [(turn, "user" if fold == 4 else role, text)] * (0 if fold == 0 else 2 if fold == 3 else 1)
    return found


def test_core_against_every_repair():
    steps = repair.Turns()
    names = {repair.SOUND: None, repair.DUPLICATE: "duplicate", repair.TRUNCATED: "truncated"}
    turns = [(r, "x", f) for r in ("system", "user", "assistant", "tool") for f in (repair.SOUND, repair.TRUNCATED)]
    turns.append(("user", "x", repair.DUPLICATE))
    rng = random.Random(2)
    cases = [c for n in range(4) for c in itertools.product(turns, repeat=n)]
    for rows in rng.sample(cases, 300) + cases[:91] + [tuple(rng.choices(turns, k=5)) for _ in range(30)]:
        states = steps.whole(bytes(repair.kind_of(r[0], r[2]) for r in rows))
        letters, cost, out = repair.apply(steps, list(rows), states, True)
        named = [(r, t, names[f]) for r, t, f in rows]
        assert (cost, letters, [(t["role"], t["text"]) for t in out]) == every_repair(named)
        assert (cost, letters) == stepwise(named)[:2]


def test_query_against_a_plain_version(spark, folder):
    got = {r["conv_id"]: r.asDict() for r in queries.op11_structure_repair(spark, folder).collect()}
    rows = [tuple(r) for r in queries.table(spark, folder, "conversations").select(*SCHEMA.replace(",", "").split()[::2]).collect()]
    want = {c: {"conv_id": c} | plain(t, stepwise) for c, t in damaged(rows).items()}
    assert got == want


@pytest.mark.parametrize("segment_turns", [1, 3, 50, 4096])
def test_one_conversation_with_most_turns(spark, segment_turns):
    rng = random.Random(segment_turns)
    texts = ["Yes.", "No", "Why?", "", " \t", "Well. ", None, "é中!", "a", "x" * 3000 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool"]
    rows = [(7, i // 2 if i % 5 else None, rng.choice(roles), rng.choice(texts) if i % 3 else f"own {i}.") for i in range(400)]
    rows += [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(20, 60) for t in range(rng.randrange(1, 9))]
    rows += [(None, None, None, None), (None, 1, "user", "Hi.")] + [(None, 2, "assistant", "Same.")] * 30
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS segment", "1 AS conv", "2 AS open", "3 AS live").repartition(5)
    found = repair.summary(repair.repair(queries.damaged(df), queries.F.col("kept"), segment_turns=segment_turns))
    got = {r["conv_id"]: r.asDict() for r in found.collect()}
    # Turns of one number come by role, then by the digest of the text: the order the operator states.
    marks = {r[0]: r[1] for r in spark.createDataFrame([(t or "",) for _, _, _, t in rows], "t string").selectExpr("t", "xxhash64(t)").collect()}
    for conv, turns in damaged(rows).items():
        marks |= {t: r for t, r in spark.createDataFrame([(t[2],) for t in turns] or [("",)], "t string").selectExpr("t", "xxhash64(t)").collect()} if conv in (7, None) else {}
        if conv in (7, None):
            turns = sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], marks[t[2]]))
            assert got[conv] == {"conv_id": conv} | plain(turns, stepwise), conv
    assert len(got) == len(damaged(rows))


def test_edges(spark):
    empty = hashlib.sha256(b"").hexdigest()
    none = spark.createDataFrame([], SCHEMA)
    assert repair.summary(repair.repair(none)).count() == 0
    rows = [(1, 0, "user", "Hi."), (2, 0, "system", "Be brief."), (2, 1, "user", "Q?"), (2, 2, "assistant", "A.")]
    df = spark.createDataFrame(rows, SCHEMA)
    gone = {r["conv_id"]: r for r in repair.summary(repair.repair(df, present=queries.F.col("conv_id") == 2)).collect()}
    assert gone[1].asDict() == {
        "conv_id": 1, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
        "repaired_sha256": empty,
    }
    assert (gone[2]["audit"], gone[2]["cost"]) == ("KKK", 0)
