import random
import sys
from functools import lru_cache
from hashlib import sha256
from itertools import groupby
from zlib import crc32

import pytest

from mdlake.llm import queries, repair

sys.setrecursionlimit(20_000)
SPACES = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for c, t, r, x in rows:
        k = crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if k == 1:
            x = ""
        if k == 2:
            x = "".join(y for y in x if y not in ".!?")
        out += [(c, t, "user" if k == 4 else r, x)] * {0: 0, 3: 2}.get(k, 1)
    return out


def brute(rows):
    """(cost, edits, text) of a conversation by trying every edit of every turn."""
    faults, seen = [], set()
    for _, _, r, x in rows:
        body = x.rstrip(SPACES)
        faults.append(1 if not body else 2 if (r, x) in seen else 0 if body[-1] in ".!?" else 3)
        seen.add((r, x))
    follow = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, state, inserts):
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserts < 3:
            for new in ("user", "assistant"):
                if then := follow.get((state, new[0])):
                    c, a, t = best(i, then, inserts + 1)
                    found.append((c + 2, "I" + a, (f"{new}:", *t)))
        if i < len(rows):
            c, a, t = best(i + 1, state, 0)
            found.append((c + 3, "D" + a, t))
            if faults[i] not in (1, 2):
                for letter, new, paid in (("K", rows[i][2], 0), ("R", "user", 2), ("R", "assistant", 2)):
                    if then := follow.get((state, new[:1])):
                        c, a, t = best(i + 1, then, 0)
                        found.append((c + paid + (faults[i] == 3), letter + a, (f"{new}:{rows[i][3]}", *t)))
        return min(found, default=(10**9, "", ()))

    cost, audit, text = best(0, "", 0)
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    first = [r[:1] for _, _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:], strict=False))
    return (gaps, *(faults.count(k) for k in (1, 2, 3)), illegal, cost, audit, sha256("\n".join(text).encode()).hexdigest())


def expected(rows):
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2], r[3])
    found = {c: (0, 0, 0, 0, 0, 0, "", sha256().hexdigest()) for c, *_ in rows}
    for c, own in groupby(sorted(damage(rows), key=order), key=lambda r: r[0]):
        found[c] = brute(list(own))
    return found


def odd_rows():
    rng, rows = random.Random(3), []
    for c in [None, *range(60)]:
        for t in range(rng.choice([0, 1, 2, 5, 9, 30])):
            text = rng.choice(["Yes.", "No!", "cut off", "", " \t", None, f"Turn {t}.", "ok?\n", "ünï 漢.\x85", "w" * 70_000])
            rows.append((c, rng.choice([t, t, t + 4, None]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text))
    return rows + rows[:9]


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS part", "1 AS block", "2 AS codes", "3 AS k0").repartition(5)


def run(spark, rows):
    turns = frame(spark, rows)
    return {r[0]: tuple(r[1:]) for r in repair.with_all(repair.report(repair.damaged(turns)), "conv_id", turns).collect()}


def test_matches_brute_force(spark):
    rows = odd_rows()
    assert run(spark, rows) == expected(rows)


def test_long_conversation_over_many_blocks(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["a.", "b", "c!", f"d {t}."])) for t in range(800)] + [(8, 1, "user", "same.")] * 400
    monkeypatch.setattr(repair, "BLOCK_TURNS", 16)
    assert run(spark, rows) == expected(rows)


def test_checkpoints_give_the_vectors_of_a_plain_pass():
    rng = random.Random(1)
    for n in (1, 2, 3, 10, 97, 100):
        codes = bytes(rng.choice(range(16)) for _ in range(n))
        plain = [repair.END]
        for code in reversed(codes):
            plain.append(repair.step(code, plain[-1]))
        assert list(repair.behind_each(codes, repair.END)) == plain[-2::-1]


def test_repaired_turns(spark):
    rows = odd_rows()
    turns = repair.damaged(frame(spark, rows))
    found = {}
    for r in sorted(repair.repaired_turns(turns).collect(), key=lambda r: r.position):
        found.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    want = {c: w[-1] for c, w in expected(rows).items() if w[-1] != sha256().hexdigest()}
    assert {c: sha256("\n".join(t).encode()).hexdigest() for c, t in found.items()} == want


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_query_has_every_conversation(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r[1:]) for r in queries.op13(spark, sf).collect()} == expected(rows)


@pytest.mark.parametrize("text,fault", [("", 1), (" \n", 1), ("a.", 0), ("a. \t", 0), ("a", 3), ("a.\x85", 3)])
def test_codes(text, fault):
    assert repair.code_of("user", text) == 1 | fault << 2
