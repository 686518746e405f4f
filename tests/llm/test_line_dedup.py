import hashlib
import random

import pytest

from mdlake.llm import line_dedup
from mdlake.llm.line_dedup import dedup_lines


def masked(line):
    return " ".join("<*>" if any(c in "0123456789" for c in t) else t for t in line.translate(str.maketrans("\t\x0b\x0c\r", "    ")).split(" ") if t)


def slots(tokens):
    """What a line may share with one that agrees: a block of positions, or all positions but one."""
    n, rest = len(tokens) // 5 + 1, len(tokens) - 3
    yield from (("block", j, tokens[3 + rest * j // n : 3 + rest * (j + 1) // n]) for j in range(n))
    yield from (("field", j, tokens[:j] + tokens[j + 1 :]) for j in range(3, len(tokens)))


def brute(rows):
    key = lambda d: 2**63 - 1 if d is None else d
    leaves = {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            if m := masked(line):
                tokens = tuple(m.split(" "))
                leaves.setdefault((len(tokens), tokens[:3]), {}).setdefault(tokens, set()).add(key(d))
    first = {}
    for (n, _), lines in leaves.items():
        first |= {t: min(own) for t, own in lines.items()}
        if n < 5 or len(lines) < 2 or len(set.union(*lines.values())) < 2:
            continue
        order = lambda t: (min(lines[t]), int(hashlib.md5(" ".join(t).encode()).hexdigest()[:15], 16))  # noqa: E731, B023
        leader, leads = {}, {}
        for t in sorted(lines, key=order):
            for slot in slots(t):
                lead = leader.setdefault(slot, t)
                if lead != t and 5 * sum(x == y for x, y in zip(lead, t, strict=True)) >= 4 * n:
                    leads.setdefault(t, []).append(min(lines[lead]))
        first |= {t: min(own) for t, own in leads.items()}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not masked(x) or first[tuple(masked(x).split(" "))] == key(d)]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


@pytest.mark.parametrize("broadcast", [1 << 20, 0])
def test_matches_brute_force(spark, monkeypatch, broadcast):
    monkeypatch.setattr(line_dedup, "BROADCAST_LEAVES", broadcast)
    rng = random.Random(3)
    pool = ["Page 12 of 30", "Page 7 of 9", "All rights reserved.", "user bob logged in from home", "user eve logged in from home", "user eve logged in  from work", "", "  ", "\tAll rights\treserved. "]
    pool += [f"request {w} took {i} ms" for i, w in enumerate("abc")] + [f"the cat sat on {w} mats today" for w in "xyz"]
    rows = [(i, "\n".join(rng.choice([*pool, f"own line {chr(97 + i % 26)} {chr(97 + i // 26)} here"]) for _ in range(rng.randint(0, 8)))) for i in range(150)]
    rows += [(None, "All rights reserved.\nonly here"), (None, "only here"), (500, None), (500, "Page 1 of 2"), (501, "word " * 100_000 + "\nAll rights reserved."), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS leaf", "'x' AS line", "2 AS gone").repartition(4)
    got = dedup_lines(docs).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)
    assert any(r.n_dropped for r in got)
    assert dedup_lines(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = dedup_lines(spark.createDataFrame([(1, "x")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_leaf_holds_several_templates(spark):
    """Four templates to a leaf with one or two fields, and strangers among them: each template is kept once."""
    rng = random.Random(5)
    letters = str.maketrans("0123456789", "qrstuvwxyz")
    rows, templates = [], [["the", "log", "says"] + [f"{c}{k}".translate(letters) for k in range(n - 3)] for n in (6, 9, 12, 23) for c in "abcd"]
    fields = [rng.sample(range(3, len(t)), 1 if len(t) < 10 else 2) for t in templates]
    for i in range(400):
        words = list(templates[k := rng.randrange(len(templates))])
        for at in fields[k]:
            words[at] = "".join(rng.choices("ghijk", k=4))
        stranger = ["the", "log", "says"] + ["".join(rng.choices("lmnop", k=5)) for _ in range(len(words) - 3)]
        rows.append((i, " ".join(words) + "\n" + " ".join(stranger)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, dedup_lines(docs).collect()))
    assert got == sorted(brute(rows))
    strangers, kept = {t.split("\n")[1] for _, t in rows}, [x for r in got for x in r[1].split("\n")]
    assert strangers <= set(kept)
    assert len(kept) - len(strangers) == len(templates)


def test_a_stranger_does_not_stop_a_template(spark):
    users = ["ann", "bob", "eve", "joe", "kim", "lee"]
    rows = [(i, f"session for user {u} opened by root") for i, u in enumerate(users, 2)] + [(1, "session for user tim was never here"), (9, "session for user closed all by root")]
    got = {r.doc_id: r.text for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, t in got.items() if t} == {1, 2, 9}


def test_rows_of_one_id_with_different_texts(spark):
    rows = [(1, "keep this first line\nown line of one"), (2, "x y z\nkeep this first line"), (2, "keep this first line\nother")]
    got = sorted((r.doc_id, r.text) for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, "keep this first line\nown line of one"), (2, "other"), (2, "x y z")]
