import random

import numpy as np

from mdlake.llm import exact_dedup
from mdlake.llm.exact_dedup import build_filters, decode_filter, drop_copies, merge_counts


def test_filters_merge_losslessly():
    rng = np.random.default_rng(1)
    pool = np.concatenate([rng.integers(0, 2**64, 400, np.uint64), np.arange(5, dtype=np.uint64), np.array([2**64 - 1], np.uint64)])
    parts = [rng.choice(pool, n) for n in (1, 50, 2000, 0)] + [np.repeat(pool[:1], 70_000)]
    for bits in (1, 6, 12):
        found = {}
        for part in parts:
            for block, n, payload in build_filters(part, bits):
                found.setdefault(block, []).append(decode_filter(block, n, payload, bits))
        merged = [merge_counts(x) for x in found.values()]
        got = {int(k): int(c) for keys, counts in merged for k, c in zip(keys, counts, strict=True)}
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        assert got == {int(k): int(c) for k, c in zip(keys, counts, strict=True)}


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault("".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r"), []).append((-len(t or ""), i is None, i or 0))
    return {norm: (None if (best := min(g))[1] else best[2], len(g)) for norm, g in groups.items()}


def test_matches_brute_force_with_colliding_fingerprints(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, t) for i, t in enumerate([None, "", " \t", "a b", "ab", "a b", "a  b", "AB", "x" * 300_000, "x" * 300_000 + " "])]
    rows += [(100 + i, rng.choice(["hot text", "hot  text", "hottext"]) if i % 3 == 0 else f"text {rng.randint(0, 60)}") for i in range(300)]
    rows += [(None, "a b"), (7, "AB"), (None, "lonely")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS kept", "1 AS norm").repartition(5)
    want = brute(rows)
    for collide in (False, True):
        if collide:
            monkeypatch.setattr(exact_dedup.F, "xxhash64", lambda c: exact_dedup.F.length(c).cast("long"))
        got = exact_dedup.exact_dedup(docs).collect()
        assert len(got) == len(rows)
        keys = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got}
        assert keys == {(i, *want[n], i == want[n][0]) for i, t in rows for n in ["".join(c for c in t or "" if c not in " \t\n\x0b\x0c\r")]}
    left = drop_copies(docs)
    assert left.columns == docs.columns and left.count() == len(want)
    assert drop_copies(docs.limit(0)).count() == 0


def test_sieve_gives_the_same_result_and_lets_few_others_through(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot text", "hot  text"]) if i % 3 == 0 else f"text {rng.randint(0, 200)}" if i % 3 == 1 else f"alone {i}") for i in range(600)] + [(None, None), (5, ""), (6, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'k' AS fingerprint", "1 AS norm").repartition(4)
    want = sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()), key=str)
    left = sorted(map(tuple, drop_copies(docs).collect()), key=str)
    monkeypatch.setattr(exact_dedup, "BROADCAST_FINGERPRINTS", 0)
    assert sorted(map(tuple, exact_dedup.exact_dedup(docs).collect()), key=str) == want
    assert sorted(map(tuple, drop_copies(docs).collect()), key=str) == left
    known = spark.range(20_000).selectExpr("xxhash64(id) AS fingerprint")
    bits, power = exact_dedup._sieve(known, 20_000)
    hit = lambda df: exact_dedup._bits_of(df.toPandas()["fingerprint"].to_numpy().view(np.uint64), power)
    there = lambda at: np.unpackbits(bits)[at.astype(np.int64)]
    assert there(hit(known)).all() and there(hit(spark.range(50_000, 70_000).selectExpr("xxhash64(id) AS fingerprint"))).mean() < 0.08
