import math
import zlib
from collections import Counter

import numpy as np
import pytest

from mdlake.llm import quality, queries
from mdlake.llm.quality import ORDER, SYMBOLS, classify, codes, kneser_ney, symbols


def padded(text, order):
    return [quality.SPACE] * (order - 1) + symbols(text)[ORDER - 1 :].tolist()


def brute_model(texts, order=ORDER):
    """Interpolated modified Kneser-Ney with dictionaries; returns p(tuple of `order` symbols)."""
    grams = Counter()
    for t in texts:
        s = padded(t, order)
        grams.update(tuple(s[i : i + order]) for i in range(len(s) - order + 1))
    levels = {order: grams}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    discounts, contexts = {}, {}
    for k, c in levels.items():
        n = [sum(v == j for v in c.values()) for j in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        discounts[k] = [min(j + 1.0, max(0.1, j + 1 - (j + 2) * y * n[j + 1] / n[j])) if n[j] else 0.75 for j in range(3)]
        contexts[k] = {}
        for g, v in c.items():
            contexts[k].setdefault(g[:-1], []).append(v)

    def p(g):
        if not g:
            return 1 / SYMBOLS
        k, lower = len(g), p(g[1:])
        seen = contexts[k].get(g[:-1])
        if not seen:
            return lower
        off = lambda v: discounts[k][min(v, 3) - 1]
        own = levels[k].get(g, 0)
        return ((own - off(own)) if own else 0) / sum(seen) + sum(map(off, seen)) / sum(seen) * lower

    return grams, p


def test_model_matches_dictionaries():
    texts = ["the cat sat on the mat. " * 3, "a hat, THE END!! 123", "été — 漢字", "abcabcabd"]
    grams, p = brute_model(texts)
    counts = np.zeros(SYMBOLS**ORDER, np.int64)
    for t in texts:
        np.add.at(counts, codes(symbols(t)), 1)
    table = kneser_ney(counts)
    assert table.reshape(-1, SYMBOLS).sum(1) == pytest.approx(1)
    for g in [*grams, (0, 0, 0), (63, 1, 2), (19, 7, 4)]:
        code = sum(x << quality.BITS * (ORDER - 1 - i) for i, x in enumerate(g))
        assert table[code] == pytest.approx(p(g))


def test_frames(spark):
    good = ["the quick brown fox jumps over the lazy dog and runs away " * 4, "the dog and the fox ran over the brown hill to the end of it " * 4]
    rows = [(i, good[i % 2], "en") for i in range(20)] + [(50, "zq$$ xv## QQQQ!! " * 20, "en"), (51, None, None), (52, "", "xx"), (None, good[0], "en"), (3, good[1], "en"), (53, good[0] * 3000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS perplexity", "2 AS id").repartition(3)
    trusted = spark.createDataFrame([(i,) for i in (*range(20), 3)], "doc_id long")
    got = classify(docs, trusted).collect()
    assert len(got) == len(rows)
    assert {r.doc_id for r in got if not r.kept} == {50}
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    grams, p = brute_model([t for i, t, _ in rows if i is not None and i < 20 and not out(i)])
    entropy = sum(-n * math.log2(p(g)) for g, n in grams.items()) / sum(grams.values())
    s = symbols(rows[20][1]).tolist()
    bits = sum(-math.log2(p(tuple(s[i : i + ORDER]))) for i in range(len(s) - ORDER + 1))
    want = 2 ** ((bits + quality.PRIOR * entropy) / (len(s) - ORDER + 1 + quality.PRIOR))
    assert next(r.perplexity for r in got if r.doc_id == 50) == pytest.approx(want, rel=1e-4)
    aside = {r.doc_id: r.perplexity for r in got if r.doc_id in range(20) and out(r.doc_id)}
    assert {r.threshold for r in got} == {max(aside.values())}
    assert all(r.kept and r.threshold is None for r in classify(docs, trusted.limit(0)).collect())
    assert classify(docs.limit(0), trusted).count() == 0


def test_query_matches_brute_force(spark):
    """Every perplexity, threshold and decision on whole tables."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    trusted = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality == 1 and r.toxic == 0}
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    order = quality.SHARDED_ORDER
    grams, p = brute_model([d.text for d in docs if d.doc_id in trusted and not out(d.doc_id)], order)
    memo = {}
    bits = lambda g: memo[g] if g in memo else memo.setdefault(g, -math.log2(p(g)))
    entropy = sum(n * bits(g) for g, n in grams.items()) / sum(grams.values())

    def perplexity(text):
        s = padded(text, order)
        n = len(s) - order + 1
        return 2 ** ((sum(bits(tuple(s[i : i + order])) for i in range(n)) + quality.PRIOR * entropy) / (n + quality.PRIOR))

    want = {d.doc_id: perplexity(d.text) for d in docs}
    aside = {}
    for d in docs:
        if d.doc_id in trusted and out(d.doc_id):
            aside.setdefault(d.lang, []).append(want[d.doc_id])
    every = [x for own in aside.values() for x in own]
    at = lambda xs: sorted(xs)[math.ceil(quality.QUANTILE * len(xs)) - 1]
    assert len({at(own) for own in aside.values()}) == len(aside) >= 4  # every language has a threshold of its own
    got = queries.op2(spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        bound = at(aside.get(r.lang, every))
        assert r.perplexity == pytest.approx(want[r.doc_id], rel=1e-4) and r.threshold == pytest.approx(bound, rel=1e-4)
        assert r.kept == (r.perplexity <= r.threshold)


def test_labels_of_the_tables(spark):
    """Documents of quality 1 that aren't toxic stay; junk goes; on rows that weren't counted and set no threshold."""
    sf = "/root/testdata/sf0.1"
    kept = {r.doc_id: r.kept for r in queries.op2(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    clean = [kept[r.doc_id] for r in labels if r.quality == 1 and r.toxic == 0]
    junk = [kept[r.doc_id] for r in labels if r.quality == 0]
    assert sum(clean) >= 0.99 * len(clean) and sum(junk) <= 0.08 * len(junk)


def test_other_scripts_are_told_apart(spark):
    good = "мама мыла раму и потом пошла домой к своим детям и мужу " * 6
    rows = [(i, good, "ru") for i in range(40)] + [(90, good[:200], "ru"), (91, "щъьы жшщъ ьъыщ фщъж эьъщ жъьщ " * 12, "ru")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.perplexity for r in classify(docs, spark.createDataFrame([(i,) for i in range(40)], "doc_id long")).collect()}
    assert got[91] > 3 * got[90]


def test_sharded_joins_give_the_same_model(spark, monkeypatch):
    """The tables of joined counts give the perplexities of the broadcast model for its order."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.unionByName(docs.limit(2)).unionByName(spark.createDataFrame([(None, None, "en", "s", 0), (-1, "", None, "s", 0)], docs.schema))
    texts = docs.filter("doc_id % 3 = 0").select("text")
    monkeypatch.setattr(quality, "_BLOCK_ROWS", 30)
    want = {(r.doc_id, r.lang): r.perplexity for r in quality.perplexities(docs, quality.count_ngrams(texts)).collect()}
    got = quality.sharded_perplexities(docs, texts, ORDER).collect()
    assert len(got) == docs.count()
    assert {(r.doc_id, r.lang): r.perplexity for r in got} == pytest.approx(want, rel=1e-4)
    higher = {r.doc_id: r.perplexity for r in quality.sharded_perplexities(docs, texts, 5).collect()}
    counted = [r.doc_id for r in docs.filter("doc_id % 3 = 0").collect()]
    assert all(higher[i] < want_i for (i, _), want_i in want.items() if i in counted and want_i > 3)


def test_postings_pack_losslessly():
    code = np.array([3, 3, 9, 2**24 - 1, 2**30 - 1])
    at, n = np.array([0, 65535, 7, 1, 2]), np.array([1, 65535, 300, 2, 9])
    got = quality._unpacked(quality._packed(code, at, n, quality.zstandard.ZstdCompressor()), quality.zstandard.ZstdDecompressor())
    assert all((x == y).all() for x, y in zip(got, (code, at, n), strict=True))


def test_sharded_odd_rows(spark):
    rows = [(1, None, "en"), (1, "", "en"), (2, "a" * 200_000, None), (None, "hello there", "en"), (2, "hello there", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS block", "2 AS code", "3 AS shard")
    trusted = spark.createDataFrame([(1,), (2,), (2,)], "doc_id long")
    got = classify(docs, trusted, sharded_order=4).collect()
    assert len(got) == len(rows) and len({r.perplexity for r in got if r.doc_id == 1}) == 1
    assert classify(docs.limit(0), trusted, sharded_order=4).count() == 0
    assert all(r.kept for r in classify(docs, trusted.limit(0), sharded_order=4).collect())
