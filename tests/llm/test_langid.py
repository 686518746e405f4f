import zlib
from collections import Counter

import pytest

from mdlake.llm import langid, queries


def brute_ngrams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    found = Counter()
    for w in words:
        found.update(w)
        padded = f" {w} "
        found.update(padded[i : i + 2] for i in range(len(padded) - 1))
        found.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return found


def ranked(counts, size=langid.PROFILE):
    code = lambda g: sum(ord(c) << 21 * i for i, c in enumerate(reversed(g)))
    return {g: r for r, g in enumerate(sorted(counts, key=lambda g: (-counts[g], code(g)))[:size])}


def brute(rows):
    """rows: (doc_id, text, lang) to {doc_id: (held_out, lang_pred, score)}."""
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    counts = {}
    for i, text, lang in rows:
        if lang is not None and text is not None and not out(i):
            counts.setdefault(lang, Counter()).update(brute_ngrams(text))
    profiles = {lang: ranked(c) for lang, c in sorted(counts.items())}
    result = {}
    for i, text, _ in rows:
        own = ranked(brute_ngrams(text or ""))
        if not own or not profiles:
            result[i] = (out(i), "und", 0.0)
            continue
        apart = {lang: sum(abs(p[g] - r) if g in p else langid.PROFILE for g, r in own.items()) for lang, p in profiles.items()}
        best = min(apart, key=apart.get)
        result[i] = (out(i), best, 1 - apart[best] / (langid.PROFILE * len(own)))
    return result


def test_query_matches_brute_force_and_is_accurate(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    want = brute([(d.doc_id, d.text, d.lang) for d in docs])
    got = queries.op5(spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.held_out, r.lang_pred) == want[r.doc_id][:2]
        assert r.score == pytest.approx(want[r.doc_id][2])
    lang = {d.doc_id: d.lang for d in docs}
    tested = [r for r in got if r.held_out and lang[r.doc_id]]
    assert sum(r.lang_pred == lang[r.doc_id] for r in tested) > 0.95 * len(tested)


def test_odd_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (3, "der hund und die katze", "de"), (4, None, "en"), (5, "123 !!", None), (None, "der", None), (7, "word " * 50_000, "en"), (7, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "'x' AS score", "1 AS lang_pred")
    got = langid.identify(docs, langid.learn_profiles(docs)).collect()
    assert {(r.doc_id, r.text and r.text[:3], r.lang_pred) for r in got} >= {(1, "the", "en"), (3, "der", "de"), (4, None, "und"), (5, "123", "und"), (None, "der", "de"), (7, "", "und")}
    assert all(0 <= r.score <= 1 for r in got)
    none = langid.identify(docs, langid.learn_profiles(docs.limit(0)))
    assert {r.lang_pred for r in none.collect()} == {"und"}
    stays = langid.keep_known(docs)
    assert stays.columns == docs.columns
    assert sorted(str(r.doc_id) for r in stays.collect()) == ["1", "3", "7", "None"]
