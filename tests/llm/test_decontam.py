import random

import numpy as np
import pytest

from mdlake.llm import decontam
from mdlake.llm.decontam import BenchmarkIndex, contaminated, drop_contaminated, shingle_size, similarity, words_of

WORDS = "one two three four five six seven eight nine ten eleven twelve".split()


def brute(docs, items):
    """Best similarity over every window of every item's size."""
    found = {}
    for d, text in docs:
        words = words_of(text)
        for i, item in items:
            own = words_of(item)
            size = shingle_size(len(own))
            if not own or len(words) < size:
                continue
            for s in range(max(1, len(words) - len(own) + 1)):
                score = similarity(words[s : s + len(own)], own, size)
                if score >= 0.8 and score > found.get((d, i), 0):
                    found[d, i] = score
    return found


def texts(seed, n):
    rng = random.Random(seed)
    items = [(i, " ".join(f"{rng.choice(WORDS)}{rng.choice(WORDS)}" for _ in range(rng.choice([2, 5, 9, 20, 40])))) for i in range(12)]
    items += [(20, ""), (21, None), (22, "the the the the the the the the")]
    docs = []
    for d in range(n):
        words = [f"{rng.choice(WORDS)}{rng.choice(WORDS)}" for _ in range(rng.randint(0, 60))]
        own = rng.choice(items)[1] or ""
        own = own.split()
        if own and rng.random() < 0.5:
            own[rng.randrange(len(own))] = "changed"
        if own and rng.random() < 0.3:
            own.insert(rng.randrange(len(own)), "added")
        if own and rng.random() < 0.3:
            del own[rng.randrange(len(own))]
        at = rng.randint(0, len(words))
        docs.append((d, " ".join(words[:at] + [" ".join(own).upper().replace(" ", ", ")] + words[at:])))
    docs += [(n, None), (n + 1, ""), (n + 2, "the " * 3000), (n + 3, "word " * 100_000)]
    return docs, items


def test_matches_every_window(spark):
    docs, items = texts(4, 150)
    want = brute(docs[:-1], items)
    frame = spark.createDataFrame(docs + docs[:3], "doc_id long, text string").selectExpr("*", "1 AS item_id", "'a' AS similarity")
    got = contaminated(frame, spark.createDataFrame(items + items[:2], "item_id long, text string")).collect()
    assert len(want) > 40 and len(got) == len(want)
    assert {(r.doc_id, r.item_id): r.similarity for r in got} == pytest.approx(want)


def test_multi_index_finds_all_within_the_radius():
    rng = random.Random(6)
    index = BenchmarkIndex([(i, " ".join(rng.choices(WORDS, k=8))) for i in range(40)])
    number = lambda x: int(x[0]) | int(x[1]) << 64
    flips = [number(index.fps[i % 40]) ^ sum(1 << b for b in rng.sample(range(128), k)) for i, k in enumerate([0, 5, 12, 20, 31, 32] * 20)]
    window, item = index._within(np.array([[f & 2**64 - 1, f >> 64] for f in flips], np.uint64), 8)
    want = {(w, i) for w, f in enumerate(flips) for i, g in enumerate(index.fps) if bin(f ^ number(g)).count("1") <= index.radius}
    assert set(zip(window.tolist(), item.tolist(), strict=True)) == want
    assert index.radius == 31


def test_candidates_and_recall_of_a_large_benchmark():
    """Over 20,000 items a window meets less than a hundredth of them, and similar items are found."""
    rng = random.Random(8)
    vocabulary = [f"{a}{b}" for a in WORDS for b in WORDS]
    items = [(i, rng.choices(vocabulary, k=20 + i % 120)) for i in range(20_000)]
    index = BenchmarkIndex([(i, " ".join(w)) for i, w in items])
    found = want = met = windows = 0
    for i, words in rng.sample(items, 150):
        own = list(words)
        for at in rng.sample(range(len(own)), max(1, len(own) // 60)):
            own[at] = "changed"
        score = similarity(own, words, 5)
        want += score >= 0.8
        found += score >= 0.8 and i in index.matches(" ".join(own))
        fps = decontam._fingerprints(decontam._hashes(own, 5)[None])
        met += len(index.candidates(fps, len(own))[0])
        windows += 1
    assert want > 60 and found >= 0.99 * want
    assert met / windows < 0.01 * len(items)


def test_benchmark_in_chunks(spark, monkeypatch):
    docs, items = texts(5, 40)
    frames = spark.createDataFrame(docs[:-1], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(tuple, contaminated(*frames).collect()))
    monkeypatch.setattr(decontam, "MAX_INDEX_BYTES", 600)
    assert sorted(map(tuple, contaminated(*frames).collect())) == whole


def test_empty_tables_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (1, "x")], "doc_id long, text string")
    items = spark.createDataFrame([(7, "A b c d e f")], "item_id long, text string")
    assert [tuple(r) for r in contaminated(docs, items).collect()] == [(None, 7, 1.0, 0)]
    assert [r.doc_id for r in drop_contaminated(docs, items).collect()] == [1]
    mixed = spark.createDataFrame([(None, "a b c d e f"), (None, "clean"), (5, "A b c d e f"), (5, "clean too"), (6, None)], "doc_id long, text string")
    assert sorted(r.text or "" for r in drop_contaminated(mixed, items).collect()) == ["", "clean", "clean too"]
    assert drop_contaminated(docs.limit(0), items).count() == 0
    assert contaminated(docs, items.limit(0)).count() == 0
    assert contaminated(docs.limit(0), items).count() == 0
