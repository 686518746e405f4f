import itertools
import random

import numpy as np
import xxhash

from mdlake.llm import simhash as module
from mdlake.llm.components import connected_components
from mdlake.llm.simhash import block_masks, drop_near_copies, link_fingerprints, near_groups, shard_stars, shards_of, signature, simhash

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def brute_simhash(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, fps, radius=3):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, f), (j, g) in itertools.combinations(zip(ids, fps, strict=True), 2):
        if bin(f ^ g).count("1") <= radius:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_masks_cover_every_pair():
    rng = random.Random(1)
    for blocks in (4, 5, 6, 7):
        masks = block_masks(3, blocks)
        for _ in range(500):
            x = rng.getrandbits(64)
            y = x ^ sum(1 << b for b in rng.sample(range(64), 3))
            assert any((x ^ y) & m == 0 for m in masks)


def test_forest_matches_all_pairs():
    rng = random.Random(2)
    for n in (1, 2, 60, 700):
        base = [rng.getrandbits(64) for _ in range(4)]
        values = []
        while len(values) < n:
            x = rng.choice(base)
            for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 5, 9, 20])):
                x ^= 1 << b
            values.append(x)
        values = list(dict.fromkeys(values))
        a = np.array(values, np.uint64)
        starts = np.array(sorted({0, len(values) // 3, len(values) // 2}))
        label = shard_stars(a, starts, 3)
        for s, e in zip(starts, [*starts[1:], len(values)], strict=True):
            want = brute_components(list(range(s, e)), values[s:e])
            assert {i: int(label[i]) for i in range(s, e)} == want


def test_groups_match_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choices(WORDS, k=120)) for _ in range(6)]
    texts = [None, "", " \t\n", "One", "one two", "One Two Three", "ÉTÉ été ABC"]
    for t in base:
        texts += [t, t.upper(), t.replace(" ", "\n\t"), t + " extra", "start " + t, " ".join(t.split()[:-2])]
    texts.append("long " * 200_000)
    rows = [(i * 7 % 1000 + 5, t, "x", "y") for i, t in enumerate(texts)]
    got = near_groups(spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id string").repartition(3)).collect()
    fps = {r[0]: brute_simhash(r[1]) for r in rows[:-1]}
    fps[rows[-1][0]] = simhash(rows[-1][1])
    want = brute_components(list(fps), list(fps.values()))
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(i, f"{f:016x}", want[i]) for i, f in fps.items()}
    assert len(got) == len(rows)


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id long, text string"
    rows = [(4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (None, None), (2, "")]
    got = sorted(((r.doc_id, r.component_id) for r in near_groups(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == sorted([(4, 4), (4, 4), (None, 4), (None, 2), (2, 2)], key=str)
    assert near_groups(spark.createDataFrame([], schema)).count() == 0


def test_crowded_shards_are_split(spark, monkeypatch):
    """A third of the fingerprints share 40 bits; with a small bound they move to finer shards and lose no link."""
    monkeypatch.setattr(module, "SPLIT_ENTRIES", 60)
    rng = random.Random(9)
    crowd = {0xABCDEF0123 << 24 | rng.getrandbits(24) for _ in range(500)}
    values = list(crowd | {rng.getrandbits(64) for _ in range(800)} | {x ^ 1 << rng.randrange(64) for x in rng.sample(sorted(crowd), 100)})
    reps = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v, i) for i, v in enumerate(values)], "fp long, rep long")
    sizes = [r["count"] for r in shards_of(reps, 3).groupBy("mask", "key").count().collect()]
    assert max(sizes) <= 60 and shards_of(reps, 3).select("mask").distinct().count() > len(block_masks(3, 4))
    got = {r.node: r.component for r in connected_components(link_fingerprints(reps)).collect()}
    want = brute_components(list(range(len(values))), values)
    assert {i: got.get(i, i) for i in want} == want


def test_components_match_union_find(spark):
    rng = random.Random(4)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2060)] + [(5, 5), (1, 2), (2, 1)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = [(r.node, r.component) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()]
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert len(got) == len(linked) and dict(got) == {x: find(x) for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_of_a_large_group_and_of_short_texts(spark):
    rng = random.Random(11)
    base = rng.choices([f"{a}{b}" for a in WORDS for b in WORDS], k=150)
    rows = [(10 + i, " ".join(base[:at] + [f"edit{i}"] + base[at + 1 :])) for i in range(120) for at in [rng.randrange(150)]]
    rows += [(500 + i, " ".join(rng.choices(WORDS, k=60))) for i in range(40)] + [(700, "Two words"), (701, "two  WORDS"), (702, "other"), (703, None), (704, ""), (705, "word " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS id", "2 AS hash", "3 AS shard").repartition(7)
    left = drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [10, *range(500, 540), 700, 702, 703, 704, 705]
    assert drop_near_copies(docs.limit(0)).count() == 0
    assert signature(None) == (0, []) and len(signature("a")[1]) == module.BANDS


def test_rows_without_an_id_connect_others(spark, monkeypatch):
    """Fingerprints 0, 7 and 63 are a chain over a row without an id."""
    rows = [(1, 0), (None, 7), (2, 63), (None, 0xFFFFF00000), (None, 0xFFFFF00001)]
    monkeypatch.setattr(module, "fingerprints", lambda *_: spark.createDataFrame(rows, "doc_id long, fp long"))
    got = module.near_groups(spark.createDataFrame([], "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, int(r.fingerprint, 16), r.component_id) for r in got), key=lambda r: r[1]) == [(1, 0, 1), (None, 7, 1), (2, 63, 1), (None, 0xFFFFF00000, None), (None, 0xFFFFF00001, None)]


def test_helper_names_do_not_clash(spark):
    text = " ".join(WORDS) + " tail"
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "else altogether here")], "doc_id long, text string").selectExpr("*", "1 AS __id", "2 AS __hash", "3 AS id", "4 AS node")
    kept = module.drop_near_copies(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 3}


def test_long_shards_over_many_batches():
    import pyarrow as pa

    shard = np.sort(np.random.default_rng(4).choice([1, 2, 2, 2, 2, 5, 6], 5000))
    other = np.arange(5000)
    batches = [pa.RecordBatch.from_arrays([pa.array(shard[a : a + 37]), pa.array(other[a : a + 37])], names=["s", "o"]) for a in range(0, 5000, 37)]
    got = list(module._shards(iter(batches), 1))
    assert all((np.diff(np.concatenate([g[k] for g in got])) >= 0).all() for k in (0, 1)) and sum(len(g[0]) for g in got) == 5000
    ends = [set(g[0].tolist()) for g in got]
    assert all(not a & b for i, a in enumerate(ends) for b in ends[i + 1 :])


def test_an_entry_is_tried_against_all_of_its_shard(spark, monkeypatch):
    """All texts are in one shard and within the radius, but only neighbours of each chain are similar; some fingerprints are equal."""
    monkeypatch.setattr(module, "signature", lambda text, size: (len(text) % 7, [1]))
    rng = random.Random(5)
    texts = {}
    for chain in range(3):
        words = [f"w{rng.randrange(10**6)}" for _ in range(330)]
        texts |= {chain + 3 * k: " ".join(words[12 * k : 12 * k + 150]) for k in range(4)}
    ids = rng.sample(range(100), len(texts))
    docs = {i: texts[k] for i, k in zip(ids, sorted(texts), strict=True)}
    sets = {i: module.shingle_set(t) for i, t in docs.items()}
    links = [(a, b) for a in docs for b in docs if a < b and module.jaccard(sets[a], sets[b]) >= 0.8]
    least = {i: i for i in docs}
    for _ in docs:
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
    kept = drop_near_copies(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values())) and len(set(least.values())) == 3


def test_retries_find_every_pair_of_different_labels():
    rng = np.random.default_rng(8)
    values = rng.integers(0, 2**64, 90, dtype=np.uint64) & np.uint64(0xFFFFFFFFFF)
    starts, label = np.array([0, 40, 41]), rng.integers(0, 5, 90)
    shard = np.searchsorted(starts, np.arange(90), side="right")
    want = {(i, j) for i in range(90) for j in range(i) if shard[i] == shard[j] and label[i] != label[j] and int(values[i] ^ values[j]).bit_count() <= 18}
    a, b, cut = module.shard_retries(values, starts, 18, label, 1000)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want and want and not cut.any()
    a, b, cut = module.shard_retries(values, starts, 18, label, 2)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) < want and cut.any()


def test_texts_apart_from_a_large_group_are_not_compared_with_it(spark, monkeypatch):
    """Sixty texts share a base with a group of near copies but have too many edits of their own to be similar to any."""
    rng = random.Random(12)
    base = rng.choices([f"{a}{b}" for a in WORDS for b in WORDS], k=150)

    def edited(name, places):
        words = list(base)
        for at in places:
            words[at] = f"{name}-{at}"
        return " ".join(words)

    docs = {i: edited(i, rng.sample(range(150), 1)) for i in range(100)} | {1000 + i: edited(i, [5, 25, 45, 65, rng.randrange(80, 150)]) for i in range(60)}
    docs |= {2000: docs[1007] + " end", 2001: docs[1020] + " end"}
    sets = {i: module.shingle_set(t) for i, t in docs.items()}
    least = {i: min(j for j in docs if j == i or i < 1000 and j < 1000 or module.jaccard(sets[i], sets[j]) >= 0.8) for i in docs}
    monkeypatch.setattr(module, "signature", lambda text, size: (len(text) % 3, [1]))
    tried, park = [], module.park

    def counting(df, name):
        found = park(df, name)
        if name == "tried":
            tried.append(found.count())
        return found

    monkeypatch.setattr(module, "park", counting)
    kept = drop_near_copies(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in docs if least[i] == i) and len(set(least.values())) == 61
    assert sum(tried) < 3 * len(docs)


def test_bounds_keep_every_similar_pair():
    rng = np.random.default_rng(3)
    core = rng.integers(0, 2**63, 150)
    sets = [set(rng.choice(core, 150 - (k := int(rng.integers(0, 30))), replace=False).tolist()) | set(rng.integers(0, 2**63, k).tolist()) for _ in range(80)]
    shared = {h for h in set().union(*sets) if sum(h in s for s in sets) > 1}
    n = np.array([len(s) for s in sets])
    counts = np.array([np.bincount([h % module.BUCKETS for h in s & shared], minlength=module.BUCKETS) for s in sets], np.uint32)
    starts, label = np.array([0, 30]), np.arange(80)
    values, shard = np.zeros(80, np.uint64), np.repeat([0, 1], [30, 50])
    a, b, cut = module.shard_retries(values, starts, 18, label, 1000, (n, counts), 0.8)
    similar = {(i, j) for i in range(80) for j in range(i) if shard[i] == shard[j] and module.jaccard(sets[i], sets[j]) >= 0.8}
    pairs = set(zip(a.tolist(), b.tolist(), strict=True))
    every = 30 * 29 // 2 + 50 * 49 // 2
    assert similar and similar <= pairs and len(pairs) < every / 2 and not cut.any()
    assert module.may_link(shard, n, counts.sum(1), 0.8)[list({i for p in similar for i in p})].all()
