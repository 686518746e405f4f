import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mdlake.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS n", "'x' AS ints", "2 AS anchor_id", "3 AS score").repartition(4)


def brute(rows, every=100, top=5, low=80):
    """Every pair scored one by one."""
    known = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        row = (str(label), [math.floor(256 * float(np.float32(x))) for x in v])
        known[i] = min(known.get(i, row), row)
    out = set()
    for a, (own, x) in known.items():
        if a % every:
            continue
        scores = [(-sum(p * q for p, q in zip(x, y, strict=False)), i, label) for i, (label, y) in known.items() if i != a]
        scores.sort()
        for s, p, _ in [t for t in scores if t[2] == own][:top]:
            inside = [(-n, i) for n, i, label in scores if label != own and low * -s <= 100 * -n <= 100 * -s][:top]
            out |= {(a, p, k, i, -s, n) for k, (n, i) in enumerate(inside, 1)}
    return out


def mined(spark, rows):
    found = negatives.mine(negatives.usable(frame(spark, rows)), F.col("vec_id") % 100 == 0).collect()
    assert len(found) == len({tuple(r) for r in found})
    return {tuple(r) for r in found}


def odd_rows(seed=4, n=1500, dims=12):
    rng = random.Random(seed)
    hot = [rng.uniform(-1, 1) for _ in range(dims)]
    rows = []
    for i in range(n):
        v = list(hot) if i % 3 == 0 else [rng.gauss(0, 0.4) for _ in range(rng.choice([dims, dims, dims, 3, 0]))]
        rows.append((i * 7 % 5000, v, rng.choice([0, 0, 0, 1, 2, i % 50])))
    rows += [(100, hot, None), (200, None, 1), (None, hot, 1), (300, [float("nan")] * dims, 1), (400, [float("inf")] * dims, 1), (500, [None] * dims, 1), (90_000, hot, 77), (90_100, [-0.5] * dims, 78), (90_200, [0.0] * dims, 1)]
    return rows + rows[:200] + [(7, [0.1] * dims, 3)]


def test_matches_brute_force(spark):
    rows = odd_rows()
    got = mined(spark, rows)
    assert got == brute(rows) and len(got) > 100


def test_lower_thresholds_fill_the_windows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "WANTED", (1, 3))
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    rows = odd_rows(9, 700)
    assert mined(spark, rows) == brute(rows)


def test_components_too_large_for_exact_doubles(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-2e5, 2e5) for _ in range(6)], i % 3) for i in range(300)]
    assert mined(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(100, [0.5], 1)]) == set()


@pytest.mark.parametrize("scale", [1, 1000])
def test_index_loses_no_pair(spark, scale):
    rng = np.random.default_rng(2)
    spread = np.geomspace(300, 3, 32)
    rows, anchors = ((rng.normal(0, spread, (n, 32)) * scale).astype(np.int64) for n in (400, 50))
    frame_ = spark.createDataFrame([(r.tolist(),) for r in rows], "ints array<long>")
    moments = negatives.Moments(frame_)
    assert moments.n == 400 and np.allclose(moments.mean, rows.mean(0)) and np.allclose(moments.variance, rows.var(0))
    true = rows @ anchors.T
    for share in (0.5, 0.99):
        thresholds = np.quantile(true, share, axis=0)
        index = negatives.Index(anchors, thresholds, moments)
        row, anchor, score = index.pairs(rows[:, moments.order], np.arange(50))
        assert set(zip(row.tolist(), anchor.tolist(), score.tolist(), strict=True)) == {(i, j, int(true[i, j])) for i, j in zip(*np.nonzero(true >= thresholds), strict=True)}
    # Thresholds that no row can reach leave an anchor out of the index, high ones shorten it.
    norm = np.sqrt((anchors.astype(float) ** 2).sum(1))
    assert (negatives.Index(anchors, norm * moments.norm * 1.01, moments).steps == 0).all()
    assert negatives.Index(anchors, norm * moments.norm * 0.3, moments).steps.mean() < negatives.STEPS


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r[0], r[1], (r[2] + 1) % 10 if r[0] % 7 == 0 else r[2]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert {tuple(r) for r in queries.op12(spark, sf).collect()} == brute(rows)
