import itertools
import math
import random
from zlib import crc32

import numpy as np
import pytest

from mdlake.llm import queries, toxicity


def by_paths(lift, moves):
    """Marginals by listing every sequence of tags."""
    n, total, one, two = len(lift), 0.0, np.zeros(len(lift)), np.zeros((len(lift), 3))
    weight = {(0, 1): moves[1], (1, 0): moves[2], (1, 1): moves[3], (0, 0): 0.0}
    for tags in itertools.product((0, 1), repeat=n):
        e = math.exp(sum(a * b for a, b in zip(lift, tags, strict=True)) + moves[0] * tags[0] + sum(weight[p] for p in itertools.pairwise(tags)))
        total += e
        one += e * np.array(tags)
        for i, p in enumerate(itertools.pairwise(tags), 1):
            if p != (0, 0):
                two[i][{(0, 1): 0, (1, 0): 1, (1, 1): 2}[p]] += e
    return one / total, two / total


def test_forward_backward_sums_all_paths():
    rng = np.random.default_rng(1)
    parts, moves = [rng.normal(0, 3, n) for n in (3, 1, 9, 1, 7, 10)], rng.normal(0, 1.5, 4)
    first = np.concatenate([np.arange(len(p)) == 0 for p in parts])
    one, two = toxicity.forward_backward(np.concatenate(parts), first, moves)
    want = [by_paths(p, moves) for p in parts]
    assert np.allclose(one, np.concatenate([w[0] for w in want])) and np.allclose(two, np.concatenate([w[1] for w in want]))


def test_gradient_is_the_slope_of_the_likelihood():
    rng = np.random.default_rng(3)
    block = toxicity.Block.unpack(toxicity.Block.of(["bad bad ok", "ok fine", "badly ok bad"], [1, 0, 1]).pack())
    slot, marks = np.full(1 << toxicity.BITS, -1, np.int32), np.zeros(1 << toxicity.BITS, bool)
    used = np.unique(block.words)
    slot[used] = np.arange(len(used))
    marks[toxicity.tokenize(["bad"])[3][0, 0]] = True
    theta = rng.normal(0, 0.5, len(used) + 5)

    def loss(theta):
        field = toxicity.Field(slot, marks, theta)
        total, lift = 0.0, field.lifts(block.words)[block.tokens]
        labels = marks[block.words].any(1)[block.tokens] & (block.labels[block.doc] == 1)
        m = theta[field.n + 1 :]
        for d in range(3):
            own = block.doc == d
            score = lambda tags: lift[own] @ tags + m[0] * tags[0] + sum((0, m[1], m[2], m[3])[2 * a + b] for a, b in itertools.pairwise(tags))  # noqa: E731, B023
            total += math.log(sum(math.exp(score(np.array(t))) for t in itertools.product((0, 1), repeat=int(own.sum())))) - score(labels[own].astype(int))
        return total

    got = toxicity.Field(slot, marks, theta).gradient(block)
    for i in range(len(theta)):
        step = np.zeros(len(theta))
        step[i] = 1e-5
        assert abs((loss(theta + step) - loss(theta - step)) / 2e-5 - got[i]) < 1e-6


def test_tokens_and_features():
    texts = ["Ünï-code WORD.", None, "", "漢字 word1word", "İx"]
    doc, start, end, features = toxicity.tokenize(texts)
    assert [texts[d][a:b] for d, a, b in zip(doc, start, end, strict=True)] == ["Ünï", "code", "WORD", "漢字", "word", "word", "İx"]
    assert (features[2] == features[4]).all() and (features[4] == features[5]).all()
    longer = toxicity.tokenize(["wordless"])[3][0]
    assert longer[2] == features[4][2] and longer[0] != features[4][0]  # the same first four letters


def corpus(n=1500, seed=2):
    """Clean texts of random words, toxic ones with several words of two stems."""
    rng = random.Random(seed)
    syllables = ["ba", "de", "lo", "mi", "ru", "sa", "te", "vo", "ne", "ki"]
    word = lambda k: "".join(rng.choice(syllables) for _ in range(k))
    docs, labels = [], []
    for i in range(n):
        words = [word(rng.randint(1, 4)) for _ in range(rng.randint(15, 120))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["grzk", "pfuxl"]) + word(rng.randint(0, 2)))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS h", "1 AS y", "2 AS apart", "3 AS id").repartition(3),
        spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "1 AS quality", "'z' AS text"),
    )


def test_held_out_documents_and_spans(spark):
    docs, labels = corpus()
    extra = [(9001, None), (9002, ""), (9003, "123 !?"), (None, docs[0][1]), docs[5], (9004, "lo " * 300_000 + "grzkba pfuxlmi grzk pfuxl")]
    d, y = frames(spark, docs + extra, [*labels, (None, 1), (3, None), labels[7]])
    rows = toxicity.score(d, toxicity.learn(d, y)).collect()
    assert len(rows) == len(docs) + len(extra)
    truth = dict(labels)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.99 * len(held)
    text = dict(docs)
    spans = [(r, text[r.doc_id][s.start : s.end]) for r in held for s in r.spans]
    assert sum("grzk" in s or "pfuxl" in s for _, s in spans) >= 0.95 * len(spans) > 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[9001].score == by_id[9002].score == by_id[9003].score and by_id[9001].predicted == 0 and by_id[9001].spans == []
    assert by_id[9004].spans and by_id[9004].spans[-1].start >= 900_000
    assert len({(r.score, r.predicted) for r in rows if r.doc_id == docs[5][0]}) == 1


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = corpus(300)
    other = [(i, 1 - t if crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    d, y = frames(spark, docs, labels)
    _, z = frames(spark, docs, other)
    first, second = ({r.doc_id: r.score for r in toxicity.score(d, toxicity.learn(d, labels_)).collect()} for labels_ in (y, z))
    assert first == pytest.approx(second, abs=1e-9)


def test_without_classes(spark):
    docs, labels = corpus(40)
    d, y = frames(spark, docs, labels)
    assert {r.predicted for r in toxicity.score(d, toxicity.learn(d, y.limit(0))).collect()} == {0}
    assert {r.predicted for r in toxicity.score(d, toxicity.learn(d, y.selectExpr("doc_id", "1 AS toxic"))).collect()} == {1}
    assert toxicity.score(d.limit(0), toxicity.learn(d.limit(0), y)).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in queries.op11(spark, sf).collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    clean = [rows[i] for i, t in labels.items() if t == 0]
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
