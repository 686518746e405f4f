import base64
import itertools

import public_tokenizers as P
import tiktoken
from tests.llm.test_decontam import brute as brute_items
from tests.llm.test_langid import brute as brute_langs

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def brute_near(docs):
    """The smallest id of each component of documents whose sets of five-word shingles have a similarity of 0.8."""
    sets = {}
    for i, text in docs.items():
        words = text.translate({c: c + 32 for c in range(65, 91)}).split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(docs, 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) > 0:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in docs}


def test_pipeline_matches_brute_force(spark):
    docs = {d.doc_id: d for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    langs = brute_langs([(d.doc_id, d.text, d.lang) for d in docs.values()])
    stays = [i for i in docs if langs[i][1] != "und" and langs[i][2] >= 0.25]
    best = {}
    for i in stays:
        norm = "".join(c for c in docs[i].text if c not in " \t\n\x0b\x0c\r")
        best[norm] = min(best.get(norm, i), i, key=lambda j: (-len(docs[j].text), j))
    stays = sorted(best.values())
    groups = brute_near({i: docs[i].text for i in stays})
    stays = [i for i in stays if groups[i] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dirty = {d for d, _ in brute_items([(i, docs[i].text) for i in stays], items)}
    assert dirty
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {i: library.encode_ordinary(docs[i].text) for i in stays if i not in dirty}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == want
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)


def test_stages_keep_the_columns_and_survive_odd_tables(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "some words here", "en", "s", 5), (3, "some words here", "en", "s", 5), (None, "other words there", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == docs.columns
            frame = spark.createDataFrame(out.collect(), docs.schema)
        ids = corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
        assert all(r.round_trip for r in ids)
    assert sorted(str(r.doc_id) for r in corpus_pipeline.STAGES[1][1](spark, docs, SF).collect()) == ["1", "3", "None"]


def test_near_copies_without_or_with_equal_ids(spark):
    words = [f"word{i} " for i in range(200)]
    base, near, other = "".join(words), "".join(words[:190]) + "end", "".join(reversed(words))
    rows = [(5, near), (5, other), (None, base), (3, base), (None, "x" + other), (9, ""), (9, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.STAGES[2][1](spark, docs, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(5, other), (3, base), (9, ""), (9, None)], key=str)
