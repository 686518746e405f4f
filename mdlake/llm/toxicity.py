"""Toxicity: a linear-chain conditional random field tags toxic tokens; its marginals give document scores and spans.

Tokens are runs of letters, folded to lower case one by one. A token's features are itself, its first 3 to 6 and its
last 3 to 5 letters, hashed to 2^BITS buckets. Labels are of documents, so tokens get theirs by distance: a token of a
toxic document is toxic if one of its features is found in toxic documents far more often than in others (the lower
bound of its log odds is over TOKEN_ODDS); all other tokens are clean. The field has two states, weights for the
features whose odds differ surely enough from even ones, and four transition weights. It is fitted by full-batch
steps (resilient propagation): each is a job over the written training tokens that adds up gradients.

The document score is a logistic function of the sum and the density of the marginals, fitted on labelled rows (checksum
remainder CALIBRATION) that the field hasn't seen, weighted to the classes' true sizes. Spans of offending tokens have
offsets in code points of the original text.

Bounds: the classifier learns from at most TRAIN_ROWS distinct labelled texts of each class, those with the least
hashes of their text. Everything else covers all rows: each text is scored whole, in one pass without a shuffle, by a
table of 2^BITS weights that is broadcast (4 MB).

Defined cases: null and empty texts, and texts without letters, have the score of a document without tokens. Rows with
null ids or labels teach nothing; of repeated labels the larger counts; copies of a text teach once, with the largest
label. Without toxic or without clean rows every score is the share of toxic ones (0 where there are no labels).
Repeated rows get equal results, an empty table gives an empty result, other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import bounded, park, text_batches

BITS = 20
PREFIXES, SUFFIXES = (3, 4, 5, 6), (3, 4, 5)
WIDTH = 1 + len(PREFIXES) + len(SUFFIXES)
#: Distinct labelled texts of each class from which the field is learned, and as many for the document score.
TRAIN_ROWS = 6000
#: Log odds over which a feature makes a token of a toxic document toxic, and documents that must hold it.
TOKEN_ODDS, LEAST_DOCS = 1.0, 3
STEPS = 24
#: Weight of the prior that keeps weights small.
PRIOR = 0.05
THRESHOLD = 0.3
#: Marginal at which a token belongs to an offending span.
SPAN = 0.5
#: The remainder of an id's checksum modulo 4 that sets the document score; that of held-out rows teaches nothing.
CALIBRATION, HELD_OUT = 3, 2
#: Labelled ids (8 bytes each) up to which they are broadcast, and characters that are tagged at a time.
BROADCAST_IDS, CHARS = 1 << 20, 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """The lower-case code point of every letter; zero for what is no letter."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        if (c := chr(i)).isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: np.uint64) -> np.ndarray:
        out = np.full(n, base)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_BASE), run(_INVERSE)


def tokenize(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end, features) of each token; starts and ends are in code points of the document."""
    joined = "\n".join(t or "" for t in texts)
    points = _folding()[np.frombuffer(f" {joined} ".encode("utf-32-le", "surrogatepass"), np.uint32)]
    letter = points > 0
    edge = np.flatnonzero(letter[1:] != letter[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    size = 1 << max(10, int(len(points)).bit_length())
    power, inverse = _powers(size)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(points.astype(np.uint64) * power[: len(points)], out=sums[1:])
    length = end - start
    features = np.empty((len(start), WIDTH), np.int32)
    cuts = [(start, end), *((start, start + np.minimum(k, length)) for k in PREFIXES), *((end - np.minimum(k, length), end) for k in SUFFIXES)]
    for k, (a, b) in enumerate(cuts):
        mixed = ((sums[b] - sums[a]) * inverse[a] + np.uint64(k + 1)) * _BASE
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _BASE
        features[:, k] = (mixed >> np.uint64(64 - BITS)).astype(np.int32)
    begin = np.cumsum([1, *(len(t or "") + 1 for t in texts)])
    doc = np.searchsorted(begin, start, side="right") - 1
    return doc, start - begin[doc], end - begin[doc], features


def _scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """The values r of r -> (a r + b) / (c r + d) after each step, the first from 1.

    The steps are dealt to lanes that go side by side: lanes are composed first, which gives where each starts.
    """
    n = len(a)
    steps = max(1, math.isqrt(n) // 2)
    lanes = -(-n // steps)
    fill = lanes * steps - n
    a, b, c, d = (np.concatenate([x, np.full(fill, y)]).reshape(lanes, steps).T.copy() for x, y in ((a, 1.0), (b, 0.0), (c, 0.0), (d, 1.0)))
    p, q, r, s = np.ones(lanes), np.zeros(lanes), np.zeros(lanes), np.ones(lanes)
    for k in range(steps):
        p, q, r, s = a[k] * p + b[k] * r, a[k] * q + b[k] * s, c[k] * p + d[k] * r, c[k] * q + d[k] * s
        top = np.maximum(np.maximum(p, q), np.maximum(r, s))
        p, q, r, s = p / top, q / top, r / top, s / top
    at, now = np.empty(lanes), 1.0
    for k, (p_, q_, r_, s_) in enumerate(zip(p.tolist(), q.tolist(), r.tolist(), s.tolist(), strict=True)):
        at[k] = now
        now = min(max((p_ * now + q_) / max(r_ * now + s_, 1e-300), 1e-300), 1e300)
    out = np.empty((steps, lanes))
    for k in range(steps):
        at = np.clip((a[k] * at + b[k]) / np.maximum(c[k] * at + d[k], 1e-300), 1e-100, 1e100)
        out[k] = at
    return out.T.ravel()[:n]


def forward_backward(lift: np.ndarray, first: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(marginals, pair marginals) of tokens: lift is the log weight of toxic over clean, first marks where documents start.

    moves: log weights of (start toxic, clean to toxic, toxic to clean, toxic to toxic). Pair marginals are those of
    (clean, toxic), (toxic, clean), (toxic, toxic) with the token before, zero at a start.
    """
    n = len(lift)
    if not n:
        return np.zeros(0), np.zeros((0, 3))
    w = np.exp(np.clip(lift, -30, 30))
    begin, ct, tc, tt = np.exp(np.clip(moves, -30, 30))
    forth = _scan(np.where(first, 0.0, w * tt), np.where(first, w * begin, w * ct), np.where(first, 0.0, tc), np.ones(n))
    next_w, ends = np.append(w[1:], 1.0)[::-1], np.append(first[1:], True)[::-1]
    back = _scan(np.where(ends, 0.0, next_w * tt), np.where(ends, 1.0, tc), np.where(ends, 0.0, next_w * ct), np.ones(n))[::-1]
    odds = forth * back
    before, behind = np.concatenate(([1.0], forth[:-1])), w * back
    parts = np.stack([np.ones(n), ct * behind, before * tc, before * tt * behind], 1)
    pairs = parts[:, 1:] / parts.sum(1, keepdims=True)
    pairs[first] = 0
    return odds / (1 + odds), pairs


def _groups(texts: Iterator[tuple], chars: int = CHARS) -> Iterator[list[tuple]]:
    """Rows whose first value is a text, some CHARS characters at a time."""
    held, size = [], 0
    for row in texts:
        held.append(row)
        size += len(row[0] or "")
        if size > chars or len(held) == 1000:
            yield held
            held, size = [], 0
    if held:
        yield held


class Block:
    """Training documents: the features of each distinct token, the tokens of each document, and the labels."""

    def __init__(self, words: np.ndarray, tokens: np.ndarray, sizes: np.ndarray, labels: np.ndarray):
        self.words, self.tokens, self.sizes, self.labels = words, tokens, sizes, labels
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.first = np.concatenate(([True], self.doc[1:] != self.doc[:-1])) if len(self.doc) else np.zeros(0, bool)

    @classmethod
    def of(cls, texts: list[str | None], labels: list[int]) -> Block:
        doc, _, _, features = tokenize(texts)
        _, at, tokens = np.unique(features.view([("", np.int32)] * WIDTH).ravel(), return_index=True, return_inverse=True)
        return cls(features[at], tokens.ravel().astype(np.int32), np.bincount(doc, minlength=len(texts)).astype(np.int32), np.array(labels, np.int32))

    def pack(self) -> bytes:
        arrays = [self.words.ravel(), self.tokens, self.sizes, self.labels]
        return zstandard.compress(b"".join([np.array([len(a) for a in arrays], np.int32).tobytes(), *(a.astype("<i4").tobytes() for a in arrays)]))

    @classmethod
    def unpack(cls, data: bytes) -> Block:
        flat = np.frombuffer(zstandard.decompress(data), "<i4")
        parts = np.split(flat[4:], np.cumsum(flat[:3]))
        return cls(parts[0].reshape(-1, WIDTH), *parts[1:])

    def documents_with(self) -> tuple[np.ndarray, np.ndarray]:
        """(buckets, toxic or not) of each document and bucket that it holds."""
        words = np.unique(self.doc.astype(np.int64) << 32 | self.tokens)
        held = np.unique((words >> 32 << BITS)[:, None] | self.words[words & 0xFFFFFFFF])
        return held & ((1 << BITS) - 1), self.labels[held >> BITS]


class Field:
    """Weights of a field: slot gives each bucket's place among the weights, or -1."""

    def __init__(self, slot: np.ndarray, toxic: np.ndarray, theta: np.ndarray):
        self.slot, self.toxic, self.theta, self.n = slot, toxic, theta, len(theta) - 5

    def lifts(self, words: np.ndarray) -> np.ndarray:
        return np.append(self.theta[: self.n], 0.0)[self.slot[words]].sum(1) + self.theta[self.n]

    def gradient(self, block: Block) -> np.ndarray:
        """Of the negative log likelihood of a block's token labels."""
        labels = self.toxic[block.words].any(1)[block.tokens] & (block.labels[block.doc] == 1)
        marginal, pairs = forward_backward(self.lifts(block.words)[block.tokens], block.first, self.theta[self.n + 1 :])
        before = np.concatenate(([False], labels[:-1]))
        held = np.stack([~before & labels, before & ~labels, before & labels], 1)
        held[block.first] = False
        off = marginal - labels
        by_word = np.bincount(block.tokens, off, len(block.words))
        slots = self.slot[block.words]
        return np.concatenate([np.bincount(slots.ravel() + 1, np.repeat(by_word, WIDTH), self.n + 1)[1:], [off.sum(), off[block.first].sum()], (pairs - held).sum(0)])


def _facts(doc: np.ndarray, n: int, marginal: np.ndarray) -> np.ndarray:
    """What the document score looks at: one, the sum of its marginals (small and large ones told apart), and their density."""
    total, size = np.bincount(doc, marginal, n), np.bincount(doc, minlength=n)
    return np.stack([np.ones(n), np.log1p(100 * total), np.log1p(total), np.log1p(1000 * total / (size + 20))], 1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, prior: float = 1e-2) -> np.ndarray:
    """Coefficients by Newton's method, whose steps are halved until they help; a slight prior holds them small."""
    def loss(b: np.ndarray) -> float:
        return float((weight * (np.logaddexp(0, x @ b) - y * (x @ b))).sum() + prior / 2 * (b @ b))

    out = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ out, -30, 30)))
        slope = (x * (weight * p * (1 - p))[:, None]).T @ x + prior * np.eye(len(out))
        move, now = np.linalg.solve(slope, x.T @ (weight * (y - p)) - prior * out), loss(out)
        while np.abs(move).max() > 1e-9 and loss(out + move) > now:
            move = move / 2
        out = out + move
    return out


class Model:
    """What scoring needs: a weight for each bucket, the transition weights and the document score's coefficients."""

    def __init__(self, weights: np.ndarray, bias: float, moves: np.ndarray, score: np.ndarray):
        self.weights, self.bias, self.moves, self.score = weights, bias, moves, score

    def apply(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[dict]]]:
        """(scores, spans) of whole texts."""
        doc, start, end, features = tokenize(texts)
        first = np.concatenate(([True], doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, bool)
        marginal, _ = forward_backward(self.weights[features].sum(1, dtype=np.float64) + self.bias, first, self.moves)
        scores = 1 / (1 + np.exp(-np.clip(_facts(doc, len(texts), marginal) @ self.score, -30, 30)))
        hot = np.flatnonzero(marginal >= SPAN)
        spans: list[list[dict]] = [[] for _ in texts]
        if len(hot):
            opens = np.concatenate(([True], (hot[1:] != hot[:-1] + 1) | first[hot[1:]]))
            closes = np.append(opens[1:], True)
            for d, a, b in zip(doc[hot[opens]].tolist(), start[hot[opens]].tolist(), end[hot[closes]].tolist(), strict=True):
                spans[d].append({"start": a, "end": b})
        return scores, spans


def remainder(id_: Column) -> Column:
    return F.crc32(F.coalesce(id_.cast("string"), F.lit(""))) % 4


def _chosen(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[tuple[int, int], int]]:
    """(id, h, y, apart) of the rows that teach, and how many distinct texts there are of each (class, apart).

    docs: id, text; labels: id, y. At most TRAIN_ROWS rows for each class and part are chosen.
    """
    ids = park(labels.filter("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.max((F.col("y") > 0).cast("int")).alias("y")), "labelled")
    rows = docs.filter((remainder(F.col("id")) != HELD_OUT) & F.col("text").isNotNull()).select("id", F.xxhash64("text").alias("h"))
    rows = rows.join(bounded(ids, BROADCAST_IDS), "id")
    texts = rows.groupBy("h").agg(F.max("y").alias("y"), F.min("id").alias("id"))
    texts = park(texts.select("id", "h", "y", (remainder(F.col("id")) == CALIBRATION).cast("int").alias("apart")), "distinct-texts")
    sizes = {(r["y"], r["apart"]): r["count"] for r in texts.groupBy("y", "apart").count().collect()}
    out = None
    for y, apart in sorted(sizes):
        some = texts.filter((F.col("y") == y) & (F.col("apart") == apart)).orderBy("h").limit(TRAIN_ROWS)
        out = some if out is None else out.union(some)
    return (park(out, "chosen") if out is not None else texts), sizes


def _training_blocks(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(apart, data): packed blocks of the chosen rows, at most 4 * TRAIN_ROWS texts in all."""
    # docs may repeat an id; the hash tells which of its texts is meant.
    texts = docs.withColumn("h", F.xxhash64("text")).join(F.broadcast(chosen.withColumnRenamed("id", "chosen_id").withColumnRenamed("h", "chosen_h")), (F.col("id") == F.col("chosen_id")) & (F.col("h") == F.col("chosen_h")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {0: [], 1: []}
        rows = ((t, y, apart) for batch in batches for t, y, apart in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        for group in _groups(rows):
            for apart in held:
                some = [r for r in group if r[2] == apart]
                if some:
                    data = Block.of([r[0] for r in some], [r[1] for r in some]).pack()
                    yield pa.RecordBatch.from_arrays([pa.array([apart], pa.int32()), pa.array([data])], names=["apart", "data"])

    packed = text_batches(texts.select("text", "y", "apart")).mapInArrow(run, "apart int, data binary")
    return park(packed.repartition(24), "training")


def _over_blocks(blocks: DataFrame, apart: int, give, schema: str) -> DataFrame:
    """What give(block) yields as lists of columns, for each block of a part."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in give(Block.unpack(data.as_py()))], names=names)

    return blocks.filter(F.col("apart") == apart).select("data").mapInArrow(run, schema)


def _features(blocks: DataFrame, toxic: int, clean: int) -> Field:
    """A field without weights yet: the buckets that count, and those that make tokens toxic."""

    def count(block: Block) -> list:
        buckets, y = block.documents_with()
        kept, at = np.unique(buckets, return_inverse=True)
        return [kept, np.bincount(at.ravel(), y, len(kept)).astype(np.int64), np.bincount(at.ravel(), 1 - y, len(kept)).astype(np.int64)]

    sums = _over_blocks(blocks, 0, count, "bucket long, t long, n long").groupBy("bucket").agg(F.sum("t").alias("t"), F.sum("n").alias("n"))
    odds = F.log((F.col("t") + 0.5) / (toxic + 1.0)) - F.log((F.col("n") + 0.5) / (clean + 1.0))
    spread = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("n") + 0.5))
    marked = sums.filter(F.col("t") + F.col("n") >= LEAST_DOCS).withColumn("odds", odds).withColumn("spread", spread).filter(F.abs("odds") > F.col("spread"))
    # At most 2^BITS rows.
    found = marked.select("bucket", ((F.col("t") >= LEAST_DOCS) & (F.col("odds") - 2 * F.col("spread") > TOKEN_ODDS)).alias("toxic")).orderBy("bucket").toArrow()
    buckets = found.column("bucket").to_numpy()
    slot, marks = np.full(1 << BITS, -1, np.int32), np.zeros(1 << BITS, bool)
    slot[buckets] = np.arange(len(buckets))
    marks[buckets] = found.column("toxic").to_numpy(zero_copy_only=False)
    theta = np.zeros(len(buckets) + 5)
    theta[len(buckets)] = -3
    return Field(slot, marks, theta)


def _fit(field: Field, blocks: DataFrame) -> Field:
    """Resilient propagation over the whole training set; a gradient is a row of at most 2^BITS numbers a block."""
    step, last = np.full(len(field.theta), 0.3), np.zeros(len(field.theta))
    context = blocks.sparkSession.sparkContext
    tables = context.broadcast((field.slot, field.toxic))

    def gradient(theta: np.ndarray) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, total = Field(*tables.value, theta), np.zeros(len(theta))
            for batch in batches:
                for data in batch.column(0):
                    total += own.gradient(Block.unpack(data.as_py()))
            yield pa.RecordBatch.from_arrays([pa.array([total.astype("<f8").tobytes()])], names=["g"])

        rows = blocks.filter("apart = 0").select("data").mapInArrow(run, "g binary").collect()
        return sum((np.frombuffer(r["g"], "<f8") for r in rows), np.zeros(len(theta)))

    for _ in range(STEPS):
        slope = gradient(field.theta) + PRIOR * field.theta
        turn = slope * last
        step = np.clip(np.where(turn > 0, step * 1.2, np.where(turn < 0, step * 0.5, step)), 1e-4, 2)
        last = np.where(turn < 0, 0, slope)
        field.theta = field.theta - np.sign(last) * step
    tables.unpersist()
    return field


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """The model of labelled rows, those of remainder HELD_OUT left out. labels: the id and a label, 1 for toxic."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    chosen, sizes = _chosen(rows, labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("y")))
    total = {y: sizes.get((y, 0), 0) + sizes.get((y, 1), 0) for y in (0, 1)}
    if not sizes.get((0, 0)) or not sizes.get((1, 0)):
        share = (total[1] + 0.0) / max(1, sum(total.values()))
        constant = math.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(np.zeros(1 << BITS, np.float32), -30.0, np.zeros(4), np.array([constant, 0, 0, 0]))
    blocks = _training_blocks(rows, chosen)
    used = {key: min(n, TRAIN_ROWS) for key, n in sizes.items()}
    field = _fit(_features(blocks, used[1, 0], used[0, 0]), blocks)
    weights = np.append(field.theta[: field.n], 0.0)[field.slot].astype(np.float32)
    bias, moves = float(field.theta[field.n]), field.theta[field.n + 1 :]
    shared = blocks.sparkSession.sparkContext.broadcast(weights)

    def facts(block: Block) -> list:
        marginal, _ = forward_backward(shared.value[block.words].sum(1, dtype=np.float64)[block.tokens] + bias, block.first, moves)
        return [block.labels, *_facts(block.doc, len(block.sizes), marginal).T]

    part = 1 if sizes.get((0, 1)) and sizes.get((1, 1)) else 0
    seen = np.array(_over_blocks(blocks, part, facts, "y int, one double, small double, large double, density double").orderBy("y", "small", "large", "density").collect(), np.float64)
    y, x = seen[:, 0], seen[:, 1:]
    weight = np.where(y == 1, sizes[1, part] / used[1, part], sizes[0, part] / used[0, part])
    return Model(weights, bias, moves, _logistic(x, y, weight))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, spans) of every row, spans as arrays of (start, end) in code points."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for group in _groups((t.as_py(), i, h) for i, h, t in zip(ids, out, batch.column(2), strict=True)):
                scores, spans = shared.value.apply([g[0] for g in group])
                yield pa.RecordBatch.from_arrays([pa.array([g[1] for g in group], pa.int64()), pa.array([g[2] for g in group], pa.bool_()), pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32)), pa.array(spans, kind)], names=["doc_id", "held_out", "score", "predicted", "spans"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (remainder(F.col(id_col)) == HELD_OUT).alias("held_out"), F.col(text_col).alias("text"))
    return text_batches(rows).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start:long,end:long>>")
