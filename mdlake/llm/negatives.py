"""Hard negatives: for each anchor and each of its nearest rows of the same label, the nearest other-label rows in a window of scores below.

Scores are integer inner products. They are found by threshold joins in the manner of L2AP. A task holds a group of
anchors as an inverted index over dimensions, in falling order of their mean square. An anchor isn't indexed in its
last dimensions where the product of its norm there and the largest norm of all rows stays under its threshold: no row
can reach the threshold through them alone. Rows pass by in blocks and add partial scores dimension by dimension;
pairs whose partial score and product of remaining norms stay under the threshold are pruned; the others get their
exact score. Thresholds start high and are lowered for the anchors whose windows aren't full: first to where WANTED[0]
rows are expected above the window's lower edge by the mean and variance of all rows' dimensions, then WANTED[1], and
at last to the edge of the window itself, so the result is exact whatever the estimates are worth.

Groups of ANCHORS anchors meet slices of the rows, both by hashes of ids, so no label, copied vector or anchor makes
a task large; rows are shuffled once for each group of anchors. A task gives at most TOP rows for each window.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part. A repeated
id counts once, by its least label and vector. Shorter vectors count as zero in the dimensions they lack. An anchor
without another row of its label, and a positive without a negative in its window (a negative score has none), give no
row. Ties go to the smaller id; copies of a vector are rows of their own. Other columns are ignored. An empty table
gives an empty result. Scores must stay within a long.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mdlake.llm.common import park

TOP = 5
#: A window reaches from this many hundredths of the positive's score to the score itself.
LOW = 80
#: Rows that the first two thresholds are set to expect in a window; the third is the window's edge.
WANTED = (32, 512)
#: Anchors in a group, and rows that meet them at a time.
ANCHORS, ROWS = 4096, 512
#: Steps in which dimensions are added.
STEPS = 4
#: Norm products under this are exact as doubles, and so are all partial scores.
_EXACT = 2.0**52
_LEAST, _MOST = -(2**63), 2**63 - 1


def usable(rows: DataFrame, label: Column | str = "label", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, label, ints): rows that take part, each component as floor(256 * x); a repeated id counts once."""
    label = F.col(label) if isinstance(label, str) else label
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("string").alias("label"), F.col(vector_col).alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL").filter(fine)
    ints = F.transform("v", lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("long"))
    return rows.groupBy("vec_id").agg(F.min(F.struct("label", ints.alias("ints"))).alias("r")).select("vec_id", "r.label", "r.ints")


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (sizes == dims).all():
        return flat.reshape(len(sizes), dims)
    out = np.zeros((len(sizes), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


class Moments:
    """Number of rows, mean and variance of each dimension, and the largest norm, over all rows."""

    def __init__(self, rows: DataFrame):
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                dims = int(np.diff(batch.column(0).offsets.to_numpy()).max(initial=0))
                x = _matrix(batch.column(0), dims).astype(np.float64)
                own = np.zeros((4, dims + 1))
                own[0, :dims], own[1, :dims], own[2], own[3] = x.sum(0), (x * x).sum(0), len(x), (x * x).sum(1).max(initial=0)
                if total is not None:
                    wide = np.zeros((4, max(own.shape[1], total.shape[1])))
                    wide[:, : total.shape[1]] += total
                    wide[:2, : own.shape[1]] += own[:2]
                    wide[2], wide[3] = total[2, 0] + own[2, 0], max(total[3, 0], own[3, 0])
                    own = wide
                total = own
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.shape[1])), *(pa.array(t) for t in total)], names=["dim", "s", "q", "n", "norm"])

        parts = rows.select("ints").mapInArrow(sums, "dim long, s double, q double, n double, norm double")
        found = parts.groupBy("dim").agg(F.sum("s"), F.sum("q"), F.sum("n"), F.max("norm")).orderBy("dim").collect()
        self.dims = max(0, len(found) - 1)
        self.n = found[0][3] if found else 0.0
        self.norm = math.sqrt(max((r[4] for r in found), default=0.0))
        mean, square = (np.array([r[k] for r in found[: self.dims]]) / max(1.0, self.n) for k in (1, 2))
        self.mean, self.variance = mean, np.maximum(square - mean * mean, 0)
        self.order = np.argsort(-square, kind="stable")


class Index:
    """Anchors as lists by dimension, without the last dimensions that can't carry a row over the threshold."""

    def __init__(self, anchors: np.ndarray, thresholds: np.ndarray, moments: Moments):
        self.ints = anchors[:, moments.order]
        self.by_dim = self.ints.astype(np.float64)
        self.exact = float(np.sqrt((self.by_dim**2).sum(1)).max(initial=0)) * moments.norm < _EXACT
        self.edges = [round(k * moments.dims / STEPS) for k in range(STEPS + 1)]
        self.rest = np.stack([np.sqrt((self.by_dim[:, e:] ** 2).sum(1)) for e in self.edges], 1)
        self.thresholds = thresholds.astype(np.float64)
        #: Steps in which an anchor is indexed: up to the first edge behind which its threshold is out of reach.
        reach = self.rest * moments.norm * (1 + 1e-9) + 1e-6
        self.steps = (STEPS + 1 - (reach < self.thresholds[:, None]).sum(1)).clip(0, STEPS)
        self.lists = [np.flatnonzero(self.steps > k) for k in range(STEPS)]

    def pairs(self, rows: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor, score) of the pairs of these rows (dimensions in the index's order) and anchors at or above the anchor's threshold."""
        x = rows.astype(np.float64)
        partial, alive = np.zeros((len(rows), len(which))), np.ones((len(rows), len(which)), bool)
        alive[:, self.steps[which] == 0] = False
        steps = self.steps[which]
        for k in range(STEPS):
            here = np.flatnonzero((steps > k) & alive.any(0))
            if not len(here):
                break
            low, high = self.edges[k], self.edges[k + 1]
            partial[:, here] += x[:, low:high] @ self.by_dim[which[here], low:high].T
            remaining = np.sqrt((x[:, high:] ** 2).sum(1))
            bound = partial[:, here] + remaining[:, None] * self.rest[which[here], k + 1] * (1 + 1e-9) + 1e-6
            alive[:, here] &= bound >= self.thresholds[which[here]]
        row, at = np.nonzero(alive)
        score = np.zeros(len(row), np.int64)
        for start in range(0, len(row), 1 << 17):
            cut = slice(start, start + (1 << 17))
            r, a = row[cut], at[cut]
            if self.exact:
                # Dimensions that weren't indexed are added for the pairs that are left.
                total = partial[r, a]
                for k in range(STEPS):
                    late = np.flatnonzero(steps[a] <= k)
                    low, high = self.edges[k], self.edges[k + 1]
                    total[late] += np.einsum("ij,ij->i", x[r[late], low:high], self.by_dim[which[a[late]], low:high])
                score[cut] = np.rint(total)
            else:
                score[cut] = np.einsum("ij,ij->i", rows[r], self.ints[which[a]])
        kept = score >= np.where(np.isneginf(self.thresholds[which[at]]), _LEAST, np.ceil(self.thresholds[which[at]]).clip(-(2.0**62), 2.0**62).astype(np.int64))
        return row[kept], which[at[kept]], score[kept]


def _best(anchor: np.ndarray, window: np.ndarray, ids: np.ndarray, score: np.ndarray, top: int) -> tuple[np.ndarray, ...]:
    """The first rows of each (anchor, window) by falling score and rising id."""
    by = np.lexsort((ids, ~score, window, anchor))
    anchor, window, ids, score = anchor[by], window[by], ids[by], score[by]
    first = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1]))) if len(anchor) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(anchor)), 0)) if len(anchor) else np.zeros(0, int)
    keep = np.arange(len(anchor)) - start < top
    return anchor[keep], window[keep], ids[keep], score[keep]


def threshold_join(asked: DataFrame, rows: DataFrame, moments: Moments, same: bool, top: int = TOP) -> DataFrame:
    """(anchor_id, window, vec_id, score): the first rows of each window, of the anchor's label (same) or of others.

    asked: anchor_id, label, ints, lows, highs (a score window each, both ends included); rows: vec_id, label, ints.
    """
    spark = rows.sparkSession
    groups = max(1, math.ceil(asked.count() / ANCHORS))
    slices = max(1, math.ceil(2 * int(spark.conf.get("spark.sql.shuffle.partitions")) / groups))
    of = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("array<long>")
    left = asked.select(of("anchor_id", groups).alias("group"), every(slices).alias("slice"), F.lit(0).alias("kind"), F.col("anchor_id").alias("id"), "label", "ints", "lows", "highs")
    right = rows.select(every(groups).alias("group"), of("vec_id", slices).alias("slice"), F.lit(1).alias("kind"), F.col("vec_id").alias("id"), "label", "ints", none.alias("lows"), none.alias("highs"))
    met = left.union(right).repartition(groups * slices, "group", "slice").sortWithinPartitions("group", "slice", "kind", "label")
    names = ["anchor_id", "window", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, parts, index = None, [], None
        held = [np.zeros(0, np.int64)] * 4

        def give() -> Iterator[pa.RecordBatch]:
            if len(held[0]):
                yield pa.RecordBatch.from_arrays([pa.array(ids[held[0]]), *map(pa.array, held[1:])], names=names)

        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], 1)
            edges = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1)))) if len(keys) else np.zeros(0, int)
            for start, end in zip(edges.tolist(), [*edges[1:].tolist(), len(keys)], strict=True):
                group, slice_, kind = keys[start].tolist()
                run_ = batch.slice(start, end - start)
                if own != (group, slice_):
                    yield from give()
                    own, parts, index, held = (group, slice_), [], None, [np.zeros(0, np.int64)] * 4
                if kind == 0:
                    parts.append(run_)
                    continue
                if not parts:
                    continue
                if index is None:
                    ids = np.concatenate([p.column(3).to_numpy() for p in parts])
                    labels = np.concatenate([np.array(p.column(4).to_pylist(), object) for p in parts])
                    width = max(int(np.diff(p.column(6).offsets.to_numpy()).max(initial=0)) for p in parts)
                    lows, highs = (np.concatenate([_matrix(p.column(k), width) if k else None for p in parts]) for k in (6, 7))
                    opened = np.concatenate([np.arange(width) < np.diff(p.column(6).offsets.to_numpy())[:, None] for p in parts])
                    least = np.where(opened, lows, _MOST).min(1)
                    index = Index(np.concatenate([_matrix(p.column(5), moments.dims) for p in parts]), np.where(least == _LEAST, -np.inf, least.astype(np.float64)), moments)
                for at in range(0, run_.num_rows, ROWS):
                    some = run_.slice(at, ROWS)
                    row_ids, row_labels = some.column(3).to_numpy(), np.array(some.column(4).to_pylist(), object)
                    x = _matrix(some.column(5), moments.dims)[:, moments.order]
                    for label in dict.fromkeys(row_labels.tolist()):
                        mine = np.flatnonzero(row_labels == label)
                        which = np.flatnonzero((labels == label) == same)
                        if not len(which):
                            continue
                        row, anchor, score = index.pairs(x[mine], which)
                        near = row_ids[mine[row]]
                        other = near != ids[anchor]
                        near, anchor, score = near[other], anchor[other], score[other]
                        found = [held]
                        for w in range(width):
                            inside = opened[anchor, w] & (score >= lows[anchor, w]) & (score <= highs[anchor, w])
                            found.append([anchor[inside], np.full(int(inside.sum()), w), near[inside], score[inside]])
                        held = list(_best(*(np.concatenate([f[k] for f in found]) for k in range(4)), top))
        yield from give()

    return met.mapInArrow(run, "anchor_id long, window long, vec_id long, score long")


def _tail(z: float) -> float:
    return NormalDist().cdf(-z)


def _lower(high: float, edge: int, mean: float, deviation: float, n: float, wanted: int | None) -> int:
    """The score above which `wanted` of n rows are expected under `high`, not below the window's edge."""
    if wanted is None or not deviation or n <= 0:
        return edge
    share = (_tail((high - mean) / deviation) if high < math.inf else 0.0) + wanted / n
    return edge if share >= 0.5 else max(edge, min(int(high) if high < math.inf else _MOST, math.floor(mean - deviation * NormalDist().inv_cdf(share))))


def _ask(windows: DataFrame, moments: Moments, wanted: int | None) -> DataFrame:
    """asked for threshold_join, with `full` where a window is asked for down to its edge.

    windows: anchor_id, label, ints, n (rows that compete), edges and highs (arrays; a null high has no bound).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), moments.dims).astype(np.float64)
            means, deviations = x @ moments.mean, np.sqrt(x**2 @ moments.variance)
            lows, tops, full = [], [], []
            for mean, deviation, n, edges, highs in zip(means.tolist(), deviations.tolist(), *(batch.column(k).to_pylist() for k in (3, 4, 5)), strict=True):
                low = [_lower(math.inf if h is None else h, e, mean, deviation, n, wanted) for e, h in zip(edges, highs, strict=True)]
                lows.append(low)
                tops.append([_MOST if h is None else h for h in highs])
                full.append([a == b for a, b in zip(low, edges, strict=True)])
            kinds = pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(v, t) for v, t in zip((lows, tops, full), kinds, strict=True))], names=["anchor_id", "label", "ints", "lows", "highs", "full"])

    frame = windows.select("anchor_id", "label", "ints", F.col("n").cast("long").alias("n"), "edges", "highs")
    return park(frame.mapInArrow(run, "anchor_id long, label string, ints array<long>, lows array<long>, highs array<long>, full array<boolean>"), "asked")


def _fill(windows: DataFrame, rows: DataFrame, moments: Moments, same: bool, top: int) -> DataFrame:
    """(anchor_id, name, rank, vec_id, score): the first rows of every window. windows: one row each, with a name in its anchor."""
    open_, done = park(windows, "windows"), []
    for wanted in (*WANTED, None):
        by_anchor = open_.groupBy("anchor_id").agg(F.first("label").alias("label"), F.first("ints").alias("ints"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("name", "edge", "high"))).alias("w"))
        asked = _ask(by_anchor.select("*", F.col("w.edge").alias("edges"), F.col("w.high").alias("highs")), moments, wanted)
        hits = threshold_join(asked, rows, moments, same, top)
        order = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "vec_id")
        hits = park(hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top), "hits")
        names = by_anchor.select("anchor_id", F.posexplode("w").alias("window", "w")).select("anchor_id", "window", "w.name")
        edges = asked.select("anchor_id", F.posexplode("full").alias("window", "full"))
        many = hits.groupBy("anchor_id", "window").agg(F.max("rank").alias("held"))
        state = names.join(edges, ["anchor_id", "window"]).join(many, ["anchor_id", "window"], "left").select("anchor_id", "window", "name", (F.col("full") | (F.coalesce("held", F.lit(0)) >= top)).alias("filled"))
        state = park(state, "state")
        done.append(hits.join(state.filter("filled"), ["anchor_id", "window"]).select("anchor_id", "name", "rank", "vec_id", "score"))
        open_ = park(open_.join(state.filter("NOT filled").select("anchor_id", "name"), ["anchor_id", "name"], "left_semi"), "windows")
        if not open_.take(1):
            break
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return park(out, "filled")


def mine(rows: DataFrame, anchor: Column, top: int = TOP, low: int = LOW) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score). rows: as from usable(); anchor: which of them ask."""
    rows = park(rows, "vectors")
    moments = Moments(rows)
    by_label = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    anchors = park(rows.filter(anchor).join(by_label, "label").select(F.col("vec_id").alias("anchor_id"), "label", "ints", "n"), "anchors")
    near = anchors.select("*", F.lit(0).cast("long").alias("name"), F.lit(_LEAST).cast("long").alias("edge"), F.lit(None).cast("long").alias("high"))
    positives = _fill(near, rows, moments, True, top).select("anchor_id", F.col("rank").cast("long").alias("name"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    edge = F.expr(f"(positive_score * {low} + 99) div 100")
    windows = anchors.join(positives, "anchor_id").filter("positive_score >= 0").select("anchor_id", "label", "ints", (F.lit(int(moments.n)) - F.col("n")).alias("n"), "name", edge.alias("edge"), F.col("positive_score").alias("high"))
    negatives = _fill(windows, rows, moments, False, top)
    return negatives.join(positives, ["anchor_id", "name"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE_SQL = """
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS ints FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_inner_product(a.ints, b.ints)::BIGINT AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 5
"""
