"""Benchmark decontamination with SimHash windows.

1. A window has the size in words of a benchmark item. Only windows that share a word shingle with an item can
   be similar to it at all, so windows are laid where a shared shingle puts the item's start; all others have
   similarity zero with every item and are not fingerprinted.
2. Each window's SimHash of 128 bits is looked up among the items of its own length, in a multi-index of their
   fingerprints: with BLOCKS blocks, some block of two fingerprints within the radius differs by at most
   radius // BLOCKS bits, and every such value of every block is listed, so no item within the radius is missed.
   The radius lies DEVIATIONS standard deviations over the mean distance at the similarity asked for.
3. The weighted Jaccard similarity of the two multisets of shingles decides, on the words themselves.

Words are runs of letters, digits and underscores in lower case; shingles have five words, or all words of a
shorter item. The benchmark is indexed by the driver and broadcast when its text is at most MAX_INDEX_BYTES, and
in as many chunks of that size as it takes otherwise; documents are never shuffled, and `drop_contaminated` decides
on each row where it is.

Defined cases: null and empty texts have no words, and neither match nor are matched. Repeated rows of either
table give equal rows once. Rows without an id are reported with a null id. Empty tables give no rows.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import park, text_batches

SHINGLE = 5
THRESHOLD = 0.8
BITS, BLOCKS = 128, 16
DEVIATIONS = 3
MAX_INDEX_BYTES = 32 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: (window, item) pairs that are held at once.
_PAIRS = 1 << 20
_POSITIONS = 1 << 15
_words = re.compile(r"\w+").findall


def words_of(text: str | None) -> list[str]:
    return _words((text or "").lower())


def shingle_size(words: int) -> int:
    return min(SHINGLE, words)


def similarity(a: list[str], b: list[str], size: int) -> float:
    """Weighted Jaccard similarity of the shingles: shared repeats over all repeats."""
    x, y = (Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) for w in (a, b))
    shared = sum((x & y).values())
    return shared / (sum(x.values()) + sum(y.values()) - shared)


def _hashes(words: list[str], size: int) -> np.ndarray:
    hash_ = xxhash.xxh64_intdigest
    return np.array([hash_(" ".join(words[i : i + size])) for i in range(len(words) - size + 1)], np.uint64)


def _fingerprints(hashes: np.ndarray) -> np.ndarray:
    """SimHash of each row of shingle hashes, as two words."""
    more = (hashes ^ (hashes >> np.uint64(31))) * _MIX
    both = np.stack([hashes, more ^ (more >> np.uint64(29))], -1).astype("<u8")
    bits = np.unpackbits(both.view(np.uint8), axis=-1, bitorder="little")
    return np.packbits(2 * bits.sum(1, dtype=np.int32) > hashes.shape[1], axis=-1, bitorder="little").view("<u8")


def radius_for(threshold: float) -> int:
    """Distance that two texts of this similarity hardly ever exceed."""
    p = math.acos(min(1.0, 2 * threshold / (1 + threshold))) / math.pi
    return int(BITS * p + DEVIATIONS * math.sqrt(BITS * p * (1 - p)))


def _codes(ids: np.ndarray, size: int) -> np.ndarray:
    code = np.zeros(len(ids) - size + 1, np.uint64)
    for j in range(size):
        code = (code + ids[j : j + len(code)].astype(np.uint64) + np.uint64(1)) * _MIX
    return code


def _expand(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each range its number, and its positions one after the other."""
    n = ends - starts
    return np.repeat(np.arange(len(n)), n), np.repeat(starts - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())


class BenchmarkIndex:
    """Shared shingles, fingerprints and their multi-index for the items of a benchmark."""

    def __init__(self, items: list[tuple[int | None, str | None]], threshold: float = THRESHOLD):
        self.radius, self.threshold = radius_for(threshold), threshold
        found = {(id_, tuple(w)): w for id_, text in items if (w := words_of(text))}
        self.items = [(id_, w) for (id_, _), w in found.items()]
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(itertools.chain.from_iterable(w for _, w in self.items)), 1)}
        self.length = np.array([len(w) for _, w in self.items], np.int64)
        self.fps = np.array([_fingerprints(_hashes(w, shingle_size(len(w)))[None])[0] for _, w in self.items], np.uint64).reshape(-1, 2)
        # For each shingle size: sorted codes with the item length and the offset that each was seen at.
        self.seeds = {}
        for size in sorted({shingle_size(len(w)) for _, w in self.items}):
            seen = [(_codes(self._ids(w), size), len(w)) for _, w in self.items if shingle_size(len(w)) == size]
            rows = np.unique(np.concatenate([np.stack([c, np.full(len(c), n, np.uint64), np.arange(len(c), dtype=np.uint64)], 1) for c, n in seen]), axis=0)
            self.seeds[size] = rows[:, 0].copy(), rows[:, 1].astype(np.int64), rows[:, 2].astype(np.int64)
        # For each item length its items, and for each block those listed under every value near their own.
        near = np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)) <= self.radius // BLOCKS
        self.blocks = {}
        for length in np.unique(self.length).tolist():
            own = np.flatnonzero(self.length == length).astype(np.int32)
            listed = [np.nonzero(near[:, values]) for values in self.fps[own].astype("<u8").view(np.uint8).reshape(-1, BLOCKS).T]
            self.blocks[length] = own, [(np.searchsorted(value, np.arange(257)).astype(np.int32), item.astype(np.int32)) for value, item in listed]

    def _ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.vocabulary.get, words, itertools.repeat(0)), np.int64, len(words))

    def _windows(self, ids: np.ndarray, size: int) -> np.ndarray:
        """Rows (length, start) of the windows that shared shingles call for."""
        if len(ids) < size:
            return np.zeros((0, 2), np.int64)
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        at = np.flatnonzero(known[size:] - known[:-size] == size)
        if not len(at):
            return np.zeros((0, 2), np.int64)
        codes, length, offset = self.seeds[size]
        own = _codes(ids, size)[at]
        out = []
        for a in range(0, len(at), _POSITIONS):
            part = own[a : a + _POSITIONS]
            which, seed = _expand(np.searchsorted(codes, part), np.searchsorted(codes, part, side="right"))
            start = np.clip(at[a : a + _POSITIONS][which] - offset[seed], 0, np.maximum(len(ids) - length[seed], 0))
            out.append(np.unique(np.stack([length[seed], start], 1), axis=0))
        rows = np.unique(np.concatenate(out), axis=0)
        # An insertion or deletion shifts the starts that its two sides call for; the windows between belong too.
        length, start = rows.T
        gap = np.diff(start, append=start[-1:])
        gap[np.append(length[1:] != length[:-1], True) | (gap > length)] = 1
        which, start = _expand(start, start + gap)
        return np.stack([length[which], start], 1)

    def candidates(self, fps: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of the items of this length that share a block with a window, nearly."""
        own, blocks = self.blocks[length]
        pairs = []
        for (first, item), values in zip(blocks, fps.astype("<u8").view(np.uint8).reshape(-1, BLOCKS).T, strict=True):
            window, at = _expand(first[values].astype(np.int64), first[values.astype(np.int64) + 1].astype(np.int64))
            pairs.append(window * len(own) + item[at])
        window, item = np.divmod(np.unique(np.concatenate(pairs)), len(own))
        return window, own[item]

    def _within(self, fps: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of all fingerprints within the radius."""
        window, item = self.candidates(fps, length)
        close = np.bitwise_count(fps[window] ^ self.fps[item]).sum(1) <= self.radius
        return window[close], item[close]

    def matches(self, text: str | None) -> dict[int, tuple[float, int]]:
        """For each item found in a text the best similarity and the first word of its window."""
        best: dict[int, tuple[float, int]] = {}
        words = words_of(text)
        ids = self._ids(words)
        for size in self.seeds:
            windows = self._windows(ids, size)
            for length in np.unique(windows[:, 0]).tolist():
                starts = windows[windows[:, 0] == length, 1]
                # A text shorter than the item is one window.
                wide = min(length, len(words)) - size + 1
                step = max(1, _PAIRS // max(wide, BLOCKS * len(self.blocks[length][0])))
                for a in range(0, len(starts), step):
                    part = starts[a : a + step]
                    low, high = int(part[0]), int(part[-1]) + length
                    hashes = _hashes(words[low:high], size)
                    near, item = self._within(_fingerprints(hashes[(part - low)[:, None] + np.arange(wide)]), length)
                    for w, i in zip(near.tolist(), item.tolist(), strict=True):
                        start = int(part[w])
                        score = similarity(words[start : start + length], self.items[i][1], size)
                        if score >= self.threshold and score > best.get(i, (0.0, 0))[0]:
                            best[i] = score, start
        return best


def _indexes(benchmark: DataFrame, item_col: str, item_text_col: str, threshold: float) -> Iterator[tuple[BenchmarkIndex, bool]]:
    """Indexes of the benchmark, one for each chunk of at most about MAX_INDEX_BYTES of text, and whether there are several."""
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // MAX_INDEX_BYTES))
    for k in range(chunks):
        chunk = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(chunks)) == k)
        yield BenchmarkIndex([tuple(r) for r in chunk.collect()], threshold), chunks > 1


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, similarity, start): the items found in each document, at the best window's first word."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = []
    for index, more in _indexes(benchmark, item_col, item_text_col, threshold):
        part, shared = _contaminated(rows, index)
        if more:
            # A chunk's matches are written and its index is freed before the next one is made.
            part = park(part, "matches")
            shared.destroy()
        parts.append(part)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(F.max_by("similarity", F.struct("similarity", -F.col("start"))).alias("similarity"), F.max_by("start", F.struct("similarity", -F.col("start"))).alias("start"))


def _contaminated(rows: DataFrame, own: BenchmarkIndex) -> tuple[DataFrame, Broadcast]:
    shared = rows.sparkSession.sparkContext.broadcast(own)
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("similarity", pa.float64()), ("start", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            found = [(id_.as_py(), index.items[i][0], *hit) for id_, text in zip(*batch.columns, strict=True) for i, hit in index.matches(text.as_py()).items()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], t) for k, t in enumerate(schema.types)], schema=schema)

    return text_batches(rows).mapInArrow(run, "doc_id long, item_id long, similarity double, start long"), shared


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs in which no benchmark item was found; each row is judged by its own text."""
    at = docs.columns.index(text_col)
    for own, more in _indexes(benchmark, item_col, item_text_col, threshold):
        shared = docs.sparkSession.sparkContext.broadcast(own)
        docs = _clean(docs, shared, at)
        if more:
            # As above: what is left after a chunk is written, and the chunk's index freed.
            docs = park(docs, "clean")
            shared.destroy()
    return docs


def _clean(docs: DataFrame, shared: Broadcast, at: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([not shared.value.matches(t.as_py()) for t in batch.column(at)], pa.bool_()))

    return text_batches(docs).mapInArrow(run, docs.schema)
