"""SimHash near-duplicate groups through forests of BK-trees.

1. Every text gets a 64-bit SimHash of its word shingles; equal fingerprints collapse to one row, so copies
   cost nothing further.
2. Fingerprints within the radius agree on some choice of (blocks - radius) out of `blocks` bit blocks, so one
   row for each choice sends every pair that can link to a common shard. The number of blocks follows the
   number of fingerprints: evenly spread ones leave a few dozen to a shard at any corpus size. Where they crowd,
   the members of a large shard go to shards of more blocks, so that no task holds more than a bounded number.
3. A shard's fingerprints form a BK-tree (children keyed by their Hamming distance to the parent). A search
   follows only the edges within the radius of its distance to a node, and skips subtrees that already belong
   to its own component, so that a dense group needs no list of all its pairs. A shard gives the links of a
   spanning star. All trees of a batch are built and searched together with numpy.
4. The links' connected components are the groups.

Near copies by similarity (`drop_near_copies`): 64 bits aren't selective at the distance that a similarity of 0.8
asks for. There, shards are made of a document's least shingle hashes, of which similar texts share some however
large the corpus is; in each shard a BK-tree of five-word SimHashes links every entry with an earlier one within a
wide radius, and the exact similarity of both texts' shingles decides on each link. A large group of near copies
costs no list of its pairs: an entry is tried against one other first. Where that leaves candidates of a shard apart,
the shard is searched again for pairs of different groups, with four times as many tries for an entry in each round,
until every such pair was tried that can be similar: shingles that no text of another group in an open shard has can't
be shared with one, and what is left is counted in BUCKETS by hash. Two texts share no more than the sum of the lesser
counts, so most texts that edits keep apart from a large group are told by numbers and not compared with its members.

The trees stay where their shard's queries are; they are not broadcast, since the fingerprints of a corpus have
no bound on their size.

Defined cases: null, empty and white-space texts have fingerprint zero and link like any other. Repeated rows
get equal results. Rows without doc_id share the group of equal fingerprints and link no further by themselves.
Empty tables give empty results; other columns are ignored. `drop_near_copies` takes rows of equal id and text as
one, judges rows without an id like others (they come last), and leaves texts without words alone.
"""

from __future__ import annotations

import itertools
import uuid
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import bounded, park, text_batches, text_or_empty
from mdlake.llm.components import connected_components

SEED = 42
#: Fingerprints that a shard holds on average at most.
SHARD_ENTRIES = 64
#: Fingerprints of a shard above which its members move to finer shards.
SPLIT_ENTRIES = 1 << 16
#: (query, node) pairs that a search holds at once.
FRONTIER = 1 << 21
#: Entries that an entry of a shard is tried against when the shard is searched again; later rounds take RETRIES times as many.
RETRIES = 4
#: Signature of a text for near copies: BANDS shards, each named by ROWS least shingle hashes.
BANDS, ROWS = 12, 4
#: Distance within which five-word SimHashes become candidates: 3 deviations over the mean at a similarity of 0.8.
WIDE_RADIUS = 18
NEAR_SHINGLE, NEAR_SIMILARITY = 5, 0.8
_LAST = 2**63 - 1
#: Counts by which a set of shingles is known when a bound on a similarity is asked.
BUCKETS = 64
#: What rounding may take from a similarity that is compared with a bound.
_SLACK = 1e-9
_CHUNK = 1 << 16
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_OFFSETS = (np.arange(8) * 256).astype(np.int64)
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def _shingle_hashes(words: list[bytes], size: int) -> Iterator[np.ndarray]:
    """Hashes of the shingles of a text, a chunk at a time; fewer words than a shingle's are one shingle."""
    hash_ = xxhash.xxh64_intdigest
    if len(words) <= size:
        yield np.array([hash_(b" ".join(words), SEED)], "<u8")
        return
    join = b" ".join([b"%b"] * size).__mod__
    shingles = zip(*(itertools.islice(words, i, None) for i in range(size)), strict=False)
    while part := [hash_(s, SEED) for s in map(join, itertools.islice(shingles, _CHUNK))]:
        yield np.array(part, "<u8")


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_LOWER).split()


class _Votes:
    """Counts of the set bits of hashes."""

    def __init__(self) -> None:
        self.total, self.n = np.zeros(2048, np.int64), 0

    def add(self, hashes: np.ndarray) -> None:
        self.total += np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _OFFSETS).ravel(), minlength=2048)
        self.n += len(hashes)

    def fingerprint(self) -> int:
        ones = self.total.reshape(8, 256) @ _BITS
        return int(np.packbits((2 * ones > self.n).astype(np.uint8).ravel(), bitorder="little").view("<u8")[0])


def simhash(text: str | None, size: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text, repeats included."""
    if not (words := _words(text)):
        return 0
    votes = _Votes()
    for hashes in _shingle_hashes(words, size):
        votes.add(hashes)
    return votes.fingerprint()


def fingerprints(docs: DataFrame, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp): the SimHash of each row as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                fps = np.array([simhash(t.as_py(), size) for t in part.column(1)], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps)], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return text_batches(rows).mapInArrow(run, "doc_id long, fp long")


def block_masks(radius: int, blocks: int) -> list[int]:
    """Masks of which each two fingerprints within the radius agree on at least one."""
    edge = [64 * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in itertools.pairwise(edge)]
    return [sum(chosen) for chosen in itertools.combinations(block, blocks - radius)]


def blocks_for(entries: int, radius: int) -> int:
    """The fewest blocks that leave about SHARD_ENTRIES evenly spread fingerprints or fewer to a shard."""
    return next((n for n in range(radius + 1, 2 * radius + 7) if entries / 2 ** (64 * (n - radius) / n) <= SHARD_ENTRIES), 2 * radius + 7)


def _finer(blocks: int, radius: int) -> list[int]:
    """Numbers of blocks to try one after the other; the last leaves a shard 2**16 different fingerprints at most."""
    last = 4 * radius if radius else 1
    return [blocks, *[n for n in range(blocks + 1, last) if (n - blocks) % 2], *([last] if last > blocks else [])]


def _routed(entries: DataFrame, radius: int, blocks: int) -> DataFrame:
    masks = [F.struct(F.lit(1000 * blocks + i).alias("mask"), F.col("fp").bitwiseAND(F.lit(m - (1 << 64) if m >> 63 else m)).alias("key")) for i, m in enumerate(block_masks(radius, blocks))]
    return entries.select("fp", "rep", F.explode(F.array(*masks)).alias("shard")).select("shard.mask", "shard.key", "fp", "rep")


def shards_of(reps: DataFrame, radius: int) -> DataFrame:
    """(mask, key, fp, rep): every two fingerprints within the radius meet in a shard.

    Where fingerprints crowd, the members of a shard of more than SPLIT_ENTRIES move to shards of more blocks, until
    none is larger or the blocks leave it no room for more.
    """
    parts, levels = [], _finer(blocks_for(reps.count(), radius), radius)
    for blocks in levels:
        routed = _routed(reps, radius, blocks)
        if blocks == levels[-1]:
            break
        crowded = park(routed.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > SPLIT_ENTRIES).select("mask", "key"), "crowded")
        if crowded.isEmpty():
            break
        crowded = bounded(crowded)
        parts.append(routed.join(crowded, ["mask", "key"], "left_anti"))
        reps = park(routed.join(crowded, ["mask", "key"], "left_semi").select("fp", "rep").distinct(), "crowd")
    for part in parts:
        routed = routed.unionByName(part)
    return routed


class Forest:
    """BK-trees over the fingerprints of many shards, built level by level with numpy.

    values: fingerprints; starts: where each shard begins. Within a shard the first entry is the root. Entries equal to
    a node are leaves below it, side by side.
    """

    def __init__(self, values: np.ndarray, starts: np.ndarray):
        n = len(values)
        sizes = np.diff(np.append(starts, n))
        self.values, self.root = values, np.repeat(starts, sizes)
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        self.levels = [starts]
        waiting = np.setdiff1d(np.arange(n), starts, assume_unique=True)
        node = self.root[waiting]
        while len(waiting):
            apart = np.bitwise_count(values[waiting] ^ values[node]).astype(np.int64)
            equal, other = waiting[apart == 0], apart > 0
            parent[equal] = node[~other]
            waiting, node, apart = waiting[other], node[other], apart[other]
            slot = node * 128 + apart
            slots, first, back = np.unique(slot, return_index=True, return_inverse=True)
            new = waiting[first]
            parent[new], edge[new] = slots >> 7, slots & 127
            self.levels.append(np.concatenate([new, equal]))
            rest = np.ones(len(waiting), bool)
            rest[first] = False
            waiting, node = waiting[rest], new[back[rest]]
        children = np.flatnonzero(parent >= 0)
        keys = parent[children] * 128 + edge[children]
        order = np.argsort(keys)
        self.parent, self.children, self.keys = parent, children[order], keys[order]

    def links(self, query: np.ndarray, radius: int, label: np.ndarray, most: int | None = None, cut: np.ndarray | None = None, fit: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within the radius, without those in subtrees that wholly have the query's label.

        A query ends after `most` pairs; it is marked in `cut` if it may have more. Pairs that don't fit aren't counted.
        """
        low, high = label.copy(), label.copy()
        found = np.zeros(len(label), np.int64)
        for level in self.levels[:0:-1]:
            np.minimum.at(low, self.parent[level], low[level])
            np.maximum.at(high, self.parent[level], high[level])
        stack = [(query, self.root[query])]
        while stack:
            q, node = stack.pop()
            if len(q) > FRONTIER:
                stack += [(part_q, part_n) for part_q, part_n in zip(np.array_split(q, len(q) // FRONTIER + 1), np.array_split(node, len(q) // FRONTIER + 1), strict=True)]
                continue
            mixed = ~((low[node] == high[node]) & (low[node] == label[q]))
            q, node = q[mixed], node[mixed]
            if most is not None:
                ended = found[q] >= most
                cut[q[ended]] = True
                q, node = q[~ended], node[~ended]
            if not len(q):
                continue
            apart = np.bitwise_count(self.values[q] ^ self.values[node]).astype(np.int64)
            near = (apart <= radius) & (label[q] != label[node])
            if fit is not None:
                near[near] = fit(q[near], node[near])
            if near.any():
                x, y = q[near], node[near]
                if most is not None:
                    order = np.argsort(x, kind="stable")
                    x, y = x[order], y[order]
                    kept = found[x] + np.arange(len(x)) - np.searchsorted(x, x) < most
                    cut[x[~kept]] = True
                    x, y = x[kept], y[kept]
                    np.add.at(found, x, 1)
                yield x, y
            a = np.searchsorted(self.keys, node * 128 + np.maximum(apart - radius, 0))
            n = np.searchsorted(self.keys, node * 128 + apart + radius, side="right") - a
            at = np.repeat(a - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            if len(at):
                stack.append((np.repeat(q, n), self.children[at]))


def _unite(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after linking a and b: the least index of each component."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, up := label[label]):
            label = up


def shard_stars(values: np.ndarray, starts: np.ndarray, radius: int) -> np.ndarray:
    """For each entry the least entry of its shard that it reaches through links within the radius."""
    forest, label = Forest(values, starts), np.arange(len(values))
    # Few queries first: once a dense group has a label, the other members skip it.
    rank = np.arange(len(values)) - forest.root
    bound = 0
    while bound <= rank.max(initial=-1):
        upper = max(64, 2 * bound)
        chunk = np.flatnonzero((rank >= bound) & (rank < upper))
        for part in np.array_split(chunk, len(chunk) // FRONTIER + 1):
            for a, b in list(forest.links(part, radius, label)):
                label = _unite(label, a, b)
        bound = upper
    return label


def _shards(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of whole shards, from batches sorted by their first `keys` columns; a long shard is joined once."""
    held: list[list[np.ndarray]] = []

    def whole() -> list[np.ndarray]:
        return [np.concatenate(c) for c in zip(*held, strict=True)]

    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        # The last shard may go on in the next batch; what came before it is whole.
        other = np.zeros(len(columns[0]), bool)
        for c in columns[:keys]:
            other |= c != c[-1]
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if held and (cut or any(c[0] != h[-1] for c, h in zip(columns[:keys], held[-1], strict=False))):
            held.append([c[:cut] for c in columns])
            yield whole()
            held = []
        elif cut:
            yield [c[:cut] for c in columns]
        held.append([c[cut:] for c in columns])
    if held:
        yield whole()


def _starts(keys: list[np.ndarray]) -> np.ndarray:
    change = np.zeros(len(keys[0]) - 1, bool)
    for c in keys:
        change |= c[1:] != c[:-1]
    return np.concatenate(([0], np.flatnonzero(change) + 1))


def link_fingerprints(reps: DataFrame, radius: int = 3) -> DataFrame:
    """(a, b): links that connect the representatives of fingerprints within the radius. reps: fp, rep."""
    routed = shards_of(reps, radius)

    def search(mask: np.ndarray, key: np.ndarray, fp: np.ndarray, rep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = _starts([mask, key])
        size = np.diff(np.append(starts, len(fp)))
        many = np.repeat(size > 1, size)
        if not many.any():
            return rep[:0], rep[:0]
        kept = size[size > 1]
        label = shard_stars(fp[many].view(np.uint64), np.concatenate(([0], np.cumsum(kept)[:-1])), radius)
        moved = label != np.arange(len(label))
        return rep[many][moved], rep[many][label[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _shards(batches, 2):
            a, b = search(*columns)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    ordered = routed.repartition("mask", "key").sortWithinPartitions("mask", "key", "rep")
    return ordered.mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, radius: int = 3, size: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest doc_id that each row reaches through links within the radius."""
    rows = park(fingerprints(docs, size, id_col, text_col), "simhash")
    reps = rows.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    # Fingerprints are linked, not ids: those of rows without an id connect others too.
    linked = connected_components(link_fingerprints(reps.select("fp", F.col("fp").alias("rep")), radius))
    rooted = reps.join(linked, reps["fp"] == linked["node"], "left").select("fp", "rep", F.coalesce("component", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _mixers() -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.default_rng(SEED).integers(0, 2**63, (2, BANDS * ROWS), dtype=np.int64).astype(np.uint64)
    return drawn[0], drawn[1] * np.uint64(2) + np.uint64(1)


def signature(text: str | None, size: int = NEAR_SHINGLE) -> tuple[int, list[int]]:
    """The SimHash of a text and the names of its shards, as signed numbers; no shards without words."""
    if not (words := _words(text)):
        return 0, []
    add, times = _mixers_once
    votes, least = _Votes(), np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for hashes in _shingle_hashes(words, size):
        votes.add(hashes)
        for at in range(0, len(hashes), 2048):
            least = np.minimum(least, ((hashes[at : at + 2048, None] ^ add) * times).min(0))
    names = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        names = (names ^ row) * np.uint64(0x9E3779B97F4A7C15)
        names ^= names >> np.uint64(29)
    return votes.fingerprint() - (1 << 64 if votes.fingerprint() >> 63 else 0), names.view(np.int64).tolist()


_mixers_once = _mixers()


def shard_links(values: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each entry an earlier one of its shard within the radius, or itself, and the least entry that it reaches through candidates.

    Entries that are linked aren't searched again, so the links needn't join all that reach each other.
    """
    forest, label = Forest(values, starts), np.arange(len(values))
    rank, best, bound = np.arange(len(values)) - forest.root, np.arange(len(values)), 0
    while bound <= rank.max(initial=-1):
        upper = max(64, 2 * bound)
        chunk = np.flatnonzero((rank >= bound) & (rank < upper))
        for part in np.array_split(chunk, len(chunk) // FRONTIER + 1):
            for a, b in list(forest.links(part, radius, label)):
                np.minimum.at(best, np.maximum(a, b), np.minimum(a, b))
                label = _unite(label, a, b)
        bound = upper
    return best, label


def most_similar(n: np.ndarray, other: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The greatest Jaccard similarity of sets of n and `other` elements that have at most `common` in common."""
    shared = np.minimum(np.minimum(common, n), other)
    return shared / np.maximum(n + other - shared, 1)


def may_link(shard: np.ndarray, n: np.ndarray, common: np.ndarray, similarity: float) -> np.ndarray:
    """Whether an entry's set can be similar to one of the sizes in its shard, of which it has at most `common` elements.

    The best size is the nearest to `common` on either side.
    """
    wide = np.int64(1) << 40
    sizes = np.sort(shard * wide + n)
    at = np.searchsorted(sizes, shard * wide + common)
    found = np.zeros(len(n), bool)
    for near in (np.minimum(at, len(n) - 1), np.maximum(at - 1, 0)):
        found |= (sizes[near] // wide == shard) & (most_similar(n, sizes[near] % wide, common) >= similarity - _SLACK)
    return found


def shard_retries(
    values: np.ndarray, starts: np.ndarray, radius: int, label: np.ndarray, most: int, sizes: tuple[np.ndarray, np.ndarray] | None = None, similarity: float = NEAR_SIMILARITY
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (later, earlier) of different labels within the radius, and whether an entry of the pair may have more than `most`.

    Of two labels one isn't the commonest of its shard, so the entries of that one need not ask. sizes: of each entry
    how many shingles it has and, by bucket, how many of them texts of other labels may have; pairs that these keep apart
    are left out.
    """
    fit = None
    if sizes is not None:
        n, counts = sizes

        def fit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            shared = [np.minimum(counts[x], counts[y]).sum(1, dtype=np.int64) for x, y in zip(*(np.array_split(i, len(a) // _CHUNK + 1) for i in (a, b)), strict=True)]
            return most_similar(n[a], n[b], np.concatenate(shared)) >= similarity - _SLACK

    shard = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(values))))
    order = np.lexsort((label, shard))
    first = _starts([shard[order], label[order]])
    count, of = np.diff(np.append(first, len(order))), shard[order][first]
    commonest = np.zeros(len(starts), np.int64)
    by_count = np.argsort(count, kind="stable")
    commonest[of[by_count]] = label[order][first][by_count]
    cut, found = np.zeros(len(values), bool), []
    asking = np.flatnonzero(label != commonest[shard])
    if sizes is not None:
        asking = asking[may_link(shard, n, counts.sum(1, dtype=np.int64), similarity)[asking]]
    for part in np.array_split(asking, len(asking) // FRONTIER + 1):
        found += list(Forest(values, starts).links(part, radius, label, most, cut, fit)) if len(part) else []
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    return np.maximum(a, b), np.minimum(a, b), cut[a]


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a or b else 0.0


def shingle_set(text: str | None, size: int = NEAR_SHINGLE) -> set:
    words = _words(text)
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def similar_groups(docs: DataFrame, similarity: float = NEAR_SIMILARITY, size: int = NEAR_SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, component): the groups of rows that pairs of similar texts connect; a node is a struct of id and text hash.

    Ids that are missing are the largest number. Rows without a similar one are left out.
    """
    text = text_or_empty(text_col)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = [signature(t.as_py(), size) for t in part.column(2)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array([x for x, _ in found], pa.int64()), pa.array([x for _, x in found], pa.list_(pa.int64()))], names=["id", "hash", "fp", "shards"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, id_, hash_, fp in _shards(batches, 1):
            best, label = shard_links(fp.view(np.uint64), _starts([shard]), WIDE_RADIUS)
            own = np.flatnonzero(label != np.arange(len(label)))
            to, least = best[own], label[own]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (shard[own], id_[own], hash_[own], id_[to], hash_[to], id_[least], hash_[least])], names=["shard", "id", "hash", "id2", "hash2", "id3", "hash3"])

    def search_again(most: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for shard, id_, hash_, fp, group, group_hash, n, counts in _shards(batches, 1):
                sizes = n, np.frombuffer(b"".join(counts), "<u4").reshape(-1, BUCKETS)
                order = np.lexsort((group_hash, group))
                label = np.zeros(len(order), np.int64)
                label[order[_starts([group[order], group_hash[order]])[1:]]] = 1
                label[order] = np.cumsum(label[order])
                a, b, cut = shard_retries(fp.view(np.uint64), _starts([shard]), WIDE_RADIUS, label, most, sizes, similarity)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (shard[a], id_[a], hash_[a], id_[b], hash_[b], cut)], names=["shard", "id", "hash", "id2", "hash2", "cut"])

        return run

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                texts = [t.as_py() for t in part.column(4)]
                hashes = [np.unique(np.concatenate([np.zeros(0, "<u8"), *(_shingle_hashes(w, size) if (w := _words(t)) else [])])).view(np.int64) for t in texts]
                counts = pa.array([len(shingle_set(t, size)) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns[:4], counts, pa.array(hashes, pa.list_(pa.int64()))], names=["id", "hash", "g", "g_hash", "n", "shingles"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_bucket = lambda hashes: np.bincount(hashes.values.to_numpy().view(np.uint64) % np.uint64(BUCKETS), minlength=BUCKETS) if hashes.is_valid else 0
        for batch in batches:
            counts = []
            for n, hashes, own in zip(*batch.columns[2:], strict=True):
                # Should hashes of a text be equal, its counts bound nothing.
                all_known = n.as_py() == len(hashes.values)
                counts.append((by_bucket(hashes) - by_bucket(own) if all_known else np.full(BUCKETS, n.as_py())).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(counts, pa.binary())], names=["id", "hash", "n", "counts"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, set()
        for batch in batches:
            good = np.zeros(len(batch), bool)
            for i, (a, b) in enumerate(zip(batch.column(4), batch.column(5), strict=True)):
                if (b := b.as_py()) != last:
                    last, held = b, shingle_set(b, size)
                good[i] = jaccard(shingle_set(a.as_py(), size), held) >= similarity
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=batch.schema.names[:4]).filter(pa.array(good))

    pair = ["id", "hash", "id2", "hash2"]
    node = lambda n="": F.struct(F.col(f"id{n}").alias("id"), F.col(f"hash{n}").alias("hash"))

    def similar(pairs: DataFrame) -> DataFrame:
        """(a, b): those of the pairs whose texts are similar enough."""
        both = pairs.select("id", "hash").union(pairs.select(F.col("id2").alias("id"), F.col("hash2").alias("hash"))).distinct()
        texts = rows.join(bounded(park(both, "involved"), 1 << 20), ["id", "hash"], "left_semi").dropDuplicates(["id", "hash"])
        held = park(texts, "involved-texts")
        joined = pairs.join(held, ["id", "hash"]).join(held.select(F.col("id").alias("id2"), F.col("hash").alias("hash2"), F.col("text").alias("text2")), ["id2", "hash2"])
        return joined.select(*pair, "text", "text2").mapInArrow(verify, "id long, hash long, id2 long, hash2 long").select(node().alias("a"), node("2").alias("b"))

    def sizes_of(open_entries: DataFrame, groups: DataFrame) -> DataFrame:
        """(id, hash, n, counts): how many shingles a text in an open shard has, and by bucket those that texts of other groups there have."""
        there = open_entries.select("id", "hash").distinct().withColumn("node", node()).join(groups, "node", "left").withColumn("g", F.coalesce("component", "node"))
        there = park(there.select("id", "hash", F.col("g.id").alias("g"), F.col("g.hash").alias("g_hash")), "open-texts")
        texts = rows.join(bounded(there, 1 << 20), ["id", "hash"]).dropDuplicates(["id", "hash"]).select("id", "hash", "g", "g_hash", "text")
        sets = park(texts.mapInArrow(shingled, "id long, hash long, g long, g_hash long, n long, shingles array<long>"), "open-shingles")
        each = sets.select("id", "hash", "g", "g_hash", F.explode("shingles").alias("shingle"))
        spread = each.groupBy("shingle").agg(F.min("g").alias("a"), F.max("g").alias("b"), F.min("g_hash").alias("c"), F.max("g_hash").alias("d"))
        own = bounded(park(spread.filter("a = b AND c = d").select("shingle"), "own-shingles"), 1 << 20)
        owned = each.join(own, "shingle", "left_semi").groupBy("id", "hash").agg(F.collect_list("shingle").alias("own"))
        return park(sets.join(owned, ["id", "hash"], "left").select("id", "hash", "n", "shingles", "own").mapInArrow(counted, "id long, hash long, n long, counts binary"), "open-sizes")

    signed = park(text_batches(rows).mapInArrow(sign, "id long, hash long, fp long, shards array<long>"), "signed")
    entries = signed.select(F.explode("shards").alias("shard"), "id", "hash", "fp")
    routed = entries.repartition("shard").sortWithinPartitions("shard", "id", "hash")
    found = park(routed.mapInArrow(search, "shard long, id long, hash long, id2 long, hash2 long, id3 long, hash3 long"), "candidates")
    tried = park(found.select(*pair).filter("id <> id2 OR hash <> hash2").distinct(), "tried")
    groups = connected_components(similar(tried))
    # A shard is settled if all that reach each other through candidates are of one group; other shards are searched again.
    of = lambda n: groups.select(F.col("node").alias(f"node{n}"), F.col("component").alias(f"group{n}"))
    placed = found.select("shard", node().alias("node1"), node("3").alias("node3")).join(of(1), "node1", "left").join(of(3), "node3", "left")
    unsettled = park(placed.filter(F.coalesce("group1", "node1") != F.coalesce("group3", "node3")).select("shard").distinct(), "open-shards")
    # Groups only grow together, so what no other group has at first is in no other later.
    most, sizes = RETRIES, None
    while not unsettled.isEmpty():
        again = entries.join(bounded(unsettled), "shard", "left_semi")
        sizes = bounded(sizes_of(again, groups)) if sizes is None else sizes
        again = again.join(sizes, ["id", "hash"]).withColumn("node", node()).join(groups, "node", "left").withColumn("g", F.coalesce("component", "node"))
        routed = again.select("shard", "id", "hash", "fp", F.col("g.id").alias("g"), F.col("g.hash").alias("g_hash"), "n", "counts").repartition("shard").sortWithinPartitions("shard", "id", "hash")
        found = park(routed.mapInArrow(search_again(most), "shard long, id long, hash long, id2 long, hash2 long, cut boolean"), "candidates")
        fresh = park(found.select(*pair).distinct().join(tried, pair, "left_anti"), "tried")
        groups = connected_components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(similar(fresh)))
        tried, unsettled, most = tried.union(fresh), park(found.filter("cut").select("shard").distinct(), "open-shards"), most * RETRIES
    return groups


def drop_near_copies(docs: DataFrame, similarity: float = NEAR_SIMILARITY, size: int = NEAR_SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay: of each group of similar texts the document with the smallest id."""
    groups = similar_groups(docs, similarity, size, id_col, text_col)
    id_, hash_ = (f"{name}_{uuid.uuid4().hex}" for name in ("id", "hash"))
    gone = park(groups.filter("node <> component").select(F.col("node.id").alias(id_), F.col("node.hash").alias(hash_)), "near-copies")
    own = (F.coalesce(docs[id_col].cast("long"), F.lit(_LAST)) == F.col(id_)) & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == F.col(hash_))
    return docs.join(bounded(gone, 1 << 20), own, "left_anti")
