"""Byte-level BPE encoding and decoding with padded numpy matrices.

A text is cut into pieces by the tokenizer's pattern; pieces are encoded one by one, and each distinct piece of
a batch only once. Pieces of similar length form the rows of a padded id matrix. In every round each row merges
its leftmost pair of least rank: the ranks of all neighbouring pairs are kept beside the ids, so a merge looks
up just the two pairs that it makes, in an open-addressing hash table. Rows close up after a merge and leave
the matrix when no pair is left. Pieces longer than the widest bucket, where rounds times width would grow with
the square of the length, merge in the same order through a heap.

The vocabulary file is read by the driver and broadcast; its size is checked against MAX_VOCABULARY.

Defined cases: null text is the empty text with no ids; special tokens are never produced and their strings are
ordinary text. Repeated rows encode alike, empty tables give empty results. Null ids decode to empty bytes, and
an id outside the vocabulary is an error. Results are added as columns; a column of that name is replaced.
A worker holds one group of texts, a bounded memory of pieces and the vocabulary; texts are grouped by bytes.
"""

from __future__ import annotations

import base64
import heapq
import sys
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mdlake.llm.common import text_batches

WIDTHS = (4, 6, 8, 12, 16, 24, 32, 48, 64, 128)
MAX_VOCABULARY = 64 << 20
#: Bytes of pieces and their ids that a worker remembers, about; checked before each group of texts.
REMEMBERED_BYTES = 24 << 20
#: Characters of the texts that are cut and encoded together; a longer text is a group of its own.
GROUP_CHARS = 1 << 18
_NONE = np.int32(2**31 - 1)
_ROWS = 1 << 15
#: What an entry of the memory takes besides its bytes: two objects and their place in the dictionary.
_ENTRY_BYTES = 180


class Codec:
    """Ranks, hashed pairs and a bounded memory of encoded pieces; one to a worker."""

    def __init__(self, vocabulary: bytes, pattern: str):
        self.rank = {base64.b64decode(token): int(id_) for token, id_ in map(bytes.split, vocabulary.splitlines()) if token}
        self.token = [b""] * (max(self.rank.values()) + 1)
        for token, id_ in self.rank.items():
            self.token[id_] = token
        self.pieces = regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.known_bytes = 0
        self.byte_id = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        pairs = [(self.rank[t[:k]], self.rank[t[k:]], id_) for t, id_ in self.rank.items() for k in range(1, len(t)) if t[:k] in self.rank and t[k:] in self.rank]
        left, right, merged = np.array(pairs, np.int64).reshape(-1, 3).T
        self._hash(left << 32 | right, merged)
        self.byte_pairs = self.pair(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256)).reshape(256, 256)

    def _hash(self, keys: np.ndarray, merged: np.ndarray) -> None:
        self.shift = np.uint64(64 - max(4, int(2 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.keys, self.merged, self.mask = np.full(size, -1, np.int64), np.full(size, _NONE, np.int32), size - 1
        waiting, slot = np.arange(len(keys)), self._slot(keys)
        while len(waiting):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = keys[waiting[free]]
            self.merged[slot[free]] = merged[waiting[free]]
            lost = self.keys[slot] != keys[waiting]
            waiting, slot = waiting[lost], (slot[lost] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The id that each pair merges into, which is its rank; _NONE where it doesn't merge or an id is negative."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        slot = self._slot(keys)
        out = self.merged[slot]
        missed = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] >= 0))
        out[self.keys[slot] != keys] = _NONE
        while len(missed):
            slot = (slot[missed] if len(slot) != len(missed) else slot) + 1 & self.mask
            held = self.keys[slot]
            found = held == keys[missed]
            out[missed[found]] = self.merged[slot[found]]
            more = ~found & (held >= 0)
            missed, slot = missed[more], slot[more]
        out[(left < 0) | (right < 0)] = _NONE
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> list[bytes]:
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(-1, width)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        column = np.arange(width)
        ids = np.where(column < size[:, None], self.byte_id[data], -1)
        # ranks[:, j] belongs to the pair at j and j + 1; two spare columns serve the shifts.
        ids = np.concatenate([ids, np.full((len(ids), 2), -1, ids.dtype)], 1)
        ranks = np.full(ids.shape, _NONE, np.int32)
        ranks[:, : width - 1] = np.where(column[1:] < size[:, None], self.byte_pairs[data[:, :-1], data[:, 1:]], _NONE)
        done, live = ids.copy(), np.arange(len(ids))
        column = np.arange(ids.shape[1])
        while True:
            at = ranks.argmin(1)
            row = np.arange(len(at))
            best = ranks[row, at]
            if (ended := best == _NONE).any():
                done[live[ended]] = -1
                done[live[ended], : ids.shape[1]] = ids[ended]
                go = ~ended
                ids, ranks, live, at, best, row = ids[go], ranks[go], live[go], at[go], best[go], np.arange(go.sum())
                if not len(live):
                    break
                width = max(4, int((ids >= 0).sum(1).max()) + 2)
                ids, ranks, column = ids[:, :width], ranks[:, :width], np.arange(width)
            after = column >= at[:, None] + 1
            ids = np.where(after, np.concatenate([ids[:, 1:], np.full((len(ids), 1), -1, ids.dtype)], 1), ids)
            ids[row, at] = best
            ranks = np.where(after, np.concatenate([ranks[:, 1:], np.full((len(ids), 1), _NONE, np.int32)], 1), ranks)
            ranks[row, at] = self.pair(best, ids[row, np.minimum(at + 1, ids.shape[1] - 1)])
            inner = at > 0
            ranks[row[inner], at[inner] - 1] = self.pair(ids[row[inner], at[inner] - 1], best[inner])
        flat, ends = done[done >= 0].astype(np.int32).tobytes(), (4 * np.cumsum((done >= 0).sum(1))).tolist()
        return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _heap(self, piece: bytes) -> bytes:
        ids, n = [self.rank[bytes([b])] for b in piece], len(piece)
        text = [bytes([b]) for b in piece]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int) -> None:
            if i >= 0 and (j := after[i]) < n and (rank := self.rank.get(text[i] + text[j])) is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            text[i], ids[i], ids[j] = text[i] + text[j], rank, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return np.array([x for x in ids if x >= 0], np.int32).tobytes()

    def learn(self, pieces: set[str]) -> None:
        """Encode pieces that aren't known yet; ids are kept as packed 32-bit numbers."""
        buckets: dict[int, list[str]] = {}
        for piece in pieces:
            raw = piece.encode()
            self.known_bytes += _ENTRY_BYTES + 2 * len(raw)
            if (id_ := self.rank.get(raw)) is not None:
                self.known[piece] = id_.to_bytes(4, sys.byteorder)
            elif width := next((w for w in WIDTHS if len(raw) <= w), 0):
                buckets.setdefault(width, []).append(piece)
            else:
                self.known[piece] = self._heap(raw)
        for width, found in buckets.items():
            for at in range(0, len(found), _ROWS):
                part = found[at : at + _ROWS]
                self.known.update(zip(part, self._matrix([p.encode() for p in part], width), strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.pieces.findall(t) for t in texts]
        if self.known_bytes > REMEMBERED_BYTES:
            self.known, self.known_bytes = {}, 0
        self.learn(set(chain.from_iterable(cut)).difference(self.known))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, pieces)), np.int32) for pieces in cut]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def _codec(vocabulary: bytes, pattern: str) -> Codec:
    return Codec(vocabulary, pattern)


def _vocabulary(path: str) -> bytes:
    with open(path, "rb") as f:
        data = f.read(MAX_VOCABULARY + 1)
    if len(data) > MAX_VOCABULARY:
        raise ValueError(f"{path} is larger than {MAX_VOCABULARY} bytes")
    return data


def _groups(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most GROUP_CHARS bytes together, or a single row."""
    start, held = 0, 0
    for at, size in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if held and held + size > GROUP_CHARS:
            yield start, at
            start, held = at, 0
        held += size
    if start < len(column):
        yield start, len(column)


def encode(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", ids_col: str = "ids", bytes_col: str | None = None, keep: list[str] | None = None) -> DataFrame:
    """docs with the token ids of each text and, where bytes_col is named, the bytes that they decode to.

    vocabulary: path of a file of base64 tokens and ranks. keep: the columns that stay, all if not given; a text
    that isn't among them goes to Python once and doesn't come back.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_vocabulary(vocabulary))
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (ids_col, bytes_col)]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(f"`{text_col}`").cast("string").alias("t"))
    added = [T.StructField(ids_col, T.ArrayType(T.IntegerType()))] + ([T.StructField(bytes_col, T.BinaryType())] if bytes_col else [])
    schema = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in kept] + added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for batch in batches:
            for start, end in _groups(batch.columns[-1]):
                part = batch.slice(start, end - start)
                found = codec.encode([t or "" for t in part.columns[-1].to_pylist()])
                ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                new = [pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))]
                if bytes_col:
                    new.append(pa.array([codec.decode(ids.tolist()) for ids in found], pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new], names=schema.names)

    return text_batches(rows).mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """df with the bytes that each row's ids stand for."""
    shared = df.sparkSession.sparkContext.broadcast(_vocabulary(vocabulary))
    kept = [c for c in df.columns if c != bytes_col]
    rows = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)])
    schema = T.StructType([*[T.StructField(c, df.schema[c].dataType) for c in kept], T.StructField(bytes_col, T.BinaryType())])
    at = kept.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared.value, pattern)
        for batch in batches:
            for k in range(0, len(batch), 256):
                part = batch.slice(k, 256)
                found = pa.array([codec.decode(ids or []) for ids in part.columns[at].to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=schema.names)

    return text_batches(rows).mapInArrow(run, schema)
