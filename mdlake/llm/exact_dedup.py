"""Exact deduplication with counting quotient filters and byte verification.

1. Each partition turns the 64-bit fingerprints of its normalised texts into counting quotient filters,
   one per block of the fingerprint space. Copies within a partition become one entry with a count, so a
   text that makes up a third of the corpus costs one entry a partition.
2. Filters of one block are merged two by two along their sorted remainders; counts add up and nothing is lost.
3. Only texts whose fingerprint has a count above one are compared byte by byte (Spark groups them by the
   whole text), so that fingerprint collisions never join different texts. Up to BROADCAST_FINGERPRINTS repeated
   fingerprints are sent to the texts, which are sorted out where they are; beyond that a sieve of them is (16 bits
   for each, 2**MAX_SIEVE_POWER at most), which lets one text in sixteen or so through to the comparison as well,
   with the same result. Copies are combined before they are shuffled either way.

Defined cases: null text is the empty text, and all empty texts are one group. Rows with equal doc_id and
equal text are one document: each is reported, `kept` follows the doc_id, and `drop_copies` leaves one row.
A null doc_id comes last in ties. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import bounded, park, strip_space, text_batches, text_or_empty

QUOTIENT_BITS = 8
#: Fingerprints that a merged block holds on average; bounds the memory of a merging task.
BLOCK_ENTRIES = 1 << 20
#: Fingerprints gathered in a partition before its filters are written out.
FLUSH_ENTRIES = 1 << 22
#: Repeated fingerprints (8 bytes each) up to which their table is broadcast.
BROADCAST_FINGERPRINTS = 1 << 20
#: Largest sieve (64 MB), and the segments that it is made in.
MAX_SIEVE_POWER, SEGMENT_BITS = 29, 6
SEGMENTS = 1 << SEGMENT_BITS
_ESCAPE = 255


def encode_filter(fingerprints: np.ndarray, counts: np.ndarray, block_bits: int) -> bytes:
    """Pack sorted distinct fingerprints of one block.

    The block's bits are implied, the next QUOTIENT_BITS are the quotient and the rest the remainder. Layout:
    occupied bitmap (one bit a quotient), run-end bitmap (one bit an entry), remainders in order of quotient
    and value, one-byte counters, then the counters that exceed a byte.
    """
    rest = 64 - block_bits - QUOTIENT_BITS
    quotient = (fingerprints >> np.uint64(rest)) & np.uint64((1 << QUOTIENT_BITS) - 1)
    remainder = fingerprints & np.uint64((1 << rest) - 1)
    occupied = np.zeros(1 << QUOTIENT_BITS, np.uint8)
    occupied[quotient.astype(np.int64)] = 1
    run_end = np.ones(len(fingerprints), np.uint8)
    run_end[:-1] = quotient[1:] != quotient[:-1]
    small = np.minimum(counts, _ESCAPE).astype(np.uint8)
    return b"".join((np.packbits(occupied).tobytes(), np.packbits(run_end).tobytes(), remainder.astype("<u8").tobytes(), small.tobytes(), counts[counts >= _ESCAPE].astype("<i8").tobytes()))


def decode_filter(block: int, entries: int, payload: bytes, block_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted fingerprints of a filter and their counts."""
    rest = 64 - block_bits - QUOTIENT_BITS
    at = (1 << QUOTIENT_BITS) // 8
    occupied = np.flatnonzero(np.unpackbits(np.frombuffer(payload, np.uint8, at)))
    size = (entries + 7) // 8
    run_end = np.unpackbits(np.frombuffer(payload, np.uint8, size, at))[:entries]
    at += size
    remainder = np.frombuffer(payload, "<u8", entries, at)
    at += 8 * entries
    counts = np.frombuffer(payload, np.uint8, entries, at).astype(np.int64)
    counts[counts == _ESCAPE] = np.frombuffer(payload, "<i8", -1, at + entries)
    run = np.concatenate(([0], np.cumsum(run_end)[:-1])).astype(np.int64) if entries else np.zeros(0, np.int64)
    high = (np.uint64(block) << np.uint64(QUOTIENT_BITS)) | occupied[run].astype(np.uint64)
    return (high << np.uint64(rest)) | remainder, counts


def _merge(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two sorted runs of (fingerprint, count) as one: each entry's place is its own rank and its rank among the others."""
    (a, n), (b, m) = one, other
    keys, counts = np.empty(len(a) + len(b), a.dtype), np.empty(len(a) + len(b), np.int64)
    at_a, at_b = np.arange(len(a)) + np.searchsorted(b, a), np.arange(len(b)) + np.searchsorted(a, b, side="right")
    keys[at_a], keys[at_b], counts[at_a], counts[at_b] = a, b, n, m
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def merge_counts(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted runs of (fingerprint, count) into one, adding the counts of equal fingerprints."""
    parts = list(parts) or [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    while len(parts) > 1:
        parts = [_merge(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0]


def build_filters(fingerprints: np.ndarray, block_bits: int) -> Iterator[tuple[int, int, bytes]]:
    """One filter (block, entries, payload) for each block that the fingerprints touch."""
    keys, counts = np.unique(fingerprints, return_counts=True)
    if not len(keys):
        return
    blocks = keys >> np.uint64(64 - block_bits)
    starts = np.flatnonzero(np.concatenate(([True], blocks[1:] != blocks[:-1])))
    for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
        yield int(blocks[a]), int(b - a), encode_filter(keys[a:b], counts[a:b], block_bits)


def repeated_fingerprints(fingerprints: DataFrame, rows: int) -> DataFrame:
    """(fingerprint, n) of the fingerprints with a count above one.

    fingerprints: one long column; rows: how many there are about, which sets the number of blocks.
    """
    block_bits = min(32, max(6, math.ceil(math.log2(max(1, rows) / BLOCK_ENTRIES)))) if rows > BLOCK_ENTRIES else 6
    filter_schema = pa.schema([("block", pa.int64()), ("entries", pa.int64()), ("payload", pa.binary())])

    def flush(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        rows = list(build_filters(np.concatenate(held), block_bits))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(filter_schema.types)], schema=filter_schema)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            size += len(held[-1])
            if size >= FLUSH_ENTRIES:
                yield from flush(held)
                held, size = [], 0
        if size:
            yield from flush(held)

    def merge(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        block = int(key[0])
        keys, counts = merge_counts([decode_filter(block, n, p, block_bits) for n, p in zip(group["entries"], group["payload"], strict=True)])
        more = counts > 1
        return pd.DataFrame({"fingerprint": keys[more].view(np.int64), "n": counts[more]})

    filters = fingerprints.mapInArrow(build, "block long, entries long, payload binary")
    return filters.groupBy("block").applyInPandas(merge, "fingerprint long, n long")


def _whole(number: int) -> Column:
    return F.lit(str(number)).cast("decimal(20,0)")


def _best(id_: Column, size: Column) -> Column:
    """A number that is largest for the most code points, then the smallest id; a null id is the last."""
    rank = F.coalesce(_whole(2**63) - id_.cast("decimal(20,0)"), _whole(0))
    return (size.cast("decimal(12,0)") * _whole(2 * 10**19) + rank).cast("decimal(38,0)")


def _best_id(best: Column) -> Column:
    rank = (best % _whole(2 * 10**19)).cast("decimal(20,0)")
    return F.when(rank > 0, (_whole(2**63) - rank).cast("long"))


def _bits_of(fingerprints: np.ndarray, power: int) -> np.ndarray:
    """The bit of a sieve of 2**power bits that each fingerprint has; its lowest bits name the segment."""
    segment = fingerprints & np.uint64(SEGMENTS - 1)
    inside = (fingerprints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - power + SEGMENT_BITS)
    return segment << np.uint64(power - SEGMENT_BITS) | inside


def _sieve(found: DataFrame, rows: int) -> tuple[np.ndarray, int]:
    """Bits of the repeated fingerprints, made by segment in tasks; 2**MAX_SIEVE_POWER bits at most come to the driver."""
    power = min(MAX_SIEVE_POWER, max(12, math.ceil(math.log2(16 * rows))))

    def make(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << (power - SEGMENT_BITS), bool)
        bits[_bits_of(group["fingerprint"].to_numpy().view(np.uint64), power) & np.uint64(len(bits) - 1)] = True
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(bits).tobytes()]})

    made = found.groupBy(F.pmod("fingerprint", F.lit(SEGMENTS)).alias("segment")).applyInPandas(make, "segment long, bits binary").collect()
    out = np.zeros((SEGMENTS, 1 << (power - SEGMENT_BITS - 3)), np.uint8)
    for r in made:
        out[r["segment"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel(), power


def _repeated(fingerprints: DataFrame) -> Callable[[DataFrame, bool], DataFrame]:
    """Splits a frame with a fingerprint column: rows that may have a repeated fingerprint, or those that have none.

    Repeated fingerprints are broadcast up to BROADCAST_FINGERPRINTS; beyond that a sieve of them is, which lets a few
    others through to the byte comparison. Either way only suspects leave their place.
    """
    found = park(repeated_fingerprints(fingerprints, fingerprints.count()).select("fingerprint"), "repeated")
    rows = found.count()
    if rows <= BROADCAST_FINGERPRINTS:
        return lambda df, hit: df.join(F.broadcast(found), "fingerprint", "left_semi" if hit else "left_anti")
    bits, power = _sieve(found, rows)
    shared = fingerprints.sparkSession.sparkContext.broadcast(bits)

    def split(df: DataFrame, hit: bool) -> DataFrame:
        at = df.columns.index("fingerprint")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bit = _bits_of(batch.column(at).to_numpy(zero_copy_only=False).view(np.uint64), power)
                there = (shared.value[(bit >> np.uint64(3)).astype(np.int64)] >> (7 - (bit & np.uint64(7))).astype(np.uint8)) & 1
                yield batch.filter(pa.array(there == hit))

        return text_batches(df).mapInArrow(run, df.schema)

    return split


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Class of each row: doc_id, keep_id, group_size, kept, text_sha256, n_chars."""
    text = text_or_empty(text_col)
    # The original text stays behind: only its length goes along with the normalised one.
    base = docs.select(F.col(id_col).alias("doc_id"), F.char_length(text).cast("long").alias("n_chars"), strip_space(text).alias("norm"))
    rows = park(base.select("doc_id", "n_chars", F.xxhash64("norm").alias("fingerprint"), F.sha2("norm", 256).alias("text_sha256")), "texts")
    suspects = _repeated(rows.select("fingerprint"))(base.withColumn("fingerprint", F.xxhash64("norm")), True)
    # Grouping by the whole text is the byte comparison; copies are combined before they are shuffled.
    classes = (
        suspects.groupBy("norm")
        .agg(F.count(F.lit(1)).alias("group_size"), F.max(_best(F.col("doc_id"), F.col("n_chars"))).alias("best"))
        .filter("group_size > 1")
        .select(F.sha2("norm", 256).alias("text_sha256"), _best_id(F.col("best")).alias("keep_id"), "group_size")
    )
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return rows.join(bounded(park(classes, "classes")), "text_sha256", "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), "text_sha256", "n_chars"
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, with their own columns: one for each distinct text.

    Texts without a repeated fingerprint pass where they are; of the others, the best row of each text stays.
    """
    text = text_or_empty(text_col)
    best = F.struct(_best(F.col(id_col), F.char_length(text).cast("long")).alias("best"), F.xxhash64(text).alias("tie"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), strip_space(text).alias("norm"), best.alias("best"))
    split = _repeated(docs.select(F.xxhash64(strip_space(text)).alias("fingerprint")))
    marked = rows.withColumn("fingerprint", F.xxhash64("norm"))
    first = split(marked, True).groupBy("norm").agg(F.max_by("row", "best").alias("row"))
    return split(marked, False).select("row.*").unionByName(first.select("row.*"))
