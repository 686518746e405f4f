"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

Characters are folded to 64 symbols: Latin letters by base and case, letters of other scripts spread over the same
symbols, digits, spaces and signs. The query uses n-grams of SHARDED_ORDER symbols. The model is a table for each
order that grows with the trusted text. The n-grams of a block of documents are counted by document and packed by
shard of the model before they are shuffled; a task holds one shard's probabilities, lets the blocks pass by and
gives sums for a whole block, which are added up by block. Nothing of the model or the documents is broadcast or
collected.

For short n-grams there is also a model that is a table of 64**3 entries (1 MB) at any size, and is broadcast: nothing
of a document is shuffled for its score then. Trusted rows are found by a join on the id: up to BROADCAST_IDS ids are
sent to the texts, beyond that both are shuffled.

A document's perplexity is smoothed by PRIOR symbols at the model's own entropy, so that a few words can't look
bad by chance. It is kept up to the QUANTILE of its language's trusted documents. Those are held out: a quarter of
the trusted rows, by a checksum of their id, aren't counted and set the thresholds, each language's its own, however
few its held-out rows are.

Defined cases: null and empty texts have the prior's perplexity. Rows without a language form a group of their
own; a language without trusted documents takes the quantile of all trusted ones, and where none is held out that of
the counted ones is taken; with no trusted document at all every row is kept. Repeated rows get equal results,
repeated labels count once, empty tables give empty results.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import bounded, park, text_batches

BITS, ORDER = 6, 3
SYMBOLS = 1 << BITS
QUANTILE = 0.995
PRIOR = 100
#: Trusted ids (8 bytes each) up to which they are broadcast.
BROADCAST_IDS = 1 << 20
#: Length of the n-grams of the sharded model, and how many of them a task holds of it at most, about.
SHARDED_ORDER, SHARD_CODES = 4, 1 << 20
#: Documents and postings of a block.
_BLOCK_ROWS, _BLOCK_POSTINGS = 1000, 1 << 21
#: Symbols 0 to 51 are letters, the signs are the last eight.
LETTERS, SPACE, DIGIT, STOP, QUOTE, SIGN = 52, 52, 53, 54, 55, 56


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """The symbol of every code point: Latin letters by their base and case, others spread over the same symbols."""
    point = np.arange(0x110000)
    letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    symbol = np.where(letter, point * 31 % LETTERS, SIGN + point % 8).astype(np.uint8)
    for i in range(0x3000):
        c = chr(i)
        base = unicodedata.normalize("NFKD", c)[0]
        if "a" <= base <= "z":
            symbol[i] = ord(base) - 97
        elif "A" <= base <= "Z":
            symbol[i] = ord(base) - 65 + 26
        elif c.isspace():
            symbol[i] = SPACE
        elif base.isdigit():
            symbol[i] = DIGIT
        elif c in ".,;:":
            symbol[i] = STOP
        elif c in "?'’\"-()":
            symbol[i] = QUOTE
    return symbol


def symbols(text: str | None) -> np.ndarray:
    """A text as symbols after ORDER - 1 spaces."""
    return _folding()[np.frombuffer((" " * (ORDER - 1) + (text or "")).encode("utf-32-le", "surrogatepass"), np.uint32)]


def codes(own: np.ndarray) -> np.ndarray:
    """The n-grams that end at each symbol of the text."""
    code = np.zeros(len(own) - ORDER + 1, np.int32)
    for j in range(ORDER):
        code = code << BITS | own[j : j + len(code)]
    return code


def kneser_ney(counts: np.ndarray) -> np.ndarray:
    """Conditional probability of the last symbol of each n-gram: interpolated, with modified discounts.

    counts: of all SYMBOLS**ORDER n-grams. Lower orders count the distinct symbols that come before.
    """
    levels = [counts.astype(np.float64)]
    while len(levels[0]) > SYMBOLS:
        levels.insert(0, (levels[0] > 0).reshape(SYMBOLS, -1).sum(0).astype(np.float64))
    below = np.full(1, 1 / SYMBOLS)
    for c in levels:
        n = [float((c == k).sum()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        by_count = [min(k + 1.0, max(0.1, k + 1 - (k + 2) * y * n[k + 1] / n[k])) if n[k] else 0.75 for k in range(3)]
        discount = np.select([c == 0, c == 1, c == 2], [0.0, by_count[0], by_count[1]], by_count[2])
        table, off = c.reshape(-1, SYMBOLS), discount.reshape(-1, SYMBOLS)
        total = table.sum(1, keepdims=True)
        lower = np.tile(below, SYMBOLS) if len(c) > SYMBOLS else np.broadcast_to(below, len(c))
        lower = lower.reshape(-1, SYMBOLS)
        safe = np.maximum(total, 1)
        below = np.where(total > 0, (table - off) / safe + off.sum(1, keepdims=True) / safe * lower, lower).ravel()
    return below


def count_ngrams(texts: DataFrame) -> np.ndarray:
    """Counts of all n-grams over a frame of one column of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**ORDER, np.int64)
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(codes(symbols(text.as_py())))
                size += len(held[-1])
                if size > 1 << 20:
                    total += np.bincount(np.concatenate(held), minlength=len(total))
                    held, size = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=len(total))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["code", "n"])

    sums = text_batches(texts).mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SYMBOLS**ORDER, np.int64)
    out[sums.column("code").to_numpy()] = sums.column("n").to_numpy()
    return out


def held_out(id_: Column) -> Column:
    """The quarter of ids that sets thresholds."""
    return F.crc32(id_.cast("string")) % 4 == 2


def perplexities(docs: DataFrame, counts: np.ndarray, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(doc_id, lang, perplexity) under the model of the counts."""
    bits = -np.log2(kneser_ney(counts))
    entropy = float((counts * bits).sum() / max(1, counts.sum())) if counts.sum() else float(BITS)
    shared = docs.sparkSession.sparkContext.broadcast(bits.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            out = []
            for t in batch.column(2):
                own = codes(symbols(t.as_py()))
                out.append(2 ** ((float(table[own].sum(dtype=np.float64)) + PRIOR * entropy) / (len(own) + PRIOR)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["doc_id", "lang", "perplexity"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return text_batches(rows).mapInArrow(run, "doc_id long, lang string, perplexity double")


def _encoded(text: str | None, order: int) -> np.ndarray:
    """The n-grams of this length that end at each symbol of the text."""
    own = np.concatenate([np.full(order - 1, SPACE, np.uint8), symbols(text)[ORDER - 1 :]]).astype(np.int64)
    code = np.zeros(len(own) - order + 1, np.int64)
    for j in range(order):
        code = code << BITS | own[j : j + len(code)]
    return code


def _gram_counts(texts: DataFrame, order: int) -> DataFrame:
    """(code, n): counts of the n-grams of a frame of one column of texts, by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, n = np.unique(np.concatenate([_encoded(t.as_py(), order) for t in batch.column(0)] or [np.zeros(0, np.int64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

    return text_batches(texts).mapInArrow(run, "code long, n long")


def _level(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(code, c, off) and (context, total, spread) of one order; only four counts of counts come to the driver."""
    counts = park(counts, "level")
    n = [r or 0 for r in counts.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first()]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
    by_count = [min(k + 1.0, max(0.1, k + 1 - (k + 2) * y * n[k + 1] / n[k])) if n[k] else 0.75 for k in range(3)]
    off = F.when(F.col("c") == 1, by_count[0]).when(F.col("c") == 2, by_count[1]).otherwise(by_count[2])
    counts = counts.withColumn("off", off)
    contexts = counts.groupBy(F.shiftright("code", BITS).alias("context")).agg(F.sum("c").alias("total"), F.sum("off").alias("spread"))
    return counts, contexts


def sharded_bits(trusted: DataFrame, wanted: DataFrame, order: int) -> DataFrame:
    """(code, bits) of the wanted n-grams (code, without repeats) under the model of the trusted ones (code, c).

    The model is a table for each order, which grows with the trusted text; n-grams meet it by joins on hashed shards.
    """
    levels = [_level(trusted)]
    for k in range(order - 1, 0, -1):
        levels.append(_level(levels[-1][0].groupBy((F.col("code").bitwiseAND((1 << BITS * k) - 1)).alias("code")).agg(F.count(F.lit(1)).alias("c"))))
    needs = [park(wanted, "wanted")]
    for k in range(order - 1, 0, -1):
        needs.append(needs[-1].select(F.col("code").bitwiseAND((1 << BITS * k) - 1).alias("code")).distinct())
    below = None
    for k, ((counts, contexts), need) in enumerate(zip(reversed(levels), reversed(needs), strict=True), 1):
        rows = need.withColumn("context", F.shiftright("code", BITS)).join(counts, "code", "left").join(contexts, "context", "left")
        if below is None:
            rows = rows.withColumn("lower", F.lit(1 / SYMBOLS))
        else:
            suffix = F.col("code").bitwiseAND((1 << BITS * (k - 1)) - 1)
            rows = rows.withColumn("suffix", suffix).join(below.select(F.col("code").alias("suffix"), F.col("p").alias("lower")), "suffix")
        p = F.when(F.col("total").isNull(), F.col("lower")).otherwise(F.coalesce(F.col("c") - F.col("off"), F.lit(0.0)) / F.col("total") + F.col("spread") / F.col("total") * F.col("lower"))
        below = park(rows.select("code", p.alias("p")), "probability")
    return below.select("code", (-F.log2("p")).alias("bits"))


def _packed(codes_: np.ndarray, at: np.ndarray, n: np.ndarray, packer: zstandard.ZstdCompressor) -> bytes:
    """Postings in order of code as one compressed buffer: codes as steps, then the text's place and the count of each."""
    step = np.diff(codes_, prepend=np.int64(0))
    return len(codes_).to_bytes(4, "little") + packer.compress(step.astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes() + at.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes() + np.minimum(n, 65535).astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes())


def _unpacked(data: bytes, unpacker: zstandard.ZstdDecompressor) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:4], "little")
    raw = np.frombuffer(unpacker.decompress(data[4:]), np.uint8)
    column = lambda start, width, kind: np.ascontiguousarray(raw[start * n : (start + width) * n].reshape(width, n).T).view(kind).ravel()
    return np.cumsum(column(0, 8, "<i8")), column(8, 2, "<u2").astype(np.int64), column(10, 2, "<u2").astype(np.int64)


def _shard_of(code, shards: int):
    """The shard of a code, as an array or a column."""
    return code % 1_000_003 * 7919 % shards


_POSTINGS = "shard int, kind int, block long, code long, bits double, data binary, ids array<long>, langs array<string>, sizes array<long>"


def _postings(rows: DataFrame, order: int, shards: int) -> DataFrame:
    """The n-grams of documents (doc_id, lang, text) by blocks of documents and shards of codes, in the form _POSTINGS.

    Within a block a document is a place of two bytes. Each block also gives a row of its documents (kind 2), whose
    place is its shard.
    """
    schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("block", pa.int64()), ("code", pa.int64()), ("bits", pa.float64()), ("data", pa.binary()), ("ids", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, packer, k = TaskContext.get().partitionId(), zstandard.ZstdCompressor(level=3), 0

        def block(ids: list, langs: list, found: list) -> pa.RecordBatch:
            code = np.concatenate([c for c, _ in found] or [np.zeros(0, np.int64)])
            n = np.concatenate([m for _, m in found] or [np.zeros(0, np.int64)])
            at = np.repeat(np.arange(len(found)), [len(c) for c, _ in found])
            # A count of more than two bytes is written as several postings.
            while (big := n > 65535).any():
                code, at, n = np.concatenate([code, code[big]]), np.concatenate([at, at[big]]), np.concatenate([np.minimum(n, 65535), n[big] - 65535])
            shard = _shard_of(code, shards)
            order_ = np.lexsort((at, code, shard))
            code, at, n, shard = code[order_], at[order_], n[order_], shard[order_]
            starts = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1]))) if len(shard) else np.zeros(0, np.int64)
            ends = [*starts[1:], len(shard)]
            name = task << 32 | k
            out = [(int(shard[x]), 1, name, None, None, _packed(code[x:y], at[x:y], n[x:y], packer), None, None, None) for x, y in zip(starts, ends, strict=True)] if len(starts) else []
            out.append((k % shards, 2, name, None, None, None, ids, langs, [int(m.sum()) for _, m in found]))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(schema.types)], schema=schema)

        ids, langs, found, held = [], [], [], 0
        for batch in batches:
            for id_, lang, text in zip(*batch.columns, strict=True):
                code, n = np.unique(_encoded(text.as_py(), order), return_counts=True)
                ids.append(id_.as_py())
                langs.append(lang.as_py())
                found.append((code, n))
                held += len(code)
                if held > _BLOCK_POSTINGS or len(ids) == _BLOCK_ROWS:
                    yield block(ids, langs, found)
                    ids, langs, found, held, k = [], [], [], 0, k + 1
        if ids:
            yield block(ids, langs, found)

    return text_batches(rows).mapInArrow(run, _POSTINGS)


def _partial_sums(meeting: DataFrame) -> DataFrame:
    """(block, sums, ids, langs, sizes): bits of a block's documents from one shard, or the documents of the block.

    meeting: _POSTINGS rows by shard, those of the model (kind 0) first; a task holds one shard of the model.
    """
    schema = pa.schema([("block", pa.int64()), ("sums", pa.binary()), ("ids", pa.list_(pa.int64())), ("langs", pa.list_(pa.string())), ("sizes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, own, parts, model = zstandard.ZstdDecompressor(), None, [], None
        for batch in batches:
            shard, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            out = []
            edges = np.flatnonzero(np.concatenate(([True], (shard[1:] != shard[:-1]) | (kind[1:] != kind[:-1])))) if len(shard) else np.zeros(0, np.int64)
            for x, y in zip(edges.tolist(), [*edges[1:].tolist(), len(shard)], strict=True):
                if shard[x] != own:
                    own, parts, model = shard[x], [], None
                if kind[x] == 0:
                    parts.append((batch.column(3).slice(x, y - x).to_numpy(zero_copy_only=False), batch.column(4).slice(x, y - x).to_numpy(zero_copy_only=False)))
                    continue
                if kind[x] == 1 and model is None:
                    codes_, bits = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                    by = np.argsort(codes_)
                    model, parts = (codes_[by], bits[by]), []
                for row in batch.slice(x, y - x).to_pylist():
                    if row["kind"] == 1:
                        code, at, n = _unpacked(row["data"], unpacker)
                        sums = np.bincount(at, n * model[1][np.searchsorted(model[0], code)])
                        out.append((row["block"], sums.astype("<f8").tobytes(), None, None, None))
                    else:
                        out.append((row["block"], None, row["ids"], row["langs"], row["sizes"]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(schema.types)], schema=schema)

    return meeting.mapInArrow(run, "block long, sums binary, ids array<long>, langs array<string>, sizes array<long>")


def _block_means(partial: DataFrame) -> DataFrame:
    """(doc_id, lang, size, mean): partial sums of a block added up. partial: sorted by block, its documents first."""
    schema = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("size", pa.int64()), ("mean", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, total = None, None

        def done() -> pa.RecordBatch:
            sizes = np.array(held["sizes"], np.int64)
            return pa.RecordBatch.from_arrays([pa.array(held["ids"], pa.int64()), pa.array(held["langs"], pa.string()), pa.array(sizes), pa.array(total / np.maximum(sizes, 1))], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                if row["ids"] is not None:
                    if held is not None:
                        yield done()
                    held, total = row, np.zeros(len(row["ids"]))
                else:
                    sums = np.frombuffer(row["sums"], "<f8")
                    total[: len(sums)] += sums
        if held is not None:
            yield done()

    return partial.mapInArrow(run, "doc_id long, lang string, size long, mean double")


def sharded_perplexities(docs: DataFrame, trusted_texts: DataFrame, order: int = SHARDED_ORDER, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(doc_id, lang, perplexity) by sharded count joins: every document's n-grams meet the model's tables in shuffles.

    trusted_texts: one column. The model's tables grow with the trusted text; nothing of them is broadcast or
    collected. The n-grams of a block of documents are counted and packed by shard before they are shuffled, a task
    keeps one shard of the model and lets the blocks pass by, and each gives sums for a whole block.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    trusted = park(_gram_counts(trusted_texts, order).groupBy("code").agg(F.sum("n").alias("c")), "trusted-grams")
    wanted = _gram_counts(rows.select("text"), order).select("code").union(trusted.select("code")).distinct()
    bits = park(sharded_bits(trusted, wanted, order), "bits")
    sums = trusted.join(bits, "code").agg(F.sum(F.col("c") * F.col("bits")), F.sum("c")).first()
    entropy = sums[0] / sums[1] if sums[1] else float(BITS)
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = max(tasks, math.ceil(bits.count() / SHARD_CODES))
    none = lambda kind: F.lit(None).cast(kind)
    model = bits.select(_shard_of(F.col("code"), shards).cast("int"), F.lit(0), none("long"), "code", "bits", none("binary"), none("array<long>"), none("array<string>"), none("array<long>"))
    meeting = _postings(rows, order, shards).union(model).repartition("shard").sortWithinPartitions("shard", "kind")
    partial = _partial_sums(meeting).repartition("block").sortWithinPartitions("block", F.col("ids").isNull())
    smooth = (F.col("mean") * F.col("size") + PRIOR * entropy) / (F.col("size") + PRIOR)
    return _block_means(partial).select("doc_id", "lang", F.pow(F.lit(2.0), smooth).alias("perplexity"))


def classify(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", quantile: float = QUANTILE, sharded_order: int | None = None) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, kept) of each row. trusted: one column, the ids of trusted documents.

    sharded_order: n-grams of this length by sharded count joins, instead of the broadcast model.
    """
    ids = park(trusted.select(F.col(trusted.columns[0]).cast("long").alias("id")).filter("id IS NOT NULL").distinct(), "trusted")
    trusted = bounded(ids, BROADCAST_IDS)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(trusted, "id", "left_semi")
    counted = texts.filter(~held_out(F.col("id"))).select("text")
    found = sharded_perplexities(docs, counted, sharded_order, id_col, lang_col, text_col) if sharded_order else perplexities(docs, count_ngrams(counted), id_col, lang_col, text_col)
    scores = park(found, "perplexity")
    good = scores.join(trusted, scores["doc_id"] == trusted["id"], "left_semi")
    bound = F.percentile_approx("perplexity", quantile, 10_000)
    apart = good.filter(held_out(F.col("doc_id")))
    overall = apart.agg(bound).first()[0] or good.agg(bound).first()[0]
    overall = F.lit(overall).cast("double")
    by_lang = apart.groupBy(F.col("lang").alias("of")).agg(bound.alias("threshold"))
    marked = scores.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    threshold = F.coalesce("threshold", overall)
    return marked.select("doc_id", "lang", "perplexity", threshold.alias("threshold"), F.coalesce(F.col("perplexity") <= threshold, F.lit(True)).alias("kept"))
