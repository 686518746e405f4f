"""Chat formatting by quotation linking.

1. Each message is parsed into its own text and its quoted passages: runs of lines of one quote level. Own
   paragraphs and quoted passages are normalised (lower case, single spaces) and hashed.
2. A quoted passage is joined to the latest earlier message of the conversation whose own text holds it. The
   search runs over (conversation, hash, block of turns) with the best of earlier blocks carried along, so that
   a passage quoted a million times is never paired with its million originals.
3. A message answers the message behind its outermost linked passage. Answers form threads (the connected
   components of these links), and a conversation is ordered by thread, then turn: each message follows the one
   that it answers, without quotes or attribution lines.
4. Positions within a conversation come from a range partitioning over (conversation, thread, turn): a
   conversation with a third of all messages is spread over many tasks.

Defined cases: null text is empty. Messages without a conversation or turn are never linked; each keeps its own
thread. Repeated (conversation, turn) rows are one message for linking and get following positions. Quotes that
match nothing are removed and link nothing. Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mdlake.llm.common import park
from mdlake.llm.components import connected_components

#: Turns that one window of the search spans.
BLOCK_TURNS = 1024
_QUOTE = re.compile(r"(?:[ \t]?>)+[ \t]?")
_ATTRIBUTION = re.compile(r"\s*(?:On\b.*\bwrote|.*\b(?:wrote|schrieb|a écrit|escribió))\s*:\s*$", re.IGNORECASE)


def passage_hash(lines: list[str]) -> bytes | None:
    """Hash of a passage in lower case with single spaces; None without words."""
    words = " ".join(lines).lower().split()
    return xxhash.xxh3_128_digest(" ".join(words)) if words else None


def _paragraphs(lines: list[str]) -> list[list[str]]:
    out: list[list[str]] = [[]]
    for line in lines:
        if line.strip():
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return [p for p in out if p]


def parse(text: str | None) -> tuple[str, list[tuple[int, bytes]], list[bytes]]:
    """Own text without quotes, (level, hash) of the quoted passages in order, hashes of the own passages."""
    lines = [(m[0].count(">"), line[m.end() :]) if (m := _QUOTE.match(line)) else (0, line) for line in (text or "").split("\n")]
    quoted = any(level for level, _ in lines)
    lines = [x for i, x in enumerate(lines) if not (quoted and x[0] == 0 and i + 1 < len(lines) and lines[i + 1][0] and _ATTRIBUTION.match(x[1]))]
    own, quotes, runs = [], [], []
    for level, line in lines:
        if not runs or runs[-1][0] != level:
            runs.append((level, []))
        runs[-1][1].append(line)
    passages = []
    for level, run in runs:
        if level:
            candidates = dict.fromkeys([passage_hash(run), *map(passage_hash, _paragraphs(run))])
            quotes += [(level, h) for h in candidates if h]
        else:
            own += run
            passages += [run, *_paragraphs(run)]
    clean = "\n".join(own).strip("\n") if quoted else text or ""
    return clean, quotes, [h for h in dict.fromkeys(map(passage_hash, [own, *passages])) if h]


def parsed(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, quotes, own) of messages (conv_id, turn, role, text)."""
    schema = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("quotes", pa.list_(pa.struct([("level", pa.int32()), ("hash", pa.binary())]))), ("own", pa.list_(pa.binary()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [parse(t.as_py()) for t in batch.column(3)]
            quotes = [[{"level": level, "hash": h} for level, h in q] for _, q, _ in found]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([c for c, _, _ in found], pa.string()), pa.array(quotes, schema.types[4]), pa.array([o for _, _, o in found], schema.types[5])], schema=schema)

    rows = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, quotes array<struct<level:int,hash:binary>>, own array<binary>")


def replies(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, reply_to): the message that each linked message answers. messages: the result of parsed()."""
    known = messages.filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    quotes = known.select("conv_id", "turn", F.posexplode("quotes").alias("at", "quote")).select("conv_id", "turn", "at", "quote.level", "quote.hash")
    wanted = quotes.select("conv_id", "hash").distinct()
    own = known.select("conv_id", "turn", F.explode("own").alias("hash")).join(wanted, ["conv_id", "hash"], "left_semi")
    block = F.floor(F.col("turn") / BLOCK_TURNS).alias("block")
    events = quotes.select("conv_id", "hash", block, "turn", "level", "at", F.lit(None).cast("long").alias("source")).union(own.select("conv_id", "hash", block, "turn", F.lit(None).cast("int"), F.lit(None).cast("int"), F.col("turn")))
    earlier = Window.partitionBy("conv_id", "hash").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = events.groupBy("conv_id", "hash", "block").agg(F.max("source").alias("last")).select("conv_id", "hash", "block", F.max("last").over(earlier).alias("carried"))
    within = Window.partitionBy("conv_id", "hash", "block").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    linked = events.withColumn("near", F.max("source").over(within)).filter("level IS NOT NULL").join(carried, ["conv_id", "hash", "block"]).withColumn("reply_to", F.coalesce("near", "carried"))
    return linked.filter("reply_to IS NOT NULL").groupBy("conv_id", "turn").agg(F.min_by("reply_to", F.struct("level", "at")).alias("reply_to"))


def conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, position, turn, role, text, reply_to, thread, n_quotes): reply-ordered messages without quotes."""
    rows = park(parsed(messages), "messages")
    links = park(replies(rows), "replies")
    node = lambda turn: F.struct("conv_id", F.col(turn).alias("turn"))
    threads = connected_components(links.select(node("turn").alias("a"), node("reply_to").alias("b")))
    threads = threads.select("node.conv_id", "node.turn", F.col("component.turn").alias("root"))
    out = rows.select("conv_id", "turn", "role", "text", F.size("quotes").cast("long").alias("n_quotes")).join(links, ["conv_id", "turn"], "left").join(threads, ["conv_id", "turn"], "left")
    out = out.withColumn("thread", F.coalesce("root", "turn")).drop("root")
    order = ["conv_id", "thread", "turn", "role", "text"]
    parts = int(messages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = park(out.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    placed = ranged.withColumn("row", F.row_number().over(Window.partitionBy("conv_id", "part").orderBy("thread", "turn", "role", "text")))
    same = placed["conv_id"].eqNullSafe(offsets["conv_id"]) & (placed["part"] == offsets["part"])
    return placed.join(offsets, same).select(placed["conv_id"], (F.col("offset") + F.col("row") - 1).cast("long").alias("position"), "turn", "role", "text", "reply_to", "thread", "n_quotes")
