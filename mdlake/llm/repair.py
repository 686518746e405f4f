"""Conversation structure repair: the cheapest edits that make a conversation's turns alternate.

Edits are Keep (0), Rerole to user or assistant (2), Delete (3; the only one for a blank or duplicate turn) and Insert
of an empty user or assistant turn (2). A truncated turn that stays costs 1 more. Role initials of the outcome read
`(s?(ua)+)?`; among the cheapest edit strings the ASCII-least is taken.

The search is a square-root checkpointed dynamic programme over four states (start, after system, user, assistant):
the state-cost vector behind each block of turns is kept as a checkpoint, vectors within a block are kept only at each
square root of its length, and segments are computed again while the walk goes forward. Vectors are taken less their
least cost, so few of them exist and steps are remembered.

1. Turns are sorted by range over (conversation, turn, role, start of the text, its hash, place) and packed into
   blocks of at most BLOCK_TURNS turns or BLOCK_CHARS characters (a longer turn is a block), so that a conversation
   with a third of all turns, or one turn that is repeated as often, is spread over many tasks. Blocks are written.
2. Duplicates are found by 16-byte digests alone: first places combine before the shuffle, and only digests that
   occur twice are joined back.
3. One byte a turn passes backwards through each conversation and leaves the checkpoints.
4. Checkpoints and texts meet by conversation, sorted, and stream through the forward walk. SHA-256 and the walk are
   sequential by nature, so a conversation is one task here, which holds one block and the edit string.

Defined cases: a null role or text is one space. Turns of equal number go by role, the first 64 characters of the
text, its hash. A null conversation id is one conversation, null turn numbers come first, repeated rows are
duplicates, and the empty table gives an empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b, sha256
from math import isqrt

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import SPACES, park

BLOCK_TURNS, BLOCK_CHARS = 4096, 1 << 16
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
DELETE, INSERT, REROLE, CUT = 3, 2, 2, 1
_INITIALS = "sua"
#: The state after the user or assistant turn that is due in each state, and that turn's role.
_DUE = (2, 2, 3, 2)
_ROLES = {2: "user", 3: "assistant"}
#: Costs behind the last turn: nothing, or the inserts that are missing.
END = (0, 4, 2, 0)

Vector = tuple[int, int, int, int]


def code_of(role: str, text: str) -> int:
    """Role initial (s, u, a, other: 0 to 3) and four times the fault, duplicates aside."""
    body = text.rstrip(SPACES)
    fault = BLANK if not body else 0 if body[-1] in ".!?" else TRUNCATED
    return (_INITIALS.find(role[0]) if role and role[0] in _INITIALS else 3) | fault << 2


def _kept(code: int, state: int) -> int | None:
    """The state after a turn that is kept, if it may be."""
    if code >> 2 in (BLANK, DUPLICATE):
        return None
    initial = code & 3
    if initial == 0:
        return 1 if state == 0 else None
    return _DUE[state] if initial < 3 and _DUE[state] == initial + 1 else None


def _costs(code: int, behind: Vector) -> Vector:
    """Costs of each state before a turn, given those behind it."""
    out = []
    extra = CUT if code >> 2 == TRUNCATED else 0
    for state in range(4):
        cost = DELETE + behind[state]
        if code >> 2 not in (BLANK, DUPLICATE):
            cost = min(cost, REROLE + extra + behind[_DUE[state]])
        if (then := _kept(code, state)) is not None:
            cost = min(cost, extra + behind[then])
        out.append(cost)
    for _ in range(2):
        out = [min(c, INSERT + out[_DUE[state]]) for state, c in enumerate(out)]
    return tuple(out)


@lru_cache(maxsize=1 << 16)
def step(code: int, behind: Vector) -> Vector:
    """The vector before a turn, less its least cost."""
    costs = _costs(code, behind)
    least = min(costs)
    return tuple(c - least for c in costs)


@lru_cache(maxsize=1 << 16)
def choose(code: int, behind: Vector, state: int) -> tuple[tuple[tuple[str, str | None], ...], int, int]:
    """The ASCII-least of the cheapest edits up to and with a turn (letter, new role), their cost and the next state."""
    left, edits, paid = _costs(code, behind), [], 0
    extra = CUT if code >> 2 == TRUNCATED else 0
    while True:
        due = _DUE[state]
        if DELETE + behind[state] == left[state]:
            return (*edits, ("D", None)), paid + DELETE, state
        if INSERT + left[due] == left[state]:
            edits, paid, state = [*edits, ("I", _ROLES[due])], paid + INSERT, due
            continue
        then = _kept(code, state)
        if then is not None and extra + behind[then] == left[state]:
            return (*edits, ("K", None)), paid + extra, then
        return (*edits, ("R", _ROLES[due])), paid + REROLE + extra, due


def behind_each(codes: bytes, end: Vector) -> Iterator[Vector]:
    """The vector behind each turn of a block, first turn first; a square root of them is held at a time."""
    n = len(codes)
    gap, points, vector = max(1, isqrt(n)), {}, end
    for i in range(n - 1, -1, -1):
        if i == n - 1 or (i + 1) % gap == 0:
            points[i // gap] = vector
        vector = step(codes[i], vector)
    for start in range(0, n, gap):
        last = min(start + gap, n) - 1
        segment = [points[last // gap]]
        for i in range(last, start, -1):
            segment.append(step(codes[i], segment[-1]))
        while segment:
            yield segment.pop()


def damaged(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text): turns damaged by crc32 of `conv_id:turn` modulo 20, nulls as one space.

    0 drops a turn, 1 empties its text, 2 removes [.!?] from it, 3 repeats it, 4 makes its role user.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"), (F.crc32(F.concat(space(conv), F.lit(":"), space(turn))) % 20).alias("k"))
    changed = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.explode(F.array_repeat(F.col("k"), F.when(F.col("k") == 3, 2).otherwise(1)))
    return rows.filter("k <> 0").select("conv_id", "turn", F.when(F.col("k") == 4, "user").otherwise(F.col("role")).alias("role"), changed.alias("text"), copies.alias("k")).drop("k")


_BLOCK = "conv_id {}, part int, block long, turns array<long>, roles array<string>, texts array<string>, codes binary, marks array<binary>"


def _blocks(turns: DataFrame) -> DataFrame:
    """Sorted turns packed as rows; (part, block) is their order."""
    id_type = turns.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text"), F.monotonically_increasing_id()]
    keyed = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), *[c.alias(f"k{i}") for i, c in enumerate(order[3:])])
    placed = keyed.repartitionByRange(*order[:3], "k0", "k1", "k2").sortWithinPartitions(*order[:3], "k0", "k1", "k2").drop("k0", "k1", "k2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, held, chars, total = TaskContext.get().partitionId(), 0, [], 0, 0
        names = ["conv_id", "part", "block", "turns", "roles", "texts", "codes", "marks"]
        types = None

        def block() -> list:
            marks = [blake2b(f"{conv}\0{len(role)}\0{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest() for conv, _, role, text in held]
            return [held[0][0], part, k, [r[1] for r in held], [r[2] for r in held], [r[3] for r in held], bytes(code_of(r[2], r[3]) for r in held), marks]

        def packed(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        done = []

        for batch in batches:
            types = [batch.schema.field(0).type, pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary(), pa.list_(pa.binary())]
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (row[0] != held[0][0] or len(held) == BLOCK_TURNS or chars + len(row[3]) > BLOCK_CHARS):
                    done.append(block())
                    held, chars, k, total = [], 0, k + 1, total + chars
                    if total > 1 << 22 or len(done) == 1000:
                        yield packed(done)
                        done, total = [], 0
                held.append(row)
                chars += len(row[3])
        if held:
            yield packed([*done, block()])

    return park(placed.mapInArrow(run, _BLOCK.format(id_type)), "blocks")


def _with_duplicates(blocks: DataFrame) -> DataFrame:
    """(conv_id, part, block, codes), with later turns of equal role and text in a conversation marked."""
    turns = blocks.select("part", "block", F.posexplode("marks").alias("at", "mark"))
    place = F.struct("part", "block", "at")
    repeated = turns.groupBy("mark").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark", "first")
    later = turns.join(repeated, "mark").filter(place > F.col("first")).groupBy("part", "block").agg(F.collect_list("at").alias("later"))
    rows = blocks.select("conv_id", "part", "block", "codes").join(later, ["part", "block"], "left").select("conv_id", "part", "block", "codes", "later")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for codes, later in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist(), strict=True):
                codes = bytearray(codes)
                for at in later or ():
                    if codes[at] >> 2 != BLANK:
                        codes[at] = codes[at] & 3 | DUPLICATE << 2
                out.append(bytes(codes))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], names=["conv_id", "part", "block", "codes"])

    return rows.mapInArrow(run, f"conv_id {blocks.schema['conv_id'].dataType.simpleString()}, part int, block long, codes binary")


def _checkpoints(codes: DataFrame) -> DataFrame:
    """codes with `behind`, the vector behind each block: a pass from the end of each conversation to its start."""
    back = codes.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("part"), F.desc("block"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, vector = (), END
        for batch in batches:
            out = []
            for conv, data in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if own != (conv,):
                    own, vector = (conv,), END
                out.append(list(vector))
                for code in reversed(data):
                    vector = step(code, vector)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.int32()))], names=["conv_id", "part", "block", "codes", "behind"])

    return back.mapInArrow(run, f"conv_id {codes.schema['conv_id'].dataType.simpleString()}, part int, block long, codes binary, behind array<int>")


def _walks(turns: DataFrame) -> DataFrame:
    """Blocks with their checkpoints, by conversation and in order; the checkpoint row comes before its block."""
    blocks = _blocks(turns)
    points = park(_checkpoints(_with_duplicates(blocks)), "checkpoints")
    none = lambda kind: F.lit(None).cast(kind)
    texts = blocks.select("conv_id", "part", "block", F.lit(1).alias("kind"), none("binary").alias("codes"), none("array<int>").alias("behind"), "turns", "roles", "texts")
    both = texts.union(points.select("conv_id", "part", "block", F.lit(0), "codes", "behind", none("array<long>"), none("array<string>"), none("array<string>")))
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block", "kind")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id as a 1-tuple, edit, its cost, turn, role before, code, new role, new text) of each edit; edit "" ends a conversation."""
    own, state, point = None, 0, None
    for batch in batches:
        for i in range(batch.num_rows):
            conv = (batch.column(0)[i].as_py(),)
            if own != conv:
                if own is not None:
                    yield from _ending(own, state)
                own, state = conv, 0
            if batch.column(3)[i].as_py() == 0:
                point = batch.column(4)[i].as_py(), tuple(batch.column(5)[i].as_py())
                continue
            codes, end = point
            for code, behind, turn, role, text in zip(codes, behind_each(codes, end), *(batch.column(k)[i].as_py() for k in (6, 7, 8)), strict=True):
                edits, paid, state = choose(code, behind, state)
                for letter, new in edits[:-1]:
                    yield conv, letter, 0, None, None, None, new, ""
                letter, new = edits[-1]
                yield conv, letter, paid, turn, role, code, None if letter == "D" else new or role, None if letter == "D" else text
    if own is not None:
        yield from _ending(own, state)


def _ending(conv: tuple, state: int) -> Iterator[tuple]:
    while state not in (0, 3):
        state = _DUE[state]
        yield conv, "I", INSERT, None, None, None, _ROLES[state], ""
    yield conv, "", 0, None, None, None, None, None


def repaired_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, position, edit, role, text) of every turn of the outcome. turns: conv_id, turn, role, text."""
    walks = _walks(turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, position, kind = [], 0, 0, None

        def out() -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*held, strict=True), types, strict=True)], names=["conv_id", "position", "edit", "role", "text"])

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in source:
                kind = batch.schema.field(0).type
                yield batch

        for conv, letter, _, _, _, _, role, text in _edited(typed(batches)):
            if letter == "":
                position = 0
            elif letter != "D":
                held.append((conv[0], position, letter, role, text))
                position, size = position + 1, size + len(text)
                if len(held) == BLOCK_TURNS or size > BLOCK_CHARS:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return walks.mapInArrow(run, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, position long, edit string, role string, text string")


_REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def report(turns: DataFrame) -> DataFrame:
    """One row for each conversation that has turns: gaps, faults, cost, audit and the SHA-256 of its repaired text."""
    walks = _walks(turns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, names = None, ["conv_id", *(f.split()[0] for f in _REPORT.split(", "))]

        def typed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in source:
                kind = batch.schema.field(0).type
                yield batch

        fresh = lambda: ([0] * 6, [], sha256(), [None, None, 0], None)
        faults, audit, digest, span, before = fresh()
        lines, done = 0, []

        def packed(rows: list) -> pa.RecordBatch:
            types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

        for conv, letter, paid, turn, role, code, new, text in _edited(typed(batches)):
            if letter == "":
                faults[0] = span[1] - span[0] + 1 - span[2] if span[2] else 0
                done.append((conv[0], *faults, "".join(audit), digest.hexdigest()))
                if len(done) == 1000:
                    yield packed(done)
                    done = []
                faults, audit, digest, span, before = fresh()
                lines = 0
                continue
            audit.append(letter)
            faults[5] += paid
            if code is not None:
                if code >> 2:
                    faults[code >> 2] += 1
                if before is not None and before + role[:1] not in ("su", "ua", "au"):
                    faults[4] += 1
                before = role[:1]
                if turn is not None:
                    if turn != span[1]:
                        span[2] += 1
                    span[0], span[1] = turn if span[0] is None else span[0], turn
            if new is not None:
                digest.update(f"{chr(10) if lines else ''}{new}:{text}".encode("utf-8", "surrogatepass"))
                lines += 1
        if done:
            yield packed(done)

    return walks.mapInArrow(run, f"conv_id {turns.schema['conv_id'].dataType.simpleString()}, {_REPORT}")


def with_all(found: DataFrame, ids: Column | str, turns: DataFrame) -> DataFrame:
    """The report with a row of zeros for conversations of `turns` that have no turn left."""
    every = turns.select((F.col(ids) if isinstance(ids, str) else ids).alias("conv_id")).distinct()
    rows = every.alias("e").join(found.alias("f"), F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")), "left")
    zeros = [F.coalesce(f"f.{c}", F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return rows.select("e.conv_id", *zeros, F.coalesce("f.audit", F.lit("")).alias("audit"), F.coalesce("f.repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"))


#: The same rows in SQL: a recursive table goes from the last turn to the first with a (cost, edits, text) for each state.
ORACLE_SQL = r"""
    WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
    c AS (SELECT * EXCLUDE (k), xor(list_reduce(list_prepend(4294967295::BIGINT, [unicode(x)::BIGINT FOR x IN string_split(k, '')]), lambda h, b: list_reduce(list_prepend(xor(h, b), [0::BIGINT FOR _ IN range(8)]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 20 AS k FROM o),
    d AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role, CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text FROM c, range(CASE WHEN k = 3 THEN 2 ELSE 1 END) WHERE k <> 0),
    n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body FROM d),
    m AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM n),
    f AS (SELECT *, CASE WHEN body = '' THEN 1 WHEN seen > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p, max(i) OVER (PARTITION BY conv_id) AS last FROM m),
    w AS (
        SELECT DISTINCT conv_id, last + 1 AS i, {'c': 0, 'a': '', 't': ''} AS s0, {'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} AS s1, {'c': 2, 'a': 'I', 't': chr(10) || 'assistant:'} AS s2, {'c': 0, 'a': '', 't': ''} AS s3 FROM f
        UNION ALL
        SELECT conv_id, i,
            list_min([b0, {'c': 2 + b2.c, 'a': 'I' || b2.a, 't': u || b2.t}, {'c': 4 + b3.c, 'a': 'II' || b3.a, 't': u || v || b3.t}]), list_min([b1, {'c': 2 + b2.c, 'a': 'I' || b2.a, 't': u || b2.t}, {'c': 4 + b3.c, 'a': 'II' || b3.a, 't': u || v || b3.t}]),
            list_min([b2, {'c': 2 + b3.c, 'a': 'I' || b3.a, 't': v || b3.t}]), list_min([b3, {'c': 2 + b2.c, 'a': 'I' || b2.a, 't': u || b2.t}])
        FROM (
            SELECT conv_id, i, chr(10) || 'user:' AS u, chr(10) || 'assistant:' AS v,
                list_min([{'c': 3 + s0.c, 'a': 'D' || s0.a, 't': s0.t}, CASE WHEN ok AND r = 's' THEN {'c': x + s1.c, 'a': 'K' || s1.a, 't': line || s1.t} WHEN ok AND r = 'u' THEN {'c': x + s2.c, 'a': 'K' || s2.a, 't': line || s2.t} END, CASE WHEN ok THEN {'c': 2 + x + s2.c, 'a': 'R' || s2.a, 't': asu || s2.t} END]) AS b0,
                list_min([{'c': 3 + s1.c, 'a': 'D' || s1.a, 't': s1.t}, CASE WHEN ok AND r = 'u' THEN {'c': x + s2.c, 'a': 'K' || s2.a, 't': line || s2.t} END, CASE WHEN ok THEN {'c': 2 + x + s2.c, 'a': 'R' || s2.a, 't': asu || s2.t} END]) AS b1,
                list_min([{'c': 3 + s2.c, 'a': 'D' || s2.a, 't': s2.t}, CASE WHEN ok AND r = 'a' THEN {'c': x + s3.c, 'a': 'K' || s3.a, 't': line || s3.t} END, CASE WHEN ok THEN {'c': 2 + x + s3.c, 'a': 'R' || s3.a, 't': asa || s3.t} END]) AS b2,
                list_min([{'c': 3 + s3.c, 'a': 'D' || s3.a, 't': s3.t}, CASE WHEN ok AND r = 'u' THEN {'c': x + s2.c, 'a': 'K' || s2.a, 't': line || s2.t} END, CASE WHEN ok THEN {'c': 2 + x + s2.c, 'a': 'R' || s2.a, 't': asu || s2.t} END]) AS b3
            FROM (SELECT f.conv_id, f.i, s0, s1, s2, s3, r, fault NOT IN (1, 2) AS ok, (fault = 3)::INT AS x, chr(10) || role || ':' || text AS line, chr(10) || 'user:' || text AS asu, chr(10) || 'assistant:' || text AS asa FROM w JOIN f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i - 1)
        )
    ),
    r AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 1) AS blank, count(*) FILTER (WHERE fault = 2) AS duplicate, count(*) FILTER (WHERE fault = 3) AS truncated, count(*) FILTER (WHERE p || r NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1)
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s0.c, 0)::BIGINT AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(substr(s0.t, 2), '')) AS repaired_sha256
    FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM e.conv_id AND w.i = 1
"""
