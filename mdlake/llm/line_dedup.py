"""Line deduplication by a log-template tree, in DataFrame functions only.

1. A line is cut into tokens; tokens with a digit become the field <*>. The tree's path is the token count, then
   the first DEPTH tokens; its end is a leaf.
2. Lines of a leaf that are equal after masking share a template.
3. A leaf of lines with MIN_TOKENS tokens or more may hold any number of further templates, whose fields are words.
   Two lines that agree on SIMILARITY of all positions are equal in one of a few disjoint blocks of positions, and
   often in all positions but one. Lines that share such a slot meet the first line of the slot, in the order of
   their smallest document: a line that agrees with one of its slots' first lines is led by it, as an instance of the
   same template. A stranger in the leaf shares no slot with the others and so changes nothing for them.
4. A line found in two or more documents stays in the one with the smallest doc_id and is dropped from the others; a
   line that is led stays only in the document of its leader, where it is the first of its template.

Lines are masked once and written with their position in the text, as two hashes (leaf and masked text, 128 bits
together) beside the masked words. Only the distinct lines of leaves that hold several travel as text afterwards; a
line compares with at most one other line for each of its slots, so a leaf that holds a third of all lines costs no
list of pairs. A line that a third of all documents hold is combined before each grouping.

Defined cases: null text is the empty text; lines without tokens are kept and belong to no template. Rows with
equal doc_id are one document. Rows without doc_id count as one document that comes last. Empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mdlake.llm.common import bounded, park, text_or_empty

DEPTH = 3
MIN_TOKENS = 5
SIMILARITY = 0.8
FIELD = "<*>"
#: Leaves (8 bytes each) up to which their table is broadcast; beyond, lines are shuffled to them.
BROADCAST_LEAVES = 1 << 20
_LAST = 2**63 - 1


def masked(line: Column) -> Column:
    """A line with single spaces and its variable tokens as fields; each rewrite runs only where it changes something."""
    has = lambda c, x: F.contains(c, F.lit(x))
    odd = has(line, "\t") | has(line, "\r") | has(line, "\x0b") | has(line, "\x0c")
    plain = F.when(odd, F.translate(line, "\t\x0b\x0c\r", "    ")).otherwise(line)
    plain = F.trim(F.when(has(plain, "  "), F.regexp_replace(plain, " +", " ")).otherwise(plain))
    return F.when(plain.rlike("[0-9]"), F.regexp_replace(plain, r"(?<![^ ])[^ 0-9]*+[0-9][^ ]*", FIELD)).otherwise(plain)


def _tokens(line: Column) -> Column:
    return F.split(line, " ")


def _size(line: Column) -> Column:
    """Tokens of a masked line: one more than its spaces."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _leaf(line: Column, depth: int) -> Column:
    return F.xxhash64(_size(line), F.substring_index(line, " ", depth))


def _slots(line: Column, leaf: Column, size: Column, depth: int, similarity: float) -> Column:
    """Hashes of what a line may share with another that agrees: each block of positions, and all positions but one.

    There is one block more than the positions in which two lines that agree may differ.
    """

    def of(words: Column) -> Column:
        each = F.transform(words, lambda x, i: F.xxhash64(i, x))
        mixed = lambda hashes: F.aggregate(hashes, F.lit(0).cast("long"), lambda x, y: x.bitwiseXOR(y))
        n = F.floor(size * (1 - similarity) + 1e-6).cast("int") + 1
        rest = F.greatest(size - depth, F.lit(0)).cast("long")
        edge = lambda i: F.floor(rest * i / n).cast("int")
        block = lambda hashes: F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(leaf, F.lit("block"), i, mixed(F.slice(hashes, edge(i) + depth + 1, edge(i + 1) - edge(i)))))
        field = lambda hashes, whole: F.transform(F.slice(hashes, F.lit(depth + 1), size), lambda x, i: F.xxhash64(leaf, F.lit("field"), i, whole.bitwiseXOR(x)))
        once = lambda hashes: F.transform(F.array(mixed(hashes)), lambda whole: F.concat(block(hashes), field(hashes, whole)))
        return F.element_at(F.element_at(F.transform(F.array(each), once), 1), 1)

    return of(_tokens(line))


def led_lines(held: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY) -> DataFrame:
    """(leaf, template, first): the lines that another one leads, with the smallest document among their leaders.

    held: leaf, template, size, line, low (smallest document), without repeats.
    """
    # Ties between lines of one document go by a digest that SQL has too.
    tie = F.conv(F.substring(F.md5("line"), 1, 15), 16, 10).cast("long")
    held = park(held.withColumn("own", F.struct("low", tie.alias("tie"))), "open-lines")
    slots = held.select("leaf", "own", F.explode(_slots(F.col("line"), F.col("leaf"), F.col("size"), depth, similarity)).alias("slot"))
    slots = park(slots, "slots")
    least = slots.groupBy("slot").agg(F.min("own").alias("lead"), F.max("own").alias("last")).filter("lead < last").select("slot", "lead")
    pairs = slots.join(least, "slot").filter("lead < own").select("leaf", "own", "lead").distinct()
    words = held.select("leaf", "own", "template", "line")
    leaders = held.select("leaf", F.col("own").alias("lead"), F.col("line").alias("other"))
    met = pairs.join(words, ["leaf", "own"]).join(leaders, ["leaf", "lead"])
    tokens = _tokens(F.col("line"))
    same = F.size(F.filter(F.zip_with(tokens, _tokens(F.col("other")), lambda x, y: x == y), lambda x: x))
    return met.filter(same >= similarity * F.size(tokens) - 1e-6).groupBy("leaf", "template").agg(F.min("lead.low").alias("first"))


def recurring_templates(lines: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY) -> DataFrame:
    """(leaf, template, first): the lines that occur in other documents than the one which keeps them.

    lines: doc, leaf, template, size, line.
    """
    leaves = lines.filter(F.col("size") >= MIN_TOKENS).groupBy("leaf").agg(*[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("template", "doc")])
    open_leaves = park(leaves.filter("min_template <> max_template AND min_doc <> max_doc").select("leaf"), "leaves")
    held = lines.join(bounded(open_leaves, BROADCAST_LEAVES), "leaf").groupBy("leaf", "template", "size", "line").agg(F.min("doc").alias("low"))
    led = park(led_lines(held, depth, similarity), "led")
    templates = lines.groupBy("leaf", "template").agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
    kept = templates.join(led, ["leaf", "template"], "left").withColumn("keep", F.coalesce("first", "low"))
    return kept.filter("keep <> high OR low <> high").select("leaf", "template", F.col("keep").alias("first"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped): each document without the lines that an earlier one holds."""
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("doc"), text.alias("text"))
    exploded = base.select("doc", F.xxhash64("text").alias("hash"), F.posexplode(F.split("text", "\n")).alias("at", "line")).select("doc", "hash", "at", masked(F.col("line")).alias("line"))
    lines = exploded.filter("line <> ''").withColumn("size", _size(F.col("line")))
    lines = park(lines.select("doc", "hash", "at", _leaf(F.col("line"), depth).alias("leaf"), F.xxhash64("line").alias("template"), "size", F.when(F.col("size") >= MIN_TOKENS, F.col("line")).alias("line")), "lines")
    recurring = recurring_templates(lines, depth, similarity)
    # A text is known by its document and hash: rows with equal ids may hold different texts.
    gone = lines.select("doc", "hash", "at", "leaf", "template").join(recurring, ["leaf", "template"]).filter("doc <> first").groupBy("doc", "hash").agg(F.collect_set("at").alias("gone"))
    rows = base.withColumn("hash", F.xxhash64("text")).join(gone, ["doc", "hash"], "left").withColumn("lines", F.split("text", "\n"))
    kept = F.filter("lines", lambda x, i: ~F.array_contains("gone", i))
    left = F.when(F.col("gone").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text"))
    return rows.select("doc_id", left.alias("text"), F.size("lines").cast("long").alias("n_lines"), F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0).cast("long").alias("n_dropped"))


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(doc_id, {_LAST}) AS doc, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
raw AS (SELECT DISTINCT doc, unnest(lines) AS line FROM d),
m AS (SELECT doc, line, regexp_replace(trim(regexp_replace(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    '), ' +', ' ', 'g')), '[^ ]*[0-9][^ ]*', '{FIELD}', 'g') AS t FROM raw),
k AS (SELECT doc, line, t, string_split(t, ' ') AS tokens, len(string_split(t, ' ')) AS size, array_to_string(string_split(t, ' ')[1:{DEPTH}], ' ') AS lead FROM m WHERE t <> ''),
leaf AS (SELECT size, lead FROM k GROUP BY size, lead HAVING count(DISTINCT t) > 1 AND min(doc) <> max(doc) AND size >= {MIN_TOKENS}),
held AS (SELECT size, lead, t, tokens, min(doc) AS low, ('0x' || substr(md5(t), 1, 15))::BIGINT AS tie FROM k JOIN leaf USING (size, lead) GROUP BY size, lead, t, tokens),
numbered AS (SELECT *, floor(size * {1 - SIMILARITY:.6f} + 1e-6)::INT + 1 AS n, size - {DEPTH} AS rest FROM held),
blocks AS (SELECT *, unnest(range(0, n)) AS j FROM numbered),
fields AS (SELECT *, unnest(range({DEPTH + 1}, size + 1)) AS j FROM numbered),
slots AS (SELECT size, lead, t, tokens, low, tie, 'block' AS kind, j, tokens[{DEPTH + 1} + rest * j // n : {DEPTH} + rest * (j + 1) // n] AS held FROM blocks
  UNION ALL SELECT size, lead, t, tokens, low, tie, 'field', j, list_concat(tokens[1 : j - 1], tokens[j + 1 :]) FROM fields),
pairs AS (SELECT *, first_value(low) OVER w AS lead_low, first_value(t) OVER w AS lead_t, first_value(tokens) OVER w AS others FROM slots WINDOW w AS (PARTITION BY size, lead, kind, j, held ORDER BY low, tie)),
led AS (SELECT t, min(lead_low) AS first FROM pairs WHERE t <> lead_t AND len([i FOR i IN range(1, size + 1) IF tokens[i] = others[i]]) >= {SIMILARITY} * size - 1e-6 GROUP BY t),
firsts AS (SELECT k.doc, k.line, coalesce(led.first, min(k.doc) OVER (PARTITION BY k.t)) AS first FROM k LEFT JOIN led USING (t)),
gone AS (SELECT doc, list(line) AS gone FROM firsts WHERE doc <> first GROUP BY doc),
kept AS (SELECT doc_id, lines, [x FOR x IN lines IF NOT coalesce(list_contains(gone, x), false)] AS kept FROM d LEFT JOIN gone USING (doc))
SELECT doc_id, len(lines) AS n_lines, len(lines) - len(kept) AS n_dropped, sha256(array_to_string(kept, chr(10))) AS text_sha256 FROM kept
"""
