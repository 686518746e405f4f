import random

from mdlake.llm import queries
from mdlake.llm.chat import conversations, parse, passage_hash


def quote(text, level=1):
    return "\n".join(">" * level + " " + line for line in text.split("\n"))


def test_parse():
    text = "Hi.\n\nOn Monday Ann wrote:\n> First  part\n> goes on\n>> deeper\n\nMy answer.\n> > again deep\nEnd."
    clean, quotes, own = parse(text)
    assert clean == "Hi.\n\n\nMy answer.\nEnd."
    assert quotes == [(1, passage_hash(["first part goes on"])), (2, passage_hash(["deeper"])), (2, passage_hash(["again deep"]))]
    assert passage_hash(["my ANSWER."]) in own and passage_hash(["End."]) in own
    assert parse(None) == ("", [], []) and parse("a > b\n") == ("a > b\n", [], [passage_hash(["a > b"])])


def brute(rows):
    """Positions, answers and threads by trying every earlier message."""
    out = []
    by_conv = {}
    for c, t, r, x in rows:
        by_conv.setdefault(c, []).append((t, r, x))
    for c, own in by_conv.items():
        answers, root = {}, {}
        for t, _, x in own:
            if c is None or t is None:
                continue
            for _, h in sorted(((level, i), h) for i, (level, h) in enumerate(parse(x)[1])):
                if found := [u for u, _, y in own if u is not None and u < t and h in parse(y)[2]]:
                    answers.setdefault(t, max(found))
        for t in sorted(t for t, _, _ in own if t is not None):
            root[t] = root[answers[t]] if t in answers else t
        rank = lambda m: (root.get(m[0], -1) if m[0] is not None else -2, -2 if m[0] is None else m[0], m[1], parse(m[2])[0])
        for i, m in enumerate(sorted(own, key=rank)):
            out.append((c, i, m[0], m[1], parse(m[2])[0], answers.get(m[0]), root.get(m[0]), len(parse(m[2])[1])))
    return sorted(out, key=str)


def test_matches_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for c in (1, 2, 3, None):
        said = []
        for t in range(3000 if c == 2 else 25):
            text = f"Message {t} of {c}.\nSecond line." if rng.random() < 0.7 else "Thanks."
            if said and rng.random() < 0.5:
                text = f"Ann wrote:\n{quote(rng.choice(said[-40:]))}\n\n{text}"
            if rng.random() < 0.1:
                text = quote("never said", 2) + "\n" + text
            said.append(text)
            rows.append((c, t, "user" if t % 2 else "assistant", text))
    rows += [(1, None, "user", quote("Thanks.")), (9, 0, "user", None), (9, 1, "user", ""), (9, 1, "user", ""), (10, 5, "user", "w " * 100_000)]
    small = [r for r in rows if r[0] != 2]
    columns = "conv_id long, turn long, role string, text string"
    frame = lambda x: spark.createDataFrame(x, columns).selectExpr("*", "'x' AS thread", "1 AS part", "2 AS hash").repartition(5)
    got = conversations(frame(rows)).collect()
    assert sorted((tuple(r) for r in got if r.conv_id != 2), key=str) == brute(small)
    big = [r for r in got if r.conv_id == 2]
    assert sorted(r.position for r in big) == list(range(3000))
    at = {r.turn: r.position for r in big}
    assert all(at[r.reply_to] < at[r.turn] for r in big if r.reply_to is not None)
    assert sum(r.reply_to is not None for r in big) > 1000
    assert conversations(frame(rows).limit(0)).count() == 0


def test_plain_conversations_keep_their_turns(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").collect()
    got = queries.op6(spark, "/root/testdata/sf0.001").collect()
    assert {(r.conv_id, r.turn, r.position, r.text) for r in got} == {(r.conv_id, r.turn, r.turn, r.text) for r in rows}
