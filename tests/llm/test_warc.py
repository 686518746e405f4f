import base64
import gzip
import hashlib
import io
import random

import pytest

from mdlake.llm import warc


def test_records_survive_any_chunking(monkeypatch):
    rng = random.Random(1)
    rows = [(None, None, b""), (1, "http://a/ é\r\n", b"\r\n\r\n" * 3), (2, "u", rng.randbytes(300_000)), (3, "u", b"x" * 2_000_000)]
    data = b"".join(warc.member(warc.record(i, u, p, warc.base32(hashlib.sha1(p).digest()), 2, i == 2)) for i, u, p in rows)
    for size in (1 << 18, 997, 61) if len(data) < 1 << 20 else (1 << 18, 997):
        monkeypatch.setattr(warc, "CHUNK", size)
        got = list(warc.read_archive(io.BytesIO(data)))
        assert [(r[0], r[2], r[3], r[4], r[6]) for r in got] == [(i, "revisit" if i == 2 else "response", 2 if i == 2 else None, len(p), None if i == 2 else p) for i, _, p in rows]
        assert got[1][1] == "http://a/%20é%0D%0A"
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") == 4


@pytest.mark.parametrize("harm", ["cut", "digest", "long", "short"])
def test_damage_is_reported(harm):
    whole = warc.record(1, "u", b"hello", warc.base32(hashlib.sha1(b"hello").digest()), None, False)
    data = {
        "cut": warc.member(whole)[:-9],
        "digest": warc.member(whole.replace(b"hello", b"hallo")),
        "long": warc.member(whole + b"x"),
        "short": warc.member(whole[:-6]),
    }[harm]
    with pytest.raises(ValueError, match="file, record 0"):
        list(warc.read_archive(io.BytesIO(data), "file"))


@pytest.mark.parametrize("min_bytes", [0, 4])
def test_frames(spark, tmp_path, min_bytes):
    rng = random.Random(2)
    rows = [(i, f"http://h/{i}", rng.choice(["", None, "abc", "long page é " * 40, f"own {i}"])) for i in range(200)]
    rows += [(None, "n", "abc"), (199, "again", rows[199][2]), (500, None, "z" * 3_000_000), (None, "m", "only null"), (None, "m", "only null")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'p' AS payload", "1 AS digest").repartition(6)
    manifest = spark.createDataFrame(warc.write_archives(pages, f"file://{tmp_path}", min_bytes, archive_bytes=4000).collect())
    got = warc.read_archives(manifest).collect()
    assert manifest.count() > 6 and len(got) == len(rows)
    last = {}
    for i, _, html in rows:
        last[html or ""] = max(last.get(html or "", -1), -1 if i is None else i)
    want = []
    for i, _, html in rows:
        payload = (html or "").encode()
        response = len(payload) < min_bytes or last[html or ""] in (i, -1)
        want.append((i, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "response" if response else "revisit", None if response else last[html or ""], payload if response else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) or (b"" if r.payload is not None else None)) for r in got), key=str) == sorted(want, key=str)


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archives(warc.write_archives(pages, f"file://{tmp_path}")).count() == 0
