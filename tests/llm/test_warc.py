import base64
import hashlib
from collections import Counter

from tidemark.llm import warc

SCHEMA = "page_id long, url string, html string, record_type string"


def brute(rows, least=0):
    first, used, out = {}, Counter(), []
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for i, _, html, *_ in order:
        first.setdefault(html or "", i)
    for i, _, html, *_ in order:
        p = (html or "").encode()
        again = len(p) >= least and used[html or ""] > 0
        used[html or ""] += 1
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if again else "response", first[html or ""] if again else None))
    return sorted(map(repr, out))


ROWS = [
    (3, "u", "same", "x"), (1, "v", "same", "x"), (1, "v", "same", "x"), (1, "w", "same", "x"), (2, None, None, "x"), (5, "u", "", "x"), (None, "x", "n", "x"),
    (None, "x", "n", "x"), (7, "u\r\n z", "é\r\n\r\nWARC/1.1\r\n", "x"), (9, "q", "n", "x"), (8, "q", "long " * 50_000, "x"),
]


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    for least in (0, 3):
        assert sorted(map(repr, (tuple(r) for r in warc.archived(pages, least).collect()))) == brute(ROWS, least)
    assert warc.archived(pages.limit(0)).count() == 0


def test_hot_payload_and_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SHARD_ROWS", 50)
    rows = [(i, f"http://h/{i}", "hot" if i % 3 == 0 else f"page {i}", "x") for i in range(400)]
    pages = spark.createDataFrame(rows, SCHEMA)
    manifests = []
    for name, order in (("a", "page_id"), ("b", "html")):
        lines = warc.write_archive(pages.repartition(7, order), f"{tmp_path}/{name}", roll_bytes=4_000)
        manifests.append(sorted(tuple(r) for r in lines.collect()))
    assert manifests[0] == manifests[1]  # the same bytes however the rows were dealt
    assert len(manifests[0]) > 8 and sum(m[2] for m in manifests[0]) == 400
    assert not list(tmp_path.glob("*/_temporary*"))
    # shards follow the page ids and are near their size
    by_shard = {}
    for r in warc.read_archive(spark, f"{tmp_path}/a").collect():
        by_shard.setdefault(int(r.file.split("-")[1]), []).append(int(r.page_id))
    ranges = [(min(x), max(x)) for _, x in sorted(by_shard.items())]
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:])) and len(ranges) >= 8
    assert max(map(len, by_shard.values())) <= 150
    back = warc.read_archive(spark, f"{tmp_path}/a").collect()
    assert len({r.page_id for r in back}) == 400 and sum(r.record_type == "response" for r in back) == 400 - 133


def test_a_changed_byte_is_found(spark, tmp_path):
    import gzip
    import io

    import pytest

    data = warc.record_bytes("1", "u", b"payload", None, False, 0)
    headers, block = next(warc.read_file(io.BytesIO(gzip.compress(data))))
    assert block.endswith(b"payload") and headers["WARC-Payload-Digest"] == f"sha1:{warc.payload_digest(b'payload')}"
    with pytest.raises(ValueError):
        list(warc.read_file(io.BytesIO(gzip.compress(data)[:-20])))


def test_folders_with_and_without_a_scheme(spark, tmp_path):
    pages = spark.createDataFrame(ROWS, SCHEMA)
    for name in (f"{tmp_path}/plain", f"file:{tmp_path}/one", f"file://{tmp_path}/three"):
        assert warc.write_archive(pages, name).agg({"records": "sum"}).first()[0] == len(ROWS)
        assert warc.read_archive(spark, name).count() == len(ROWS)
    assert sorted(x.name for x in tmp_path.iterdir()) == ["one", "plain", "three"]
