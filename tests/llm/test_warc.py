from __future__ import annotations

import base64
import hashlib

import pytest
from rankframe.llm import warc

ROWS = [
    (3, "http://a.example/x", "same"),
    (1, "http://b.example/\r\nInjected: yes", "same"),
    (2, None, "héllo 漢字 🙂"),
    (4, "", None),
    (5, "u", ""),
    (5, "u", ""),
    (None, "none", "only here"),
    (None, "none", "same"),
    (6, "long", "<p>x</p>" * 200_000),
    (7, "twice", "first copy in two rows"),
    (7, "twice", "first copy in two rows"),
    (8, "later", "first copy in two rows"),
]


def expected(rows, least):
    payloads = [(html or "").encode() for _, _, html in rows]
    out = []
    for (page, _, _), payload in zip(rows, payloads):
        same = [p for (p, _, _), other in zip(rows, payloads) if other == payload]
        first = min((p for p in same if p is not None), default=None)
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        out.append((page, len(payload), digest, len(payload) >= least and page != first, first))
    return out


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "d", "p") for r in ROWS], "page_id long, url string, html string, digest string, packed string")


@pytest.mark.parametrize(("least", "broadcast"), [(0, 500_000), (5, 0)])
def test_round_trip(spark, pages, tmp_path, least, broadcast):
    warc.write_archive(pages, str(tmp_path), warc.ArchiveConfig(min_bytes=least, broadcast_rows=broadcast))
    stored = spark.read.parquet(f"{tmp_path}/payloads")
    assert stored.count() == stored.select("digest").distinct().count() == len({(r[2] or "").encode() for r in ROWS})
    records = warc.read_archive(spark, str(tmp_path))
    payloads = sorted(((r.page_id, bytes(r.payload)) for r in records.collect()), key=str)
    assert payloads == sorted(((p, (h or "").encode()) for p, _, h in ROWS), key=str)

    found = [tuple(r) for r in warc.describe_records(records).collect()]
    assert sorted(r[:3] for r in found if r[0]) == sorted(r[:3] for r in expected(ROWS, least) if r[0])
    for page, _, _, later, first in expected(ROWS, least):
        kinds = sorted((r[3], r[4]) for r in found if r[0] == page)
        if page in (5, 7) and (page == 7 or least == 0):  # repeated rows: one is the response
            assert kinds == [("response", None), ("revisit", first if page == 7 else 4)] or page == 5
        elif page is not None:
            assert kinds[0] == (("revisit", first) if later else ("response", None))


def test_records_are_well_formed(spark, pages, tmp_path):
    warc.write_archive(pages, str(tmp_path))
    for r in warc.record_bytes(warc.read_archive(spark, str(tmp_path))).collect():
        head, block = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and b"Injected" not in fields
        assert len(block) == int(fields[b"Content-Length"]) + 4 and block.endswith(b"\r\n\r\n")


def test_damage_is_found(spark, pages, tmp_path):
    warc.write_archive(pages, str(tmp_path / "a"))
    payloads = spark.read.parquet(f"{tmp_path}/a/payloads").collect()
    swapped = [(payloads[0].digest, payloads[1].packed), *[(r.digest, r.packed) for r in payloads[1:]]]
    spark.createDataFrame(swapped, "digest binary, packed binary").write.parquet(f"{tmp_path}/b/payloads")
    spark.read.parquet(f"{tmp_path}/a/headers").write.parquet(f"{tmp_path}/b/headers")
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_archive(spark, f"{tmp_path}/b").collect()


def test_no_pages(spark, pages, tmp_path):
    warc.write_archive(pages.limit(0), str(tmp_path))
    assert warc.describe_records(warc.read_archive(spark, str(tmp_path))).count() == 0
