"""Archives written, normalised and read back, against hashes of the payloads themselves."""

import base64
import gzip
import hashlib
import io
import json

import pyarrow as pa
import pytest

from tabloom.llm.warc import archived, normalise_file, read_member, record

BIG = "<p>" + "long text é " * 200_000


def table(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, records int").repartition(3)


def expected(rows, least):
    first = {}
    for page_id, _, page, *_ in rows:
        if page_id is not None:
            first[page or ""] = min(page_id, first.get(page or "", page_id))
    for page_id, _, page, *_ in rows:
        raw = (page or "").encode()
        repeated = sum((p or "") == (page or "") for _, _, p, *_ in rows) > 1
        other = first.get(page or "") if repeated and len(raw) >= least and first.get(page or "") != page_id else None
        yield page_id, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if other is None else "revisit", other


@pytest.mark.parametrize("least", [0, 10])
def test_pages_come_back(spark, least):
    rows = [(5, "http://a/\r\nX: y", "<b>same page</b>"), (3, None, "<b>same page</b>"), (9, "u", "<b>same page</b>"), (1, "u", None), (2, "u", ""), (8, "é", BIG),
            (7, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n"), (6, "u", "tiny"), (4, "u", "tiny"), (None, "u", "<b>same page</b>"), (None, "u", "alone of its kind"), (3, "u", "<b>same page</b>")]
    rows = [(*r, "x", 1) for r in rows]
    got = archived(table(spark, rows), least_bytes=least)
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected(rows, least), key=str)


def test_empty_table(spark):
    assert archived(table(spark, [])).count() == 0


def test_members_stand_where_the_index_says():
    records = [record(str(k), "http://x/", bytes(range(256)) * k, "D", None, False) for k in range(40)]
    records.insert(7, record("r", "u", b"abc", "D", "1", True))
    monolithic = gzip.compress(b"".join(records[:20])) + gzip.compress(b"".join(records[20:]))  # two members, neither a record's
    out, index = io.BytesIO(), io.BytesIO()
    assert normalise_file(pa.BufferReader(monolithic), out, index) == (41, len(out.getvalue()))
    lines = [json.loads(x) for x in index.getvalue().splitlines()]
    for line, want in zip(lines, records, strict=True):
        assert gzip.decompress(out.getvalue()[line["offset"] : line["offset"] + line["length"]]) == want
    assert read_member(out.getvalue()[lines[7]["offset"] :][: lines[7]["length"]])["record_type"] == "revisit"
    assert gzip.decompress(out.getvalue()) == b"".join(records)
    with pytest.raises(ValueError):
        normalise_file(pa.BufferReader(gzip.compress(b"".join(records)[:-30])), io.BytesIO(), io.BytesIO())
