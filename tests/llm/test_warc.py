import gzip
import hashlib
import io
from pathlib import Path

from vellum.llm import warc
from vellum.llm.store import fresh_path

LONG = "<p>" + "x" * 120 + "</p>\r\n\r\nWARC/1.1\r\n"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string, payload string")


def test_report_matches_definition(spark):
    rows = [(5, "http://a", LONG, "", ""), (3, None, LONG, "", ""), (9, "http://b\r\nX: 1", LONG, "", ""), (1, "u", "short", "", ""), (2, "u", "short", "", ""), (7, "u", None, "", ""), (8, "u", "", "", "")]
    rows += [(10, "é", "ünïcödé " * 20, "", ""), (None, "u", "lonely" * 30, "", ""), (None, "u", LONG, "", ""), (3, None, LONG, "", "")]
    got = warc.report(pages(spark, rows)).collect()
    assert len(got) == len(rows)
    want = []
    for i, _, h, *_ in rows:
        raw = (h or "").encode()
        least = min([r[0] for r in rows if r[2] == h and r[0] is not None], default=None) if len(raw) >= 100 else None
        revisit = least is not None and i != least
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", least if revisit else None))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_archive_round_trip_and_form(spark):
    rows = [(i, f"http://x/{i}", f"page {i % 3} " * 30, "", "") for i in range(20)]
    path = fresh_path(spark, "t")
    warc.write_archive(pages(spark, rows), path)
    back = warc.resolve(warc.read_archive(spark, path)).collect()
    assert {r.page_id: bytes(r.payload).decode() for r in back} == {r[0]: r[2] for r in rows}
    assert sum(r.record_type == "response" for r in back) == 3
    raw = b"".join(gzip.decompress(f.read_bytes()) for f in Path(path.removeprefix("file://")).glob("*.gz"))
    records = list(warc.parse(io.BufferedReader(io.BytesIO(raw))))
    assert len(records) == 20
    for headers, block in records:
        assert int(headers["content-length"]) == len(block)
        assert ("warc-refers-to" in headers) == (headers["warc-type"] == "revisit")


def test_empty(spark):
    assert warc.report(pages(spark, [(1, "", "", "", "")]).limit(0)).count() == 0
