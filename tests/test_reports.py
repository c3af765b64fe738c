"""Tables over several lines, reports, statuses and text lines against plain loops and worked cases."""

import re

import pytest

from vellum.operators import costs, exports, geometry, structure
from vellum.streaming import lifecycle

TEXTS = {
    1: "# Chapter 1. One\nsome words <table><tr>\n## 3.1 inside\n</tr></table> after\nFig. 1.2 x\nword-\n# Chapter 2. Two\n<table>a</table> ⚠",
    2: "</table>\n<table>\nnever closed\n# 3. Head",
    3: "<table>\n<table>x</table>\n# Heading\n</table><table>\n# no heading\n</table>",
    4: "",
}


def lines(spark, texts=TEXTS):
    return spark.createDataFrame([(b, n, t) for b, x in texts.items() for n, t in enumerate(x.split("\n"), 1)], "book int, line int, text string")


def test_whole_tables(spark):
    got = {r.book: r for r in structure.measures(lines(spark)).collect()}
    table = re.compile(r"(?is)<table\b.*?</table>")
    for book, text in TEXTS.items():
        body = table.sub("", text)
        r = got[book]
        assert r.tables == len(table.findall(text))
        assert r.words == len(re.sub(r"<[^>]+>", " ", body).split())
        assert r.headings == len(re.findall(r"(?m)^#{1,6}\s+\S", body))
        assert r.figures == len(set(re.findall(r"Fig\.\s*\d+\.\d+[a-z]?", body)))
        assert r.open_hyphens == sum(1 for x in text.split("\n") if re.search(r"[^\W\d_]{2}-$", x))


def test_chapter_map_cuts_tables_at_chapters(spark):
    got = sorted((r.start, r.end, r.words, r.tables, r.marks, r.clean) for r in structure.chapter_map(lines(spark)).collect() if r.book == 1)
    assert got == [(1, 6, 4 + 2 + 1 + 3 + 1, 1, 0, False), (7, 8, 4 + 1, 1, 1, False)]
    cut = {1: "# Chapter 1. A\n<table>\n# Chapter 2. B\nx</table>"}
    assert sorted((r.start, r.tables) for r in structure.chapter_map(lines(spark, cut)).collect()) == [(1, 0), (3, 0)]


def test_report(spark):
    rows = lines(spark)
    cover = spark.createDataFrame([(1, "chapter", 1, 3), (1, "none", 0, 0)], "book int, label string, found int, total int")
    got = {r.book: r.text for r in exports.report(structure.measures(rows.where("book = 1")), structure.measures(rows), cover, structure.chapter_map(rows), structure.table_queue(rows)).collect()}
    assert set(got) == set(TEXTS)
    assert "| tables | 2 | 2 |" in got[1] and "| tables |  | 0 |" in got[4]
    assert "| chapter | 3 | 1 (33%) |" in got[1] and "| none | 0 | 0 (0%) |" in got[1]
    assert "| 1-6 | 11 | 1 | 0 |" in got[1] and "Chapters without tables and marks: 0" in got[1]
    assert "Tables without a scan: 2" in got[1]
    assert "## Chapters" not in got[2] and "## Labels" not in got[2]


def test_outcomes(spark):
    rows = [(1, 0.0, "loading"), (1, 5.0, "running"), (1, 9.0, "exited"), (2, 0.0, None), (2, 3.0, "offline"), (3, 0.0, "loading"), (4, 0.0, "loading"), (4, 100.0, "running")]
    got = {r.instance: (r.outcome, r.at) for r in lifecycle.outcomes(spark.createDataFrame(rows, "instance int, at double, status string"), 60.0).collect()}
    assert got == {1: ("up", 5.0), 2: ("dead", 3.0), 3: ("late", 60.0), 4: ("late", 60.0)}


def test_summary_is_replaced(spark, tmp_path):
    path = str(tmp_path / "run")
    for n in (3, 2):
        pages = spark.createDataFrame([("a", float(i)) for i in range(n)], "run string, at double")
        lifecycle.write_summary(lifecycle.summary(pages), path)
    assert [tuple(r) for r in spark.read.json(path).select("run", "pages", "seconds", "pages_per_sec").collect()] == [("a", 2, 1.0, 2.0)]


def test_probe_output(spark):
    df = spark.createDataFrame([("x\n12.5\n",), ("12\nbad",), ("",), (None,)], "o string")
    assert [r.v for r in df.select(exports.parsed_speed(df.o).alias("v")).collect()] == [12.5, 0.0, 0.0, 0.0]


def test_market_without_offers(spark):
    offers = spark.createDataFrame([(1, 7, 1, True, 5.0)], "id int, machine_id int, num_gpus int, rentable boolean, dph_total double")
    with pytest.raises(ValueError):
        costs.market(offers, costs.Host("g", 1, max_dph=0.25, machine_id=7))


def test_text_lines(spark):
    spans = [(1, 0, n, w, 9.0 + (w == "big"), float(x0), 10.0 * n, float(x1), 10.0 * n + 8) for n in range(6) for w, x0, x1 in (("left", 10, 90), ("big", 120, 200), (" ", 250, 299), ("right", 320, 400))]
    spans.append((1, 1, 0, "mid", 20.0, 280.0, 0.0, 330.0, 9.0))
    spans += [(2, 0, 0, "alone", 8.0, 10.0, 0.0, 500.0, 9.0), (2, 0, 1, "  ", 8.0, 10.0, 0.0, 500.0, 9.0)]
    df = spark.createDataFrame(spans, "page int, block int, line int, text string, size double, x0 double, y0 double, x1 double, y1 double")
    got = {(r.page, r.block, r.line, r.col): (r.text, r.size, r.x0, r.x1) for r in geometry.text_lines(df, 600.0, 300.0).collect()}
    want = {(1, 1, 0, -1): ("mid", 20.0, 280.0, 330.0), (2, 0, 0, 0): ("alone", 8.0, 10.0, 500.0)}
    for n in range(6):
        want[1, 0, n, 0] = ("left big", 10.0, 10.0, 200.0)
        want[1, 0, n, 1] = ("right", 9.0, 320.0, 400.0)
    assert got == want
