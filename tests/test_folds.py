"""Ordered operators against plain loops."""

import random
import re

import pandas as pd
from pyspark.sql import functions as F

from vellum.operators import alignment, geometry, structure


def join_by_loop(lines):
    """Join hyphens pass after pass until nothing changes."""
    lines = [re.sub(r"([^\W\d_])((?:</?\w[^>]*>)*)\\-([^\W\d_])", r"\1\2\3", x) for x in lines]
    changed = True
    while changed:
        changed, out, i = False, [], 0
        while i < len(lines):
            nxt = next((j for j in range(i + 1, len(lines)) if lines[j].strip()), None)
            if re.search(r"[^\W\d_]{2}-$", lines[i]) and nxt is not None and lines[nxt].lstrip()[0].islower():
                out.append(lines[i][:-1] + lines[nxt].lstrip())
                i, changed = nxt + 1, True
            else:
                out.append(lines[i])
                i += 1
        lines = out
    return lines


def test_hyphens(spark):
    rng = random.Random(1)
    pool = ["ab-", "xab-", "b-", "c", "  cd", "Two-", "Upper", "", "  ", "e-", "é-", "straße-", "im\\-posed", "Da</mark>\\-tum", "a1-", "слово-", "часть", "9", "z-"]
    volumes = {b: [rng.choice(pool) for _ in range(rng.randint(1, 14))] for b in range(400)}
    df = spark.createDataFrame([(b, i + 1, t) for b, ls in volumes.items() for i, t in enumerate(ls)], "book long, line int, text string")
    got = {}
    for r in structure.join_hyphens(df).orderBy("book", "line").collect():
        got.setdefault(r.book, []).append(r.text)
    for b, ls in volumes.items():
        assert got[b] == join_by_loop(ls), ls


def test_hyphens_twice_change_nothing(spark):
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(["tech-", "", "no-", "logy", "End-", "Of"])], "book long, line int, text string")
    once = structure.join_hyphens(df)
    again = structure.join_hyphens(once.select("book", "line", "text"))
    assert [r.text for r in once.orderBy("line").collect()] == [r.text for r in again.orderBy("line").collect()] == ["technology", "End-", "Of"]


def share(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    s = min((x[2] - x[0]) * (x[3] - x[1]) for x in (a, b))
    return max(w, 0) * max(h, 0) / s if s > 0 else 0


def random_boxes(rng, n):
    labels = ["table", "text", "image", "inline_formula", "reference", "paragraph_title", "seal"]
    out = []
    for i in range(n):
        x, y = rng.randint(0, 80), rng.randint(0, 80)
        out.append((i, rng.choice(labels), rng.randint(0, 9) / 10, float(x), float(y), float(x + rng.randint(2, 60)), float(y + rng.randint(2, 60))))
    return out


BOX = "page long, i int, label string, score double, x0 double, y0 double, x1 double, y1 double"


def test_suppression(spark):
    rng = random.Random(2)
    pages = {p: random_boxes(rng, rng.randint(1, 12)) for p in range(150)}
    got = {}
    for r in geometry.suppress(spark.createDataFrame([(p, *b) for p, bs in pages.items() for b in bs], BOX)).collect():
        got.setdefault(r.page, set()).add(r.i)
    for p, bs in pages.items():
        bs = [b for b in bs if b[1] != "reference"]
        alive = {b[0]: True for b in bs}
        for n, a in enumerate(bs):
            if a[5] - a[3] < 6 or a[6] - a[4] < 6:
                alive[a[0]] = False
            for b in bs[n + 1 :]:
                if not (alive[a[0]] and alive[b[0]]):
                    continue
                over, size = share(a[3:], b[3:]), lambda x: (x[5] - x[3]) * (x[6] - x[4])
                pair = {a[1], b[1]}
                if "inline_formula" in pair and over > 0.5:
                    for x in (a, b):
                        alive[x[0]] &= x[1] != "inline_formula"
                elif over > 0.7:
                    if len(pair) == 2 and pair & {"table", "image", "seal", "chart"}:
                        if "table" in pair and pair - {"table", "image", "seal", "chart"}:
                            alive[(b if a[1] == "table" else a)[0]] = False
                    else:
                        alive[(b if size(a) >= size(b) else a)[0]] = False
        assert got.get(p, set()) == {i for i, on in alive.items() if on}, bs


def test_views_merge(spark):
    rng = random.Random(3)
    pages = {p: (random_boxes(rng, 6), random_boxes(rng, 5)) for p in range(60)}
    frame = lambda k: spark.createDataFrame([(p, *b) for p, x in pages.items() for b in x[k]], BOX)
    got = {}
    for r in geometry.merge_views(frame(0), frame(1), 100.0).orderBy("page", "ord").collect():
        got.setdefault(r.page, []).append((r.label, r.score, (r.x0, r.y0, r.x1, r.y1)))
    for p, (own, extra) in pages.items():
        boxes = [(b[1], b[2], b[3:]) for b in own]
        for e in sorted(extra, key=lambda b: -b[2]):
            box, area = e[3:], lambda x: (x[2] - x[0]) * (x[3] - x[1])
            hits = [n for n, b in enumerate(boxes) if b[0] == "table" and share(box, b[2]) > 0.55]
            if hits:
                _, s, b = boxes[hits[0]]
                boxes[hits[0]] = ("table", max(s, e[2]), box if area(box) > area(b) else b)
            else:
                order = lambda x: ((x[0] + x[2]) / 2 >= 50, x[1])
                later = [n for n, b in enumerate(boxes) if order(b[2]) > order(box)]
                boxes.insert(later[0] if later else len(boxes), ("table", e[2], box))
        assert got[p] == boxes


def relabelled(spark, text, blocks):
    volumes = spark.createDataFrame([(1, text)], "book long, text string")
    rows = spark.createDataFrame([(1, i, la, t) for i, (la, t) in enumerate(blocks)], "book long, pos int, label string, text string")
    out = alignment.relabel(volumes, rows).collect()
    return out[0].text, {r.what: r.n for r in out if r.what}


def test_relabel(spark):
    blocks = [
        ("doc_title", "The Book"), ("header", "Chapter 1"), ("header", "Scraping"), ("text", "Plain words here."), ("paragraph_title", "Sec. 11.10\nDefinition"), ("header", "lower case prose stays"),
        ("figure_title", "Fig. 1.1 A thing"), ("header", "Chapter 2. Grinding metal"), ("text", "***"),
    ]
    text = "The Book\n\n# Chapter 1\n\nScraping\n\nPlain words here.\n\n## Sec. 11.10\n\nDefinition\n\nlower case prose stays\n\n<img src=\"a\">\n\nFig. 1.1 A thing\n\nChapter 2. Grinding metal"
    out, counts = relabelled(spark, text, blocks)
    assert out == "# The Book\n\n## Chapter 1. Scraping\n\nPlain words here.\n\n### Sec. 11.10 Definition\n\nlower case prose stays\n\n<img src=\"a\">\n\nFig. 1.1 A thing\n\n## Chapter 2. Grinding metal"
    assert counts["chapter"] == 2 and counts["title"] == 1 and counts["section"] == 1 and counts["caption bound"] == 1 and counts["header left as prose"] == 1
    again, _ = relabelled(spark, out, blocks)
    assert again == out


def test_relabel_contents_note_is_added_once(spark):
    blocks = [("content", "CONTENTS\n. . . . . ."), *[("header", f"Chapter {n}. Name {n}") for n in range(1, 7)]]
    text = "CONTENTS\n. . . . . .\n\n" + "\n\n".join(f"Chapter {n}. Name {n}" for n in range(1, 7))
    out, counts = relabelled(spark, text, blocks)
    assert out.count(alignment.NOTE) == 1 and counts["contents unread"] == 1
    again, _ = relabelled(spark, out, blocks)
    assert again == out


def test_relabel_without_blocks_keeps_text(spark):
    assert relabelled(spark, "One\n\nTwo", [("text", " ")])[0] == "One\n\nTwo"


def test_marks_survive_structure(spark):
    text = ["## Chapter 1. A", "word ⚠ and ≠ <mark>x</mark>-", "lower tail", "<table><tr><td>.005 ⚠</td></tr></table>"]
    df = spark.createDataFrame([(1, i + 1, t) for i, t in enumerate(text)], "book long, line int, text string")
    before = structure.measures(df).collect()[0]
    after = structure.measures(structure.join_hyphens(df).select("book", "line", "text")).collect()[0]
    for c in ("tables", "cautions", "unstable", "marks", "headings"):
        assert before[c] == after[c]


def test_first_gap_and_pandas_frames_are_typed(spark):
    empty = spark.createDataFrame([], BOX)
    assert geometry.suppress(empty).count() == 0 and geometry.merge_views(empty, empty, 10.0).count() == 0
    assert isinstance(geometry.box_pairs(empty).toPandas(), pd.DataFrame)
    assert geometry.column_gutter(empty, 100.0).select(F.col("gutter")).count() == 0
