"""Layout geometry. Boxes are rows (page, i, label, score, x0, y0, x1, y1); every join of boxes is within a page."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Labels that never yield to a table, and labels outside the columns of text.
HARD = ("table", "image", "seal", "chart")
NOT_COLUMN = ("number", "header", "footer", "header_image", "footer_image")


def overlap(a: str, b: str) -> Column:
    """Shared area over the smaller area of two boxes given as column prefixes; 0 if the smaller has none."""
    c = lambda p, n: F.col(f"{p}.{n}")
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(c(a, hi), c(b, hi)) - F.greatest(c(a, lo), c(b, lo)))
    area = lambda p: F.greatest(F.lit(0.0), c(p, "x1") - c(p, "x0")) * F.greatest(F.lit(0.0), c(p, "y1") - c(p, "y0"))
    small = F.least(area(a), area(b))
    return F.when(small > 0, side("x0", "x1") * side("y0", "y1") / small).otherwise(F.lit(0.0))


def box_pairs(boxes: DataFrame, least: float = 0.0) -> DataFrame:
    """page, i, j (i < j), ratio of the pairs of a page's boxes that share area, above least.

    An equi-join on the page with the touch test as its condition; pages hold some dozens of boxes."""
    a, b = boxes.alias("a"), boxes.alias("b")
    touch = (F.col("a.x0") < F.col("b.x1")) & (F.col("b.x0") < F.col("a.x1")) & (F.col("a.y0") < F.col("b.y1")) & (F.col("b.y0") < F.col("a.y1"))
    pairs = a.join(b, (F.col("a.page") == F.col("b.page")) & (F.col("a.i") < F.col("b.i")) & touch)
    return pairs.select(F.col("a.page").alias("page"), F.col("a.i").alias("i"), F.col("b.i").alias("j"), overlap("a", "b").alias("ratio")).where(F.col("ratio") > least)


def matched_boxes(left: DataFrame, right: DataFrame, least: float = 0.5) -> DataFrame:
    """page, i, j, iou of boxes of two detectors of one label whose intersection over union is at least `least`."""
    a, b = left.alias("a"), right.alias("b")
    touch = (F.col("a.x0") < F.col("b.x1")) & (F.col("b.x0") < F.col("a.x1")) & (F.col("a.y0") < F.col("b.y1")) & (F.col("b.y0") < F.col("a.y1"))
    side = lambda lo, hi: F.greatest(F.lit(0.0), F.least(F.col(f"a.{hi}"), F.col(f"b.{hi}")) - F.greatest(F.col(f"a.{lo}"), F.col(f"b.{lo}")))
    area = lambda p: (F.col(f"{p}.x1") - F.col(f"{p}.x0")) * (F.col(f"{p}.y1") - F.col(f"{p}.y0"))
    shared = side("x0", "x1") * side("y0", "y1")
    # the optimiser may put the last condition before the touch test, so it has to hold for boxes apart as well
    iou = F.when(shared > 0, shared / (area("a") + area("b") - shared))
    pairs = a.join(b, (F.col("a.page") == F.col("b.page")) & (F.col("a.label") == F.col("b.label")) & touch)
    return pairs.select(F.col("a.page").alias("page"), F.col("a.i").alias("i"), F.col("b.i").alias("j"), iou.alias("iou")).where(F.col("iou") >= least)


def above_threshold(boxes: DataFrame, usual: float = 0.3, by_label: dict[str, float] | None = None) -> DataFrame:
    """Boxes whose score reaches their label's threshold."""
    limit = F.lit(usual)
    for label, value in (by_label or {}).items():
        limit = F.when(F.col("label") == label, F.lit(value)).otherwise(limit)
    return boxes.where(F.col("score") >= limit)


def column_gutter(boxes: DataFrame, width: float, need_side: int = 2, least_gap: float = 6.0) -> DataFrame:
    """page, gutter: the middle between two columns of text, of the pages that have two.

    The largest gap of the sorted left edges (15 % of the width at least) parts the boxes; both sides need boxes, and
    the right edges of the left side must stay clear of the left edges of the right side."""
    text = boxes.where((F.col("label") != "table") & ~F.col("label").isin(*NOT_COLUMN))
    by = Window.partitionBy("page").orderBy("x0", "i")
    gaps = text.withColumn("__before", F.lag("x0").over(by)).withColumn("__gap", F.col("x0") - F.col("__before"))
    # the first of equal gaps, as it comes in order of the edges
    cut = gaps.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.max_by(F.struct("__before", "x0", "__gap"), F.struct("__gap", -F.col("x0"), -F.col("i"))).alias("g"))
    cut = cut.where((F.col("n") >= 2 * need_side) & (F.col("g.__gap") > 0) & (F.col("g.__gap") >= width * 0.15)).select("page", ((F.col("g.__before") + F.col("g.x0")) / 2).alias("at"))
    left = F.col("x0") < F.col("at")
    sides = text.join(cut, "page").groupBy("page").agg(F.count_if(left).alias("l"), F.count_if(~left).alias("r"), F.max(F.when(left, F.col("x1"))).alias("edge_l"), F.min(F.when(~left, F.col("x0"))).alias("edge_r"))
    fits = (F.col("l") >= need_side) & (F.col("r") >= need_side) & (F.col("edge_r") - F.col("edge_l") >= least_gap)
    return sides.where(fits).select("page", F.floor((F.col("edge_l") + F.col("edge_r")) / 2).cast("long").alias("gutter"))


def gutter_split(boxes: DataFrame, gutters: DataFrame, clear: Column | None = None, min_gutter: float = 12.0, margin: float = 4.0, min_half: float = 120.0) -> DataFrame:
    """boxes with wide tables across the gutter as two halves (part 1 and 2; part 0: whole). clear: the corridor is empty."""
    rows = boxes.join(gutters, "page", "left")
    m = F.col("gutter").cast("double")
    wide = (F.col("label") == "table") & (F.col("x0") < m - min_gutter) & (F.col("x1") > m + min_gutter) & (m - F.col("x0") > min_half) & (F.col("x1") - m > min_half)
    cut = F.coalesce(wide & (clear if clear is not None else F.lit(True)), F.lit(False))
    part = lambda n, a, b: F.struct(F.lit(n).alias("part"), a.cast("double").alias("x0"), b.cast("double").alias("x1"))
    parts = F.when(cut, F.array(part(1, F.col("x0"), m - margin), part(2, m + margin, F.col("x1")))).otherwise(F.array(part(0, F.col("x0"), F.col("x1"))))
    return rows.withColumn("__p", F.explode(parts)).select("page", "i", "label", "__p.part", "__p.x0", "y0", "__p.x1", "y1")


def vertical_gaps(lines: DataFrame, top: float, bottom: float, least: float = 55.0) -> DataFrame:
    """page, col, y0, y1: bands of a column without lines, of at least `least` points.

    lines: page, col (0, 1, or -1 for lines across both), y0, y1. The cursor is the largest y1 so far."""
    both = lines.withColumn("col", F.explode(F.when(F.col("col") == -1, F.array(F.lit(0), F.lit(1))).otherwise(F.array("col"))))
    by = Window.partitionBy("page", "col").orderBy("y0", "y1")
    before = F.greatest(F.lit(top), F.max("y1").over(by.rowsBetween(Window.unboundedPreceding, -1)))
    inner = both.select("page", "col", before.alias("a"), F.col("y0").alias("b"))
    last = both.groupBy("page", "col").agg(F.greatest(F.lit(top), F.max("y1")).alias("a")).withColumn("b", F.lit(bottom))
    return inner.unionByName(last).where(F.col("b") - F.col("a") >= least).select("page", "col", F.col("a").cast("double").alias("y0"), F.col("b").cast("double").alias("y1"))


def two_columns(lines: DataFrame, spans: DataFrame, width: float, gutter: float, wide: float = 0.49, band: float = 10.0) -> DataFrame:
    """page, two_col: more than four lines, and hardly any wide line whose text crosses the gutter.

    lines: page, line, x0, x1; spans: page, line, x0, x1."""
    crossing = spans.where((F.col("x0") < gutter + band) & (F.col("x1") > gutter - band)).select("page", "line").distinct().withColumn("__c", F.lit(1))
    rows = lines.join(crossing, ["page", "line"], "left")
    n = rows.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.count_if((F.col("x1") - F.col("x0") >= width * wide) & F.col("__c").isNotNull()).alias("full"))
    return n.select("page", ((F.col("n") > 4) & (F.col("full") <= F.greatest(F.lit(2.0), F.lit(0.05) * F.col("n")))).alias("two_col"))


def line_columns(lines: DataFrame, pages: DataFrame, width: float, gutter: float, wide: float = 0.49) -> DataFrame:
    """lines with col: -1 for centred narrow lines across the gutter of a two-column page, else by their middle; 0 on others."""
    across = (F.col("x0") < gutter) & (F.col("x1") > gutter) & (F.col("x1") - F.col("x0") < width * wide)
    side = F.when((F.col("x0") + F.col("x1")) / 2 < gutter, 0).otherwise(1)
    return lines.join(pages, "page").withColumn("col", F.when(~F.col("two_col"), 0).when(across, -1).otherwise(side))


def _by_page(boxes: DataFrame, order: list[str], fields: list[str], fold, schema: dict[str, pa.DataType], ddl: str) -> DataFrame:
    """fold(page, rows) → output rows, over each page's boxes in order.

    Pages are gathered by the JVM and folded many to a batch: a Python call per page costs far more than its boxes."""
    cells = F.array_sort(F.collect_list(F.struct(*order, *fields)))
    pages = boxes.groupBy("page").agg(cells.alias("rows"))

    def run(batches):
        for batch in batches:
            out = [row for page, rows in zip(batch.column("page").to_pylist(), batch.column("rows").to_pylist(), strict=True) for row in fold(page, rows)]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.values(), strict=True)], names=list(schema))

    return pages.mapInArrow(run, ddl)


_BOX = {"x0": pa.float64(), "y0": pa.float64(), "x1": pa.float64(), "y1": pa.float64()}


def _share(a, b) -> float:
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    small = min(max(0.0, a[2] - a[0]) * max(0.0, a[3] - a[1]), max(0.0, b[2] - b[0]) * max(0.0, b[3] - b[1]))
    return max(0.0, w) * max(0.0, h) / small if small else 0.0


def _loser(p: dict, q: dict, ratio: float) -> set[str]:
    """Which of an earlier box p and a later box q goes: 'p', 'q', both or none."""
    kinds = {p["label"], q["label"]}
    if "inline_formula" in kinds and ratio > 0.5:
        return {name for name, box in (("p", p), ("q", q)) if box["label"] == "inline_formula"}
    if ratio <= 0.7:
        return set()
    if len(kinds) == 2 and kinds & set(HARD):
        if "table" in kinds and not kinds <= set(HARD):
            return {"q"} if p["label"] == "table" else {"p"}
        return set()
    return {"q"} if p["area"] >= q["area"] else {"p"}


def suppress(boxes: DataFrame, least_side: float = 6.0) -> DataFrame:
    """Boxes that survive: tables win over text whatever their size, formulas yield, else the larger box stays.

    A drop changes what later pairs see, so each page is folded in order of i; a page's boxes are a small group."""

    def fold(page, rows):
        for r in rows:
            r["box"] = (r["x0"], r["y0"], r["x1"], r["y1"])
            r["area"] = max(0.0, r["x1"] - r["x0"]) * max(0.0, r["y1"] - r["y0"])
        gone: set[int] = set()
        for a, p in enumerate(rows):
            if min(p["x1"] - p["x0"], p["y1"] - p["y0"]) < least_side:
                gone.add(a)
            for b in range(a + 1, len(rows)):
                if a in gone:
                    break
                if b not in gone:
                    lost = _loser(p, rows[b], _share(p["box"], rows[b]["box"]))
                    gone |= ({a} if "p" in lost else set()) | ({b} if "q" in lost else set())
        return [(page, r["i"], r["label"], *r["box"]) for n, r in enumerate(rows) if n not in gone]

    schema = {"page": pa.int64(), "i": pa.int32(), "label": pa.string()} | _BOX
    sides = [F.col(c).cast("double").alias(c) for c in _BOX]
    kept = boxes.where("label <> 'reference'").select(F.col("page").cast("long").alias("page"), F.col("i").cast("int").alias("i"), "label", *sides)
    return _by_page(kept, ["i"], ["label", *_BOX], fold, schema, "page long, i int, label string, x0 double, y0 double, x1 double, y1 double")


def from_views(found: DataFrame, width: float, height: float, least_score: float = 0.3, scale: float = 1.0) -> DataFrame:
    """Table boxes of transformed views in page coordinates: clamped to the page, small ones dropped.

    found: page, view (shift or flip), dx, dy, score, x0, y0, x1, y1. A horizontal flip mirrors x, a vertical one y."""
    x0 = F.when(F.col("view") == "flip_x", width - F.col("x1")).otherwise(F.col("x0") + F.col("dx"))
    x1 = F.when(F.col("view") == "flip_x", width - F.col("x0")).otherwise(F.col("x1") + F.col("dx"))
    y0 = F.when(F.col("view") == "flip_y", height - F.col("y1")).otherwise(F.col("y0") + F.col("dy"))
    y1 = F.when(F.col("view") == "flip_y", height - F.col("y0")).otherwise(F.col("y1") + F.col("dy"))
    clamp = lambda v, top: F.greatest(F.lit(0.0), F.least(F.lit(float(top)), v))
    rows = found.where((F.col("label") == "table") & (F.col("score") >= least_score)).select("page", "i", "score", clamp(x0, width).alias("x0"), clamp(y0, height).alias("y0"), clamp(x1, width).alias("x1"), clamp(y1, height).alias("y1"))
    return rows.where((F.col("x1") - F.col("x0") >= 40 * scale) & (F.col("y1") - F.col("y0") >= 25 * scale))


def merge_views(boxes: DataFrame, extra: DataFrame, width: float, least: float = 0.55) -> DataFrame:
    """page, ord, label, score, box: a page's boxes with table candidates of other views folded in by falling score.

    A candidate that overlaps a table replaces it if larger (never the union) and lifts its score; another one is
    inserted in reading order: left half of the page first, then by height. Folded per page."""
    sides = [F.col(c).cast("double").alias(c) for c in _BOX]
    one = lambda df, part, order, label: df.select(F.col("page").cast("long").alias("page"), F.lit(part).alias("part"), order.cast("double").alias("at"), F.col("i").cast("int").alias("i"), label.alias("label"), F.col("score").cast("double").alias("score"), *sides)
    tagged = one(boxes, 0, F.col("i"), F.col("label")).unionByName(one(extra, 1, -F.col("score"), F.lit("table")))

    def place(box) -> tuple:
        return (0 if (box[0] + box[2]) / 2 < width / 2 else 1, box[1])

    def fold(page, rows):
        own: list[list] = []
        for r in rows:
            box = (r["x0"], r["y0"], r["x1"], r["y1"])
            if r["part"] == 0:
                own.append([r["label"], r["score"], box])
                continue
            size = lambda b: (b[2] - b[0]) * (b[3] - b[1])
            same = next((o for o in own if o[0] == "table" and _share(box, o[2]) > least), None)
            if same:
                same[1], same[2] = max(same[1], r["score"]), box if size(box) > size(same[2]) else same[2]
            else:
                at = next((n for n, o in enumerate(own) if place(o[2]) > place(box)), len(own))
                own.insert(at, ["table", r["score"], box])
        return [(page, n, o[0], o[1], *o[2]) for n, o in enumerate(own)]

    schema = {"page": pa.int64(), "ord": pa.int32(), "label": pa.string(), "score": pa.float64()} | _BOX
    return _by_page(tagged, ["part", "at", "i"], ["label", "score", *_BOX], fold, schema, "page long, ord int, label string, score double, x0 double, y0 double, x1 double, y1 double")


def reading_order(items: DataFrame) -> DataFrame:
    """items (page, i, col, y0) with rank: by column (-1: over both, 0, 1), then from the top; ties in order of i."""
    return items.withColumn("rank", F.row_number().over(Window.partitionBy("page").orderBy("col", "y0", "i")).cast("long"))


def page_range(pages: DataFrame, first: int, last: int) -> DataFrame:
    """The pages from first up to but not with last."""
    return pages.where((F.col("page") >= first) & (F.col("page") < last))


def text_lines(spans: DataFrame, width: float, gutter: float, wide: float = 0.49, band: float = 10.0) -> DataFrame:
    """page, block, line, col, x0, y0, x1, y1, text, size (the largest) of the lines that spans make up.

    spans: page, block, line, text, size, x0, y0, x1, y1; blank ones don't count, but in a line's box. On a page of two
    columns a line is split at the gutter by the middles of its spans, unless it is narrow and stands across: col -1."""
    box = lambda: [F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1")]
    key = ["page", "block", "line"]
    full = spans.where(T.strip(F.col("text")) != "")
    lines = spans.groupBy(*key).agg(*box(), F.count_if(T.strip(F.col("text")) != "").alias("__n")).where("__n > 0").drop("__n")
    named = lambda df: df.withColumn("line", F.struct("block", "line"))
    pages = two_columns(named(lines), named(full), width, gutter, wide, band)
    across = (F.col("l0") < gutter) & (F.col("l1") > gutter) & (F.col("l1") - F.col("l0") < width * wide)
    side = F.when((F.col("x0") + F.col("x1")) / 2 < gutter, 0).otherwise(1)
    placed = full.join(lines.select(*key, F.col("x0").alias("l0"), F.col("x1").alias("l1"), F.col("y0").alias("m0"), F.col("y1").alias("m1")), key).join(pages, "page")
    placed = placed.withColumn("col", F.when(~F.col("two_col"), 0).when(across, -1).otherwise(side))
    split = F.col("two_col") & (F.col("col") >= 0)
    sides = {"x0": ("l0", F.min), "y0": ("m0", F.min), "x1": ("l1", F.max), "y1": ("m1", F.max)}
    return placed.groupBy(*key, "col").agg(
        *[f(F.when(split, F.col(c)).otherwise(F.col(own))).alias(c) for c, (own, f) in sides.items()], T.joined_spans(F.collect_list(F.struct("x0", "text"))).alias("text"), F.max("size").alias("size")
    )
