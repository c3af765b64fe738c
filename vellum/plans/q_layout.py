"""Queries over layout boxes, text-layer lines and uncertain places."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import confidence, geometry
from .views import view

RUNS: dict = {}


def query(sql: str | None):
    def add(f):
        RUNS[f.__name__] = (f, sql)
        return f

    return add


_AREA = "greatest(0e0, {p}.x1 - {p}.x0) * greatest(0e0, {p}.y1 - {p}.y0)"
_SHARED = "greatest(0e0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0e0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"


@query(f"SELECT a.page, a.i, b.i AS j, round({_SHARED} / least({_AREA.format(p='a')}, {_AREA.format(p='b')}), 6) AS ratio FROM v_boxes a JOIN v_boxes b ON a.page = b.page AND a.i < b.i WHERE {_SHARED} > 0")
def box_overlap(spark, sf_dir):
    return geometry.box_pairs(view(spark, sf_dir, "v_boxes")).withColumn("ratio", F.round("ratio", 6))


@query(f"""
WITH c AS (SELECT page, i, label, x0 + 3 AS x0, x1 + 3 AS x1, y0 - 2 AS y0, y1 - 2 AS y1 FROM v_boxes)
SELECT a.page, a.i, b.i AS j, round({_SHARED} / ({_AREA.format(p='a')} + {_AREA.format(p='b')} - {_SHARED}), 6) AS iou FROM v_boxes a JOIN c b ON a.page = b.page AND a.label = b.label
WHERE {_SHARED} > 0 AND {_SHARED} / ({_AREA.format(p='a')} + {_AREA.format(p='b')} - {_SHARED}) >= 5e-1""")
def detector_match(spark, sf_dir):
    boxes = view(spark, sf_dir, "v_boxes")
    moved = boxes.select("page", "i", "label", (F.col("x0") + 3).alias("x0"), (F.col("x1") + 3).alias("x1"), (F.col("y0") - 2).alias("y0"), (F.col("y1") - 2).alias("y1"))
    return geometry.matched_boxes(boxes, moved).withColumn("iou", F.round("iou", 6))


@query("SELECT page, i FROM v_boxes WHERE score >= CASE WHEN label = 'table' THEN 5e-2 ELSE 3e-1 END")
def detector_threshold(spark, sf_dir):
    return geometry.above_threshold(view(spark, sf_dir, "v_boxes"), 0.3, {"table": 0.05}).select("page", "i")


_GUTTER = """
t AS (SELECT * FROM v_boxes WHERE label NOT IN ('table', 'number', 'header', 'footer', 'header_image', 'footer_image')),
g AS (SELECT *, lag(x0) OVER (PARTITION BY page ORDER BY x0, i) AS b FROM t),
r AS (SELECT *, count(*) OVER (PARTITION BY page) AS n, row_number() OVER (PARTITION BY page ORDER BY x0 - b DESC NULLS LAST, x0, i) AS r FROM g),
cut AS (SELECT page, (b + x0) / 2 AS place FROM r WHERE r = 1 AND n >= 4 AND x0 - b > 0 AND x0 - b >= 760 * 15e-2),
s AS (SELECT page, count(*) FILTER (x0 < place) AS l, count(*) FILTER (x0 >= place) AS rr, max(x1) FILTER (x0 < place) AS el, min(x0) FILTER (x0 >= place) AS er FROM t JOIN cut USING (page) GROUP BY page),
gut AS (SELECT page, floor((el + er) / 2)::BIGINT AS gutter FROM s WHERE l >= 2 AND rr >= 2 AND er - el >= 6)"""


@query(f"WITH {_GUTTER} SELECT page, gutter FROM gut")
def column_gutter(spark, sf_dir):
    return geometry.column_gutter(view(spark, sf_dir, "v_boxes"), 760.0)


@query(f"""WITH {_GUTTER}, w AS (SELECT v.*, gutter, coalesce(label = 'table' AND x0 < gutter - 12 AND x1 > gutter + 12 AND gutter - x0 > 20 AND x1 - gutter > 20, false) AS cut FROM v_boxes v LEFT JOIN gut USING (page))
SELECT page, i, 0 AS part, x0, x1 FROM w WHERE NOT cut UNION ALL SELECT page, i, 1, x0, gutter - 4e0 FROM w WHERE cut UNION ALL SELECT page, i, 2, gutter + 4e0, x1 FROM w WHERE cut""")
def gutter_split(spark, sf_dir):
    boxes = view(spark, sf_dir, "v_boxes")
    return geometry.gutter_split(boxes, geometry.column_gutter(boxes, 760.0), min_half=20.0).select("page", "i", "part", "x0", "x1")


@query("""
WITH l AS (SELECT page, unnest(CASE WHEN i % 5 = 4 THEN [0, 1] ELSE [i % 2] END)::INT AS col, y0, y1 FROM v_boxes),
c AS (SELECT page, col, greatest(30e0, max(y1) OVER (PARTITION BY page, col ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS a, y0 AS b FROM l UNION ALL SELECT page, col, greatest(30e0, max(y1)), 800e0 FROM l GROUP BY page, col)
SELECT page, col, coalesce(a, 30e0) AS y0, b AS y1 FROM c WHERE b - coalesce(a, 30e0) >= 55""")
def vertical_gaps(spark, sf_dir):
    col = F.when(F.col("i") % 5 == 4, -1).otherwise(F.col("i") % 2).cast("int")
    return geometry.vertical_gaps(view(spark, sf_dir, "v_boxes").select("page", col.alias("col"), "y0", "y1"), 30.0, 800.0)


@query("""
WITH n AS (SELECT page, count(*) AS n, count(*) FILTER (x1 - x0 >= 500 * 49e-2 AND x0 < 260 AND x1 > 240) AS f FROM v_boxes GROUP BY page)
SELECT page, n > 4 AND f <= greatest(2e0, 5e-2 * n) AS two_col FROM n""")
def two_column(spark, sf_dir):
    lines = view(spark, sf_dir, "v_boxes").select("page", F.col("i").alias("line"), "x0", "x1")
    return geometry.two_columns(lines, lines, 500.0, 250.0)


@query("""
WITH n AS (SELECT page, count(*) AS n, count(*) FILTER (x1 - x0 >= 500 * 49e-2 AND x0 < 260 AND x1 > 240) AS f FROM v_boxes GROUP BY page), t AS (SELECT page, n > 4 AND f <= greatest(2e0, 5e-2 * n) AS two FROM n)
SELECT page, i AS line, CASE WHEN NOT two THEN 0 WHEN x0 < 250 AND x1 > 250 AND x1 - x0 < 500 * 49e-2 THEN -1 WHEN (x0 + x1) / 2 < 250 THEN 0 ELSE 1 END AS col FROM v_boxes JOIN t USING (page)""")
def line_columns(spark, sf_dir):
    lines = view(spark, sf_dir, "v_boxes").select("page", F.col("i").alias("line"), "x0", "x1")
    return geometry.line_columns(lines, geometry.two_columns(lines, lines, 500.0, 250.0), 500.0, 250.0).select("page", "line", "col")


@query(None)
def box_suppression(spark, sf_dir):
    """An order-dependent fold per page; tests hold it to a plain loop."""
    return geometry.suppress(view(spark, sf_dir, "v_boxes"))


@query(None)
def multiview_merge(spark, sf_dir):
    """An order-dependent fold per page; tests hold it to a plain loop."""
    boxes = view(spark, sf_dir, "v_boxes")
    seen = boxes.where("i % 3 = 0").withColumn("label", F.lit("table")).withColumn("view", F.when(F.col("i") % 2 == 0, "flip_x").otherwise("cut")).withColumn("dx", F.lit(5.0)).withColumn("dy", F.lit(7.0))
    return geometry.merge_views(boxes, geometry.from_views(seen, 800.0, 900.0, 0.3), 800.0)


_SPANS = """
w AS (SELECT response_id, tok_no, token, logprob, sum(length(token)) OVER (PARTITION BY response_id ORDER BY tok_no)::BIGINT AS b FROM v_tokens),
s AS (SELECT response_id, b - length(token) AS a, b, round(logprob, 2) AS lp FROM w WHERE logprob < -1e0)"""
_ANSWERS = "r AS (SELECT response_id, string_agg(token, '' ORDER BY tok_no) AS response FROM v_tokens GROUP BY response_id)"


def _weak(spark, sf_dir):
    tokens = view(spark, sf_dir, "v_tokens")
    return confidence.responses(tokens), confidence.weak_spans(tokens)


@query(f'WITH {_SPANS} SELECT response_id, a AS start, b AS "end", lp FROM s')
def weak_spans(spark, sf_dir):
    return _weak(spark, sf_dir)[1]


@query(f"""WITH {_SPANS}, o AS (SELECT *, max(b) OVER (PARTITION BY response_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM s),
g AS (SELECT *, sum(CASE WHEN a <= m THEN 0 ELSE 1 END) OVER (PARTITION BY response_id ORDER BY a, b) AS g FROM o) SELECT response_id, min(a)::BIGINT AS start, max(b)::BIGINT AS "end" FROM g GROUP BY response_id, g""")
def merged_spans(spark, sf_dir):
    return confidence.merged(_weak(spark, sf_dir)[1], ["response_id"])


@query(f"""WITH {_SPANS}, {_ANSWERS}, c AS (SELECT DISTINCT cell FROM (SELECT regexp_replace(substr(text, (1 + doc_id % 7)::INT, 8), '^\\s+|\\s+$', '', 'g') AS cell FROM documents) d WHERE length(cell) >= 4),
p AS (SELECT cell, response_id, response, unnest(range(1, length(response) - length(cell) + 2)) AS i FROM c JOIN r ON contains(response, cell)),
hit AS (SELECT DISTINCT cell FROM p JOIN s USING (response_id) WHERE substr(response, i, length(cell)) = cell AND a < i - 1 + length(cell) AND b > i - 1)
SELECT cell, cell IN (SELECT cell FROM hit) AS suspicious FROM c""")
def mark_cells(spark, sf_dir):
    docs = view(spark, sf_dir, "documents")
    cells = docs.select(F.col("text").substr((F.col("doc_id") % 7 + 1).cast("int"), F.lit(8)).alias("text"))
    return confidence.suspicious_cells(cells, *_weak(spark, sf_dir))


@query(f"""WITH {_SPANS}, {_ANSWERS}, b AS (SELECT response_id, response, 4 AS base FROM r WHERE length(response) >= 24 AND response_id % 15 NOT IN (5, 10)),
e AS (SELECT DISTINCT response_id, base + a AS a, base + b AS b FROM b JOIN s USING (response_id) WHERE s.b - a >= 3),
o AS (SELECT *, max(b) OVER (PARTITION BY response_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM e),
g AS (SELECT *, sum(CASE WHEN a <= m THEN 0 ELSE 1 END) OVER (PARTITION BY response_id ORDER BY a, b) AS g FROM o), k AS (SELECT response_id, count(DISTINCT g) AS n FROM g GROUP BY response_id)
SELECT r.response_id AS page, coalesce(n, 0)::BIGINT AS n_marks, ((CASE response_id % 15 WHEN 5 THEN 2 * length(response) + 8 WHEN 10 THEN length(response) + 32 ELSE length(response) + 8 END) + coalesce(n, 0) * 39)::BIGINT AS n_chars FROM r LEFT JOIN k USING (response_id)""")
def mark_prose(spark, sf_dir):
    answers, spans = _weak(spark, sf_dir)
    kind = F.col("response_id") % 15
    text = F.concat(F.lit("In: "), F.when(kind == 10, F.concat(F.lit("<table><tr>"), "response", F.lit("</tr></table>"))).otherwise(F.col("response")), F.when(kind == 5, F.col("response")).otherwise(F.lit("")), F.lit(" end"))
    pages = answers.select(F.col("response_id").alias("page"), "response_id", text.alias("text"))
    return confidence.prose_marks(pages, answers, spans).select("page", "n_marks", F.length("text").cast("long").alias("n_chars"))


@query(f"""WITH {_SPANS}, {_ANSWERS}, k AS (SELECT response_id, count(*)::BIGINT AS n_spans, min(lp) AS worst FROM s GROUP BY response_id)
SELECT response_id, n_spans, worst, (SELECT count(*) FROM k)::BIGINT AS n_responses FROM k ORDER BY response_id LIMIT 400""")
def low_confidence(spark, sf_dir):
    return confidence.low_confidence(*_weak(spark, sf_dir)).drop("response")


@query("""
WITH c AS (SELECT user_id AS "case", event_type AS answer, count(*)::BIGINT AS n FROM events GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY "case" ORDER BY n DESC, answer)::INT AS rank FROM c) SELECT * FROM r WHERE rank <= 3""")
def probe_answers(spark, sf_dir):
    return confidence.answer_counts(view(spark, sf_dir, "events").select(F.col("user_id").alias("case"), F.col("event_type").alias("answer")))


@query("SELECT page, i, row_number() OVER (PARTITION BY page ORDER BY i % 3 - 1, y0, i) AS rank FROM v_boxes")
def reading_order(spark, sf_dir):
    items = view(spark, sf_dir, "v_boxes").select("page", "i", (F.col("i") % 3 - 1).alias("col"), "y0")
    return geometry.reading_order(items).select("page", "i", "rank")


@query("SELECT page, count(*) AS n FROM v_boxes WHERE page >= 100 AND page < 1000 GROUP BY page")
def page_range(spark, sf_dir):
    return geometry.page_range(view(spark, sf_dir, "v_boxes"), 100, 1000).groupBy("page").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT response_id AS case, min(logprob) AS worst FROM v_tokens GROUP BY response_id")
def worst_reading(spark, sf_dir):
    return confidence.worst_reading(view(spark, sf_dir, "v_tokens").withColumnRenamed("response_id", "case"))
