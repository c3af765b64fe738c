"""Queries over rendering, paragraphs, rasters and schedules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import geometry, raster, rendering
from .views import view

RUNS: dict = {}


def query(sql: str | None):
    def add(f):
        RUNS[f.__name__] = (f, sql)
        return f

    return add


_ITEMS = """i AS (SELECT conv_id AS book, turn AS pos, CASE turn % 5 WHEN 0 THEN 'chapter' WHEN 1 THEN CASE WHEN conv_id % 3 = 0 THEN 'page' ELSE 'head' END WHEN 2 THEN 'head' WHEN 3 THEN 'sec' ELSE 'body' END AS kind,
 (turn + 1)::VARCHAR AS num, substr(text, 1, 10) AS text, turn AS page, CASE WHEN turn % 2 = 0 THEN turn END AS printed FROM conversations)"""


@query(f"""
WITH {_ITEMS}, l AS (SELECT *, lag(kind) OVER w AS k1, lag(kind, 2) OVER w AS k2, lead(kind) OVER w AS n1, lead(kind, 2) OVER w AS n2, lead(text) OVER w AS t1, lead(text, 2) OVER w AS t2 FROM i WINDOW w AS (PARTITION BY book ORDER BY pos)),
t AS (SELECT *, CASE WHEN num::INT % 2 = 0 THEN 'Known ' || num END AS title, CASE WHEN n1 = 'head' THEN t1 WHEN n1 = 'page' AND n2 = 'head' THEN t2 END AS below FROM l)
SELECT book, pos, chr(10) || CASE kind WHEN 'page' THEN '<!-- pdf page ' || page || CASE WHEN printed IS NOT NULL THEN ' | printed page ' || printed ELSE '' END || ' -->'
 WHEN 'chapter' THEN '## Chapter ' || num || ' — ' || coalesce(title, text) || CASE WHEN title IS NULL AND below IS NOT NULL THEN ' — ' || below ELSE '' END WHEN 'head' THEN '### ' || text WHEN 'sec' THEN '### Sec. ' || num || ' ' || text ELSE text END AS line
FROM t WHERE NOT (kind = 'head' AND coalesce(k1 = 'chapter' OR (k1 = 'page' AND k2 = 'chapter'), false))""")
def render_items(spark, sf_dir):
    c = view(spark, sf_dir, "conversations")
    kind = F.when(F.col("turn") % 5 == 0, "chapter").when(F.col("turn") % 5 == 1, F.when(F.col("conv_id") % 3 == 0, "page").otherwise("head")).when(F.col("turn") % 5 == 2, "head").when(F.col("turn") % 5 == 3, "sec").otherwise("body")
    items = c.select(F.col("conv_id").alias("book"), F.col("turn").alias("pos"), kind.alias("kind"), (F.col("turn") + 1).cast("string").alias("num"), F.substring("text", 1, 10).alias("text"), F.col("turn").alias("page"), F.when(F.col("turn") % 2 == 0, F.col("turn")).alias("printed"), F.lit("p").alias("path"))
    titles = spark.range(0, 400, 2).select(F.col("id").alias("num"), F.concat(F.lit("Known "), F.col("id").cast("string")).alias("title"))
    return rendering.render(items, titles)


@query("""SELECT doc_id AS id, n::INT AS n, n % 2 = 1 AS is_table, CASE n WHEN 0 THEN substr(text, 1, 20) WHEN 1 THEN '<table><tr>x</tr></table>' WHEN 2 THEN ' mid ' WHEN 3 THEN '<TABLE a=1>' || chr(10) || '</TABLE>' ELSE '' END AS text FROM documents, range(5) r(n)""")
def protected_tables(spark, sf_dir):
    text = F.concat(F.substring("text", 1, 20), F.lit("<table><tr>x</tr></table> mid <TABLE a=1>\n</TABLE>"))
    return rendering.segments(view(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), text.alias("text")))


@query("""
WITH t AS (SELECT doc_id, replace(text, chr(10), chr(10) || ' ' || chr(10)) AS text FROM documents), s AS (SELECT doc_id, regexp_split_to_array(text, '\\n\\s*\\n') AS p FROM t)
SELECT doc_id AS id, i::INT AS n, p[i + 1] AS text, CASE WHEN i + 1 < len(p) THEN chr(10) || ' ' || chr(10) ELSE '' END AS sep FROM (SELECT doc_id, p, unnest(range(len(p))) AS i FROM s) x""")
def paragraphs(spark, sf_dir):
    return rendering.paragraphs(view(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.replace("text", F.lit("\n"), F.lit("\n \n")).alias("text")))


@query("SELECT DISTINCT conv_id AS book, (turn + 1)::INT AS num FROM conversations WHERE turn % 4 < 2")
def chapter_blocks(spark, sf_dir):
    c, n = view(spark, sf_dir, "conversations"), (F.col("turn") + 1).cast("string")
    text = F.when(F.col("turn") % 4 == 0, F.concat(F.lit(" KAPITEL "), n, F.lit(". "))).when(F.col("turn") % 4 == 1, F.concat(F.lit("Глава "), n, F.lit(". "), "text")).otherwise(F.concat(F.lit("The chapter "), n))
    return rendering.chapter_blocks(c.select(F.col("conv_id").alias("book"), F.lit("header").alias("label"), F.regexp_replace(text, "\n", " ").alias("text")))


@query("SELECT event_id, [1e-1, 1e-1, 2e-1, 3e-1, 5e-1, 8e-1, 9e-1, 1e0][least(event_id % 12, 7) + 1] AS temperature, least(pow(2e0, event_id % 12), 3e1) AS wait_s FROM events")
def retry_schedule(spark, sf_dir):
    heat, wait = rendering.retry_schedule(F.col("event_id") % 12)
    return view(spark, sf_dir, "events").select("event_id", heat.alias("temperature"), wait.alias("wait_s"))


@query("SELECT event_id, greatest(1e0, coalesce(TRY_CAST(CASE event_id % 4 WHEN 0 THEN 'two' WHEN 1 THEN '1.0' WHEN 2 THEN '4' ELSE '3' END AS DOUBLE), 0) / 2) AS scale FROM events")
def render_scale(spark, sf_dir):
    s = F.element_at(F.array(*map(F.lit, ["two", "1.0", "4", "3"])), (F.col("event_id") % 4 + 1).cast("int"))
    return view(spark, sf_dir, "events").select("event_id", raster.render_scale(s).alias("scale"))


@query("SELECT vec_id, len(list_filter(embedding, lambda x: floor(abs(x) * 2550) > 235)) / greatest(1, len(embedding)) AS blankness FROM embeddings")
def blank_share(spark, sf_dir):
    # in single precision like the vectors: a product in double falls short of a whole number that it reaches here
    samples = F.transform("embedding", lambda x: F.floor(F.abs(x) * F.lit(2550).cast("float")))
    return view(spark, sf_dir, "embeddings").select("vec_id", raster.blankness(samples).alias("blankness"))


@query(None)
def tabular_crops(spark, sf_dir):
    """Crops drawn from boxes: three lines of text, in columns for even pages; tests hold the decision to cases.

    A crop's pixels depend on whether its page is even, so both drawings are constants, a byte a pixel."""
    drawn = lambda ink: F.lit(bytes(0 if y % 12 < 8 and ink(x) else 255 for y in range(36) for x in range(120)))
    pixels = F.when(F.col("page") % 2 == 0, drawn(lambda x: x % 40 < 20)).otherwise(drawn(lambda x: x % 7 < 6))
    boxes = view(spark, sf_dir, "v_boxes")
    return raster.tabular_crops(boxes.select("page", "i", F.lit("text").alias("label"), pixels.alias("raster"), F.lit(120).alias("width")))


@query("""
WITH l AS (SELECT page, (i % 2)::INT AS col, y0, y1 FROM v_boxes), c AS (SELECT page, col, greatest(30e0, coalesce(max(y1) OVER (PARTITION BY page, col ORDER BY y0, y1 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 30e0)) AS a, y0 AS b FROM l UNION ALL SELECT page, col, greatest(30e0, max(y1)), 800e0 FROM l GROUP BY page, col)
SELECT page, col, CASE col WHEN 0 THEN 42e0 ELSE 252e0 END AS x0, a + 1 AS y0, CASE col WHEN 0 THEN 248e0 ELSE 470e0 END AS x1, b - 1 AS y1 FROM c WHERE b - a >= 57""")
def figure_bands(spark, sf_dir):
    lines = view(spark, sf_dir, "v_boxes").select("page", (F.col("i") % 2).cast("int").alias("col"), "y0", "y1")
    return raster.figure_bands(geometry.vertical_gaps(lines, 30.0, 800.0), {0: (42.0, 248.0), 1: (252.0, 470.0)})


@query("SELECT doc_id, concat('# ', lang, chr(10), CASE WHEN doc_id % 3 = 0 THEN '' ELSE chr(10) || '*' || source || '*' || chr(10) END, chr(10), '> note', chr(10)) AS head FROM documents")
def book_front(spark, sf_dir):
    head = rendering.front(F.concat(F.lit(" "), "lang"), F.when(F.col("doc_id") % 3 == 0, None).otherwise(F.col("source")), "note")
    return view(spark, sf_dir, "documents").select("doc_id", head.alias("head"))


@query(None)
def entity_text(spark, sf_dir):
    """Tag-free text with entities decoded, of every document: SQL has no table of entities, so tests hold it to a loop."""
    docs = view(spark, sf_dir, "documents")
    marked = F.concat(F.lit("<p a='1'>&lt;"), "text", F.lit("&gt; &amp;amp; &frac12; &quot;x&#34; &nbsp;&#xe9;</p>"))
    return docs.select("doc_id", F.md5(T.decoded(T.untag(marked))).alias("text"))
