"""Queries over reports, run summaries, probes and assembled text lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import costs, exports, geometry, structure
from ..streaming import lifecycle
from .views import view

RUNS: dict = {}


def query(sql: str | None):
    def add(f):
        RUNS[f.__name__] = (f, sql)
        return f

    return add


@query('SELECT user_id AS run, count(*)::BIGINT AS pages, round(max("at") - min("at"), 1) AS seconds, round(count(*) / greatest(max("at") - min("at"), 1e-6), 3) AS pages_per_sec FROM (SELECT user_id, floor(epoch_us(ts) / 1e6) AS "at" FROM events) e GROUP BY user_id')
def run_summary(spark, sf_dir):
    done = view(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).cast("double").alias("at"))
    return lifecycle.summary(done)


_STATUS = "CASE event_id % 7 WHEN 0 THEN 'running' WHEN 1 THEN 'exited' WHEN 2 THEN 'offline' ELSE 'loading' END"


@query(f"""
WITH s AS (SELECT instance, "at", CASE {_STATUS} WHEN 'running' THEN 'up' WHEN 'loading' THEN NULL ELSE 'dead' END AS o FROM v_heartbeats),
w AS (SELECT *, min("at") OVER (PARTITION BY instance) AS since FROM s), d AS (SELECT *, row_number() OVER (PARTITION BY instance ORDER BY o IS NULL, "at", o) AS n FROM w)
SELECT instance, CASE WHEN o IS NOT NULL AND "at" - since < 864e2 THEN o ELSE 'late' END AS outcome, CASE WHEN o IS NOT NULL AND "at" - since < 864e2 THEN "at" ELSE since + 864e2 END AS "at" FROM d WHERE n = 1""")
def first_statuses(spark, sf_dir):
    return lifecycle.outcomes(view(spark, sf_dir, "v_heartbeats").withColumn("status", F.expr(_STATUS)), 86400.0)


@query("""
WITH r AS (SELECT instance, min("at") AS started, CASE WHEN instance % 4 = 0 THEN 864e2 ELSE least(60 / (1 + instance % 3) * 3600.0, 864e2) END AS limit_s FROM v_heartbeats GROUP BY instance)
SELECT h.instance, h."at" FROM v_heartbeats h JOIN r USING (instance) WHERE h."at" >= started + limit_s""")
def budget_overdue(spark, sf_dir):
    beats = view(spark, sf_dir, "v_heartbeats").select("instance", "at")
    runs = beats.groupBy("instance").agg(F.min("at").alias("started")).withColumn("dph", F.when(F.col("instance") % 4 == 0, 0.0).otherwise((1 + F.col("instance") % 3).cast("double")))
    return lifecycle.overdue(beats, costs.budget_limit(runs, 60.0, 1440.0))


@query("SELECT p_partkey AS id, concat_ws('  ', p_partkey, CASE WHEN p_partkey % 3 = 0 THEN '-' ELSE 'running' END, p_name, format('${:.3f}/h', CASE WHEN p_partkey % 5 = 0 THEN 0.0 ELSE (p_partkey % 2000) / 1e3 END), p_size, p_brand) AS line FROM part")
def instance_listing(spark, sf_dir):
    part = view(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 3 != 0, "running").alias("status"), F.col("p_name").alias("label"), F.when(F.col("p_partkey") % 5 != 0, F.col("p_partkey") % 2000 / 1e3).alias("dph"),
        F.col("p_size").alias("machine_id"), F.col("p_brand").alias("gpu_name"),
    )
    return exports.listing(part)


@query("SELECT event_id, CASE WHEN event_id % 6 = 0 THEN 0 ELSE (12 * 1048576 * 6 * 8000::BIGINT) // (event_id % 900 * 10000000 + 1) END::BIGINT AS mbit_s, CASE event_id % 3 WHEN 0 THEN 0.0 WHEN 1 THEN 0.0 ELSE event_id % 900 END::DOUBLE AS printed FROM events")
def range_probes(spark, sf_dir):
    n = F.col("event_id")
    out = F.when(n % 3 == 0, "curl: (28)").when(n % 3 == 1, "").otherwise(F.concat(F.lit("noise\n"), (n % 900).cast("string"), F.lit("\n")))
    return view(spark, sf_dir, "events").select(n, exports.ranges_speed(F.when(n % 6 != 0, F.lit(1)), n % 900 * 10000000 + 2).alias("mbit_s"), exports.parsed_speed(out).alias("printed"))


@query("SELECT id, dph_total FROM v_offers WHERE machine_id = 7 AND num_gpus = 1 AND rentable AND dph_total < 0.25")
def market_scan(spark, sf_dir):
    return costs.market(view(spark, sf_dir, "v_offers"), costs.Host("Brand#13", 1, max_dph=0.25, machine_id=7)).select("id", "dph_total")


_TEXT_SPANS = "SELECT page, i // 3 AS block, i // 2 AS line, CASE WHEN i % 5 = 0 THEN ' ' ELSE concat(label, i) END AS text, score AS size, x0, y0, x1, y1 FROM v_boxes"


@query(f"""
WITH s AS ({_TEXT_SPANS}), f AS (SELECT * FROM s WHERE text <> ' '),
l AS (SELECT page, block, line, min(x0) AS l0, min(y0) AS m0, max(x1) AS l1, max(y1) AS m1 FROM s GROUP BY ALL HAVING count(*) FILTER (text <> ' ') > 0),
c AS (SELECT page, count(*) > 4 AND count(*) FILTER (l1 - l0 >= 600 * 0.49 AND EXISTS (SELECT 1 FROM f WHERE f.page = l.page AND f.block = l.block AND f.line = l.line AND x0 < 310 AND x1 > 290)) <= greatest(2, 0.05 * count(*)) AS two FROM l GROUP BY page),
p AS (SELECT f.*, l0, m0, l1, m1, CASE WHEN NOT two THEN 0 WHEN l0 < 300 AND l1 > 300 AND l1 - l0 < 600 * 0.49 THEN -1 WHEN (x0 + x1) / 2 < 300 THEN 0 ELSE 1 END::INT AS col, two FROM f JOIN l USING (page, block, line) JOIN c USING (page))
SELECT page, block, line, col, CASE WHEN two AND col >= 0 THEN min(x0) ELSE min(l0) END AS x0, CASE WHEN two AND col >= 0 THEN min(y0) ELSE min(m0) END AS y0, CASE WHEN two AND col >= 0 THEN max(x1) ELSE max(l1) END AS x1,
 CASE WHEN two AND col >= 0 THEN max(y1) ELSE max(m1) END AS y1, string_agg(text, ' ' ORDER BY x0, text) AS text, max(size) AS size FROM p GROUP BY page, block, line, col, two""")
def text_lines(spark, sf_dir):
    view(spark, sf_dir, "v_boxes")
    return geometry.text_lines(spark.sql(_TEXT_SPANS.replace("i // 3", "CAST(i DIV 3 AS INT)").replace("i // 2", "CAST(i DIV 2 AS INT)")), 600.0, 300.0)


_SPREAD = "CASE WHEN {n} % 8 = 3 THEN concat('<table><tr><td>', {t}) WHEN {n} % 8 = 6 THEN concat({t}, '</td></tr></table> end of it') WHEN {n} % 8 = 4 THEN concat('## 3.1 ', {t}) WHEN {n} % 8 = 7 THEN concat('# Fig. 2.', {n}, ' ', {t}) ELSE {t} END"


@query("WITH l AS (SELECT doc_id, {n} AS n, {spread} AS t FROM documents {lines}), w AS (SELECT doc_id, string_agg(t, chr(10) ORDER BY n) AS t FROM l GROUP BY doc_id), b AS (SELECT doc_id, t, regexp_replace(t, '(?is)<table\\b.*?</table>', '', 'g') AS b FROM w)\n"
       "SELECT doc_id AS book, len(list_filter(regexp_split_to_array(regexp_replace(b, '<[^>]+>', ' ', 'g'), '\\s+'), lambda x: x <> ''))::BIGINT AS words, len(regexp_extract_all(t, '(?is)<table\\b.*?</table>'))::BIGINT AS tables, len(list_distinct(regexp_extract_all(b, 'Fig\\.\\s*\\d+\\.\\d+[a-z]?')))::BIGINT AS figures, len(regexp_extract_all(b, '(?m)^#{{1,6}} +[^ \\n]'))::BIGINT AS headings FROM b"
       .format(n="line0 + 1", spread=_SPREAD.format(n="(line0 + 1)", t="line"), lines=", LATERAL (SELECT unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line0) l"))
def spread_tables(spark, sf_dir):
    """Measures of documents with tables over several lines, headings within them."""
    return structure.measures(_spread(spark, sf_dir)).select("book", "words", "tables", "figures", "headings")


def _spread(spark, sf_dir):
    lines = structure.lines_of(view(spark, sf_dir, "documents").select(F.col("doc_id").alias("book"), "text"))
    return lines.select("book", "line", F.expr(_SPREAD.format(n="line", t="text")).alias("text"))


@query(None)
def volume_report(spark, sf_dir):
    """The report of every document as a volume; tests hold its text to a plain case."""
    raw = structure.lines_of(view(spark, sf_dir, "documents").select(F.col("doc_id").alias("book"), "text"))
    lines = _spread(spark, sf_dir)
    cover = lines.groupBy("book").agg(F.count(F.lit(1)).alias("total")).select("book", F.lit("text").alias("label"), F.col("total").alias("found"), "total")
    return exports.report(structure.measures(raw), structure.measures(lines), cover, structure.chapter_map(lines), structure.table_queue(lines))
