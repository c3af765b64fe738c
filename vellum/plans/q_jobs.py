"""Queries over job lifecycles, exports and the remaining text functions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import alignment, exports, structure
from ..streaming import lifecycle
from .views import view

RUNS: dict = {}


def query(sql: str | None):
    def add(f):
        RUNS[f.__name__] = (f, sql)
        return f

    return add


@query('WITH m AS (SELECT max("at") AS now FROM v_heartbeats) SELECT instance, max("at") AS last, (SELECT now FROM m) - max("at") AS silent_s, (SELECT now FROM m) - max("at") > 9e2 AS dead FROM v_heartbeats GROUP BY instance')
def deadman_batch(spark, sf_dir):
    beats = view(spark, sf_dir, "v_heartbeats")
    now = beats.agg(F.max("at")).first()[0]
    return lifecycle.deadman(beats, now)


_SILENCES = 'SELECT instance, "at" AS since, nxt AS until FROM (SELECT instance, "at", lead("at") OVER (PARTITION BY instance ORDER BY "at") AS nxt FROM v_heartbeats) x WHERE nxt - "at" > 864e2'


@query(_SILENCES)
def silences(spark, sf_dir):
    return lifecycle.silences(view(spark, sf_dir, "v_heartbeats"), 86400.0)


def _streamed(spark, df, mode: str = "append"):
    """What a stream has put out once all input is read."""
    name = "s" + uuid.uuid4().hex
    stream = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    stream.awaitTermination()
    return spark.table(name)


def _events(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query(_SILENCES)
def heartbeat_stream(spark, sf_dir):
    """The silences of closed gaps, out of the streaming form; they must be the batch's."""
    beats = _events(spark, sf_dir).select(F.col("user_id").alias("instance"), F.col("ts").cast("timestamp").alias("at"))
    return _streamed(spark, lifecycle.silence_stream(beats, 86400.0)).where("until is not null")


@query("SELECT user_id AS run, count(*)::BIGINT AS pages_done, max(ts) AS last FROM events GROUP BY user_id")
def progress_stream(spark, sf_dir):
    done = _events(spark, sf_dir).select(F.col("user_id").alias("run"), F.col("ts").alias("at"))
    return _streamed(spark, lifecycle.progress_stream(done), "complete")


@query("""
WITH p AS (SELECT user_id AS run, event_id AS page, epoch_us(ts) / 1e6 AS "at" FROM events), r AS (SELECT run, page, row_number() OVER (PARTITION BY run ORDER BY "at", page) AS pages_done, "at" - min("at") OVER (PARTITION BY run) AS seconds FROM p)
SELECT run, page, pages_done, seconds, CASE WHEN seconds > 0 THEN pages_done / seconds END AS pages_per_s FROM r""")
def progress(spark, sf_dir):
    done = view(spark, sf_dir, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("page"), (F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)).alias("at"))
    return lifecycle.progress(done)


_ATTEMPTS = """t AS (SELECT o_custkey AS page, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS attempt, CASE WHEN o_orderkey % 7 = 0 THEN 'net' END AS error, CASE WHEN o_orderkey % 5 = 0 THEN 'length' ELSE 'stop' END AS finish_reason,
 (o_orderkey % 18000)::INT AS total_tokens, o_orderkey % 3 <> 0 AS rotation_valid, (o_orderkey % 4 * 90)::INT AS rotation_wanted, o_orderkey % 1000 AS in_tokens, o_orderkey % 300 AS out_tokens FROM orders)"""


def _attempts(spark, sf_dir):
    from pyspark.sql import Window

    o, k = view(spark, sf_dir, "orders"), F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("page"), F.row_number().over(Window.partitionBy("o_custkey").orderBy(k)).alias("attempt"), F.when(k % 7 == 0, "net").alias("error"), F.when(k % 5 == 0, "length").otherwise("stop").alias("finish_reason"),
        (k % 18000).cast("int").alias("total_tokens"), (k % 3 != 0).alias("rotation_valid"), (k % 4 * 90).cast("int").alias("rotation_wanted"), (k % 1000).alias("in_tokens"), (k % 300).alias("out_tokens"),
    )


@query(f"""WITH {_ATTEMPTS}, g AS (SELECT *, NOT rotation_valid AND rotation_wanted IN (90, 180, 270) AS turn, row_number() OVER (PARTITION BY page ORDER BY attempt) AS n FROM t WHERE attempt <= 4 AND error IS NULL AND finish_reason = 'stop' AND total_tokens <= 16384),
f AS (SELECT p.page, a.attempt AS a, a.turn, a.rotation_wanted AS w, a.in_tokens AS ai, a.out_tokens AS ao, b.attempt AS b, b.in_tokens AS bi, b.out_tokens AS bo FROM (SELECT DISTINCT page FROM t) p LEFT JOIN g a ON a.page = p.page AND a.n = 1 LEFT JOIN g b ON b.page = p.page AND b.n = 2),
d AS (SELECT *, CASE WHEN coalesce(turn, false) THEN b ELSE a END AS done FROM f)
SELECT page, coalesce(done, 4)::BIGINT AS attempts, CASE WHEN coalesce(turn, false) AND done IS NOT NULL THEN w ELSE 0 END AS rotation, done IS NULL AS fallback, coalesce(CASE WHEN coalesce(turn, false) THEN bi ELSE ai END, 0)::BIGINT AS in_tokens, coalesce(CASE WHEN coalesce(turn, false) THEN bo ELSE ao END, 0)::BIGINT AS out_tokens FROM d""")
def retry_outcome(spark, sf_dir):
    return lifecycle.retry_outcome(_attempts(spark, sf_dir))


@query(f"WITH {_ATTEMPTS} SELECT page, attempt, finish_reason = 'stop' AND total_tokens <= 16384 AS valid FROM t")
def response_validity(spark, sf_dir):
    return _attempts(spark, sf_dir).select("page", "attempt", lifecycle.valid_response().alias("valid"))


@query("SELECT DISTINCT page_id AS page FROM pages WHERE page_id NOT IN (SELECT doc_id * 2 FROM documents)")
def pages_to_resume(spark, sf_dir):
    pages = view(spark, sf_dir, "pages").select(F.col("page_id").alias("page"))
    return lifecycle.pending(pages, view(spark, sf_dir, "documents").select((F.col("doc_id") * 2).alias("page")))


@query("""
SELECT count(*)::BIGINT AS pages, round(count(*) / sum(1e0 + o_orderkey % 3), 3) AS pages_per_s, sum(o_orderkey % 1000)::BIGINT AS in_tokens, sum(o_orderkey % 300)::BIGINT AS out_tokens, count(*) FILTER (o_orderkey % 9 = 0)::BIGINT AS fallback_pages, round(avg(o_orderkey % 4 + 1), 2) AS avg_attempts FROM orders""")
def front_page_facts(spark, sf_dir):
    k = F.col("o_orderkey")
    facts = view(spark, sf_dir, "orders").select((F.lit(1.0) + k % 3).alias("seconds"), (k % 1000).alias("in_tokens"), (k % 300).alias("out_tokens"), (k % 9 == 0).alias("fallback"), (k % 4 + 1).alias("attempts"))
    return lifecycle.run_stats(facts)


@query("""
WITH s AS (SELECT book AS id, text FROM v_lines), n AS (SELECT id, 'images' AS what, sum(len(regexp_extract_all(text, '(?i)<img |<binary '))) AS n FROM s GROUP BY id UNION ALL SELECT id, 'tables', sum(len(regexp_extract_all(text, '(?i)<table'))) FROM s GROUP BY id
 UNION ALL SELECT id, 'cautions', sum(len(regexp_extract_all(text, '⚠'))) FROM s GROUP BY id UNION ALL SELECT id, 'unstable', sum(len(regexp_extract_all(text, '≠'))) FROM s GROUP BY id)
SELECT id, what, n::BIGINT AS want, CASE WHEN what = 'images' AND id % 4 = 0 THEN 0 ELSE n END::BIGINT AS have, what = 'images' AND id % 4 = 0 AND n > 0 AS short FROM n""")
def export_reconcile(spark, sf_dir):
    volumes = view(spark, sf_dir, "v_lines").groupBy(F.col("book").alias("id")).agg(F.array_join(F.array_sort(F.collect_list(F.struct("line", "text")))["text"], "\n").alias("text"))
    lossy = volumes.withColumn("text", F.when(F.col("id") % 4 == 0, F.replace("text", F.lit("<img "), F.lit("<pic "))).otherwise(F.col("text")))
    return exports.reconcile(exports.mark_counts(volumes), exports.mark_counts(lossy))


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'alive' WHEN c_nationkey % 5 <> 0 THEN 'absent' ELSE 'unknown' END AS state FROM customer")
def instance_states(spark, sf_dir):
    c = view(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("host"))
    asked = view(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("host"), (F.col("n_nationkey") % 5 != 0).alias("ok"))
    return exports.states(c, c.where("id % 3 = 0"), asked)


@query("SELECT c_custkey, concat('bench-', substr(c_name, 1, 28)) AS label FROM customer WHERE c_mktsegment = 'BUILDING'")
def own_instances(spark, sf_dir):
    c = view(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_mktsegment") == "BUILDING", exports.label("bench-", "c_name")).otherwise(F.col("c_name")).alias("label"))
    return exports.own_instances(c, "bench-")


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 AND value * 2 >= 60 AND value > 0 THEN value * 8e0 / 1e6 / (event_id % 7 + 1) ELSE 0e0 END AS mbit_s FROM events")
def link_probes(spark, sf_dir):
    probes = view(spark, sf_dir, "events").select("event_id", (F.col("event_id") % 5 != 0).alias("ok"), F.lit(60.0).alias("sent"), F.col("value").alias("got"), (F.col("event_id") % 7 + 1).alias("seconds"))
    return exports.link_speed(probes).select("event_id", "mbit_s")


@query("SELECT doc_id, line, text FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS text, unnest(range(len(string_split(text, chr(10))))) AS line FROM documents) x WHERE ['text', 'number', 'footer', 'aside_text', 'table'][line % 5 + 1] IN ('text', 'table')")
def label_projection(spark, sf_dir):
    hidden = ["number", "header_image", "footer", "footer_image", "aside_text"]
    names = F.array(*map(F.lit, ["text", "number", "footer", "aside_text", "table"]))
    rows = view(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text")).withColumn("label", F.element_at(names, F.col("line") % 5 + 1))
    return rows.where(~F.col("label").isin(hidden)).select("doc_id", "line", "text")


@query("""SELECT conv_id, turn, concat('T = ', (turn * 10), '°, (1)/(', turn + 2, ') × ', 'a', conv_id, '  b c  d', ' end; x', chr(32), 'y') AS text FROM conversations""")
def plain_math(spark, sf_dir):
    n = lambda c: F.col(c).cast("string")
    tex = F.concat(
        F.lit("T = $ "), (F.col("turn") * 10).cast("string"), F.lit("^{\\circ} $, $\\frac{1}{"), (F.col("turn") + 2).cast("string"), F.lit("} \\times $ "),
        F.lit("\\begin{array}{ll} {a"), n("conv_id"), F.lit("} & b \\\\ c & {d} \\end{array} end; $x\\;y$"),
    )
    return view(spark, sf_dir, "conversations").select("conv_id", "turn", T.plain_math(tex).alias("text"))


@query("SELECT page_id, concat('![a](images/p', format('{:04d}', page_id), '_x.png) ![b](images/p', format('{:04d}', page_id), '_y.jpeg)') AS markdown FROM pages")
def image_links(spark, sf_dir):
    return view(spark, sf_dir, "pages").select("page_id", T.image_names(F.lit("![a](x) ![b](y.jpeg)"), F.col("page_id"), F.array(F.lit("x"), F.lit("y.jpeg"))).alias("markdown"))


@query("""
WITH s AS (SELECT page, string_agg(label, ' ' ORDER BY x0, label) AS text FROM v_boxes GROUP BY page) SELECT page, text FROM s""")
def span_lines(spark, sf_dir):
    """Spans of a line in order of x, with blanks between."""
    spans = view(spark, sf_dir, "v_boxes").groupBy("page").agg(F.collect_list(F.struct("x0", F.col("label").alias("text"))).alias("s"))
    return spans.select("page", T.joined_spans(F.col("s")).alias("text"))


@query("SELECT page, i, regexp_matches(CAST(i * 37 % 1200 AS VARCHAR), '^\\d{1,3}$') AND (y0 > 800 - 28 OR y1 < 45) AS folio FROM v_boxes")
def folio_test(spark, sf_dir):
    text = (F.col("i") * 37 % 1200).cast("string")
    return view(spark, sf_dir, "v_boxes").select("page", "i", T.is_folio(text, F.col("y0"), F.col("y1"), F.lit(800.0)).alias("folio"))


@query("""
WITH b AS (SELECT CASE doc_id % 6 WHEN 0 THEN 'header' WHEN 1 THEN 'doc_title' WHEN 2 THEN 'paragraph_title' WHEN 3 THEN 'content' ELSE 'text' END AS label FROM documents)
SELECT label, CASE label WHEN 'header' THEN 7 * 2 + 5 WHEN 'doc_title' THEN 1 + 2 WHEN 'paragraph_title' THEN 9 ELSE 0 END::BIGINT AS found, count(*)::BIGINT AS total FROM b WHERE label <> 'text' GROUP BY label""")
def label_coverage(spark, sf_dir):
    names = F.array(*map(F.lit, ["header", "doc_title", "paragraph_title", "content", "text", "text"]))
    blocks = view(spark, sf_dir, "documents").select(F.element_at(names, (F.col("doc_id") % 6 + 1).cast("int")).alias("label"))
    found = spark.createDataFrame([("chapter", 7), ("top", 5), ("title", 1), ("chapter_from_title", 2), ("section", 9)], "what string, n long")
    return structure.label_coverage(blocks, found)


@query(None)
def relabel(spark, sf_dir):
    """Documents as volumes whose lines are paragraphs, and blocks of the same lines with labels; tests hold the fold to cases."""
    docs = view(spark, sf_dir, "documents").select(F.col("doc_id").alias("book"), "text")
    lines = structure.lines_of(docs)
    label = F.element_at(F.array(*map(F.lit, ["doc_title", "header", "text", "paragraph_title", "figure_title"])), ((F.col("line") - 1) % 5 + 1).cast("int"))
    blocks = lines.select("book", F.col("line").alias("pos"), label.alias("label"), "text")
    return alignment.relabel(docs.withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n"))), blocks)


@query("SELECT doc_id % 10 AS book, concat(string_agg(text, chr(10) || chr(10) ORDER BY doc_id), chr(10) || chr(10)) AS text FROM documents GROUP BY ALL")
def book_concat(spark, sf_dir):
    from ..sources import runs

    pages = view(spark, sf_dir, "documents").select((F.col("doc_id") % 10).alias("book"), F.col("doc_id").alias("page"), "text")
    return runs.concat_pages(pages)


@query("""
WITH p AS (SELECT doc_id AS page, 'Contents' || chr(10) || ' ' || (doc_id % 5 + 1) || '. Title of Sliues ' || lang || CASE doc_id % 3 WHEN 0 THEN ' ..... ' WHEN 1 THEN ' . . ' ELSE '  ' END || doc_id || chr(10) || (doc_id % 3 + 6) || '. 9 is no title 4' AS text FROM documents),
l AS (SELECT page, unnest(string_split(text, chr(10))) AS line, unnest(range(3)) AS pos FROM p WHERE page < 8 AND upper(text) LIKE '%CONTENTS%'),
e AS (SELECT page, pos, regexp_extract(line, '^\\s*(\\d{1,2})\\.\\s+([A-Za-z][^.]*?)\\s*[.\\s]*\\s*\\d{1,3}\\s*$', ['num', 'title']) AS m FROM l)
SELECT m.num::INT AS num, arg_min(replace(replace(trim(m.title), 'RecondHioning', 'Reconditioning'), 'Sliues', 'Slides'), page * 10 + pos) AS title FROM e WHERE m.num <> '' GROUP BY ALL""")
def contents_titles(spark, sf_dir):
    from ..sources import runs

    tail = F.when(F.col("doc_id") % 3 == 0, " ..... ").when(F.col("doc_id") % 3 == 1, " . . ").otherwise("  ")
    text = F.concat(
        F.lit("Contents\n "), (F.col("doc_id") % 5 + 1).cast("string"), F.lit(". Title of Sliues "), "lang", tail, F.col("doc_id").cast("string"),
        F.lit("\n"), (F.col("doc_id") % 3 + 6).cast("string"), F.lit(". 9 is no title 4"),
    )
    return runs.contents_titles(view(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), text.alias("text")))
