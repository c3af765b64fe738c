"""Queries over book structure and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import structure
from .views import view

RUNS: dict = {}


def query(sql: str | None):
    def add(f):
        RUNS[f.__name__] = (f, sql)
        return f

    return add


@query("""
WITH l AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS text FROM documents), c AS (SELECT text, count(*) AS n FROM l WHERE text <> '' GROUP BY text)
SELECT text, n FROM c WHERE n >= greatest(3, least(20, (SELECT count(*) FROM documents) // 3))""")
def running_headers(spark, sf_dir):
    docs = view(spark, sf_dir, "documents")
    return structure.running_headers(docs.select(F.explode(F.split("text", "\n")).alias("text")), docs.agg(F.count(F.lit(1)).alias("n_pages")))


@query("""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS text FROM documents), c AS (SELECT trim(text) AS t, count(*) AS n FROM l WHERE trim(text) <> '' GROUP BY ALL)
SELECT doc_id, count(*)::BIGINT AS n_lines FROM l WHERE trim(text) NOT IN (SELECT t FROM c WHERE n >= greatest(3, least(20, (SELECT count(*) FROM documents) // 3))) GROUP BY doc_id""")
def running_headers_removed(spark, sf_dir):
    docs = view(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.explode(F.split("text", "\n")).alias("text"))
    headers = structure.running_headers(lines.select("text"), docs.agg(F.count(F.lit(1)).alias("n_pages")))
    return structure.drop_lines(lines, headers).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_lines"))


@query("SELECT doc_id, md5(lower(trim(regexp_replace(regexp_replace(text, '<[^>]+>', ' ', 'g'), '[^\\p{L}\\p{N}]+', ' ', 'g')))) AS key FROM documents")
def norm_key(spark, sf_dir):
    return view(spark, sf_dir, "documents").select("doc_id", F.md5(T.key(F.col("text"))).alias("key"))


@query("SELECT book, line, regexp_replace(text, '[.…](?:\\s*[.…]){3,}', ' ', 'g') AS text, len(regexp_extract_all(text, '[.…](?:\\s*[.…]){3,}'))::BIGINT AS n FROM v_lines")
def strip_leaders(spark, sf_dir):
    return view(spark, sf_dir, "v_lines").select("book", "line", T.strip_leaders(F.col("text")).alias("text"), T.count_leaders(F.col("text")).alias("n"))


@query("""
WITH t AS (SELECT conv_id, turn, concat('``', replace(text, '.', ' .¬'), '’') AS t FROM conversations)
SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(t, '¬', '-'), '\\^\\^|''''|``', '"', 'g'), '[‘’‛´`]', '''', 'g'), '[“”]', '"', 'g'), '[\\s\\p{Z}\\x{85}\\v]+([,.;:])', '\\1', 'g'), '[\\s\\p{Z}\\x{85}\\v]{2,}', ' ', 'g'), '^[\\s\\p{Z}\\x{85}\\v]+|[\\s\\p{Z}\\x{85}\\v]+$', '', 'g') AS text FROM t""")
def clean_text(spark, sf_dir):
    noisy = F.concat(F.lit("``"), F.replace("text", F.lit("."), F.lit(" .¬")), F.lit("’"))
    return view(spark, sf_dir, "conversations").select("conv_id", "turn", T.clean(noisy).alias("text"))


@query("""
WITH w AS (SELECT conv_id, turn, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: x <> '') AS w FROM conversations)
SELECT conv_id, turn, array_to_string(list_transform(w, lambda x, i: CASE WHEN i > 1 AND list_contains(['of','and','the','a','an','to','in','on','for','with','by','or'], x) THEN x ELSE concat(CASE substr(x, 1, 1) WHEN 'ß' THEN 'SS' ELSE upper(substr(x, 1, 1)) END, substr(x, 2)) END), ' ') AS title FROM w""")
def title_case(spark, sf_dir):
    return view(spark, sf_dir, "conversations").select("conv_id", "turn", T.title_case(F.col("text")).alias("title"))


@query("SELECT page_id, md5(regexp_replace(html, '<[^>]+>', '', 'g')) AS text FROM pages")
def tag_strip(spark, sf_dir):
    return view(spark, sf_dir, "pages").select("page_id", F.md5(T.untag(F.col("html"))).alias("text"))


@query("SELECT book, line, regexp_replace(text, '(?i)<img\\b[^>]*?src\\s*=\\s*\"([^\"]+)\"[^>]*?/?>', '<img src=\"\\1\" alt=\"Image\" />', 'g') AS text FROM v_lines WHERE text LIKE '%<img%'")
def img_canonical(spark, sf_dir):
    return view(spark, sf_dir, "v_lines").where(F.col("text").contains("<img")).select("book", "line", T.canonical_images(F.col("text")).alias("text"))


@query("""
SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN NULL ELSE lang END AS primary_language, doc_id % 3 = 0 AS is_rotation_valid, CASE WHEN doc_id % 4 = 3 THEN 0 ELSE (doc_id % 4 * 90)::INT END AS rotation_correction,
 doc_id % 7 = 0 AS is_table, NULL::BOOLEAN AS is_diagram, md5(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', '')) AS body FROM documents""")
def front_matter(spark, sf_dir):
    answer = F.concat(
        F.lit("---\nprimary_language: "), F.when(F.col("doc_id") % 5 == 0, "null").otherwise(F.col("lang")), F.lit("\nis_rotation_valid: "), F.when(F.col("doc_id") % 3 == 0, "True").otherwise("no"),
        F.lit("\nrotation_correction: "), F.when(F.col("doc_id") % 4 == 3, "left").otherwise((F.col("doc_id") % 4 * 90).cast("string")), F.lit("\nother: 1\nis_table: "), F.when(F.col("doc_id") % 7 == 0, "yes").otherwise("false"), F.lit("\n---\n"), "text",
    )
    f = view(spark, sf_dir, "documents").select("doc_id", T.front_matter(answer).alias("f"))
    return f.select("doc_id", *[f"f.{c}" for c in ("primary_language", "is_rotation_valid", "rotation_correction", "is_table", "is_diagram")], F.md5("f.body").alias("body"))


_NUMBER = """
n AS (SELECT *, regexp_extract(title, '^(\\S{0,12}?)[.\\s]*(\\d+)\\.(\\d+)', ['p', 'a', 'b']) AS m, regexp_matches(title, '^(\\S{0,12}?)[.\\s]*(\\d+)\\.(\\d+)') AS ok FROM v_headings),
s AS (SELECT *, CASE WHEN ok AND lower(trim(m.p, '.§ ')) IN ('', 'sec', 'sect', 'section', 'разд', 'раздел', 'п', 'пункт', 'abschn', 'abschnitt', 'art', 'статья') THEN TRY_CAST(m.a AS INT) END AS a, TRY_CAST(m.b AS INT) AS b0 FROM n)"""


@query(f"WITH {_NUMBER} SELECT book, line, a, CASE WHEN a IS NOT NULL THEN b0 END AS b FROM s")
def section_numbers(spark, sf_dir):
    n = T.section_number(F.col("title"))
    return view(spark, sf_dir, "v_headings").select("book", "line", n["a"].alias("a"), n["b"].alias("b"))


@query("""
SELECT book, line, CASE WHEN regexp_matches(text, '^#{1,6}\\s+(?i:Chapter|Глава|Kapitel|Chapitre|Capitolo|Capítulo|Capitulo|Hoofdstuk|Rozdział)\\s+\\d+\\.') THEN 'chapter' ELSE 'sub' END AS role, trim(regexp_extract(text, '^(#{1,6})\\s+(\\S.*)$', 2)) AS title,
 length(regexp_extract(text, '^(#{1,6})\\s+(\\S.*)$', 1))::INT AS depth FROM v_lines WHERE regexp_matches(text, '^(#{1,6})\\s+(\\S.*)$')""")
def headings(spark, sf_dir):
    return structure.headings(view(spark, sf_dir, "v_lines")).select("book", "line", "role", "title", "depth")


_RANGES = """
last AS (SELECT book, max(line) + 2 AS n_lines FROM v_headings GROUP BY book),
r AS (SELECT h.*, n_lines, coalesce(CASE WHEN role = 'chapter' THEN min(CASE WHEN role = 'chapter' THEN line END) OVER (PARTITION BY h.book ORDER BY line ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) ELSE lead(line) OVER (PARTITION BY h.book ORDER BY line) END - 1, n_lines) AS "end"
  FROM v_headings h JOIN last USING (book))"""
_DISORDER = """
g AS (SELECT *, count(CASE WHEN role = 'chapter' THEN num END) OVER w AS grp, coalesce(last_value(CASE WHEN role = 'chapter' THEN num END IGNORE NULLS) OVER w, 0) AS chap, CASE WHEN role = 'chapter' THEN num * 1000000 ELSE a * 1000000 + b0 END AS v
  FROM (SELECT book, line, role, num, title, a, CASE WHEN a IS NOT NULL THEN b0 END AS b0 FROM s) s0 WINDOW w AS (PARTITION BY book ORDER BY line)),
d AS (SELECT *, coalesce(max(v) OVER (PARTITION BY book, grp ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM g),
bad AS (SELECT book, line, title, a <> chap OR v < before AS bad FROM d WHERE role <> 'chapter' AND a IS NOT NULL)"""


def _heads(spark, sf_dir):
    h = view(spark, sf_dir, "v_headings")
    return h, h.groupBy("book").agg((F.max("line") + 2).alias("n_lines"))


@query(f"""WITH {_RANGES} SELECT book, line, role, "end" FROM r""")
def ranges(spark, sf_dir):
    return structure.ranges(*_heads(spark, sf_dir)).select("book", "line", "role", "end")


@query(f"WITH {_NUMBER}, {_DISORDER} SELECT book, line, bad FROM bad")
def disorder(spark, sf_dir):
    return structure.disorder(view(spark, sf_dir, "v_headings")).select("book", "line", "bad")


@query(f"""WITH {_NUMBER}, {_DISORDER}, {_RANGES}, e AS (SELECT r.*, min(CASE WHEN role = 'chapter' THEN line END) OVER (PARTITION BY book) AS f, max(line) OVER (PARTITION BY book) AS z FROM r)
SELECT e.book, e.line, concat(CASE WHEN role = 'chapter' OR depth = 1 OR coalesce(e.line < f, false) THEN '' ELSE '    ' END, '- ', e.title, '  — строки ', e.line, '–', "end",
 CASE WHEN role = 'chapter' AND "end" = n_lines AND z > e.line THEN '  (до конца файла: задняя часть книги входит сюда же)' ELSE '' END, CASE WHEN bad.bad THEN '   <!-- порядок нарушен -->' ELSE '' END) AS entry FROM e LEFT JOIN bad ON bad.book = e.book AND bad.line = e.line""")
def toc(spark, sf_dir):
    return structure.contents(*_heads(spark, sf_dir))


@query("""
WITH c AS (SELECT book, num FROM v_headings WHERE role = 'chapter' AND (book + num) % 3 <> 0), w AS (SELECT book, unnest(range(1, max(num) + 1)) AS num FROM c GROUP BY book)
SELECT book, num::INT AS num FROM w WHERE (book, num) NOT IN (SELECT (book, num) FROM c)""")
def missing_chapters(spark, sf_dir):
    return structure.missing_numbers(view(spark, sf_dir, "v_headings").where("role <> 'chapter' or (book + num) % 3 <> 0"))


@query("""
WITH l AS (SELECT book, line, text, trim(text) AS t FROM v_lines), f AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY line) AS r FROM l WHERE t <> ''),
x AS (SELECT a.*, CASE WHEN regexp_matches(a.text, '^#{1,6}\\s+(\\d+)\\.\\s+\\S') THEN regexp_extract(a.text, '^#{1,6}\\s+(\\d+)\\.', 1)::BIGINT END AS k,
 CASE WHEN a.line - b.line <= 3 THEN nullif(regexp_extract(b.t, '^#{0,6}\\s*(\\d+)\\.\\s+\\S', 1), '')::BIGINT END AS kb, CASE WHEN c.line - a.line <= 3 THEN nullif(regexp_extract(c.t, '^#{0,6}\\s*(\\d+)\\.\\s+\\S', 1), '')::BIGINT END AS kc
 FROM f a LEFT JOIN f b ON b.book = a.book AND b.r = a.r - 1 LEFT JOIN f c ON c.book = a.book AND c.r = a.r + 1),
d AS (SELECT *, coalesce(abs(kb - k) = 1, false) OR coalesce(abs(kc - k) = 1, false) AS demoted FROM x)
SELECT book, line, CASE WHEN demoted THEN regexp_replace(text, '^#{1,6}\\s+(\\d+)\\.\\s+(\\S.*)$', '\\1. \\2') ELSE text END AS text, demoted FROM d""")
def list_demotion(spark, sf_dir):
    return structure.demote_lists(view(spark, sf_dir, "v_lines")).where(T.strip(F.col("text")) != "")


@query(None)
def hyphen_join(spark, sf_dir):
    """A fixed point over lines; tests hold it to a plain fold."""
    return structure.join_hyphens(view(spark, sf_dir, "v_lines"))


@query("""
WITH i AS (SELECT conv_id AS book, turn AS pos, CASE WHEN turn % 6 = 5 THEN 'page' WHEN turn % 4 = 3 THEN 'caption' ELSE 'body' END AS kind, CASE WHEN turn % 3 = 0 THEN regexp_replace(text, '[.!?:;]*$', '') WHEN turn % 3 = 1 THEN concat(lower(text), '-') ELSE text END AS text FROM conversations),
l AS (SELECT *, lag(text) OVER w AS p, lag(kind) OVER w AS pk FROM i WINDOW w AS (PARTITION BY book ORDER BY pos)),
j AS (SELECT *, CASE WHEN kind = 'body' AND pk = 'body' AND (regexp_matches(p, '[-¬]$') OR (NOT regexp_matches(p, '[.!?:;"'')\\]]$') AND regexp_matches(text, '^\\p{Ll}'))) THEN 0 ELSE 1 END AS s FROM l),
g AS (SELECT *, sum(s) OVER (PARTITION BY book ORDER BY pos) AS g, lead(s) OVER (PARTITION BY book ORDER BY pos) AS ns, lead(text) OVER (PARTITION BY book ORDER BY pos) AS nt FROM j)
SELECT book, min(pos) AS pos, arg_min(kind, pos) AS kind, string_agg(CASE WHEN coalesce(ns, 1) = 1 THEN text WHEN regexp_matches(text, '[-‐—]$') AND regexp_matches(nt, '^\\p{Ll}') THEN regexp_replace(text, '.$', '') ELSE concat(text, ' ') END, '' ORDER BY pos) AS text, count(*)::BIGINT AS n_parts
FROM g GROUP BY book, g""")
def merge_bodies(spark, sf_dir):
    c = view(spark, sf_dir, "conversations")
    kind = F.when(F.col("turn") % 6 == 5, "page").when(F.col("turn") % 4 == 3, "caption").otherwise("body")
    text = F.when(F.col("turn") % 3 == 0, F.regexp_replace("text", "[.!?:;]*$", "")).when(F.col("turn") % 3 == 1, F.concat(F.lower("text"), F.lit("-"))).otherwise(F.col("text"))
    return structure.merge_bodies(c.select(F.col("conv_id").alias("book"), F.col("turn").alias("pos"), kind.alias("kind"), text.alias("text")))


@query("""
SELECT conv_id AS book, turn AS pos, last_value(CASE WHEN turn % 4 = 2 THEN turn * 10 END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS printed FROM conversations""")
def carry_folio(spark, sf_dir):
    items = view(spark, sf_dir, "conversations").select(F.col("conv_id").alias("book"), F.col("turn").alias("pos"), F.when(F.col("turn") % 4 == 2, F.col("turn") * 10).alias("folio"))
    return structure.carry_folio(items).select("book", "pos", "printed")


@query("""
WITH h AS (SELECT book, regexp_extract(text, '^(#{1,6})\\s+(\\S.*)$', 2) AS t FROM v_lines WHERE regexp_matches(text, '^(#{1,6})\\s+(\\S.*)$')),
hh AS (SELECT book, count(*) AS headings, count(*) FILTER (regexp_matches(t, '^(\\S{0,12}?)[.\\s]*(\\d+)\\.(\\d+)') AND lower(trim(regexp_extract(t, '^(\\S{0,12}?)[.\\s]*(\\d+)\\.(\\d+)', 1), '.§ ')) IN ('', 'sec', 'sect', 'section', 'art')) AS numbered FROM h GROUP BY book),
f AS (SELECT book, count(DISTINCT f) AS figures FROM (SELECT book, unnest(regexp_extract_all(text, 'Fig\\.\\s*\\d+\\.\\d+[a-z]?')) AS f FROM v_lines) x GROUP BY book),
c AS (SELECT book, sum(len(list_filter(regexp_split_to_array(regexp_replace(text, '<[^>]+>', ' ', 'g'), '\\s+'), lambda w: w <> ''))) AS words, sum((length(text) - length(replace(text, '<img', ''))) // 4) AS images,
 count(*) FILTER (regexp_matches(text, '^(?:<[^>]+>\\s*)*Fig\\.')) AS captions, count(*) FILTER (regexp_matches(text, '\\p{L}{2}-$')) AS open_hyphens FROM v_lines GROUP BY book)
SELECT book, words::BIGINT AS words, images::BIGINT AS images, captions::BIGINT AS captions, open_hyphens::BIGINT AS open_hyphens, coalesce(headings, 0)::BIGINT AS headings, coalesce(numbered, 0)::BIGINT AS numbered, coalesce(figures, 0)::BIGINT AS figures FROM c LEFT JOIN hh USING (book) LEFT JOIN f USING (book)""")
def book_measures(spark, sf_dir):
    return structure.measures(view(spark, sf_dir, "v_lines")).select("book", "words", "images", "captions", "open_hyphens", "headings", "numbered", "figures")


_CHAPTERS = """c AS (SELECT doc_id AS book, {line_no} AS line, CASE WHEN ({line_no}) % 4 = 1 THEN concat('## Chapter ', ({line_no} + 3) // 4, '. ', substr(line, 1, 9)) WHEN ({line_no}) % 9 = 2 THEN concat('<!-- скан таблицы: imgs/', {line_no}, '.jpg -->') WHEN ({line_no}) % 9 = 4 THEN concat('<table><tr><td>', substr(line, 1, 9), ' ⚠</td></tr></table>') WHEN ({line_no}) % 13 = 7 THEN concat(line, ' <mark>x</mark> ≠') ELSE line END AS text FROM documents {lines})"""


def _chapters(spark, sf_dir):
    n = F.col("line")
    lines = structure.lines_of(view(spark, sf_dir, "documents").select(F.col("doc_id").alias("book"), "text"))
    short = F.substring("text", 1, 9)
    text = (
        F.when(n % 4 == 1, F.concat(F.lit("## Chapter "), F.floor((n + 3) / 4).cast("string"), F.lit(". "), short)).when(n % 9 == 2, F.concat(F.lit("<!-- скан таблицы: imgs/"), n.cast("string"), F.lit(".jpg -->")))
        .when(n % 9 == 4, F.concat(F.lit("<table><tr><td>"), short, F.lit(" ⚠</td></tr></table>"))).when(n % 13 == 7, F.concat("text", F.lit(" <mark>x</mark> ≠"))).otherwise(F.col("text"))
    )
    return lines.withColumn("text", text)


def _chapter_sql(body: str) -> str:
    from .views import DIALECTS

    d = DIALECTS["duckdb"]
    return "WITH " + _CHAPTERS.replace("{line_no}", d["line_no"]).replace("{lines}", d["lines"]) + body


@query(_chapter_sql(""",
r AS (SELECT *, last_value(CASE WHEN text LIKE '## Chapter%' THEN line END IGNORE NULLS) OVER (PARTITION BY book ORDER BY line) AS start FROM c)
SELECT book, start, max(line) AS "end", sum(len(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(text, '(?is)<table\\b.*?</table>', '', 'g'), '<[^>]+>', ' ', 'g'), '\\s+'), lambda w: w <> '')))::BIGINT AS words,
 sum(len(regexp_extract_all(text, '(?is)<table\\b.*?</table>')))::BIGINT AS tables, sum(len(regexp_extract_all(text, '[⚠≠]|<mark')))::BIGINT AS marks,
 sum(len(regexp_extract_all(text, '(?is)<table\\b.*?</table>'))) = 0 AND sum(len(regexp_extract_all(text, '[⚠≠]|<mark'))) = 0 AS clean FROM r GROUP BY book, start"""))
def chapter_map(spark, sf_dir):
    return structure.chapter_map(_chapters(spark, sf_dir))


@query(_chapter_sql(""",
l AS (SELECT *, nullif(regexp_extract(text, 'скан таблицы:\\s*(\\S+)', 1), '') AS link, CASE WHEN text LIKE '%<table%' THEN 1 ELSE 0 END AS t FROM c),
g AS (SELECT *, sum(t) OVER (PARTITION BY book ORDER BY line) - t AS g FROM l), s AS (SELECT *, last_value(link IGNORE NULLS) OVER (PARTITION BY book, g ORDER BY line) AS scan FROM g)
SELECT book, line, scan FROM s WHERE t = 1"""))
def table_queue(spark, sf_dir):
    return structure.table_queue(_chapters(spark, sf_dir))


@query("""
WITH p AS (SELECT *, last_value(CASE WHEN trim(text) <> '' THEN text END IGNORE NULLS) OVER (PARTITION BY book ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM v_lines)
SELECT book, line AS pos, coalesce(b LIKE '%<img%', false) AS bound FROM p WHERE text LIKE 'Fig.%'""")
def caption_binding(spark, sf_dir):
    items = view(spark, sf_dir, "v_lines").select("book", F.col("line").alias("pos"), F.when(F.col("text").startswith("Fig."), "figure_title").otherwise("text").alias("label"), "text")
    return structure.caption_binding(items)


@query("""
WITH t AS (SELECT conv_id, turn, concat(CASE turn % 6 WHEN 0 THEN 'Chapter ' || (turn + 1) || ' ' WHEN 1 THEN 'Sec. ' || turn || '. ' || conv_id % 50 || ' ' WHEN 2 THEN 'Fig. 3 ' ELSE '' END, CASE WHEN turn % 6 = 3 THEN upper(substr(text, 1, 40)) WHEN turn % 2 = 0 THEN substr(text, 1, 50) ELSE text END) AS t FROM conversations),
c AS (SELECT conv_id, turn, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(t, '¬', '-'), '\\^\\^|''''|``', '"', 'g'), '[‘’‛´`]', '''', 'g'), '[“”]', '"', 'g'), '[\\s\\p{Z}\\x{85}\\v]+([,.;:])', '\\1', 'g'), '[\\s\\p{Z}\\x{85}\\v]{2,}', ' ', 'g'), '^[\\s\\p{Z}\\x{85}\\v]+|[\\s\\p{Z}\\x{85}\\v]+$', '', 'g') AS t FROM t)
SELECT conv_id, turn, CASE WHEN t = '' THEN NULL WHEN regexp_matches(t, '(?i)^Chapter\\s+([0-9]{1,2})\\b\\s*(.*)$') AND length(t) < 80 THEN 'chapter' WHEN regexp_matches(t, '(?i)^Sec[.,;:^]{0,2}\\s*(\\d{1,2})\\s*[.,:;^]\\s*(\\d{1,2})\\b\\.?\\s*(.*)$') THEN 'sec'
 WHEN regexp_matches(t, '(?i)^(Fig|PLATE|Plate|Table)\\b\\.?\\s*\\d') THEN 'caption' WHEN length(t) < 75 AND length(regexp_replace(t, '[^\\p{Lu}]', '', 'g')) > 8e-1 * length(regexp_replace(t, '[^\\p{L}]', '', 'g')) AND length(regexp_replace(t, '[^\\p{L}]', '', 'g')) > 3 THEN 'head' ELSE 'body' END AS kind FROM c""")
def line_classes(spark, sf_dir):
    turn = F.col("turn")
    lead = F.when(turn % 6 == 0, F.concat(F.lit("Chapter "), (turn + 1).cast("string"), F.lit(" "))).when(turn % 6 == 1, F.concat(F.lit("Sec. "), turn.cast("string"), F.lit(". "), (F.col("conv_id") % 50).cast("string"), F.lit(" "))).when(turn % 6 == 2, "Fig. 3 ").otherwise("")
    text = F.concat(lead, F.when(turn % 6 == 3, F.upper(F.substring("text", 1, 40))).when(turn % 2 == 0, F.substring("text", 1, 50)).otherwise(F.col("text")))
    return view(spark, sf_dir, "conversations").select("conv_id", "turn", T.line_class(text)["kind"].alias("kind"))


@query("""
WITH e AS (SELECT doc_id, len(list_filter(string_split(text, chr(10)), lambda x: length(trim(regexp_replace(x, '[.…](?:\\s*[.…]){3,}', ' ', 'g'))) > 3)) AS n FROM documents)
SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN true ELSE n >= greatest(2, (doc_id % 7 * 3) // 2) END AS intact FROM e""")
def toc_intact(spark, sf_dir):
    return view(spark, sf_dir, "documents").select("doc_id", T.toc_intact(F.col("text"), (F.col("doc_id") % 7 * 3).cast("int")).alias("intact"))


@query("SELECT doc_id, trim(regexp_replace(text, '<[^>]+>', '', 'g')) <> '' AND NOT regexp_matches(trim(regexp_replace(text, '<[^>]+>', '', 'g')), '^\\p{Ll}') AS heading FROM documents")
def heading_test(spark, sf_dir):
    return view(spark, sf_dir, "documents").select("doc_id", T.looks_heading(F.col("text")).alias("heading"))
