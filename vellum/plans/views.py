"""Derived inputs over the driver's tables.

The tables hold no page markup, boxes, offers or run histories, so each operator gets a deterministic stand-in. A view
is one SELECT that Spark and DuckDB both run; where the two spell a function differently, the text has a {name} that
DIALECTS fills in. Positions are made unique with row_number, because line items have no unique key.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

DIALECTS = {
    "spark": {"epoch": "unix_micros(CAST(ts AS TIMESTAMP)) / 1e6", "lines": "LATERAL VIEW posexplode(split(text, '\\n')) l AS line0, line", "line_no": "line0 + 1"},
    "duckdb": {"epoch": "epoch_us(ts) / 1e6", "lines": ", LATERAL (SELECT unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line0) l", "line_no": "line0 + 1"},
}

VIEWS = {
    # cells of machine-read tables: a book is ten suppliers' pages, an order is a table, a line item a row
    "v_cells": """
        SELECT book, page, table_no, row_no, col_no, row_number() OVER (PARTITION BY page ORDER BY table_no, row_no, col_no) AS pos,
               CASE col_no WHEN 1 THEN concat('.', lpad(CAST(q * 7 % 1000 AS STRING), 3, '0')) WHEN 2 THEN concat(CAST(q AS STRING), '/', CAST(row_no + 1 AS STRING))
                           ELSE CASE WHEN q % 11 = 0 THEN '' ELSE concat(flag, status) END END AS text
        FROM v_rows CROSS JOIN (VALUES (1), (2), (3)) AS k(col_no)""",
    "v_rows": """
        SELECT CAST(l_suppkey % 10 AS INT) AS book, l_suppkey AS page, l_orderkey AS table_no, l_returnflag AS flag, l_linestatus AS status, CAST(l_quantity AS INT) AS q,
               CAST(row_number() OVER (PARTITION BY l_suppkey, l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice, l_discount, l_tax) AS INT) AS row_no
        FROM lineitem""",
    # two more readings of the cells: some are missing, some differ
    "v_passes": """
        SELECT 2 AS pass, book, page, table_no, row_no, col_no, pos, CASE WHEN pos * 2 % 7 = 1 THEN concat(text, 'x') ELSE text END AS text FROM v_cells WHERE pos * 2 % 7 <> 0
        UNION ALL
        SELECT 3, book, page, table_no, row_no, col_no, pos, CASE WHEN pos * 3 % 11 = 1 THEN concat('1', text) ELSE text END FROM v_cells WHERE pos * 3 % 11 <> 0 AND page % 17 <> 3""",
    # markup of a page: its tables in order
    "v_markup": """
        SELECT book, page, {agg} AS text FROM (
            SELECT book, page, table_no, concat('<table border=1>', {agg_rows}, '</table>') AS html FROM (
                SELECT book, page, table_no, row_no, concat('<tr>', {agg_cells}, '</tr>') AS html
                FROM (SELECT book, page, table_no, row_no, col_no, concat('<td>', CASE WHEN pos % 13 = 0 THEN concat('<b>', text, '</b> ⚠') ELSE text END, '</td>') AS html FROM v_cells) c
                GROUP BY book, page, table_no, row_no) r
            GROUP BY book, page, table_no) t
        GROUP BY book, page""",
    # a document's lines with the noise of recognition
    "v_lines": """
        SELECT doc_id AS book, {line_no} AS line, CASE WHEN doc_id % 4 = 0 AND ({line_no}) % 3 = 0 AND length(line) > 3 THEN concat(regexp_replace(line, '[^a-zA-Z]+$', ''), '-')
                    WHEN ({line_no}) % 5 = 0 THEN concat(line, ' . . . . . ', CAST({line_no} AS STRING))
                    WHEN ({line_no}) % 7 = 1 AND ({line_no}) > 1 THEN concat('## ', CAST({line_no} AS STRING), '. ', line)
                    WHEN ({line_no}) % 7 = 2 THEN concat(CAST({line_no} AS STRING), '. ', lower(line))
                    WHEN ({line_no}) % 11 = 4 THEN concat('<img src="imgs/', CAST(doc_id AS STRING), '.jpg" width="50%">')
                    WHEN ({line_no}) % 11 = 5 THEN concat('Fig. ', CAST({line_no} AS STRING), '.1 ', line)
                    ELSE line END AS text
        FROM documents {lines}""",
    # headings of a conversation read as a book: every fifth turn starts a chapter
    "v_headings": """
        SELECT conv_id AS book, turn AS line, CASE WHEN turn % 5 = 0 THEN 'chapter' ELSE 'sub' END AS role, CASE WHEN turn % 5 = 0 THEN CAST(turn DIV_ 5 + 1 AS INT) END AS num,
               CAST(turn % 3 + 1 AS INT) AS depth,
               CASE WHEN turn % 5 = 0 THEN concat('Chapter ', CAST(turn DIV_ 5 + 1 AS STRING), '. ', substr(text, 1, 12))
                    WHEN turn % 7 = 6 THEN concat('Plate ', CAST(turn AS STRING), '.4')
                    ELSE concat(CASE turn % 3 WHEN 0 THEN 'Sec. ' WHEN 1 THEN '' ELSE '§ ' END, CAST(turn DIV_ 5 + 1 + CASE WHEN (conv_id + turn) % 9 = 0 THEN 1 ELSE 0 END AS STRING), '.', CAST((turn * 3 + conv_id) % 7 AS STRING), ' ', substr(text, 1, 10)) END AS title
        FROM conversations""",
    # layout boxes: an order is a page
    "v_boxes": """
        SELECT page, i, label, score, x0, y0, x0 + 20 + (i * 37 + page) % 260 AS x1, y0 + 4 + (i * 53 + page) % 180 AS y1 FROM (
            SELECT page, i, CASE (i + page) % 6 WHEN 0 THEN 'table' WHEN 1 THEN 'text' WHEN 2 THEN 'image' WHEN 3 THEN 'inline_formula' WHEN 4 THEN 'reference' ELSE 'paragraph_title' END AS label,
                   (page * 31 + i * 17) % 100 / 1e2 AS score, CAST(q * 10 AS DOUBLE) AS x0, CAST((q * 29 + page) % 700 AS DOUBLE) AS y0
            FROM (SELECT l_orderkey AS page, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) - 1 AS INT) AS i, CAST(l_quantity AS INT) AS q FROM lineitem) b) x""",
    "v_offers": """
        SELECT p_partkey AS id, CAST(p_size AS BIGINT) AS machine_id, p_retailprice / 5e3 AS dph_total, CASE WHEN p_partkey % 13 = 0 THEN 0e0 WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_partkey % 1500 AS DOUBLE) END AS inet_down,
               CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE CAST(p_partkey % 9 AS DOUBLE) END AS internet_down_cost_per_tb, CAST(p_partkey % 1200 AS DOUBLE) AS disk_bw, CASE WHEN p_partkey % 7 = 0 THEN 0e0 ELSE p_partkey % 50 / 1e1 END AS cpu_ghz,
               CAST(p_partkey % 64 AS DOUBLE) AS cpu_cores_effective, p_brand AS gpu_name, CAST(p_partkey % 3 + 1 AS INT) AS num_gpus, p_partkey % 5 <> 0 AS rentable, p_partkey % 4 <> 0 AS verified,
               9e-1 + p_partkey % 100 / 1e3 AS reliability, CAST(p_partkey % 400 AS DOUBLE) AS disk_space, 11e0 + p_partkey % 4 AS cuda_vers, p_type AS region
        FROM part""",
    "v_runs": """
        SELECT event_id AS seq, CASE WHEN event_type IN ('click', 'view') THEN concat('tables-', event_type) ELSE event_type END AS job, CASE WHEN event_id % 3 = 0 THEN 'image-b' ELSE 'image-a' END AS image, CASE WHEN event_id % 23 = 0 THEN 0 ELSE user_id % 97 END AS machine_id,
               CAST(event_id AS DOUBLE) * 3e1 AS started, CASE WHEN event_id % 5 = 0 THEN 0e0 ELSE value END AS setup_s, CASE WHEN event_id % 6 = 0 THEN 0e0 ELSE value * 3e0 END AS run_s, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value * 2e0 + 1e0 END AS download_mbps,
               event_id % 8 <> 0 AS ok, value / 1e2 AS cost_usd, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value + 5e1 END AS inet_down_adv, 2e0 + event_id % 9 AS image_gb, value / 5e1 AS dph, CAST(event_id % 6 AS DOUBLE) AS per_tb
        FROM events""",
    "v_heartbeats": "SELECT event_id, user_id AS instance, {epoch} AS at FROM events",
    # tokens of machine responses: a word of a document is a token with its log-probability
    "v_tokens": """
        SELECT response_id, tok_no, CASE WHEN tok_no = 1 THEN word ELSE concat(' ', word) END AS token, -((response_id * 7 + tok_no * 13) % 40) / 1e1 AS logprob
        FROM (SELECT doc_id AS response_id, {word_no} AS tok_no, word FROM documents {words}) w""",
}
DIALECTS["spark"] |= {
    "agg": "listagg(html, '\\n') WITHIN GROUP (ORDER BY table_no)", "agg_rows": "listagg(html, '') WITHIN GROUP (ORDER BY row_no)", "agg_cells": "listagg(html, '') WITHIN GROUP (ORDER BY col_no)",
    "words": "LATERAL VIEW posexplode(split(text, '[ \\n]+')) l AS word0, word", "word_no": "word0 + 1", "DIV_": "DIV",
}
DIALECTS["duckdb"] |= {
    "agg": "string_agg(html, chr(10) ORDER BY table_no)", "agg_rows": "string_agg(html, '' ORDER BY row_no)", "agg_cells": "string_agg(html, '' ORDER BY col_no)",
    "words": ", LATERAL (SELECT unnest(regexp_split_to_array(text, '[ \\n]+')) AS word, unnest(range(len(regexp_split_to_array(text, '[ \\n]+')))) AS word0) l", "word_no": "word0 + 1", "DIV_": "//",
}


def text_of(name: str, dialect: str) -> str:
    out = VIEWS[name].replace("DIV_", DIALECTS[dialect]["DIV_"])
    for key, value in DIALECTS[dialect].items():
        out = out.replace("{" + key + "}", value)
    return out


def needs(sql: str) -> list[str]:
    """The views that sql reads, those they read first."""
    out: list[str] = []
    for name in VIEWS:
        if re.search(rf"\b{name}\b", sql):
            for x in [*needs(VIEWS[name]), name]:
                if x not in out:
                    out.append(x)
    return out


def oracle(sql: str) -> str:
    """sql with the views it reads as common table expressions in DuckDB's dialect."""
    own = needs(sql)
    if not own:
        return sql
    ctes = ",\n".join(f"{n} AS ({text_of(n, 'duckdb').strip()})" for n in own)
    body = sql.strip()
    recursive = re.match(r"WITH(\s+RECURSIVE)?\s", body)
    if recursive:
        return f"WITH{recursive[1] or ''} {ctes},\n{body[recursive.end():]}"
    return f"WITH {ctes}\n{body}"


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view, or a table, over the tables in sf_dir."""
    for t in TABLES:
        if re.search(rf"\b{t}\b", " ".join(VIEWS[n] for n in needs(name)) or name):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    own = needs(name)
    if not own:
        return spark.table(name)
    # each view is a DataFrame over the ones before it, so the tables of the last call never leak into this one
    for n in own:
        spark.sql(text_of(n, "spark")).createOrReplaceTempView(n)
    return spark.table(name)
