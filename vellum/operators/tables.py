"""Tables in page markup: cells, rows, counts, signatures, degenerate ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def html_tables(pages: DataFrame) -> DataFrame:
    """pages (…, text) → each page's columns but text, table_no (from 0), html. Pages without a table cost one search."""
    rest = [c for c in pages.columns if c != "text"]
    found = pages.where(F.lower("text").contains("<table"))
    return found.select(*rest, F.posexplode(T.all_of(F.col("text"), T.TABLE)).alias("table_no", "html"))


def html_cells(pages: DataFrame, clean=T.plain) -> DataFrame:
    """table_no, row_no, col_no, cell_no (in the table), text of every cell of the HTML tables."""
    rest = [c for c in pages.columns if c != "text"]
    row = F.transform(T.all_of(F.col("html"), T.ROW, 1), lambda r, i: F.transform(T.all_of(r, T.CELL, 1), lambda c, j: F.struct(i.alias("row_no"), j.alias("col_no"), c.alias("raw"))))
    cells = html_tables(pages).select(*rest, "table_no", F.posexplode(F.flatten(row)).alias("cell_no", "c"))
    return cells.select(*rest, "table_no", "c.row_no", "c.col_no", "cell_no", clean(F.col("c.raw")).alias("text"))


def pipe_rows(pages: DataFrame) -> DataFrame:
    """table_no, row_no, cells of tables drawn with pipes: unbroken |…| lines are a table, rules are skipped."""
    rest = [c for c in pages.columns if c != "text"]
    lines = pages.select(*rest, F.posexplode(F.split("text", "\n")).alias("line", "raw")).withColumn("raw", T.strip(F.col("raw")))
    piped = F.col("raw").startswith("|") & F.col("raw").endswith("|")
    order = Window.partitionBy(*rest).orderBy("line")
    marked = lines.withColumn("__on", piped).withColumn("__break", F.when(piped, 0).otherwise(1))
    island = marked.withColumn("__island", F.sum("__break").over(order)).where("__on").where(~F.regexp_like("raw", F.lit(T.PIPE_RULE)))
    numbered = island.withColumn("table_no", F.dense_rank().over(Window.partitionBy(*rest).orderBy("__island")) - 1)
    inside = F.regexp_replace("raw", r"^\|+|\|+$", "")
    row = F.row_number().over(Window.partitionBy(*rest, "table_no").orderBy("line")) - 1
    return numbered.select(*rest, "table_no", row.alias("row_no"), T.norm_each(F.split(inside, r"\|")).alias("cells"))


def value_rows(rows: DataFrame) -> DataFrame:
    """Rows (…, cells) that hold values: two cells that aren't empty, two that look like a number; empties are dropped."""
    full = F.filter("cells", lambda c: c != "")
    return rows.withColumn("cells", full).where((F.size("cells") >= 2) & (F.size(F.filter("cells", lambda c: F.regexp_like(c, F.lit(T.VALUE)))) >= 2))


def cell_counts(pages: DataFrame) -> DataFrame:
    """n_tables, n_cells (all), n_full (not blank) of the HTML tables of each page."""
    cells = T.all_of(F.col("text"), T.CELL, 1)
    return pages.select(
        *[c for c in pages.columns if c != "text"],
        F.regexp_count("text", F.lit(r"(?i)<table[\s>]")).cast("long").alias("n_tables"),
        F.regexp_count("text", F.lit(r"(?i)<t[dh][\s>]")).cast("long").alias("n_cells"),
        F.size(F.filter(cells, lambda c: T.strip(c) != "")).cast("long").alias("n_full"),
    )


def signature(cells: Column) -> Column:
    """One string for a table: its cells that aren't empty, joined by the unit separator."""
    return F.array_join(F.filter(cells, lambda c: c != ""), "\x1f")


def link_by_signature(left: DataFrame, right: DataFrame, within: list[str]) -> DataFrame:
    """left (within…, id, sign) joined to right (within…, id, sign): the n-th table of a signature to the n-th.

    within = [page] for page by page, [] for the whole book. Unmatched left rows keep a null right_id."""
    rank = F.row_number().over(Window.partitionBy(*within, "sign").orderBy("id"))
    a = left.withColumn("__n", rank)
    b = right.withColumn("__n", rank).select(*within, "sign", "__n", F.col("id").alias("right_id"))
    return a.join(b, [*within, "sign", "__n"], "left").select(*within, F.col("id").alias("left_id"), "right_id")


def unwrap_degenerate(tables: DataFrame) -> DataFrame:
    """tables (…, html) with text: tables of one row or one column as paragraphs, others as they are."""
    rows = F.transform(T.all_of(F.col("html"), T.ROW, 1), lambda r: F.transform(T.all_of(r, T.CELL, 1), T.untag))
    widest = F.aggregate(F.col("__rows"), F.lit(0), lambda n, r: F.greatest(n, F.size(r)))
    real = (F.size("__rows") == 0) | ((F.size("__rows") >= 2) & (widest >= 2))
    # all cells in one array to decode, then by the places of their rows again
    stops = F.aggregate(F.col("__rows"), F.array(F.lit(0)), lambda at, r: F.array_append(at, F.element_at(at, -1) + F.size(r)))
    cells = lambda i: F.slice("__cells", F.get("__stops", i) + 1, F.get("__stops", i + 1) - F.get("__stops", i))
    lines = F.filter(F.transform("__rows", lambda _, i: T.strip(F.array_join(F.transform(cells(i), T.strip), " "))), lambda x: x != "")
    out = tables.withColumn("__rows", rows).withColumn("degenerate", ~real).withColumn("__stops", stops).withColumn("__cells", T.decoded_each(F.when(F.col("degenerate"), F.flatten("__rows"))))
    return out.withColumn("text", F.when(F.col("degenerate"), F.array_join(lines, "\n\n")).otherwise(F.col("html"))).drop("__rows", "__stops", "__cells", "html")


def unwrap_pages(pages: DataFrame) -> DataFrame:
    """pages (page, text) with their degenerate tables as paragraphs; the comment that names such a table's scan goes too."""
    # Fixed value: the comment before a table.
    table = r"(?is)(?:<!-- скан таблицы: [^>]*-->\n)?<table\b.*?</table>"
    found = pages.where(F.lower("text").contains("<table")).select("page", F.explode(F.array_distinct(T.all_of(F.col("text"), table))).alias("whole"))
    made = unwrap_degenerate(found.withColumn("html", F.regexp_extract("whole", T.TABLE, 0))).where("degenerate")
    # longest first: a table without comment may also stand in the one with it
    edits = made.groupBy("page").agg(F.sort_array(F.collect_list(F.struct(F.length("whole").alias("n"), "whole", "text")), asc=False).alias("__edits"))
    joined = pages.join(edits, "page", "left")
    folded = F.aggregate("__edits", F.col("text"), lambda acc, e: F.replace(acc, e["whole"], e["text"]))
    return joined.withColumn("text", F.when(F.col("__edits").isNull(), F.col("text")).otherwise(folded)).drop("__edits")


def orphan_crops(files: DataFrame, pages: DataFrame) -> DataFrame:
    """files (path) that no scan comment of pages (text) refers to."""
    used = pages.select(F.explode(T.all_of(F.col("text"), r"скан таблицы:\s*(\S+)", 1)).alias("path")).distinct()
    return files.join(used, "path", "left_anti")
