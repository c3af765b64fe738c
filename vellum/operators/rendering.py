"""Markdown of a text-layer engine's items, front matter, paragraphs and protected tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def render(items: DataFrame, titles: DataFrame) -> DataFrame:
    """book, pos, line of items (book, pos, kind, num, text, page, printed, path); titles: num, title of the contents.

    Chapter titles come from the contents where those have one. Otherwise a head right below a chapter (a page break
    between them allowed) is its title. Such a head has no line of its own."""
    by = Window.partitionBy("book").orderBy("pos")
    rows = items.join(titles.select(F.col("num").cast("string").alias("__num"), "title"), F.col("num") == F.col("__num"), "left").drop("__num")
    for n in (1, 2):
        rows = rows.withColumn(f"__k{n}", F.lag("kind", n).over(by)).withColumn(f"__n{n}", F.lead("kind", n).over(by)).withColumn(f"__t{n}", F.lead("text", n).over(by))
    owned = (F.col("kind") == "head") & F.coalesce((F.col("__k1") == "chapter") | ((F.col("__k1") == "page") & (F.col("__k2") == "chapter")), F.lit(False))
    below = F.when(F.col("__n1") == "head", F.col("__t1")).when((F.col("__n1") == "page") & (F.col("__n2") == "head"), F.col("__t2"))
    known = F.coalesce(F.col("title"), F.lit("")) != ""
    own = F.when(known, F.col("title")).otherwise(F.when(F.upper("text") == F.col("text"), T.title_case(F.col("text"))).otherwise(F.col("text")))
    dash = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(" — "), c)).otherwise("")
    chapter = F.concat(F.lit("\n## Chapter "), "num", dash(own), F.when(~known, dash(below)).otherwise(""))
    page = F.concat(F.lit("\n<!-- pdf page "), F.col("page").cast("string"), F.when(F.col("printed").isNotNull(), F.concat(F.lit(" | printed page "), F.col("printed").cast("string"))).otherwise(""), F.lit(" -->"))
    line = (
        F.when(F.col("kind") == "page", page).when(F.col("kind") == "fig", F.concat(F.lit("\n![Figure, page "), F.col("page").cast("string"), F.lit("]("), "path", F.lit(")")))
        .when(F.col("kind") == "chapter", chapter).when(F.col("kind") == "head", F.concat(F.lit("\n### "), "text"))
        .when(F.col("kind") == "sec", F.concat(F.lit("\n### Sec. "), "num", F.when(F.coalesce("text", F.lit("")) != "", F.concat(F.lit(" "), "text")).otherwise("")))
        .when(F.col("kind") == "caption", F.concat(F.lit("\n*"), "text", F.lit("*"))).otherwise(F.concat(F.lit("\n"), "text"))
    )
    return rows.where(~owned).select("book", "pos", line.alias("line"))


def front(title: Column, author: Column, note: str) -> Column:
    """Title, author and a note as the head of a book; a missing title or author has no line."""
    one = lambda c: T.strip(F.coalesce(c, F.lit("")))
    return F.concat(F.when(one(title) != "", F.concat(F.lit("# "), one(title), F.lit("\n"))).otherwise(""), F.when(one(author) != "", F.concat(F.lit("\n*"), one(author), F.lit("*\n"))).otherwise(""), F.lit(f"\n> {note}\n"))


def segments(texts: DataFrame) -> DataFrame:
    """id, n, is_table, text: a text (id, text) cut at its tables, so that steps can pass the tables by; they join back to it."""
    split = F.split("text", T.TABLE, -1)
    found = T.all_of(F.col("text"), T.TABLE)
    n = F.size(found)
    parts = F.transform(F.sequence(F.lit(0), 2 * n), lambda i: F.struct(i.alias("n"), (i % 2 == 1).alias("is_table"), F.when(i % 2 == 1, F.get(found, F.floor(i / 2).cast("int"))).otherwise(F.get(split, F.floor(i / 2).cast("int"))).alias("text")))
    return texts.withColumn("__p", F.explode(parts)).select("id", "__p.n", "__p.is_table", "__p.text")


def paragraphs(texts: DataFrame) -> DataFrame:
    """id, n, text, sep: the paragraphs of a text and the blank stretch after each; they join back to the text."""
    gap = r"\n\s*\n"
    parts, gaps = F.split("text", gap, -1), T.all_of(F.col("text"), gap)
    rows = texts.select("id", F.posexplode(parts).alias("n", "text"), gaps.alias("__g"))
    return rows.select("id", "n", "text", F.coalesce(F.get("__g", F.col("n")), F.lit("")).alias("sep"))


def chapter_blocks(blocks: DataFrame) -> DataFrame:
    """book, num of the chapters that header and title blocks (book, label, text) name, by number alone or with a title."""
    bare, full = rf"(?i)^(?:{T.CHAPTER_WORDS})\s+(\d+)\s*\.?$", rf"(?i)^(?:{T.CHAPTER_WORDS})\s+(\d+)[.\s]+\S.*$"
    t = T.strip(F.col("text"))
    num = F.coalesce(F.nullif(F.regexp_extract(t, bare, 1), F.lit("")), F.nullif(F.regexp_extract(t, full, 1), F.lit("")))
    rows = blocks.where(F.col("label").isin("header", "doc_title")).select("book", num.try_cast("int").alias("num"))
    return rows.where("num is not null").distinct()


def retry_schedule(attempt: Column) -> tuple[Column, Column]:
    """(temperature, seconds to wait after a network error) of an attempt from 0."""
    steps = F.array(*map(F.lit, (0.1, 0.1, 0.2, 0.3, 0.5, 0.8, 0.9, 1.0)))  # fixed values
    return F.element_at(steps, F.least(attempt, F.lit(7)).cast("int") + 1), F.least(F.pow(F.lit(2.0), attempt), F.lit(30.0))
