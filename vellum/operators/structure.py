"""Structure of recognised volumes: lines, headings, ranges, order, hyphens, lists, chapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

WORD_END = r"\p{L}{2}-$"
HEADING = r"^(#{1,6})\s+(\S.*)$"


def lines_of(volumes: DataFrame) -> DataFrame:
    """volumes (book, text) → book, line (from 1), text."""
    return volumes.select("book", F.posexplode(F.split("text", "\n")).alias("line", "text")).withColumn("line", F.col("line") + 1)


def headings(lines: DataFrame) -> DataFrame:
    """book, line, role (chapter or sub), title, num, depth of the heading lines."""
    hits = lines.where(F.col("text").startswith("#") & F.regexp_like("text", F.lit(HEADING)))
    title = F.regexp_extract("text", HEADING, 2)
    num = T.chapter_number(title)
    return hits.select("book", "line", F.when(num.isNotNull(), "chapter").otherwise("sub").alias("role"), T.strip(title).alias("title"), num.alias("num"), F.length(F.regexp_extract("text", HEADING, 1)).alias("depth"))


def ranges(heads: DataFrame, last: DataFrame) -> DataFrame:
    """heads (book, line, role) with end: a chapter ends before the next chapter, others before the next heading; else at
    the last line of the book (last: book, n_lines)."""
    after = Window.partitionBy("book").orderBy("line")
    chapters = F.min(F.when(F.col("role") == "chapter", F.col("line"))).over(after.rowsBetween(1, Window.unboundedFollowing))
    following = F.when(F.col("role") == "chapter", chapters).otherwise(F.lead("line").over(after))
    return heads.withColumn("__next", following).join(last, "book").withColumn("end", F.coalesce(F.col("__next") - 1, F.col("n_lines"))).drop("__next", "n_lines")


def disorder(heads: DataFrame) -> DataFrame:
    """heads (book, line, role, num, title) of numbered sections with bad: out of their chapter, or below an earlier number."""
    by = Window.partitionBy("book").orderBy("line")
    marked = heads.withColumn("__n", T.section_number(F.col("title"))).withColumn("__chapter", F.when(F.col("role") == "chapter", F.col("num")))
    marked = marked.withColumn("__group", F.count("__chapter").over(by)).withColumn("__in", F.coalesce(F.last("__chapter", ignorenulls=True).over(by), F.lit(0)))
    value = F.when(F.col("role") == "chapter", F.struct(F.col("num").alias("a"), F.lit(0).alias("b"))).otherwise(F.col("__n"))
    before = F.max(value).over(Window.partitionBy("book", "__group").orderBy("line").rowsBetween(Window.unboundedPreceding, -1))
    zero = F.struct(F.lit(0).alias("a"), F.lit(0).alias("b"))
    out = marked.withColumn("__before", F.coalesce(before, zero)).where((F.col("role") != "chapter") & F.col("__n").isNotNull())
    return out.select("book", "line", "title", ((F.col("__n.a") != F.col("__in")) | (F.col("__n") < F.col("__before"))).alias("bad"))


def contents(heads: DataFrame, last: DataFrame) -> DataFrame:
    """A line of a table of contents per heading: book, line, entry.

    Indented unless a chapter, a first-level heading or before the first chapter; a last chapter that reaches the end
    of the book and has headings after it says so; headings out of order are marked."""
    whole = Window.partitionBy("book")
    ended = ranges(heads, last).join(last, "book")
    bad = disorder(heads).where("bad").select("book", "line", F.lit(True).alias("__bad"))
    rows = ended.withColumn("__first", F.min(F.when(F.col("role") == "chapter", F.col("line"))).over(whole)).withColumn("__last", F.max("line").over(whole)).join(bad, ["book", "line"], "left")
    flush = (F.col("role") == "chapter") | (F.col("depth") == 1) | F.coalesce(F.col("line") < F.col("__first"), F.lit(False))
    rest = (F.col("role") == "chapter") & (F.col("end") == F.col("n_lines")) & (F.col("__last") > F.col("line"))
    entry = F.concat(
        F.when(flush, "").otherwise("    "), F.lit("- "), "title", F.lit("  — строки "), F.col("line").cast("string"), F.lit("–"), F.col("end").cast("string"),
        F.when(rest, "  (до конца файла: задняя часть книги входит сюда же)").otherwise(""), F.when(F.col("__bad"), "   <!-- порядок нарушен -->").otherwise(""),
    )
    return rows.select("book", "line", entry.alias("entry"))


def demote_lists(lines: DataFrame) -> DataFrame:
    """lines with text: a numbered heading becomes a list item if the nearest line that isn't blank, within three lines
    before or after, is the item of the next or previous number."""
    head, item = r"^#{1,6}\s+(\d+)\.\s+(\S.*)$", r"^#{0,6}\s*(\d+)\.\s+\S"
    by = Window.partitionBy("book").orderBy("line")
    bare = T.strip(F.col("text"))
    full = F.when(bare != "", F.struct("line", bare.alias("text")))
    rows = lines.withColumn("__full", full)
    rows = rows.withColumn("__b", F.last("__full", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1))).withColumn("__a", F.first("__full", ignorenulls=True).over(by.rowsBetween(1, Window.unboundedFollowing)))
    k = F.regexp_extract("text", head, 1).try_cast("long")
    near = lambda c, d: F.coalesce((F.abs(F.col(f"{c}.line") - F.col("line")) <= 3) & (F.regexp_extract(f"{c}.text", item, 1).try_cast("long") == k + d), F.lit(False))
    demoted = k.isNotNull() & (near("__a", 1) | near("__a", -1) | near("__b", 1) | near("__b", -1))
    return rows.select("book", "line", F.when(demoted, F.regexp_replace("text", head, "$1. $2")).otherwise(F.col("text")).alias("text"), demoted.alias("demoted"))


def join_hyphens(lines: DataFrame) -> DataFrame:
    """book, line (of the first part), text, n_joined: words that a line break split are whole again, to the fixed point.

    Inside a line an escaped hyphen between letters goes, tags around it stay. Across lines, blank ones between them
    drop out. Over lines that aren't blank, a line joins the one before it if it starts in lower case and the line
    before ends in two letters and a hyphen, or was itself joined and is a single letter and a hyphen (the joined word
    then ends so). The second case only concerns runs of such lines: the first one of a run decides for all."""
    soft = F.regexp_replace("text", r"(\p{L})((?:</?\w[^>]*>)*)\\-(\p{L})", "$1$2$3")
    by = Window.partitionBy("book").orderBy("line")
    rows = lines.withColumn("text", soft).withColumn("__blank", T.strip(F.col("text")) == "")
    full = rows.where(~F.col("__blank")).withColumn("__lead", F.regexp_replace("text", r"(?U)^\s+", ""))
    full = full.withColumn("__low", F.regexp_like("__lead", F.lit(r"^\p{Ll}"))).withColumn("__own", F.regexp_like("text", F.lit(WORD_END))).withColumn("__own_lead", F.regexp_like("__lead", F.lit(WORD_END)))
    full = full.withColumn("__one", F.regexp_like("__lead", F.lit(r"^\p{L}-$")))
    before = lambda c: F.coalesce(F.lag(c).over(by), F.lit(False))
    full = full.withColumn("__low_before", before("__low")).withColumn("__own_before", before("__own")).withColumn("__one_before", before("__one"))
    # a line joins for certain, or as the line before does, or not at all
    kind = F.when(F.col("__low") & F.col("__own_before"), 1).when(F.col("__low") & F.col("__one_before"), F.lit(None).cast("int")).otherwise(0)
    decided = full.withColumn("__kind", kind)
    decided = decided.withColumn("__join", F.coalesce(F.last("__kind", ignorenulls=True).over(by), F.lit(0)))
    island = decided.withColumn("__island", F.sum(1 - F.col("__join")).over(by))
    part = F.struct("line", F.when(F.col("__join") == 1, F.col("__lead")).otherwise(F.col("text")).alias("text"))
    fused = island.groupBy("book", "__island").agg(F.array_sort(F.collect_list(part)).alias("p"))
    # all parts but the last end in the hyphen that goes
    text = F.concat(F.array_join(F.transform(F.slice("p", 1, F.size("p") - 1), lambda x: F.regexp_replace(x["text"], "-$", "")), ""), F.element_at("p", -1)["text"])
    whole = fused.select("book", F.col("p")[0]["line"].alias("line"), F.element_at("p", -1)["line"].alias("__end"), text.alias("text"), (F.size("p") - 1).cast("long").alias("n_joined"))
    blanks = rows.where("__blank").select("book", F.col("line").alias("__line"), "text")
    spans = whole.where("n_joined > 0").select(F.col("book").alias("__b"), "line", "__end")
    # a blank line inside a joined stretch is gone; stretches are within one book
    kept = blanks.join(spans, (F.col("book") == F.col("__b")) & (F.col("__line") > F.col("line")) & (F.col("__line") < F.col("__end")), "left_anti")
    return whole.drop("__end").unionByName(kept.select("book", F.col("__line").alias("line"), "text", F.lit(0).cast("long").alias("n_joined")))


def merge_bodies(items: DataFrame, across_pages: bool = False) -> DataFrame:
    """items (book, pos, kind, text): a body follows into the body right before it if that ends in a hyphen, or lacks a
    sentence end and this one starts in lower case. across_pages passes over page items between them."""
    rows = items.where("kind <> 'page'") if across_pages else items
    by = Window.partitionBy("book").orderBy("pos")
    # the merged tail is the tail of the last part
    before, kind = F.lag("text").over(by), F.lag("kind").over(by)
    open_end = F.regexp_like(before, F.lit("[-¬]$")) | (~F.regexp_like(before, F.lit("[.!?:;\"')\\]]$")) & F.regexp_like("text", F.lit(r"^\p{Ll}")))
    joins = (F.col("kind") == "body") & (kind == "body") & open_end
    island = rows.withColumn("__new", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).withColumn("__island", F.sum("__new").over(by))
    parts = island.groupBy("book", "__island").agg(F.array_sort(F.collect_list(F.struct("pos", "kind", "text"))).alias("p"))
    text = F.aggregate(F.slice("p", 2, F.greatest(F.size("p") - 1, F.lit(0))), F.col("p")[0]["text"], lambda acc, x: T.glue(acc, x["text"]))
    return parts.select("book", F.col("p")[0]["pos"].alias("pos"), F.col("p")[0]["kind"].alias("kind"), text.alias("text"), F.size("p").cast("long").alias("n_parts"))


def carry_folio(items: DataFrame) -> DataFrame:
    """items (book, pos, folio or null) with printed: the last folio seen up to each item."""
    return items.withColumn("printed", F.last("folio", ignorenulls=True).over(Window.partitionBy("book").orderBy("pos")))


def whole_tables(lines: DataFrame, by: list[str]) -> DataFrame:
    """lines (by…, line, text) with the lines of a table as one, under its first line's number.

    A table ends at the first </table> behind its start; without one it is no table. A line's last tag says whether the
    next one is inside a table."""
    order = Window.partitionBy(*by).orderBy("line")
    last = F.try_element_at(T.all_of(F.lower("text"), r"<table\b|</table>"), F.lit(-1))
    tagged = lines.withColumn("__tag", last).withColumn("__closes", F.max(F.when(F.lower("text").contains("</table>"), F.col("line"))).over(Window.partitionBy(*by)))
    before = F.last("__tag", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    inside = F.coalesce((before == "<table") & (F.col("line") <= F.col("__closes")), F.lit(False))
    rows = tagged.withColumn("__first", F.when(~inside, F.col("line"))).withColumn("__first", F.last("__first", ignorenulls=True).over(order))
    text = F.array_join(F.array_sort(F.collect_list(F.struct("line", "text")))["text"], "\n")
    return rows.groupBy(*by, F.col("__first").alias("line")).agg(text.alias("text"), F.max("line").alias("last"))


def measures(lines: DataFrame) -> DataFrame:
    """One row of counts per book over its lines; what stands in tables, over several lines too, is no heading or word."""
    whole = whole_tables(lines, ["book"]).withColumn("body", F.regexp_replace("text", T.TABLE, ""))
    n = lambda p: F.sum(F.regexp_count("text", F.lit(p))).cast("long")
    word = F.size(F.filter(F.split(T.untag(F.col("body"), " "), r"(?U)\s+"), lambda w: w != ""))
    title, head = F.regexp_extract("body", HEADING, 2), F.col("body").startswith("#") & F.regexp_like("body", F.lit(HEADING))
    chapter = T.chapter_number(title).isNotNull()
    counts = whole.groupBy("book").agg(
        F.sum(word).cast("long").alias("words"), n(T.TABLE).alias("tables"), n("скан таблицы:").alias("scans"), n("<img").alias("images"),
        F.count_if(F.regexp_like("body", F.lit(r"^(?:<[^>]+>\s*)*Fig\."))).alias("captions"), n(T.CAUTION).alias("cautions"), n(T.UNSTABLE).alias("unstable"), n("<mark").alias("marks"),
        n("(?md)" + WORD_END).alias("open_hyphens"), F.count_if(head & chapter).alias("chapters"), F.count_if(head).alias("headings"),
        F.count_if(head & ~chapter & T.section_number(T.strip(title)).isNotNull()).alias("numbered"),
        F.size(F.array_distinct(F.flatten(F.collect_set(T.all_of(F.col("body"), r"Fig\.\s*\d+\.\d+[a-z]?"))))).cast("long").alias("figures"),
    )
    heads = headings(whole.select("book", "line", F.col("body").alias("text")))
    bad = disorder(heads).groupBy("book").agg(F.count_if("bad").alias("disorder"))
    return counts.join(bad, "book", "left").na.fill(0, ["disorder"])


def chapter_map(lines: DataFrame) -> DataFrame:
    """book, line, end, words, tables, marks of each chapter; clean chapters have neither tables nor marks."""
    by = Window.partitionBy("book").orderBy("line")
    num = T.chapter_number(F.regexp_extract("text", r"^#{1,6}\s+(\S.*)$", 1))
    rows = lines.withColumn("__start", F.when(num.isNotNull(), F.col("line"))).withColumn("__chapter", F.last("__start", ignorenulls=True).over(by)).where("__chapter is not null")
    rows = whole_tables(rows.select("book", "__chapter", "line", "text"), ["book", "__chapter"])
    n = lambda p: F.sum(F.regexp_count("text", F.lit(p))).cast("long")
    word = F.size(F.filter(F.split(T.untag(F.regexp_replace("text", T.TABLE, ""), " "), r"(?U)\s+"), lambda w: w != ""))
    out = rows.groupBy("book", F.col("__chapter").alias("start")).agg(F.max("last").alias("end"), F.sum(word).cast("long").alias("words"), n(T.TABLE).alias("tables"), n(f"[{T.CAUTION}{T.UNSTABLE}]|<mark").alias("marks"))
    return out.withColumn("clean", (F.col("tables") == 0) & (F.col("marks") == 0))


def table_queue(lines: DataFrame) -> DataFrame:
    """book, line, scan of each line with a table: the nearest scan link before it that no table before took."""
    by = Window.partitionBy("book").orderBy("line")
    link = F.nullif(F.regexp_extract("text", r"скан таблицы:\s*(\S+)", 1), F.lit(""))
    rows = lines.withColumn("__link", link).withColumn("__table", F.when(F.col("text").contains("<table"), 1).otherwise(0))
    # links since the previous table: tables counted up to the line before
    rows = rows.withColumn("__done", F.sum("__table").over(by) - F.col("__table"))
    last = F.last("__link", ignorenulls=True).over(Window.partitionBy("book", "__done").orderBy("line"))
    return rows.withColumn("scan", last).where("__table = 1").select("book", "line", "scan")


def caption_binding(items: DataFrame) -> DataFrame:
    """Captions (book, pos, label = figure_title, text) with bound: the last text before them that isn't blank has an image."""
    by = Window.partitionBy("book").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last(F.when(T.strip(F.col("text")) != "", F.col("text")), ignorenulls=True).over(by)
    return items.withColumn("__before", before).where("label = 'figure_title'").select("book", "pos", F.coalesce(F.col("__before").contains("<img"), F.lit(False)).alias("bound"))


def missing_numbers(heads: DataFrame) -> DataFrame:
    """book, num: chapter numbers from 1 to the largest that have no heading."""
    got = heads.where("role = 'chapter'").select("book", "num").distinct()
    want = got.groupBy("book").agg(F.max("num").alias("m")).where("m >= 1").select("book", F.explode(F.sequence(F.lit(1), F.col("m"))).alias("num"))
    return want.join(got, ["book", "num"], "left_anti")


def running_headers(headers: DataFrame, n_pages: DataFrame) -> DataFrame:
    """Texts of header blocks (text) that come at least max(3, min(20, pages / 3)) times; blocks count, not pages."""
    counts = headers.select(T.strip(F.col("text")).alias("text")).where("text <> ''").groupBy("text").agg(F.count(F.lit(1)).alias("n"))
    limit = n_pages.select(F.greatest(F.lit(3), F.least(F.lit(20), F.floor(F.col("n_pages") / 3))).alias("limit"))  # one row
    return counts.crossJoin(F.broadcast(limit)).where("n >= limit").select("text", "n")


def drop_lines(lines: DataFrame, headers: DataFrame) -> DataFrame:
    """lines (…, text) without those that are a line of a running header."""
    bad = headers.select(F.explode(F.split("text", "\n")).alias("__t")).select(T.strip(F.col("__t")).alias("__t")).where("__t <> ''").distinct()
    return lines.join(bad, T.strip(F.col("text")) == F.col("__t"), "left_anti")


def label_coverage(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """label, found, total. found: what (chapter, chapter_from_title, top, title, section, caption, contents), n.

    A chapter uses up two header blocks, its number and its title; chapters that came as doc_title count there."""
    total = blocks.where(F.col("label").isin("doc_title", "header", "paragraph_title", "figure_title", "content")).groupBy("label").agg(F.count(F.lit(1)).alias("total"))
    share = F.expr("CASE what WHEN 'chapter' THEN 2 ELSE 1 END")
    to = F.expr("CASE what WHEN 'chapter' THEN 'header' WHEN 'top' THEN 'header' WHEN 'title' THEN 'doc_title' WHEN 'chapter_from_title' THEN 'doc_title' WHEN 'section' THEN 'paragraph_title' WHEN 'caption' THEN 'figure_title' WHEN 'contents' THEN 'content' END")
    got = found.select(to.alias("label"), (F.col("n") * share).alias("n")).groupBy("label").agg(F.sum("n").alias("found"))
    return total.join(got, "label", "left").select("label", F.coalesce("found", F.lit(0)).cast("long").alias("found"), "total")
