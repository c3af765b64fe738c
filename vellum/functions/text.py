"""Text functions as column expressions. Patterns are written so that Java's and RE2's engines agree."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

# Fixed values that results depend on.
TABLE = r"(?is)<table\b.*?</table>"
ROW = r"(?is)<tr[^>]*>(.*?)</tr>"
CELL = r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"
TAG = "<[^>]+>"
LEADERS = r"[.…](?:\s*[.…]){3,}"
VALUE = r"\.\d{3,5}|\d+/\d+"
PIPE_RULE = r"^\|[\s:|-]+\|$"
CHAPTER_WORDS = "Chapter|Глава|Kapitel|Chapitre|Capitolo|Capítulo|Capitulo|Hoofdstuk|Rozdział"
SECTION_WORDS = ["sec", "sect", "section", "разд", "раздел", "п", "пункт", "abschn", "abschnitt", "art", "статья"]
SMALL_WORDS = ["of", "and", "the", "a", "an", "to", "in", "on", "for", "with", "by", "or"]
CAUTION, UNSTABLE = "⚠", "≠"


def all_of(text: Column, pattern: str, group: int = 0) -> Column:
    """Every match of pattern in text, or the group of every match."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def strip(text: Column) -> Column:
    """Trim of all white space, not only of blanks."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def untag(text: Column, by: str = "") -> Column:
    return F.regexp_replace(text, TAG, by)


@F.pandas_udf(StringType())
def unescape(text: pd.Series) -> pd.Series:
    """HTML entities to characters, the full table."""
    return text.map(html.unescape, na_action="ignore")


@F.pandas_udf(ArrayType(StringType()))
def unescape_each(texts: pd.Series) -> pd.Series:
    return texts.map(lambda each: [x if x is None else html.unescape(x) for x in each], na_action="ignore")


def decoded(text: Column) -> Column:
    """Entities as characters; only texts with an ampersand go to Python, others keep the JVM's value."""
    return F.coalesce(unescape(F.when(text.contains("&"), text)), text)


def decoded_each(texts: Column) -> Column:
    """decoded() of every element of an array (a Python function has no place in a lambda)."""
    return F.coalesce(unescape_each(F.when(F.exists(texts, lambda x: x.contains("&")), texts)), texts)


def plain(cell: Column) -> Column:
    """A cell's text without tags and marks, entities decoded, trimmed."""
    return strip(F.regexp_replace(decoded(untag(cell)), f"[{CAUTION}{UNSTABLE}]", ""))


def norm(cell: Column) -> Column:
    """plain(), all quotes as the double quote, no white space."""
    return _normal(decoded(untag(cell)))


def norm_each(cells: Column) -> Column:
    """norm() of every element of an array."""
    return F.transform(decoded_each(F.transform(cells, untag)), _normal)


def _normal(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, f"[{CAUTION}{UNSTABLE}]", ""), "[”’']", '"'), r"(?U)\s+", "")


def signature_text(cell: Column) -> Column:
    """A cell for signatures: no tags, entities decoded, no caution marks (instability marks stay), no white space."""
    return F.regexp_replace(F.regexp_replace(decoded(untag(cell)), CAUTION, ""), r"(?U)\s+", "")


def reading(cell: Column) -> Column:
    """A cell for comparing readings: no tags, entities decoded, no caution marks, trimmed."""
    return strip(F.regexp_replace(decoded(untag(cell)), CAUTION, ""))


def key(text: Column) -> Column:
    """Letters and digits of a text in lower case, anything else as one blank."""
    return F.lower(F.trim(F.regexp_replace(untag(text, " "), r"[^\p{L}\p{N}]+", " ")))


def words(text: Column) -> Column:
    """ASCII letters and digits in lower case, split into words; entities are decoded."""
    return F.filter(F.split(F.lower(F.regexp_replace(decoded(untag(text, " ")), "[^A-Za-z0-9]+", " ")), " "), lambda w: w != "")


def strip_leaders(text: Column) -> Column:
    return F.regexp_replace(text, LEADERS, " ")


def count_leaders(text: Column) -> Column:
    return F.regexp_count(text, F.lit(LEADERS)).cast("long")


def clean(text: Column) -> Column:
    """Glyph repairs of recognised text: hyphens, quotes, blanks before punctuation."""
    # Signs and what stands for them.
    t = F.regexp_replace(text, "¬", "-")
    t = F.regexp_replace(t, r"\^\^|''|``", '"')
    t = F.regexp_replace(t, "[‘’‛´`]", "'")
    t = F.regexp_replace(t, "[“”]", '"')
    t = F.regexp_replace(t, r"(?U)\s+([,.;:])", "$1")
    return strip(F.regexp_replace(t, r"(?U)\s{2,}", " "))


def title_case(text: Column) -> Column:
    """Words lowered and their first letter raised, small words kept low unless they come first."""
    small = F.array(*map(F.lit, SMALL_WORDS))

    def one(w: Column, i: Column) -> Column:
        low = F.lower(w)
        return F.when((i > 0) & F.array_contains(small, low), low).otherwise(F.concat(F.upper(F.substring(low, 1, 1)), F.expr("''"), low.substr(F.lit(2), F.length(low))))

    return F.array_join(F.transform(F.filter(F.split(text, r"(?U)\s+"), lambda w: w != ""), one), " ")


def canonical_images(text: Column) -> Column:
    """Every image tag with a quoted src as <img src="…" alt="Image" />."""
    return F.regexp_replace(text, r'(?i)<img\b[^>]*?src\s*=\s*"([^"]+)"[^>]*?/?>', '<img src="$1" alt="Image" />')


def plain_math(text: Column) -> Column:
    """Simple LaTeX as readable text: arrays flattened, signs replaced in a fixed order, dollar signs unwrapped."""
    cells = lambda row: F.array_join(F.filter(F.transform(F.split(row, "&"), lambda c: F.regexp_replace(c, r"^[ {}]+|[ {}]+$", "")), lambda c: c != ""), "  ")
    rows = lambda body: F.array_join(F.filter(F.transform(F.split(body, r"\\\\"), cells), lambda r: r != ""), " ")
    pattern = r"(?s)\\begin\{array\}\{[^}]*\}(.*?)\\end\{array\}"
    t = F.aggregate(
        F.arrays_zip(all_of(text, pattern).alias("whole"), all_of(text, pattern, 1).alias("body")),
        text,
        lambda acc, m: F.replace(acc, m["whole"], rows(m["body"])),
    )
    # Replacements in order.
    for sign, by in (
        (r"\^\{\\circ\}", "°"), (r"\^\{\\prime\\prime\}", "″"), (r"\^\{\\prime\}", "′"), (r"\\mathrm\{~?([^{}]*?)~?\}", "$1"), (r"\\mathbf\{([^{}]*?)\}", "$1"),
        (r"\\mathit\{([^{}]*?)\}", "$1"), (r"\\frac\{([^{}]*)\}\{([^{}]*)\}", "($1)/($2)"), (r"\\quad|\\,|\\;", " "), (r"\\pm", "±"), (r"\\times", "×"),
        (r"\\prime", "′"), (r"\\circ", "°"), ("''", "″"), ("~", " "),
    ):
        t = F.regexp_replace(t, sign, by)
    wrapped = r"(?s)\${1,2}\s*(.*?)\s*\${1,2}"
    return F.aggregate(
        F.arrays_zip(all_of(t, wrapped).alias("whole"), all_of(t, wrapped, 1).alias("body")),
        t,
        lambda acc, m: F.replace(acc, m["whole"], F.regexp_replace(m["body"], r"\s+", " ")),
    )


def front_matter(text: Column) -> Column:
    """STRUCT of the five known keys of a leading --- block, and the body.

    A flag is true for true or yes; the rotation is 0 unless it is a whole number; null, none and nothing are null."""
    closed = text.startswith("---\n") & (F.locate("\n---", text, 5) > 0)
    end = F.locate("\n---", text, 5)
    head = F.when(closed, text.substr(F.lit(5), end - 5)).otherwise("")
    body = F.when(closed, strip(text.substr(end + 4, F.length(text)))).otherwise(strip(text))

    def value(name: str) -> Column:
        # the last line of a key counts
        lines = F.filter(F.split(head, "\n"), lambda x: F.regexp_like(x, F.lit(rf"^\s*{name}\s*:")))
        return F.when(F.size(lines) > 0, strip(F.regexp_replace(F.element_at(lines, F.greatest(F.size(lines), F.lit(1))), "^[^:]*:", "")))

    flag = lambda n: F.when(value(n).isNotNull(), F.lower(value(n)).isin("true", "yes"))
    turn = value("rotation_correction")
    language = value("primary_language")
    return F.struct(
        F.when(~language.isin("null", "none", ""), language).alias("primary_language"),
        flag("is_rotation_valid").alias("is_rotation_valid"),
        F.when(turn.rlike("^-*[0-9]+$"), F.expr("0") + turn.try_cast("int")).when(turn.isNotNull(), F.lit(0)).alias("rotation_correction"),
        flag("is_table").alias("is_table"),
        flag("is_diagram").alias("is_diagram"),
        body.alias("body"),
    )


def section_number(title: Column) -> Column:
    """STRUCT<a, b> of a title's leading section number, or null. Its prefix must be empty or a section word."""
    pattern = r"^(\S{0,12}?)[.\s]*(\d+)\.(\d+)"
    t = strip(title)
    # The pattern above, and the signs around a prefix.
    prefix = F.lower(F.regexp_replace(F.regexp_extract(t, pattern, 1), "^[.§ ]+|[.§ ]+$", ""))
    fits = F.regexp_like(t, F.lit(pattern)) & ((prefix == "") | prefix.isin(SECTION_WORDS))
    return F.when(fits, F.struct(F.regexp_extract(t, pattern, 2).cast("int").alias("a"), F.regexp_extract(t, pattern, 3).cast("int").alias("b")))


def looks_heading(text: Column) -> Column:
    """Whether the text without tags is not empty and doesn't start in lower case."""
    t = strip(untag(F.coalesce(text, F.lit(""))))
    return (t != "") & ~F.regexp_like(t, F.lit(r"^\p{Ll}"))


def chapter_number(title: Column) -> Column:
    """The number of a chapter heading line, or null."""
    # Fixed value: the form of such a line.
    return F.regexp_extract(title, rf"(?i)^(?:{CHAPTER_WORDS})\s+(\d+)\.", 1).try_cast("int")


def line_class(text: Column) -> Column:
    """STRUCT<kind, num, title> of a cleaned line: chapter, sec, caption, head, body, or null kind for nothing."""
    t = clean(text)
    # Forms of chapter, section and caption lines.
    chapter, sec, caption = r"(?i)^Chapter\s+([0-9]{1,2})\b\s*(.*)$", r"(?i)^Sec[.,;:^]{0,2}\s*(\d{1,2})\s*[.,:;^]\s*(\d{1,2})\b\.?\s*(.*)$", r"(?i)^(Fig|PLATE|Plate|Table)\b\.?\s*\d"
    letters, upper = F.length(F.regexp_replace(t, r"[^\p{L}]", "")), F.length(F.regexp_replace(t, r"[^\p{Lu}]", ""))
    edge = lambda c, of: F.regexp_replace(c, f"^[{of}]+|[{of}]+$", "")
    made = lambda kind, num, title: F.struct(F.lit(kind).alias("kind"), num.alias("num"), title.alias("title"))
    none = F.lit(None).cast("string")
    return (
        F.when(t == "", F.struct(none.alias("kind"), none.alias("num"), F.lit("").alias("title")))
        .when(F.regexp_like(t, F.lit(chapter)) & (F.length(t) < 80), made("chapter", F.regexp_extract(t, chapter, 1), edge(F.regexp_extract(t, chapter, 2), " .\\-")))
        .when(F.regexp_like(t, F.lit(sec)), made("sec", F.concat(F.regexp_extract(t, sec, 1), F.lit("."), F.regexp_extract(t, sec, 2)), edge(F.regexp_extract(t, sec, 3), " .")))
        .when(F.regexp_like(t, F.lit(caption)), made("caption", none, t))
        .when((F.length(t) < 75) & (upper > letters * F.lit(0.8)) & (letters > 3), made("head", none, title_case(t)))
        .otherwise(made("body", none, t))
    )


def is_folio(text: Column, y0: Column, y1: Column, bottom: Column) -> Column:
    """Whether a line is a page number: roman or up to three digits, in the last 28 points or the first 45."""
    # The pattern and the two distances.
    return F.regexp_like(strip(text), F.lit(r"(?i)^[ivxlcdm]{1,7}$|^\d{1,3}$")) & ((y0 > bottom - 28) | (y1 < 45))


def toc_intact(content: Column, chapters: Column) -> Column:
    """Whether a contents page lists at least half of the chapters (two at least); unknown counts are intact."""
    entries = F.size(F.filter(F.split(content, "\n"), lambda x: F.length(strip(strip_leaders(x))) > 3))
    return F.when(F.coalesce(chapters, F.lit(0)) == 0, True).otherwise(entries >= F.greatest(F.lit(2), F.floor(chapters / 2)))


def joined_spans(spans: Column) -> Column:
    """Text of ARRAY<STRUCT<x0, text>> in order of x0, blanks put between and collapsed."""
    ordered = F.array_sort(spans)
    glued = F.aggregate(ordered, F.lit(""), lambda acc, s: F.when((acc != "") & ~acc.endswith(" ") & ~s["text"].startswith(" "), F.concat(acc, F.lit(" "), s["text"])).otherwise(F.concat(acc, s["text"])))
    return strip(F.regexp_replace(glued, r"(?U)\s+", " "))


def glue(before: Column, after: Column) -> Column:
    """Two lines as one: a hyphen goes if the next line starts in lower case, a soft one always."""
    cut = (F.regexp_like(before, F.lit("[¬\\-‐—]$")) & F.regexp_like(after, F.lit(r"^\p{Ll}"))) | before.endswith("¬")
    return F.when(cut, F.concat(before.substr(F.lit(1), F.length(before) - 1), after)).otherwise(F.concat(before, F.lit(" "), after))


def image_names(markdown: Column, page: Column, ids: Column) -> Column:
    """Links to the images of a page renamed to images/pNNNN_id, with .png where the id has no known extension."""

    def name(i: Column) -> Column:
        known = F.regexp_like(F.lower(i), F.lit(r"\.(png|jpg|jpeg|webp|gif)$"))
        number = page.cast("string")
        return F.concat(F.lit("images/p"), F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number), F.lit("_"), i, F.when(known, "").otherwise(".png"))

    return F.aggregate(ids, markdown, lambda acc, i: F.replace(acc, F.concat(F.lit("]("), i, F.lit(")")), F.concat(F.lit("]("), name(i), F.lit(")"))))
