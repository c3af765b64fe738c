"""Golden cases of text functions and of the operators that read markup with entities."""

import html

from pyspark.sql import functions as F

from vellum.functions import text as T
from vellum.operators import confidence, geometry, tables, votes
from vellum.sources import runs


def of(spark, texts, function):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r.x for r in df.select("i", function(F.col("text")).alias("x")).orderBy("i").collect()]


def test_entities_are_decoded_where_cells_are_compared(spark):
    cells = ["a &amp; b", "<b>x&nbsp;</b>&#8199;y \u26a0", "plain \u2260", None, "&lt;td&gt; &notit; &#x41;"]
    assert of(spark, cells, T.plain) == ["a & b", "x\u00a0\u2007y", "plain", None, "<td> \u00acit; A"]
    assert of(spark, cells, T.norm) == ["a&b", "xy", "plain", None, "<td>\u00acit;A"]
    assert of(spark, cells, T.reading) == ["a & b", "x\u00a0\u2007y", "plain \u2260", None, "<td> \u00acit; A"]
    assert of(spark, cells, T.signature_text) == ["a&b", "xy", "plain\u2260", None, "<td>\u00acit;A"]
    assert of(spark, ["Tom&amp;Jerry &eacute;1"], T.words) == [["tom", "jerry", "1"]]


def test_entity_text_is_that_of_a_loop(spark):
    texts = ["", "&", "&amp;amp;", "a&ltb", "&#128;&#0;&#xD800;", "&frac12; x", "no entity", None]
    assert of(spark, texts, T.decoded) == [None if t is None else html.unescape(t) for t in texts]


def test_votes_join_across_spellings(spark):
    base = spark.createDataFrame([(1, 1, "A &amp; B")], "page int, pos int, text string")
    passes = spark.createDataFrame([(p, 1, 1, "A & B") for p in (2, 3)], "pass int, page int, pos int, text string")
    assert [r.unstable for r in votes.vote(base, passes, ["page"], 2).collect()] == [False]


def test_cells_in_order_and_pipe_cells(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>a&amp;</td><td>b</td></tr><tr><th>c</th></tr></table>\n| x &lt; | 'y' |\n|---|---|\n")], "page int, text string")
    got = [(r.row_no, r.col_no, r.cell_no, r.text) for r in tables.html_cells(pages).orderBy("cell_no").collect()]
    assert got == [(0, 0, 0, "a&"), (0, 1, 1, "b"), (1, 0, 2, "c")]
    assert [r.cells for r in tables.pipe_rows(pages).collect()] == [["x<", '"y"']]


def test_degenerate_tables_leave_with_their_comments(spark):
    one, two = "<table><tr><td>a&nbsp;</td><td>&lt;b</td></tr></table>", "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>"
    mark = "<!-- \u0441\u043a\u0430\u043d \u0442\u0430\u0431\u043b\u0438\u0446\u044b: a.png -->\n"
    rows = [(1, f"x\n{mark}{one}\ny {one} z\n{mark}{two}"), (2, "none"), (3, None)]
    got = {r.page: r.text for r in tables.unwrap_pages(spark.createDataFrame(rows, "page int, text string")).collect()}
    assert got == {1: f"x\na <b\ny a <b z\n{mark}{two}", 2: "none", 3: None}


def test_marks_are_written_behind_suspicious_cells(spark):
    cells = spark.createDataFrame([(1, "Tom &amp; Co"), (2, "other"), (3, "Tom &amp; Co")], "id int, text string")
    answers = spark.createDataFrame([(7, "says Tom & Co here")], "response_id int, response string")
    spans = spark.createDataFrame([(7, 5, 8, -2.0)], "response_id int, start int, end int, lp double")
    got = {r.id: r.text for r in confidence.mark_cells(cells, answers, spans).collect()}
    assert got == {1: "Tom &amp; Co \u26a0", 2: "other", 3: "Tom &amp; Co \u26a0"}


def test_clean_and_line_classes(spark):
    assert of(spark, ["a\u00a0 .", "x\n", " ^^q'' \u2018", "tail\u2003"], T.clean) == ["a.", "x", '"q" \'', "tail"]
    kinds = of(spark, ["Chapter 3\n", "CAPS LINE\n", "Sec. 1.2 t\n"], lambda c: T.line_class(c)["kind"])
    assert kinds == ["chapter", "head", "sec"]


def test_semicolons_stay_in_mathematics(spark):
    assert of(spark, ["a; b; and $x\\;y$", "p\\,q\\quad r;"], T.plain_math) == ["a; b; and x y", "p q  r;"]


def test_side_notes_count_for_columns(spark):
    boxes = [(1, i, la, 0.9, x, 10.0 * i, x + 40, 10.0 * i + 5) for i, (la, x) in enumerate([("text", 0.0), ("text", 1.0), ("aside_text", 100.0), ("text", 101.0)])]
    df = spark.createDataFrame(boxes, "page int, i int, label string, score double, x0 double, y0 double, x1 double, y1 double")
    assert [r.gutter for r in geometry.column_gutter(df, 150.0).collect()] == [70]


def test_printed_contents(spark):
    pages = [(0, "Contents\n 1. Sliues and ways . . . 12\n2. No leaders 30\n1. Second 4"), (1, "nothing\n3. Not here 5"), (9, "CONTENTS\n4. Too late 7")]
    got = {r.num: r.title for r in runs.contents_titles(spark.createDataFrame(pages, "page int, text string")).collect()}
    assert got == {1: "Slides and ways", 2: "No leaders"}


def test_names_of_images_on_late_pages(spark):
    df = spark.createDataFrame([(12345,), (7,)], "page int")
    got = [r.x for r in df.select(T.image_names(F.lit("![a](x)"), F.col("page"), F.array(F.lit("x"))).alias("x")).collect()]
    assert got == ["![a](images/p12345_x.png)", "![a](images/p0007_x.png)"]
