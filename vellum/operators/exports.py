"""Counts of an export against its source, instance states, and assembled reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def mark_counts(texts: DataFrame) -> DataFrame:
    """id, what, n of tables, images and both marks in each text (id, text)."""
    n = lambda p: F.regexp_count("text", F.lit(p)).cast("long")
    counts = F.map_from_arrays(F.array(*map(F.lit, ("tables", "images", "cautions", "unstable"))), F.array(n("(?i)<table"), n("(?i)<img |<binary "), n(T.CAUTION), n(T.UNSTABLE)))
    return texts.select("id", F.explode(counts).alias("what", "n"))


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """id, what, want, have, short: what an export lacks of its source. Both: id, what, n."""
    t = target.select("id", "what", F.col("n").alias("have"))
    rows = source.join(t, ["id", "what"], "left").select("id", "what", F.col("n").alias("want"), F.coalesce("have", F.lit(0)).cast("long").alias("have"))
    return rows.withColumn("short", F.col("have") < F.col("want"))


def states(wanted: DataFrame, listed: DataFrame, asked: DataFrame) -> DataFrame:
    """id, state: alive, absent, or unknown where the listing (host) couldn't be asked; unknown counts as alive.

    wanted: id, host; listed: id; asked: host, ok."""
    rows = wanted.join(listed.select("id").distinct().withColumn("__l", F.lit(True)), "id", "left").join(asked, "host", "left")
    return rows.select("id", F.when(F.col("__l"), "alive").when(F.col("ok"), "absent").otherwise("unknown").alias("state"))


def own_instances(instances: DataFrame, prefix: str) -> DataFrame:
    """Instances whose label marks them as ours."""
    return instances.where(F.col("label").startswith(prefix))


def label(prefix: str, name: str = "job", most: int = 28):
    """A label of a job: the prefix and the first characters of its name."""
    return F.concat(F.lit(prefix), F.substring(name, 1, most))


def ssh_target(rows: DataFrame) -> DataFrame:
    """rows (direct, proxy) with target: the direct address, else the host and port in the proxy's URL."""
    return rows.withColumn("target", F.coalesce("direct", F.nullif(F.regexp_extract("proxy", r"ssh://(?:[^@/]*@)?([^/]+)", 1), F.lit(""))))


def link_speed(probes: DataFrame) -> DataFrame:
    """probes (ok, sent, got, seconds) with mbit_s: 0 where the probe failed or less than half came."""
    good = F.col("ok") & (F.col("got") * 2 >= F.col("sent")) & (F.col("seconds") > 0)
    return probes.withColumn("mbit_s", F.when(good, F.col("got") * F.lit(8.0) / F.lit(1e6) / F.col("seconds")).otherwise(F.lit(0.0)))


def parsed_speed(output):
    """The figure in the last line of what a probe printed, as Mbit/s; 0 where there is none."""
    figure = F.regexp_extract(output, r"(?U)([^\n]*)\s*\z", 1)
    return F.coalesce(F.trim(figure).try_cast("double"), F.lit(0.0))


def ranges_speed(started_ns, ended_ns, range_mb: int = 12, ranges: int = 6):
    """Whole Mbit/s of `ranges` parallel downloads of range_mb MiB each between two times; 0 where a time is absent or none passed."""
    passed = ended_ns - started_ns
    return F.coalesce(F.when(passed > 0, F.floor(F.lit(range_mb * 1024 * 1024 * ranges * 8000) / passed)), F.lit(0)).cast("long")


def listing(instances: DataFrame) -> DataFrame:
    """id, line: one line of a listing per instance (id, status, label, dph, machine_id, gpu_name); no price counts as 0."""
    parts = ["id", "status", "label", F.format_string("$%.3f/h", F.coalesce("dph", F.lit(0.0))), "machine_id", "gpu_name"]
    shown = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("-")) for c in parts]
    return instances.select("id", F.concat_ws("  ", *shown).alias("line"))


def _section(rows: DataFrame, order: list, line, head: str, part: int, foot=None) -> DataFrame:
    """book, part, text: the lines of each book's rows in order, below a head and above a foot."""
    got = F.array_sort(F.collect_list(F.struct(*order, line.alias("__line"))))["__line"]
    texts = [F.lit(head), F.array_join(got, "\n"), *([foot] if foot is not None else [])]
    return rows.groupBy("book").agg(F.concat_ws("\n", *texts).alias("text")).select("book", F.lit(part).alias("part"), "text")


def report(before: DataFrame, after: DataFrame, cover: DataFrame, chapters: DataFrame, tables: DataFrame) -> DataFrame:
    """book, text: what is known about a volume, as Markdown.

    before, after: measures; cover: book, label, found, total; chapters: a chapter map; tables: a table queue. A section
    whose input has no row for a book is left out; the book's measures decide which books there are."""
    names = [c for c in after.columns if c != "book"]
    long = lambda df, value: df.select("book", F.posexplode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("long").alias("value")) for c in names])).alias("pos", "m")).select("book", "pos", "m.name", F.col("m.value").alias(value))
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    cells = lambda *c: F.concat(F.lit("| "), F.concat_ws(" | ", *c), F.lit(" |"))
    both = long(after, "now").join(long(before, "was").drop("name"), ["book", "pos"], "left")
    share = F.format_string("%d (%.0f%%)", "found", F.col("found") * 100 / F.greatest(F.col("total"), F.lit(1)))
    missed = F.count_if(F.col("scan").isNull())
    todo = F.concat_ws(
        "\n", F.lit("\n## To look at\n"), F.concat(F.lit("- sections out of order: "), shown("disorder")),
        F.concat(F.lit("- figures named in the text: "), shown("figures"), F.lit(", images: "), shown("images")), F.concat(F.lit("- hyphens left open: "), shown("open_hyphens")),
    )
    parts = [
        _section(both, ["pos"], cells("name", shown("was"), shown("now")), "# What is known about this volume\n\n| measure | before | after |\n|---|---|---|", 0),
        _section(cover, ["label"], cells("label", shown("total"), share), "\n## Labels found\n\n| label | blocks | found |\n|---|---|---|", 1),
        after.select("book", F.lit(2).alias("part"), todo.alias("text")),
        _section(
            chapters, ["start"], cells(F.concat(shown("start"), F.lit("-"), shown("end")), shown("words"), shown("tables"), shown("marks")), "\n## Chapters\n\n| lines | words | tables | marks |\n|---|---|---|---|", 3,
            F.concat(F.lit("\nChapters without tables and marks: "), F.count_if("clean").cast("string")),
        ),
        _section(
            tables, ["line"], cells(shown("line"), F.coalesce("scan", F.lit("-"))), "\n## Tables to check\n\n| line | scan |\n|---|---|", 4,
            F.when(missed > 0, F.concat(F.lit("\nTables without a scan: "), missed.cast("string"))),
        ),
    ]
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    text = F.array_join(F.array_sort(F.collect_list(F.struct("part", "text")))["text"], "\n")
    return after.select("book").join(whole, "book").groupBy("book").agg(F.concat(text, F.lit("\n")).alias("text"))


def preflight(tables: dict[str, DataFrame], expected: dict[str, str]) -> list[str]:
    """Names of tables whose columns and types aren't the expected ones (name → 'column type, …')."""
    bad = []
    for name, wanted in expected.items():
        have = dict(tables[name].dtypes) if name in tables else None
        want = dict(x.strip().rsplit(" ", 1) for x in wanted.split(","))
        if have is None or any(have.get(c) != t for c, t in want.items()):
            bad.append(name)
    return bad
