"""Readers of run directories and ledgers, and their writers. All paths go through Spark, so any store will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCKS = "parsing_res_list ARRAY<STRUCT<block_label: STRING, block_content: STRING, block_bbox: ARRAY<DOUBLE>>>, page_index INT, _corrupt STRING"
LEDGER = (
    "job STRING, image STRING, gpu STRING, instance_id BIGINT, machine_id BIGINT, offer_id BIGINT, dph DOUBLE, per_tb DOUBLE, inet_down_adv DOUBLE, disk_bw DOUBLE, cpu_cores DOUBLE, cpu_ghz DOUBLE, "
    "link_mbps DOUBLE, download_mbps DOUBLE, image_gb DOUBLE, started DOUBLE, setup_s DOUBLE, run_s DOUBLE, total_s DOUBLE, cost_usd DOUBLE, ok BOOLEAN, note STRING, extra MAP<STRING, STRING>, started_iso STRING, _corrupt STRING"
)
ANSWER = "pages ARRAY<STRUCT<index: INT, markdown: STRING, images: ARRAY<STRUCT<id: STRING, image_base64: STRING>>>>"


def _page(path: Column) -> Column:
    return F.regexp_extract(path, r"(\d+)\.[A-Za-z]+$", 1).cast("int")


def page_texts(spark: SparkSession, run: str) -> DataFrame:
    """page, text of the Markdown pages of a run, numbered by their file names."""
    files = spark.read.option("pathGlobFilter", "*.md").text(f"{run}/pages", wholetext=True)
    return files.select(_page(F.col("_metadata.file_name")).alias("page"), F.col("value").alias("text"))


def _page_files(spark: SparkSession, run: str) -> DataFrame:
    """page, j of the page files: parsed text, with the text itself in j._corrupt where it isn't JSON."""
    files = spark.read.option("pathGlobFilter", "*.json").text(f"{run}/pages", wholetext=True)
    return files.select(_page(F.col("_metadata.file_name")).alias("page"), F.from_json("value", BLOCKS, {"columnNameOfCorruptRecord": "_corrupt"}).alias("j"))


def page_blocks(spark: SparkSession, run: str) -> DataFrame:
    """page, pos, label, content, bbox of the blocks of a run's page files; empty blocks and unreadable files give none."""
    rows = _page_files(spark, run).where("j._corrupt IS NULL").select("page", F.posexplode("j.parsing_res_list").alias("pos", "b"))
    content = F.regexp_replace(F.col("b.block_content"), r"(?U)^\s+|\s+$", "")
    return rows.select("page", "pos", F.coalesce("b.block_label", F.lit("text")).alias("label"), content.alias("content"), F.col("b.block_bbox").alias("bbox")).where("content <> ''")


def unreadable_pages(spark: SparkSession, run: str) -> DataFrame:
    """page of the page files that can't be read: the third outcome besides good and bad, never silent."""
    return _page_files(spark, run).where("j._corrupt IS NOT NULL").select("page")


def done_pages(spark: SparkSession, run: str, only_json: bool = False) -> DataFrame:
    """page: pages that a run has finished, by file names alone; either any entry counts or JSON ones only."""
    files = spark.read.format("binaryFile").load(f"{run}/pages").select(F.col("path"))
    named = files.where(F.regexp_like("path", F.lit(r"/\d+\.json$" if only_json else r"/\d+\.[^/]*$")))
    return named.select(F.regexp_extract("path", r"/(\d+)\.[^/]*$", 1).cast("int").alias("page")).distinct()


def run_facts(spark: SparkSession, run: str) -> DataFrame:
    """One MAP of a run's facts: run.json, vllm.json and progress.json in this order, later files win."""
    parts = spark.read.option("pathGlobFilter", "{run,vllm,progress}.json").text(run, wholetext=True)
    rank = F.expr("CASE _metadata.file_name WHEN 'run.json' THEN 1 WHEN 'vllm.json' THEN 2 ELSE 3 END")
    facts = parts.select(rank.alias("rank"), F.explode(F.from_json("value", "map<string,string>")).alias("k", "v"))
    last = facts.groupBy("k").agg(F.max_by("v", "rank").alias("v"))
    return last.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias("facts"))


def _ledger_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path).where("trim(value) <> ''")
    return lines.select("value", F.from_json("value", LEDGER, {"columnNameOfCorruptRecord": "_corrupt"}).alias("j"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """Runs of a JSON-lines ledger; lines that aren't JSON are left out (bad_ledger_lines has them)."""
    return _ledger_lines(spark, path).where("j._corrupt IS NULL").select("j.*").drop("_corrupt")


def bad_ledger_lines(spark: SparkSession, path: str) -> DataFrame:
    return _ledger_lines(spark, path).where("j._corrupt IS NOT NULL").select("value")


def bad_machines(texts: DataFrame) -> DataFrame:
    """machine_id, reason, ts from the text of a map of machines (one row, value); unreadable text gives none."""
    entries = texts.select(F.explode(F.from_json("value", "map<string, struct<reason: string, ts: double>>")).alias("k", "v"))
    return entries.select(F.col("k").try_cast("bigint").alias("machine_id"), "v.reason", "v.ts").where("machine_id is not null")


def api_pages(answers: DataFrame) -> DataFrame:
    """page, markdown, image_id, image (bytes) of an OCR service's answers (value: JSON); pages without images once."""
    pages = answers.select(F.explode(F.from_json("value", ANSWER)["pages"]).alias("p"))
    return pages.select(F.col("p.index").alias("page"), F.col("p.markdown").alias("markdown"), F.explode_outer("p.images").alias("i")).select("page", "markdown", F.col("i.id").alias("image_id"), F.unbase64(F.regexp_replace("i.image_base64", "^data:[^,]*,", "")).alias("image"))


# The form of an entry of printed contents, and two misread words.
ENTRY = r"^\s*(\d{1,2})\.\s+([A-Za-z][^.]*?)\s*[.\s]*\s*\d{1,3}\s*$"
MISREAD = (("RecondHioning", "Reconditioning"), ("Sliues", "Slides"))


def contents_titles(pages: DataFrame, most: int = 8) -> DataFrame:
    """num, title of the printed contents: `N. Title …… page` lines of the first pages that say contents; first match wins."""
    rows = pages.where((F.col("page") < most) & F.upper("text").contains("CONTENTS"))
    lines = rows.select("page", F.posexplode(F.split("text", r"\r\n|[\n\r\f\x0B\x85\u2028\u2029]")).alias("pos", "line")).where(F.regexp_like("line", F.lit(ENTRY)))
    title = F.trim(F.regexp_extract("line", ENTRY, 2))
    for bad, good in MISREAD:
        title = F.replace(title, F.lit(bad), F.lit(good))
    parts = lines.select("page", "pos", F.regexp_extract("line", ENTRY, 1).cast("int").alias("num"), title.alias("title"))
    return parts.groupBy("num").agg(F.min_by("title", F.struct("page", "pos")).alias("title"))


def append_ledger(runs: DataFrame, path: str) -> None:
    """Append runs as JSON lines, with the start as ISO time in the session's zone."""
    iso = F.date_format(F.timestamp_seconds("started"), "yyyy-MM-dd'T'HH:mm:ss")
    runs.withColumn("started_iso", iso).write.mode("append").json(path)


def concat_pages(pages: DataFrame, by: str = "book") -> DataFrame:
    """by, text: the pages of each book in order, a blank line after each."""
    joined = pages.groupBy(by).agg(F.array_join(F.array_sort(F.collect_list(F.struct("page", "text")))["text"], "\n\n").alias("text"))
    return joined.withColumn("text", F.concat("text", F.lit("\n\n")))


def write_version(df: DataFrame, path: str) -> None:
    """Write a new version of a dataset; an existing one is never overwritten."""
    df.write.mode("errorifexists").parquet(path)


def snapshot_once(df: DataFrame, path: str) -> None:
    """Keep df as it was before the first rewrite: later calls change nothing."""
    df.write.mode("ignore").parquet(path)


def sync_stream(spark: SparkSession, source: str, target: str, state: str, schema: str) -> None:
    """Take over the files that came since the last call (JSON lines), each exactly once; state holds what was seen."""
    stream = spark.readStream.schema(schema).json(source)
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()


def newest(rows: DataFrame, key: list[str], at: str) -> DataFrame:
    """The latest row of each key."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(F.col(at).desc()))).where("__n = 1").drop("__n")
