"""Readers, writers and streams over temporary folders."""

import base64
import json

from pyspark.sql import functions as F

from vellum.functions import text as T
from vellum.operators import exports
from vellum.sources import runs
from vellum.streaming import lifecycle


def a_run(path):
    pages = path / "pages"
    pages.mkdir()
    (pages / "0000.md").write_text("first\npage")
    (pages / "0002.md").write_text("third")
    (pages / "0000.json").write_text(json.dumps({"page_index": 0, "parsing_res_list": [{"block_label": None, "block_content": " a \n", "block_bbox": [1, 2, 3, 4]}, {"block_label": "header", "block_content": "  "}]}))
    (pages / "0001.json").write_text("{not json")
    (path / "run.json").write_text('{"pages": 2, "model": "m"}')
    (path / "progress.json").write_text('{"pages": 3, "seconds": 1.5}')
    return str(path)


def test_run_directory(spark, tmp_path):
    run = a_run(tmp_path)
    assert [(r.page, r.text) for r in runs.page_texts(spark, run).orderBy("page").collect()] == [(0, "first\npage"), (2, "third")]
    assert [(r.page, r.pos, r.label, r.content) for r in runs.page_blocks(spark, run).collect()] == [(0, 0, "text", "a")]
    assert [r.page for r in runs.unreadable_pages(spark, run).collect()] == [1]
    assert sorted(r.page for r in runs.done_pages(spark, run).collect()) == [0, 1, 2]
    assert sorted(r.page for r in runs.done_pages(spark, run, only_json=True).collect()) == [0, 1]
    assert runs.run_facts(spark, run).collect()[0].facts == {"pages": "3", "model": "m", "seconds": "1.5"}


def test_ledger_appends_and_skips_what_is_broken(spark, tmp_path):
    path = str(tmp_path / "ledger")
    rows = spark.createDataFrame([("tables-1", 7, 0.0, True)], "job string, machine_id long, started double, ok boolean")
    runs.append_ledger(rows, path)
    runs.append_ledger(rows, path)
    (tmp_path / "ledger" / "part-x.json").write_text('{"job": "ok", "machine_id": 1}\n{broken\n\n')
    read = runs.ledger(spark, path).collect()
    assert len(read) == 3 and sum(r.started_iso == "1970-01-01T00:00:00" for r in read) == 2
    assert runs.bad_ledger_lines(spark, path).count() == 1


def test_bad_machines_and_api_pages(spark):
    texts = spark.createDataFrame([('{"7": {"reason": "slow", "ts": 1.0}, "9": {"reason": "x", "ts": 2}}',), ("oops",)], "value string")
    assert sorted(r.machine_id for r in runs.bad_machines(texts).collect()) == [7, 9]
    answer = json.dumps({"pages": [{"index": 0, "markdown": "![a](i.png)", "images": [{"id": "i.png", "image_base64": "data:image/png;base64," + base64.b64encode(b"xyz").decode()}]}, {"index": 1, "markdown": "t", "images": []}]})
    got = runs.api_pages(spark.createDataFrame([(answer,)], "value string")).orderBy("page").collect()
    assert [(r.page, r.image_id) for r in got] == [(0, "i.png"), (1, None)] and bytes(got[0].image) == b"xyz"


def test_versions_and_snapshots(spark, tmp_path):
    df, other = spark.range(3), spark.range(5)
    runs.snapshot_once(df, str(tmp_path / "s"))
    runs.snapshot_once(other, str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s")).count() == 3
    runs.write_version(df, str(tmp_path / "v"))
    try:
        runs.write_version(other, str(tmp_path / "v"))
        raise AssertionError("an existing version was overwritten")
    except Exception as e:
        assert "already exists" in str(e) or "PATH_ALREADY_EXISTS" in str(e)


def test_sync_takes_each_file_once(spark, tmp_path):
    source, target, state = (tmp_path / n for n in ("in", "out", "state"))
    source.mkdir()
    for n in range(2):
        (source / f"{n}.json").write_text(json.dumps({"page": n}))
        for _ in range(2):
            runs.sync_stream(spark, str(source), str(target), str(state), "page int")
    assert sorted(r.page for r in spark.read.parquet(str(target)).collect()) == [0, 1]


def test_silent_instances_are_told_by_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    beats = [(1, 0), (1, 100), (1, 1200), (2, 0), (3, 0), (3, 100000)]
    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps({"instance": i, "s": 1e6 + s}) for i, s in beats))
    stream = spark.readStream.schema("instance long, s double").json(str(tmp_path / "in")).select("instance", F.timestamp_seconds("s").alias("at"))
    name = "silent"
    q = lifecycle.silence_stream(stream).writeStream.format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.instance, r.since - 1e6, r.until and r.until - 1e6) for r in spark.table(name).collect()}
    assert {(1, 100.0, 1200.0), (3, 0.0, 100000.0)} <= got
    assert (1, 1200.0, None) in got and (2, 0.0, None) in got


def test_text_functions(spark):
    def one(column):
        return spark.range(1).select(column.alias("x")).collect()[0].x

    assert one(T.decoded(F.lit("a &amp; b &nbsp;&frac12;"))) == "a & b \xa0½"
    assert one(T.plain(F.lit("<b> .005 ⚠</b> ≠ "))) == ".005"
    assert one(T.norm(F.lit("1 ’ ” ' 2"))) == '1"""2'
    assert one(T.key(F.lit("<i>Мелеховский</i> двор — 3½!"))) == "мелеховский двор 3½"
    assert one(T.title_case(F.lit("THE ART of the DEAL"))) == "The Art of the Deal"
    assert one(T.plain_math(F.lit("$ 90^{\\circ} $ and $\\mathrm{~mm}$"))) == "90° and mm"
    assert one(T.glue(F.lit("tech-"), F.lit("nology"))) == "technology" and one(T.glue(F.lit("Two-"), F.lit("Upper"))) == "Two- Upper"
    assert one(T.section_number(F.lit("Sec. 10.5 Name"))).asDict() == {"a": 10, "b": 5}
    assert one(T.section_number(F.lit("Figure 10.5"))) is None
    f = one(T.front_matter(F.lit("---\nprimary_language: no\nis_table: Yes\nrotation_correction: 90\nx: 1\n---\n body \n")))
    assert (f.primary_language, f.is_table, f.rotation_correction, f.is_diagram, f.body) == ("no", True, 90, None, "body")
    assert one(T.front_matter(F.lit(" no front "))).body == "no front"


def test_preflight_and_targets(spark):
    df = spark.createDataFrame([("1.2.3.4:22", "ssh://root@h:1"), (None, "ssh://root@h:1"), (None, None)], "direct string, proxy string")
    assert [r.target for r in exports.ssh_target(df).collect()] == ["1.2.3.4:22", "h:1", None]
    assert exports.preflight({"t": df}, {"t": "direct string", "u": "a int"}) == ["u"]
    assert exports.preflight({"t": df}, {"t": "direct int"}) == ["t"]
