"""Rasters, settings and cases that the derived tables don't have."""

import numpy as np

from vellum import config
from vellum.operators import raster, rendering


def crop(columns, lines=3, width=200):
    img = np.full((lines * 14 + 6, width), 255)
    for n in range(lines):
        for a, b in columns:
            img[4 + n * 14 : 14 + n * 14, a:b:2] = 0
            img[4 + n * 14 : 14 + n * 14, a + 1 : b : 2] = 0
    return img


def test_tabularity():
    assert raster.looks_tabular(crop([(5, 50), (70, 110), (130, 190)]))
    assert not raster.looks_tabular(crop([(5, 190)]))
    assert not raster.looks_tabular(crop([(5, 100), (103, 190)]))  # gaps narrower than the lines ask for
    assert not raster.looks_tabular(crop([(5, 50), (70, 110), (130, 190)], lines=1))
    assert not raster.looks_tabular(crop([(5, 50), (70, 110), (130, 190)], lines=9))
    assert not raster.looks_tabular(np.full((40, 100), 255)) and not raster.looks_tabular(np.zeros((0, 0)))
    noted = crop([(5, 50), (70, 110), (130, 190)])
    noted[32:42, 5:190] = 0  # a note across the last of three lines leaves gaps blank in most of them
    assert raster.looks_tabular(noted)


def test_settings(tmp_path, monkeypatch):
    f = tmp_path / ".env"
    f.write_text("A=1\n B = 2\nC=x=y\n")
    monkeypatch.delenv("A", raising=False)
    assert config.setting("A", files=[str(f)]) == "1" and config.setting("C", files=[str(f), "none"]) == "x=y"
    assert config.setting("Z", "d", [str(f)]) == "d"
    monkeypatch.setenv("A", "env")
    assert config.setting("A", files=[str(f)]) == "env"
    base = {"a": {"b": 1, "c": 2}, "d": 3}
    assert config.merged(base, {"a": {"b": 9}, "d": {"e": 1}}) == {"a": {"b": 9, "c": 2}, "d": {"e": 1}}
    assert base["a"]["b"] == 1


def test_segments_and_paragraphs_join_back(spark):
    texts = ["", "no table", "<table>a</table>", "x<table\n>1</table><TABLE>2</TABLE> y\n\n\n z\n \nq", "\n\nlead", "tail\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    for rows, glue in ((rendering.segments(df), lambda r: r.text), (rendering.paragraphs(df), lambda r: r.text + r.sep)):
        got = {}
        for r in rows.orderBy("id", "n").collect():
            got[r.id] = got.get(r.id, "") + glue(r)
        assert [got[i] for i in range(len(texts))] == texts
    assert all(r.text.lower().startswith("<table") for r in rendering.segments(df).where("is_table").collect())
