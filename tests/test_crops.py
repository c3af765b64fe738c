"""Crops of every box of every page."""

import os
import random

import numpy as np
import pytest

from vellum.operators import raster
from vellum.plans import catalog, views

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_crops_of_every_box(spark):
    boxes = {(r.page, r.i) for r in views.view(spark, SF, "v_boxes").select("page", "i").collect()}
    assert any(i >= 2 for _, i in boxes) and any(p >= 400 for p, _ in boxes)
    got = {(r.page, r.i): r.label for r in catalog.queries()["tabular_crops"](spark, SF).collect()}
    assert got == {(p, i): "text" if p % 2 else "table" for p, i in boxes}


def test_packed_rasters_are_decided_like_arrays(spark):
    draw = random.Random(3)
    rows = []
    for n in range(60):
        every, wide = draw.choice([(40, 20), (7, 6), (30, 15), (200, 200)]), draw.choice([59, 60, 120, 121])
        grey = [[0 if y % 12 < 8 and x % every[0] < every[1] else draw.choice([255, 250]) for x in range(wide)] for y in range(draw.choice([12, 36, 60]))]
        rows.append((1, n, draw.choice(["text", "text", "image", None]), grey))
    rows += [(2, 0, "text", None), (2, 1, "text", []), (2, 2, None, rows[0][3])]
    want = {(p, i): "table" if la == "text" and g and raster.looks_tabular(np.array(g, np.int32)) else la for p, i, la, g in rows}
    assert {"table", "text", "image", None} == set(want.values())
    arrays = spark.createDataFrame(rows, "page int, i int, label string, raster array<array<int>>")
    packed = spark.createDataFrame([(p, i, la, None if g is None else bytes(v for line in g for v in line), len(g[0]) if g else 0) for p, i, la, g in rows], "page int, i int, label string, raster binary, width int")
    for df in (arrays, packed, arrays.where("i >= 7").repartition(2)):
        got = {(r.page, r.i): r.label for r in raster.tabular_crops(df).collect()}
        assert got == {k: v for k, v in want.items() if k in got} and len(got) == df.count()


def test_crops_are_drawn_without_a_call_per_pixel(spark):
    plan = catalog.queries()["tabular_crops"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan
