"""Boxes of two detectors that the derived tables don't have."""

from vellum.operators import geometry

BOX = "page int, i int, label string, x0 double, y0 double, x1 double, y1 double"


def test_boxes_apart_whose_negative_sides_make_up_their_areas(spark):
    left = spark.createDataFrame([(1, 0, "text", 0.0, 0.0, 10.0, 10.0)], BOX)
    right = spark.createDataFrame([(1, 0, "text", 20.0, 30.0, 30.0, 40.0), (1, 1, "text", 0.0, 0.0, 10.0, 8.0), (1, 2, "table", 0.0, 0.0, 10.0, 10.0)], BOX)
    got = [(r.page, r.i, r.j, r.iou) for r in geometry.matched_boxes(left, right).collect()]
    assert got == [(1, 0, 1, 0.8)]
