"""Decisions on grey rasters (rows: key columns, raster ARRAY<ARRAY<INT>>), whose pixels come from outside."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LIGHT = 235
PART = 1000


def render_scale(setting: Column) -> Column:
    """How much larger than the base resolution a page is drawn: half the setting, 1 at least and for bad values."""
    return F.coalesce(F.greatest(F.lit(1.0), setting.try_cast("double") / 2), F.lit(1.0))


def blankness(samples: Column) -> Column:
    """Share of light samples, every max(1, n div 20000)-th counted."""
    step = F.greatest(F.lit(1), F.floor(F.size(samples) / 20000).cast("int"))
    kept = F.filter(samples, lambda v, i: i % step == 0)
    return F.size(F.filter(kept, lambda v: v > LIGHT)) / F.greatest(F.lit(1), F.size(kept))


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    """[start, end) of the stretches of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def looks_tabular(grey: np.ndarray, scale_lines: tuple[int, int] = (2, 8), gap: float = 0.7, gaps: int = 2, share: float = 0.6) -> bool:
    """Whether a crop has columns: a few lines of text, and vertical gaps that are blank in most of them."""
    if grey.size == 0 or grey.shape[0] < 20 or grey.shape[1] < 60:
        return False
    ink = grey < max(128, int(grey.mean()) - 25)
    lines = [(a, b) for a, b in _runs(ink.any(axis=1)) if b - a >= 4]
    columns = np.flatnonzero(ink.any(axis=0))
    if not scale_lines[0] <= len(lines) <= scale_lines[1] or not len(columns):
        return False
    middle = sorted(b - a for a, b in lines)[len(lines) // 2]
    inner = ink[:, columns[0] : columns[-1] + 1]
    blank = np.mean([~inner[a:b].any(axis=0) for a, b in lines], axis=0) >= share
    return sum(b - a >= max(6, int(gap * middle)) for a, b in _runs(blank)) >= gaps


def _drawn(rasters: pa.ListArray) -> Iterator[np.ndarray | None]:
    """Each raster of a column of them without a Python object per pixel; None for null and empty ones."""
    lines = rasters.values
    ends, sides = rasters.offsets.to_numpy(), lines.offsets.to_numpy()
    if lines.null_count or lines.values.null_count:
        raise ValueError("a raster has a null line or pixel")
    pixels = lines.values.to_numpy(zero_copy_only=False)
    for a, b, there in zip(ends[:-1].tolist(), ends[1:].tolist(), rasters.is_valid().to_pylist(), strict=True):
        if not there or a == b:
            yield None
            continue
        if np.ptp(np.diff(sides[a : b + 1])):
            raise ValueError("lines of a raster differ in length")
        yield pixels[sides[a] : sides[b]].reshape(b - a, -1)


@lru_cache(1024)
def _packed_tabular(raster: bytes, width: int) -> bool:
    return looks_tabular(np.frombuffer(raster, np.uint8).reshape(-1, width).astype(np.int32))


def tabular_crops(crops: DataFrame) -> DataFrame:
    """crops (page, i, label, raster) with the label of text crops that look like tables turned to table.

    A raster is ARRAY<ARRAY<INT>>, or BINARY with a byte a pixel and the column width: a fourth of the memory, and no
    walk over single pixels on the way to Python. Equal packed rasters that come again soon are decided once."""
    packed = dict(crops.dtypes)["raster"] == "binary"

    def decided(batch):
        if packed:
            for raster, width in zip(batch.column("raster").to_pylist(), batch.column("width").to_pylist(), strict=True):
                yield bool(raster) and _packed_tabular(raster, width)
        else:
            for grey in _drawn(batch.column("raster")):
                yield grey is not None and looks_tabular(grey)

    def run(batches):
        for batch in batches:
            # in parts, so that a worker's memory does not follow the size of a batch of rasters
            for part in (batch.slice(n, PART) for n in range(0, batch.num_rows, PART)):
                text = pc.fill_null(pc.equal(part.column("label"), "text"), False)
                turned = iter(decided(part.filter(text)))
                labels = ["table" if is_text and next(turned) else label for label, is_text in zip(part.column("label").to_pylist(), text.to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("page"), part.column("i"), pa.array(labels, pa.string())], names=["page", "i", "label"])

    rows = crops.select(F.col("page").cast("long").alias("page"), F.col("i").cast("int").alias("i"), "label", "raster", *(["width"] if packed else []))
    return rows.mapInArrow(run, "page long, i int, label string")


def figure_bands(gaps: DataFrame, columns: dict[int, tuple[float, float]], least_height: float = 55.0, least_width: float = 40.0) -> DataFrame:
    """page, col, n, x0, y0, x1, y1 of the gaps (page, col, y0, y1) that can hold a figure: a point inside on both ends.

    columns: the horizontal limits of each column."""
    side = lambda k: F.element_at(F.create_map(*[F.lit(x) for c, v in columns.items() for x in (c, float(v[k]))]), F.col("col"))
    rows = gaps.select("page", "col", side(0).alias("x0"), (F.col("y0") + 1).alias("y0"), side(1).alias("x1"), (F.col("y1") - 1).alias("y1"))
    return rows.where((F.col("y1") - F.col("y0") >= least_height) & (F.col("x1") - F.col("x0") >= least_width))
