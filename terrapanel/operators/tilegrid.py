"""Cells of a metric grid with one origin for a whole zone, and pixel-aligned rectangles, inside tiles of any outline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapanel.functions import projection as pr
from terrapanel.sources.shared import spread

#: So much of a cell must lie in its tile.
INSIDE = 0.999


def _bounds(df: DataFrame, ring: str) -> DataFrame:
    x, y = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return df.withColumns({"min_x": F.array_min(x), "max_x": F.array_max(x), "min_y": F.array_min(y), "max_y": F.array_max(y)})


def _inside(df: DataFrame) -> DataFrame:
    """Cells ``x0 .. y1`` with ``share``, the part of them in the polygon ``ring``; those with less than ``INSIDE`` go."""
    whole = (F.col("x1") - F.col("x0")) * (F.col("y1") - F.col("y0"))
    cut = pr.clip(F.col("ring"), *(F.col(c) for c in ("x0", "y0", "x1", "y1")))
    share = pr.let(cut, lambda r: F.when(F.size(r) > 2, F.abs(pr.signed_area(r))).otherwise(0.0)) / whole
    return df.withColumn("share", share).where(F.col("share") >= INSIDE).drop("ring")


def metric_grid(tiles: DataFrame, side: float, origin: Column, label: str) -> DataFrame:
    """Square cells of ``side`` metres in each tile's UTM zone, on a grid that begins at the zone's ``origin`` (``x, y``).

    ``tiles`` has ``tile``, ``zone``, ``south`` and the outline ``ring`` (``lon, lat``).  ``col_off, row_off`` count from the origin and so
    are the same for a cell that two tiles see; ``col_idx, row_idx`` count from the tile's first column and row.  Cells come from the
    tile's bounds and stay if ``INSIDE`` of their area lies in its outline.
    """
    on_map = spread(tiles).withColumn("ring", pr.to_utm(F.col("ring"), F.col("zone"), F.col("south"))).withColumn("o", origin)
    on_map = _bounds(on_map, "ring")
    first, last = lambda v, o: F.floor((F.col(v) - F.col(o)) / side), lambda v, o: F.ceil((F.col(v) - F.col(o)) / side)
    spans = on_map.withColumn("c0", first("min_x", "o.x")).withColumn("r0", first("min_y", "o.y")).withColumn("c1", last("max_x", "o.x")).withColumn("r1", last("max_y", "o.y"))
    rows = spans.withColumn("row_off", F.explode(F.sequence("r0", F.col("r1") - 1))).withColumn("col_off", F.explode(F.sequence("c0", F.col("c1") - 1)))
    placed = rows.withColumn("x0", F.col("o.x") + F.col("col_off") * side).withColumn("y0", F.col("o.y") + F.col("row_off") * side)
    placed = placed.withColumn("x1", F.col("x0") + side).withColumn("y1", F.col("y0") + side)
    out = _inside(placed.withColumn("col_idx", (F.col("col_off") - F.col("c0")).cast("int")).withColumn("row_idx", (F.col("row_off") - F.col("r0")).cast("int")))
    name = F.format_string(f"%s_{label}_c%03d_r%03d", "tile", "col_idx", "row_idx")
    return out.select(name.alias("grid_id"), "tile", "col_idx", "row_idx", "col_off", "row_off", "x0", "y0", "share")


def pixel_rectangles(tiles: DataFrame, size: int, left: float, top: float, pixel: float, width: int, height: int, label: str) -> DataFrame:
    """Rectangles of ``size`` x ``size`` pixels of a raster, inside each tile.

    ``tiles`` has ``tile`` and its outline ``ring`` (``x, y``) in the raster's coordinates; the raster begins at ``left, top``.  A
    tile's pixels are those whose centres its bounds hold; rectangles lie on the raster's own multiples of ``size``, end before the tile
    and the raster do, and stay if ``INSIDE`` of their area lies in the outline.
    """
    b = _bounds(spread(tiles), "ring")
    spans = b.withColumns(
        {
            "c0": F.greatest(F.lit(0), F.ceil((F.col("min_x") - left) / pixel - 0.5)),
            "c1": F.least(F.lit(width), F.floor((F.col("max_x") - left) / pixel - 0.5) + 1),
            "r0": F.greatest(F.lit(0), F.ceil((top - F.col("max_y")) / pixel - 0.5)),
            "r1": F.least(F.lit(height), F.floor((top - F.col("min_y")) / pixel - 0.5) + 1),
        }
    ).where("c1 > c0 AND r1 > r0")
    spans = spans.withColumn("c0", F.col("c0") - F.col("c0") % size).withColumn("r0", F.col("r0") - F.col("r0") % size)
    spans = spans.withColumn("n_cols", F.floor((F.col("c1") - F.col("c0")) / size)).withColumn("n_rows", F.floor((F.col("r1") - F.col("r0")) / size)).where("n_cols > 0 AND n_rows > 0")
    upto = lambda n: F.explode(F.sequence(F.lit(0), (F.col(n) - 1).cast("int")))
    cells = spans.withColumn("row_idx", upto("n_rows")).withColumn("col_idx", upto("n_cols"))
    cells = cells.withColumn("row_off", F.col("r0") + F.col("row_idx") * size).withColumn("col_off", F.col("c0") + F.col("col_idx") * size).where((F.col("row_off") + size <= height) & (F.col("col_off") + size <= width))
    placed = cells.withColumns({"x0": left + F.col("col_off") * pixel, "x1": left + (F.col("col_off") + size) * pixel, "y0": top - (F.col("row_off") + size) * pixel, "y1": top - F.col("row_off") * pixel})
    name = F.format_string(f"%s_{label}_c%03d_r%03d", "tile", "col_idx", "row_idx")
    return _inside(placed).select(name.alias("grid_id"), "tile", "col_idx", "row_idx", "col_off", "row_off", "share")


def outside_class_box(shares: DataFrame, boxes: DataFrame) -> DataFrame:
    """``id, class_id, inside, outside_pct``: whether a cell's centre lies in its class's box, and the class's share if it doesn't.

    ``shares`` has ``id``, ``lon, lat`` of the cell's centre, ``class_id`` and ``pct``; ``boxes``, a row for each class that has one, has
    ``class_id``, the southern UTM ``zone`` it is given in, and ``xmin, xmax, ymin, ymax``.  Classes without a box are nowhere outside.
    """
    placed = shares.join(F.broadcast(boxes), "class_id", "left")
    x, y = pr.utm(F.col("lon"), F.col("lat"), F.col("zone"), F.lit(True))
    placed = placed.withColumn("inside", x.between(F.col("xmin"), F.col("xmax")) & y.between(F.col("ymin"), F.col("ymax")))
    return placed.select("id", "class_id", "inside", F.when(F.coalesce("inside", F.lit(True)), 0.0).otherwise(F.coalesce("pct", F.lit(0.0))).alias("outside_pct"))
