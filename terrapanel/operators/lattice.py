"""Grids of boxes and joins by place, all as equi-joins on lattice buckets.

A theta join of boxes would compare all with all; here each box is written once for every bucket that
it touches, boxes of the same bucket are joined, and the exact condition follows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.sources.shared import discard, partitions, table

BOX = ("x0", "y0", "x1", "y1")
EPS = 1e-9
#: So many boxes, with all that they meet, are little for one task.
BOXES_PER_TASK = 50_000


def snap_up(lon: Column, origin: float, step: float) -> Column:
    """Index of the first lattice edge at or after a coordinate."""
    return F.ceil((lon - origin) / step - EPS).cast("int")


def cells_of_chart(charts: DataFrame, size: int) -> DataFrame:
    """Whole ``size`` x ``size`` cells of each chart (pixel bounds), from its north-west corner; what is left over has no cell."""
    cols, rows = F.expr(f"(x1 - x0) DIV {size}"), F.expr(f"(y1 - y0) DIV {size}")
    grid = charts.where((cols > 0) & (rows > 0)).withColumn("col_idx", F.explode(F.sequence(F.lit(0), (cols - 1).cast("int")))).withColumn("row_idx", F.explode(F.sequence(F.lit(0), (rows - 1).cast("int"))))
    key = F.format_string(f"%s_{size}x{size}_c%03d_r%03d", F.col("chart"), F.col("col_idx"), F.col("row_idx"))
    x, y = F.col("x0") + F.col("col_idx") * size, F.col("y0") + F.col("row_idx") * size
    return grid.select(key.alias("grid_id"), "chart", "col_idx", "row_idx", x.alias("x0"), y.alias("y0"), (x + size).alias("x1"), (y + size).alias("y1"))


def with_buckets(boxes: DataFrame, size: int, halo: int = 0) -> DataFrame:
    """One row for each lattice bucket that a box, grown by ``halo``, touches; touching borders count."""
    span = lambda a, b: F.sequence(F.floor((F.col(a) - halo) / size), F.floor((F.col(b) + halo) / size))
    return boxes.withColumn("bucket_x", F.explode(span("x0", "x1"))).withColumn("bucket_y", F.explode(span("y0", "y1")))


def shared_area(a: str = "a", b: str = "b") -> Column:
    w = F.least(F.col(f"{a}.x1"), F.col(f"{b}.x1")) - F.greatest(F.col(f"{a}.x0"), F.col(f"{b}.x0"))
    h = F.least(F.col(f"{a}.y1"), F.col(f"{b}.y1")) - F.greatest(F.col(f"{a}.y0"), F.col(f"{b}.y0"))
    return F.when((w < 0) | (h < 0), F.lit(None)).otherwise(w * h)


def overlaps(left: DataFrame, right: DataFrame, size: int, same: bool = False) -> DataFrame:
    """Pairs of boxes that meet, with the shared area (0 for border contact); ``same`` gives each pair of one table once.

    Boxes meet in every bucket that both touch; the bucket of the shared part's lower corner gives the pair, so no pair has to be
    made distinct.  The join shuffles, to as many tasks as boxes (counted first) need: files say little about how many rows the buckets
    make, and their bytes little about the memory of a task.
    """
    n = partitions(left.sparkSession, left.count() + (0 if same else right.count()), BOXES_PER_TASK)
    a, b = (with_buckets(x, size).repartition(n, "bucket_x", "bucket_y").alias(k) for x, k in ((left, "a"), (right, "b")))
    corner = lambda x: F.floor(F.greatest(f"a.{x}0", f"b.{x}0") / size) == F.col(f"a.bucket_{x}")
    pairs = a.hint("merge").join(b, (F.col("a.bucket_x") == F.col("b.bucket_x")) & (F.col("a.bucket_y") == F.col("b.bucket_y"))).where(corner("x") & corner("y"))
    if same:
        pairs = pairs.where("a.box_id < b.box_id")
    return pairs.select(F.col("a.box_id").alias("a"), F.col("b.box_id").alias("b"), shared_area().alias("area")).where("area is not null")


def exclude_overlapping(boxes: DataFrame, taken: DataFrame, size: int) -> DataFrame:
    """The boxes that share area with none of ``taken``."""
    hit = overlaps(boxes, taken, size).where("area > 0").select(F.col("a").alias("box_id")).distinct()
    return boxes.join(hit, "box_id", "left_anti")


def overlap_audit(boxes: DataFrame, size: int) -> DataFrame:
    """One row: sum of areas, area of the union if nothing overlaps, pairs that overlap, pairs that only touch."""
    pairs = overlaps(boxes, boxes, size, True).agg(F.count(F.when(F.col("area") > 0, 1)).alias("n_overlaps"), F.count(F.when(F.col("area") == 0, 1)).alias("n_contacts"), F.coalesce(F.sum("area"), F.lit(0)).alias("shared_area"))
    return boxes.agg(F.sum(F.expr("(x1 - x0) * (y1 - y0)")).alias("sum_area")).crossJoin(F.broadcast(pairs))


def neighbours(cells: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Directed pairs of the eight neighbours on a lattice (``row_idx, col_idx``), within equal ``keys``."""
    offsets = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (-1, 0, 1) for c in (-1, 0, 1) if r or c))
    moved = cells.select("cell_id", *keys, F.col("row_idx"), F.col("col_idx"), F.explode(offsets).alias("o")).select(F.col("cell_id").alias("a"), *keys, (F.col("row_idx") + F.col("o.r")).alias("row_idx"), (F.col("col_idx") + F.col("o.c")).alias("col_idx"))
    return moved.join(cells.select(F.col("cell_id").alias("b"), *keys, "row_idx", "col_idx"), [*keys, "row_idx", "col_idx"]).select("a", "b")


def with_halo(cells: DataFrame, pixels: DataFrame, size: int, halo: int) -> DataFrame:
    """The pixels of each cell and of a border around it, telling core pixels; cells are ``size`` pixels wide."""
    lo, hi = -(-halo // size), -(-halo // size)
    around = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in range(-lo, hi + 1) for c in range(-lo, hi + 1)))
    near = cells.select("cell_id", "row_idx", "col_idx", F.explode(around).alias("o")).select("cell_id", "row_idx", "col_idx", (F.col("row_idx") + F.col("o.r")).alias("pr"), (F.col("col_idx") + F.col("o.c")).alias("pc"))
    px = pixels.withColumn("pr", F.expr(f"CAST(px_row DIV {size} AS INT)")).withColumn("pc", F.expr(f"CAST(px_col DIV {size} AS INT)"))
    both = near.join(px, ["pr", "pc"])
    inside = lambda grow: F.col("px_row").between(F.col("row_idx") * size - grow, (F.col("row_idx") + 1) * size - 1 + grow) & F.col("px_col").between(F.col("col_idx") * size - grow, (F.col("col_idx") + 1) * size - 1 + grow)
    return both.where(inside(halo)).select("cell_id", "px_row", "px_col", inside(0).alias("is_core"))


def regrid(target: DataFrame, source: DataFrame, scale_row: float, scale_col: float) -> DataFrame:
    """Nearest-neighbour values of a categorical layer at the pixels of another lattice."""
    at = target.withColumn("src_row", F.floor((F.col("px_row") + 0.5) * scale_row).cast("int")).withColumn("src_col", F.floor((F.col("px_col") + 0.5) * scale_col).cast("int"))
    return at.join(source, ["src_row", "src_col"], "left")


def decimate(pixels: DataFrame, factor: int, value: str) -> DataFrame:
    """The first pixel's value of each ``factor`` x ``factor`` block."""
    return pixels.groupBy(F.expr(f"CAST(px_row DIV {factor} AS INT)").alias("row_idx"), F.expr(f"CAST(px_col DIV {factor} AS INT)").alias("col_idx")).agg(F.min_by(value, F.struct("px_row", "px_col")).alias(value))


def nearest_valid(holes: DataFrame, valid: DataFrame, reach: int) -> DataFrame:
    """Value of the nearest valid pixel for each hole; ties go to the smallest row, then column.

    Holes look through buckets of ``reach`` around them, then of twice that for those that found none,
    and so on until each has one or the lattice is searched.
    """
    todo, out = holes.select("px_row", "px_col"), None
    rows = valid.agg(F.min("px_row"), F.max("px_row"), F.min("px_col"), F.max("px_col")).first()
    if rows[0] is None:
        return todo.withColumn("value", F.lit(None))
    edge = holes.agg(F.min("px_row"), F.max("px_row"), F.min("px_col"), F.max("px_col")).first()
    if edge[0] is None:
        return todo.withColumn("value", F.lit(None))
    most = max(max(rows[1], edge[1]) - min(rows[0], edge[0]), max(rows[3], edge[3]) - min(rows[2], edge[2])) + 1
    while True:
        size = reach
        key = [F.expr(f"CAST(px_row DIV {size} AS INT)").alias("br"), F.expr(f"CAST(px_col DIV {size} AS INT)").alias("bc")]
        ring = F.array(*(F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r in (-1, 0, 1) for c in (-1, 0, 1)))
        h = todo.select("px_row", "px_col", *key, F.explode(ring).alias("o")).select("px_row", "px_col", (F.col("br") + F.col("o.r")).alias("br"), (F.col("bc") + F.col("o.c")).alias("bc"))
        v = valid.select(F.col("px_row").alias("vr"), F.col("px_col").alias("vc"), "value", *key)
        d = F.pow(F.col("px_row") - F.col("vr"), 2) + F.pow(F.col("px_col") - F.col("vc"), 2)
        # Within reach nothing nearer can hide in a bucket that was not looked at.
        found = h.hint("merge").join(v, ["br", "bc"]).withColumn("d", d)
        if size < most:
            found = found.where(F.col("d") <= size * size)
        found = table(found.groupBy("px_row", "px_col").agg(F.min_by("value", F.struct("d", "vr", "vc")).alias("value")), "nearest")
        out = found if out is None else out.unionByName(found)
        if size >= most:
            return out
        was, todo = todo, table(todo.join(found.hint("merge"), ["px_row", "px_col"], "left_anti"), "holes")
        discard(was)
        if not todo.take(1):
            return out
        reach *= 2


def grid_checks(cells: DataFrame, size: int) -> DataFrame:
    """Per chart: cells, distinct keys, and steps between neighbouring columns that differ from the cell size."""
    w = Window.partitionBy("chart", "row_idx").orderBy("col_idx")
    steps = cells.withColumn("step", F.col("x0") - F.lag("x0").over(w))
    return steps.groupBy("chart").agg(F.count("*").alias("n_cells"), F.count_distinct("grid_id").alias("n_keys"), F.count(F.when(F.col("step") != size, 1)).alias("n_bad_steps"))


def window_scan(panel: DataFrame, windows: DataFrame, key: str, years: Sequence[int]) -> DataFrame:
    """Every pixel and year of each window (``key, r0, r1, c0, c1``, ends included): ``key, px_row, px_col, year, class_id``.

    Where the panel has nothing, outside its lattice too, the class is 0.
    """
    rows = windows.select(key, F.explode(F.sequence("r0", "r1")).alias("px_row"), "c0", "c1")
    every = rows.select(key, "px_row", F.explode(F.sequence("c0", "c1")).alias("px_col")).withColumn("year", F.explode(F.array(*map(F.lit, years))))
    found = every.join(panel.select("px_row", "px_col", "year", "class_id"), ["px_row", "px_col", "year"], "left")
    return found.select(key, "px_row", "px_col", "year", F.coalesce("class_id", F.lit(0)).alias("class_id"))
