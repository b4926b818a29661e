"""Lists of scenes that move from the tiles of one grid to those of another."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrapanel.operators.lattice import overlaps
from terrapanel.sources.shared import table


def transfer_lists(records: DataFrame, sources: DataFrame, targets: DataFrame, bucket: int) -> DataFrame:
    """``tile, year, satellite, scenes`` for each target tile and each year and satellite that the records have.

    ``records`` has ``name`` (source tile), ``year, satellite``, ``seq`` (their order) and the array ``scenes``; ``sources`` has
    ``name`` and bounds ``x0 .. y1``, ``targets`` ``tile`` and bounds.  A target takes the lists of all source tiles that it meets,
    borders included, in the order of their names and records; a scene counts where it is seen first.  Lists are
    whole, however long; without any scene they are empty.
    """
    left = targets.select(F.col("tile").alias("box_id"), "x0", "y0", "x1", "y1")
    right = sources.select(F.col("name").alias("box_id"), "x0", "y0", "x1", "y1")
    pairs = overlaps(left, right, bucket).select(F.col("a").alias("tile"), F.col("b").alias("name")).distinct()
    pairs = pairs.withColumn("place", F.row_number().over(Window.partitionBy("tile").orderBy("name")))
    # Each source's own list first; then a scene's place is one number, and the first of a tile is found on the map side too.
    placed = F.transform(F.coalesce("scenes", F.array()), lambda x, i: F.struct(F.col("seq").alias("seq"), i.alias("pos"), x.alias("scene")))
    own = F.array_distinct(F.transform(F.array_sort(F.flatten(F.collect_list(placed))), lambda x: x["scene"]))
    records = table(records.groupBy("name", "year", "satellite").agg(own.alias("scenes")), "lists")
    listed = pairs.hint("merge").join(records, "name").select("tile", "year", "satellite", "place", F.posexplode("scenes").alias("pos", "scene"))
    seen = listed.groupBy("tile", "year", "satellite", "scene").agg(F.min(F.col("place").cast("long") * (1 << 32) + F.col("pos")).alias("first"))
    merged = seen.groupBy("tile", "year", "satellite").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "scene"))), lambda x: x["scene"]).alias("scenes"))
    wanted = targets.select("tile").distinct().crossJoin(F.broadcast(records.select("year", "satellite").distinct()))
    none = F.array().cast(merged.schema["scenes"].dataType)
    return wanted.join(merged, ["tile", "year", "satellite"], "left").select("tile", "year", "satellite", F.coalesce("scenes", none).alias("scenes"))
