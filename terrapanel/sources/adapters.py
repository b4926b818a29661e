"""Land-cover tables derived from the driver tables, so that queries grow with them.

A pixel is a part on a lattice 50 columns wide, its class in a year follows from what was shipped, its
area falls with the row, its zone follows from the part's size; cells are 5 x 5 pixels.  Class 0 is no
data and class 8 was not observed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PERIODS = [("P1", 1995, 1996), ("P2", 1997, 1998), ("P3", 1999, 2000), ("P4", 2001, 2001)]
FIRST_YEAR, LAST_YEAR = 1995, 2001

#: CTEs with the same tables for the oracle.
SQL = """
panel AS (
  SELECT px_row, px_col, (px_row // 5) * 10 + px_col // 5 AS grid_id, 100 - px_row % 50 AS area, year, class_id FROM (
    SELECT CAST(l_partkey // 50 AS INT) AS px_row, CAST(l_partkey % 50 AS INT) AS px_col, CAST(year(l_shipdate) AS INT) AS year,
           CAST(sum(l_linenumber) % 9 AS INT) AS class_id FROM lineitem GROUP BY 1, 2, 3)),
zone AS (SELECT CAST(p_partkey // 50 AS INT) AS px_row, CAST(p_partkey % 50 AS INT) AS px_col, p_size % 6 AS eco_id FROM part),
periods AS (SELECT * FROM (VALUES ('P1', 1995, 1996), ('P2', 1997, 1998), ('P3', 1999, 2000), ('P4', 2001, 2001)) t(period, y0, y1)),
pxmode AS (SELECT px_row, px_col, grid_id, area, class_id AS mode_id FROM (
  SELECT *, row_number() OVER (PARTITION BY px_row, px_col ORDER BY n DESC, class_id) AS rk FROM (
    SELECT px_row, px_col, grid_id, area, class_id, count(*) AS n FROM panel GROUP BY ALL)) WHERE rk = 1),
cell_class AS (SELECT grid_id, mode_id AS class_id, sum(area) AS ha FROM pxmode GROUP BY ALL)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pixel(key: str) -> list:
    return [F.expr(f"CAST({key} DIV 50 AS INT)").alias("px_row"), F.expr(f"CAST({key} % 50 AS INT)").alias("px_col")]


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``px_row, px_col, grid_id, area, year, class_id``."""
    found = table(spark, sf_dir, "lineitem").groupBy("l_partkey", F.year("l_shipdate").alias("year")).agg((F.sum("l_linenumber") % 9).cast("int").alias("class_id"))
    found = found.select(*pixel("l_partkey"), "year", "class_id")
    return found.select("px_row", "px_col", F.expr("(px_row DIV 5) * 10 + px_col DIV 5").cast("int").alias("grid_id"), F.expr("100 - px_row % 50").alias("area"), "year", "class_id")


def zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``px_row, px_col, eco_id``; 0 is no zone."""
    return table(spark, sf_dir, "part").select(*pixel("p_partkey"), (F.col("p_size") % 6).alias("eco_id"))


def periods(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PERIODS, "period string, y0 int, y1 int")
