"""Reading tables whose columns come in many spellings, and writing results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def canonical(df: DataFrame, names: dict[str, Sequence[str]]) -> DataFrame:
    """Each wanted column from the first non-null of its alternative names; what none has is null."""
    lower = {c.lower(): c for c in df.columns}
    out = []
    for want, others in names.items():
        there = [F.col(f"`{lower[o.lower()]}`") for o in (want, *others) if o.lower() in lower]
        out.append((F.coalesce(*there) if there else F.lit(None)).alias(want))
    return df.select(*out)


def as_percent(df: DataFrame, column: str) -> DataFrame:
    """A share in percent, told from fractions by its greatest value."""
    most = df.agg(F.max(column).alias("most"))
    return df.crossJoin(F.broadcast(most)).withColumn(column, F.when(F.col("most") <= 1, F.col(column) * 100).otherwise(F.col(column))).drop("most")


def numeric(df: DataFrame, columns: Sequence[str], default: float = 0.0) -> DataFrame:
    """Columns as numbers, ``default`` where they are none."""
    return df.withColumns({c: F.coalesce(F.col(c).try_cast("double"), F.lit(default)) for c in columns})


def two_scales(small: DataFrame, large: DataFrame, zone: str) -> DataFrame:
    """Both scales in one table, cells without a zone left out."""
    both = small.withColumn("side", F.lit(2)).unionByName(large.withColumn("side", F.lit(3)), allowMissingColumns=True)
    return both.where(F.coalesce(F.col(zone), F.lit(0)) > 0)


def duplicate_keys(df: DataFrame, key: str, file: str) -> DataFrame:
    """Keys that several files have, with their number."""
    return df.groupBy(key).agg(F.count_distinct(file).alias("n_files")).where("n_files > 1")


def parse_date(text: Column) -> Column:
    """A date as day/month/year or ISO."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("dd/MM/yyyy")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd"))).cast("date")


def parse_years(text: Column, first: int, last: int) -> Column:
    """The distinct valid years of a comma-separated list, in order."""
    numbers = F.transform(F.split(text, "[,; ]+"), lambda x: x.try_cast("int"))
    return F.array_sort(F.array_distinct(F.filter(numbers, lambda y: y.between(first, last))))


def export_names(df: DataFrame, names: dict[str, str], most: int = 10) -> DataFrame:
    """Columns under their export names; a name that is too long or taken twice is an error."""
    out = [names.get(c, c) for c in df.columns]
    bad = [n for n in out if len(n) > most or out.count(n) > 1]
    if bad:
        raise ValueError(f"export names too long or not unique: {sorted(set(bad))}")
    return df.toDF(*out)


def write_run(df: DataFrame, path: str, run_id: str) -> None:
    """Appends a result under its run; other runs stay."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    """All runs, with columns that only some of them have."""
    return spark.read.option("mergeSchema", "true").parquet(path)


#: The properties that scenes of each sensor have them under, the first that is there counts.
SCENE_PROPERTIES = {
    "date": ("DATE_ACQUIRED", "SENSING_TIME", "GENERATION_TIME"),
    "satellite_name": ("SPACECRAFT_ID", "SATELLITE", "SPACECRAFT_NAME"),
    "sun_azimuth_angle": ("SUN_AZIMUTH", "SOLAR_AZIMUTH_ANGLE", "MEAN_SOLAR_AZIMUTH_ANGLE"),
    "sun_elevation_angle": ("SUN_ELEVATION",),
    "sun_zenith_angle": ("SOLAR_ZENITH_ANGLE", "MEAN_SOLAR_ZENITH_ANGLE"),
    "landsat_cloud": ("CLOUD_COVER",),
    "sentinel_cloud": ("CLOUDY_PIXEL_PERCENTAGE",),
    "sentinel_name": ("SPACECRAFT_NAME",),
}


def harmonise_scenes(scenes: DataFrame, key: str) -> DataFrame:
    """``key, cloud_cover, satellite_name, sun_azimuth_angle, sun_elevation_angle, date`` of scenes of any sensor.

    Properties that a table doesn't have count as null.  Elevation is 90 less the zenith where only that is
    known; the cloud cover of a scene with a ``SPACECRAFT_NAME`` is that of its pixels, else that of the scene.
    """
    found = canonical(scenes, {key: (), **SCENE_PROPERTIES})
    cloud = F.when(F.col("sentinel_name").isNotNull(), F.col("sentinel_cloud")).otherwise(F.col("landsat_cloud"))
    elevation = F.coalesce(F.col("sun_elevation_angle").cast("double"), 90 - F.col("sun_zenith_angle").cast("double"))
    day = F.date_format(F.col("date").cast("timestamp"), "yyyy-MM-dd")
    return found.select(key, cloud.cast("double").alias("cloud_cover"), "satellite_name", F.col("sun_azimuth_angle").cast("double").alias("sun_azimuth_angle"), elevation.alias("sun_elevation_angle"), day.alias("date"))


def write_report(rows: DataFrame, path: str, counts: Sequence[str]) -> None:
    """A run's results: ``table`` in Parquet, the same rows tidy in ``csv`` and, in ``summary``, JSON lines of how many
    rows there are and how many for each value of the columns ``counts``."""
    rows.write.parquet(f"{path}/table")
    kept = rows.sparkSession.read.parquet(f"{path}/table")
    kept.write.csv(f"{path}/csv", header=True)
    whole = kept.agg(F.lit("rows").alias("name"), F.lit("").alias("value"), F.count("*").alias("n"))
    for c in counts:
        whole = whole.unionByName(kept.groupBy(F.col(c).cast("string").alias("value")).agg(F.count("*").alias("n")).withColumn("name", F.lit(c)))
    whole.write.json(f"{path}/summary")


def read_report(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The table, the rows of the CSV in the table's types, and the summary of a run."""
    rows = spark.read.parquet(f"{path}/table")
    return rows, spark.read.schema(rows.schema).csv(f"{path}/csv", header=True), spark.read.schema("name string, value string, n long").json(f"{path}/summary")


def reuse_thresholds(stage: DataFrame, earlier: DataFrame, key: Sequence[str], threshold: str = "threshold") -> DataFrame:
    """The thresholds of an earlier stage for the same combination, those of the stage itself where there is none."""
    known = earlier.where(F.col(threshold).isNotNull()).groupBy(*key).agg(F.min(threshold).alias("known"))
    return stage.join(known, list(key), "left").withColumn(threshold, F.coalesce("known", threshold)).drop("known")


def earlier_selections(files: DataFrame, base: str, zone: str, scale: str) -> DataFrame:
    """Rows of ``files`` (``file`` and others) that count as taken for a selection of one UTM zone and scale.

    Those are selections with the zone and scale in their names, and the other zone's national sample of
    that scale; the selection's own output, taxonomies and reserves are not among them.
    """
    name = F.upper(F.col("file"))
    own = (name == f"SELECCION_{base.upper()}") | name.contains("_TAXONOMIA") | name.startswith("RESERVAS_")
    same = name.startswith("SELECCION_GRILLA_SSL4EO_") & name.contains(zone.upper()) & name.contains(scale.upper())
    other = "UTM19" if zone.upper() == "UTM18" else "UTM18"
    return files.where((same | (name == f"SELECCION_GRILLA_SSL4EO_MUESTRAS_{other}_{scale.upper()}")) & ~own)
