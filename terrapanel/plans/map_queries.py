"""Queries in projected coordinates: areas in their own zones, metric grids, class boxes, lists of scenes by tile."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrapanel.functions import projection as pr
from terrapanel.operators import scenes as sc
from terrapanel.operators import tilegrid as tg
from terrapanel.plans.grid_queries import _CH, _PT, charts, points
from terrapanel.sources import adapters as ad

_E = 0.08181919084262149
#: Krüger's series in the third flattening, from its polynomials.
_N = 1 / (2 * 298.257223563 - 1)
_POLY = ([1 / 2, -2 / 3, 5 / 16, 41 / 180, -127 / 288, 7891 / 37800], [0, 13 / 48, -3 / 5, 557 / 1440, 281 / 630, -1983433 / 1935360], [0, 0, 61 / 240, -103 / 140, 15061 / 26880, 167603 / 181440], [0, 0, 0, 49561 / 161280, -179 / 168, 6601661 / 7257600], [0, 0, 0, 0, 34729 / 80640, -3418889 / 1995840], [0, 0, 0, 0, 0, 212378941 / 319334400])
_R = 0.9996 * 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)


def _utm_sql(table: str, out: str) -> str:
    """CTEs ending in ``out``: the rows of ``table`` (``lon, lat, zone``) with ``x, y`` on the southern half of their zone."""
    alpha = [sum(c * _N ** (k + 1) for k, c in enumerate(row)) for row in _POLY]
    x = " + ".join(f"{a!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, a in enumerate(alpha, 1))
    y = " + ".join(f"{a!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, a in enumerate(alpha, 1))
    return f"""{out}1 AS (SELECT *, radians(lon - (zone * 6 - 183)) AS dl, sinh(atanh(sin(radians(lat))) - {_E} * atanh({_E} * sin(radians(lat)))) AS t FROM {table}),
{out}2 AS (SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t * t)) AS eta FROM {out}1),
{out} AS MATERIALIZED (SELECT * EXCLUDE (dl, t, xi, eta), 500000 + {_R!r} * (eta + {x}) AS x, 10000000 + {_R!r} * (xi + {y}) AS y FROM {out}2)"""


def parcels(s, d):
    """A quadrangle for each customer, its four corners in order, and a group."""
    p = points(s, d)
    w, h = (F.col("id") % 7 + 1) * 0.01 + 0.003, (F.col("id") % 5 + 1) * 0.01
    corner = lambda x, y: F.struct((F.col("lon") + x).alias("lon"), (F.col("lat") + y).alias("lat"))
    return p.withColumn("ring", F.array(corner(F.lit(0.0), F.lit(0.0)), corner(w, F.lit(0.0)), corner(w, h), corner(F.lit(0.0), h)))


_PARCELS = f"""pc AS (SELECT c_custkey AS id, c_nationkey AS k, CAST(-76.0 AS DOUBLE) + (c_custkey * 7 % 1000) / 100.0 AS lon0, CAST(-56.0 AS DOUBLE) + (c_custkey * 13 % 3900) / 100.0 AS lat0, (c_custkey % 7 + 1) * 0.01::DOUBLE + 0.003::DOUBLE AS w, (c_custkey % 5 + 1) * 0.01::DOUBLE AS h FROM customer),
pk AS (SELECT id, i, lon0 + CASE WHEN i IN (1, 2) THEN w ELSE 0 END AS lon, lat0 + CASE WHEN i IN (2, 3) THEN h ELSE 0 END AS lat, CAST(floor((lon0 + w / 2 + 180) / 6) + 1 AS INT) AS zone FROM pc, (SELECT unnest(range(4)) AS i)),
{_utm_sql("pk", "pm")},
pa AS (SELECT id, 32700 + any_value(zone) AS epsg, abs(sum((x - fx) * (qy - fy) - (qx - fx) * (y - fy))) / 2 / 1e6 AS area FROM (
  SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS qx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS qy, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy FROM pm WINDOW w AS (PARTITION BY id ORDER BY i)) GROUP BY 1)"""

ORIGIN, SIDE, PIXEL = (160, 40), 5280.0, 0.01


def tiles(s, d):
    """A tile for each supplier: a box with a roof, in the zone of its middle."""
    k = F.col("s_suppkey")
    t = ad.table(s, d, "supplier").select(F.format_string("T%05d", k).alias("tile"), k.alias("k"), (F.lit(-75.0) + k * 61 % 800 / 100.0).alias("lon0"), (F.lit(-55.0) + k * 37 % 3500 / 100.0).alias("lat0"))
    spots = ((0.0, 0.0, 0), (0.3, 0.0, 0), (0.3, 0.25, 0), (0.15, 0.25, 1), (0.0, 0.25, 0))
    ring = F.array(*(F.struct((F.col("lon0") + x).alias("lon"), (F.col("lat0") + y + roof * (F.col("k") % 3) * 0.02).alias("lat")) for x, y, roof in spots))
    return t.withColumn("ring", ring).withColumn("zone", (F.floor((F.col("lon0") + 0.15 + 180) / 6) + 1).cast("int")).withColumn("south", F.lit(True)).drop("k", "lon0", "lat0")


_TILES = """tl AS (SELECT printf('T%05d', s_suppkey) AS tile, i, CAST(-75.0 AS DOUBLE) + (s_suppkey * 61 % 800) / 100.0 + [0.0::DOUBLE, 0.3, 0.3, 0.15, 0.0][i + 1] AS lon, CAST(-55.0 AS DOUBLE) + (s_suppkey * 37 % 3500) / 100.0 + [0.0::DOUBLE, 0.0, 0.25, 0.25, 0.25][i + 1] + CASE WHEN i = 3 THEN s_suppkey % 3 * 0.02::DOUBLE ELSE 0 END AS lat,
  CAST(floor((CAST(-75.0 AS DOUBLE) + (s_suppkey * 61 % 800) / 100.0 + 0.15 + 180) / 6) + 1 AS INT) AS zone FROM supplier, (SELECT unnest(range(5)) AS i))"""


def _clip_sql(cells: str, ring: str, out: str) -> str:
    """CTEs ending in ``out``: ``grid_id`` and ``share``, cells (``x0 .. y1``) cut to the polygons of their tiles by four half-planes."""
    ctes = [f"{out}0 AS (SELECT grid_id, x0, y0, x1, y1, i::BIGINT AS i, r.x, r.y FROM {cells} JOIN {ring} r USING (tile))"]
    for n, (a, o, edge, sign) in enumerate((("x", "y", "x0", ">="), ("x", "y", "x1", "<="), ("y", "x", "y0", ">="), ("y", "x", "y1", "<="))):
        src, at = f"{out}{n}", f"p{o} + ({edge} - p{a}) / (q{a} - p{a}) * (q{o} - p{o})"
        point = {a: edge, o: at}
        ctes.append(f"{src}n AS (SELECT grid_id, x0, y0, x1, y1, i, x AS px, y AS py, coalesce(lead(x) OVER w, first_value(x) OVER w) AS qx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS qy FROM {src} WINDOW w AS (PARTITION BY grid_id ORDER BY i))")
        ctes.append(f"{out}{n + 1} AS (SELECT grid_id, x0, y0, x1, y1, 2 * i AS i, {point['x']} AS x, {point['y']} AS y FROM {src}n WHERE (p{a} {sign} {edge}) <> (q{a} {sign} {edge}) UNION ALL SELECT grid_id, x0, y0, x1, y1, 2 * i + 1, qx, qy FROM {src}n WHERE q{a} {sign} {edge})")
    ctes.append(f"""{out} AS (SELECT grid_id, abs(sum((x - fx) * (qy - fy) - (qx - fx) * (y - fy))) / 2 / any_value((x1 - x0) * (y1 - y0)) AS share FROM (
  SELECT *, coalesce(lead(x) OVER w, first_value(x) OVER w) AS qx, coalesce(lead(y) OVER w, first_value(y) OVER w) AS qy, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy FROM {out}4 WINDOW w AS (PARTITION BY grid_id ORDER BY i)) GROUP BY 1)""")
    return ", ".join(ctes)


_METRIC = f"""WITH {_TILES}, {_utm_sql("tl", "tm")},
bd AS (SELECT tile, zone, CAST(floor((min(x) - {ORIGIN[0]} - zone) / {SIDE}) AS BIGINT) AS c0, CAST(ceil((max(x) - {ORIGIN[0]} - zone) / {SIDE}) AS BIGINT) AS c1, CAST(floor((min(y) - {ORIGIN[1]}) / {SIDE}) AS BIGINT) AS r0, CAST(ceil((max(y) - {ORIGIN[1]}) / {SIDE}) AS BIGINT) AS r1 FROM tm GROUP BY 1, 2),
ce AS (SELECT *, printf('%s_2x2_c%03d_r%03d', tile, c - c0, r - r0) AS grid_id, {ORIGIN[0]} + zone + c * {SIDE} AS x0, {ORIGIN[1]} + r * {SIDE} AS y0, {ORIGIN[0]} + zone + c * {SIDE} + {SIDE} AS x1, {ORIGIN[1]} + r * {SIDE} + {SIDE} AS y1 FROM (SELECT *, unnest(range(c0, c1)) AS c FROM (SELECT *, unnest(range(r0, r1)) AS r FROM bd))),
{_clip_sql("ce", "tm", "cl")}
SELECT grid_id, tile, CAST(c - c0 AS INT) AS col_idx, CAST(r - r0 AS INT) AS row_idx, c AS col_off, r AS row_off, x0, y0, round(share, 6) AS share FROM ce JOIN cl USING (grid_id) WHERE share >= 0.999"""

_LEFT, _TOP, _WIDE, _HIGH, _SIZE = -76.0, -18.0, 1100, 3900, 6
_ALIGNED = f"""WITH {_TILES}, rg AS (SELECT tile, i, lon AS x, lat AS y FROM tl),
bd AS (SELECT tile, greatest(0, CAST(ceil((min(x) - {_LEFT}) / {PIXEL}::DOUBLE - 0.5) AS BIGINT)) AS c0, least({_WIDE}, CAST(floor((max(x) - {_LEFT}) / {PIXEL}::DOUBLE - 0.5) AS BIGINT) + 1) AS c1, greatest(0, CAST(ceil(({_TOP} - max(y)) / {PIXEL}::DOUBLE - 0.5) AS BIGINT)) AS r0, least({_HIGH}, CAST(floor(({_TOP} - min(y)) / {PIXEL}::DOUBLE - 0.5) AS BIGINT) + 1) AS r1 FROM rg GROUP BY 1),
sp AS (SELECT tile, c0 - c0 % {_SIZE} AS c0, r0 - r0 % {_SIZE} AS r0, c1, r1 FROM bd WHERE c1 > c0 AND r1 > r0),
ix AS (SELECT *, unnest(range((c1 - c0) // {_SIZE})) AS ci FROM (SELECT *, unnest(range((r1 - r0) // {_SIZE})) AS ri FROM sp)),
ce AS (SELECT *, printf('%s_6x6_c%03d_r%03d', tile, ci, ri) AS grid_id, {_LEFT} + co * {PIXEL}::DOUBLE AS x0, {_TOP} - (ro + {_SIZE}) * {PIXEL}::DOUBLE AS y0, {_LEFT} + (co + {_SIZE}) * {PIXEL}::DOUBLE AS x1, {_TOP} - ro * {PIXEL}::DOUBLE AS y1 FROM (SELECT *, c0 + ci * {_SIZE} AS co, r0 + ri * {_SIZE} AS ro FROM ix) WHERE co + {_SIZE} <= {_WIDE} AND ro + {_SIZE} <= {_HIGH}),
{_clip_sql("ce", "rg", "cl")}
SELECT grid_id, tile, CAST(ci AS INT) AS col_idx, CAST(ri AS INT) AS row_idx, co AS col_off, ro AS row_off, round(share, 6) AS share FROM ce JOIN cl USING (grid_id) WHERE share >= 0.999"""

#: Boxes of classes in metres: zone, and least and most easting and northing.
CLASS_BOXES = {1: (19, 200000.0, 600000.0, 5000000.0, 7400000.0), 3: (18, 500000.0, 900000.0, 4000000.0, 6500000.0), 4: (19, 100000.0, 450000.0, 6000000.0, 7900000.0)}


def class_shares(s, d):
    p = points(s, d)
    return p.select("id", "lon", "lat", (F.col("id") % 5).cast("int").alias("class_id"), (F.col("id") % 101).cast("double").alias("pct"))


def boxed(s, d):
    boxes = s.createDataFrame([(c, *v) for c, v in CLASS_BOXES.items()], "class_id int, zone int, xmin double, xmax double, ymin double, ymax double")
    return tg.outside_class_box(class_shares(s, d), boxes)


_BOXED = f"""WITH {{points}}, bx AS (SELECT * FROM (VALUES {", ".join(f"({c}, {', '.join(map(str, v))})" for c, v in CLASS_BOXES.items())}) t(class_id, zone, xmin, xmax, ymin, ymax)),
cs AS (SELECT id, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat, CAST(id % 5 AS INT) AS class_id, CAST(id % 101 AS DOUBLE) AS pct FROM pt), cz AS (SELECT cs.*, zone, xmin, xmax, ymin, ymax FROM cs LEFT JOIN bx USING (class_id)), {_utm_sql("cz", "cu")}
SELECT id, class_id, x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax AS inside, CASE WHEN zone IS NULL OR (x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax) THEN 0.0 ELSE pct END AS outside_pct FROM cu"""


def transferred(s, d):
    c = charts(s, d).withColumn("k", F.element_at(F.split("chart", "-"), -1).cast("long"))
    rows = ad.table(s, d, "lineitem").select(F.col("l_suppkey").alias("k"), F.year("l_shipdate").alias("year"), (F.col("l_linenumber") % 3).alias("satellite"), F.col("l_orderkey").alias("seq"), F.concat(F.lit("s"), (F.col("l_orderkey") % 700).cast("string")).alias("scene"), "l_linenumber")
    records = rows.groupBy("k", "year", "satellite", "seq").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "scene"))), lambda x: x["scene"]).alias("scenes"))
    records = records.join(c.select("k", F.col("chart").alias("name")), "k").drop("k")
    targets = c.where("k % 3 = 0").select(F.concat(F.lit("m"), F.col("k").cast("string")).alias("tile"), F.col("x0"), F.col("y0"), (F.col("x0") + 200).alias("x1"), (F.col("y1") + 1).alias("y1"))
    far = targets.limit(0).unionByName(c.agg(F.lit("m-far").alias("tile"), F.lit(-500).alias("x0"), F.lit(-9).alias("y0"), F.lit(-400).alias("x1"), F.lit(-5).alias("y1")))
    return sc.transfer_lists(records, c.select(F.col("chart").alias("name"), "x0", "y0", "x1", "y1"), targets.unionByName(far), 100)


_TRANSFER = f"""WITH {_CH}, ck AS (SELECT *, CAST(string_split(chart, '-')[3] AS BIGINT) AS k FROM ch),
tg AS (SELECT 'm' || k AS tile, x0, y0, x0 + 200 AS x1, y1 + 1 AS y1 FROM ck WHERE k % 3 = 0 UNION ALL SELECT 'm-far', -500, -9, -400, -5),
ls AS (SELECT chart, year(l_shipdate) AS year, l_linenumber % 3 AS satellite, l_orderkey AS seq, l_linenumber AS pos, 's' || (l_orderkey % 700) AS scene FROM lineitem JOIN ck ON k = l_suppkey),
sn AS (SELECT tile, year, satellite, scene, min((chart, seq, pos)) AS first FROM ls JOIN ck USING (chart) JOIN tg ON least(ck.x1, tg.x1) >= greatest(ck.x0, tg.x0) AND least(ck.y1, tg.y1) >= greatest(ck.y0, tg.y0) GROUP BY ALL),
mg AS (SELECT tile, year, satellite, list(scene ORDER BY first) AS scenes FROM sn GROUP BY ALL)
SELECT tile, CAST(year AS INT) AS year, satellite, coalesce(array_to_string(scenes, ','), '') AS scenes, coalesce(len(scenes), 0) AS n FROM (SELECT tile, year, satellite FROM tg, (SELECT DISTINCT year, satellite FROM ls)) LEFT JOIN mg USING (tile, year, satellite)"""

QUERIES = {
    "b3_metric_grid": (lambda s, d: tg.metric_grid(tiles(s, d), SIDE, F.struct((F.col("zone") + ORIGIN[0]).cast("double").alias("x"), F.lit(float(ORIGIN[1])).alias("y")), "2x2").withColumn("share", F.round("share", 6)), _METRIC),
    "b5_tile_rectangles": (
        lambda s, d: tg.pixel_rectangles(tiles(s, d).withColumn("ring", F.transform("ring", lambda p: F.struct(p["lon"].alias("x"), p["lat"].alias("y")))), _SIZE, _LEFT, _TOP, PIXEL, _WIDE, _HIGH, "6x6").withColumn("share", F.round("share", 6)),
        _ALIGNED,
    ),
    "b8_utm_coordinates": (
        lambda s, d: (lambda p, xy: p.select("id", F.round(xy[0], 3).alias("x"), F.round(xy[1], 3).alias("y")))(points(s, d), pr.utm(F.col("lon"), F.col("lat"), F.floor((F.col("lon") + 180) / 6) + 1, F.col("lat") < 0)),
        f"WITH {_PT}, pz AS (SELECT id, CAST(lon AS DOUBLE) AS lon, CAST(lat AS DOUBLE) AS lat, floor((lon + 180) / 6) + 1 AS zone FROM pt), {_utm_sql('pz', 'pu')} SELECT id, round(x, 3) AS x, round(y, 3) AS y FROM pu",
    ),
    "b11_class_box": (boxed, _BOXED.replace("{points}", _PT)),
    "f15_blacklist_transfer": (lambda s, d: transferred(s, d).select("tile", "year", "satellite", F.array_join("scenes", ",").alias("scenes"), F.size("scenes").cast("long").alias("n")), _TRANSFER),
    "m1_equivalent_diameter": (lambda s, d: pr.own_zone_area_km2(parcels(s, d), "ring").select("id", "epsg", F.round("area_km2", 6).alias("area_km2"), F.round("diameter_km", 6).alias("diameter_km")), f"WITH {_PARCELS} SELECT id, epsg, round(area, 6) AS area_km2, round(2 * sqrt(area / pi()), 6) AS diameter_km FROM pa"),
    "m1_size_summary": (
        lambda s, d: (lambda t: t.select("k", "n", *(F.round(c, 4).alias(c) for c in t.columns if c not in ("k", "n"))))(pr.size_summary(pr.own_zone_area_km2(parcels(s, d), "ring"), "k")),
        f"WITH {_PARCELS}, pd AS (SELECT k, area AS area_km2, 2 * sqrt(area / pi()) AS diameter_km FROM pa JOIN pc USING (id)) SELECT k, count(*) AS n, " + ", ".join(f"round(quantile_cont({c}, {q}), 4) AS {c}_{n}" for c in ("area_km2", "diameter_km") for n, q in (("median", 0.5), ("p10", 0.1), ("p90", 0.9))) + " FROM pd GROUP BY 1",
    ),
}
