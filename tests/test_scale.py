"""Work that must stay in proportion to the input, and results that must not depend on how it is dealt out."""

import random

from pyspark.sql import functions as F

from terrapanel.functions import projection
from terrapanel.operators import graph, lattice, merging, scenes, selection, tilegrid
from terrapanel.operators.superpixels import connect_segments
from terrapanel.plans import audit_queries, selection_queries, topup_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sieve_writes_the_raster_once(spark, monkeypatch):
    written, whole = [], graph.table

    def spy(df, name, *rest):
        out = whole(df, name, *rest)
        written.append((name, out.count()))
        return out

    monkeypatch.setattr(graph, "table", spy)
    rows = [(r * 100 + c, r, c, 1 if c < 3 else 10 + r * 100 + c) for r in range(9) for c in range(9)]
    out = graph.sieve(spark.createDataFrame(rows, "id int, px_row int, px_col int, v int"), "v", 3)
    assert {(r.new, r.resolved) for r in out.collect()} == {(1, True)}
    assert [n for name, n in written if name == "sieve"] == [81] and [n for name, n in written if name == "votes"] == [9] * 6 + [0]
    assert "BroadcastHashJoin" not in plan(out)


def test_near_pairs_work_out_distances_by_place_and_shuffle(spark):
    rows = [(i, -70 + i % 3 * 0.1, -40.0) for i in range(30)]
    found = merging.near_pairs(spark.createDataFrame(rows, "id int, lon double, lat double"), 12000.0)
    assert {(r.a, r.b) for r in found.collect()} == {(a, b) for a in range(30) for b in range(a + 1, 30) if abs(a % 3 - b % 3) < 2}
    assert {round(r.metres) for r in found.collect() if r.a % 3 == r.b % 3} == {0}
    text = plan(found)
    assert "Broadcast" not in text and text.index("ArrowEvalPython") > text.index("SortMergeJoin")


def test_spaced_pick_is_that_of_a_loop_however_many_points_are_looked_at(spark, monkeypatch):
    rng = random.Random(12)
    rows = [(i, -70 + rng.randrange(12) * 0.1, -40.0, rng.choice([0, 1, None])) for i in range(90)]
    want = []
    for k in (0, 1, None):
        taken = []
        for i, lon, _, _ in (r for r in rows if r[3] == k):
            # Points of no stratum conflict with nothing.
            if len(taken) < 4 and (k is None or all(abs(lon - x) > 0.25 for _, x in taken)):
                taken.append((i, lon))
        want += [(i, k, n + 1) for n, (i, _) in enumerate(taken)]
    for n in (3, 10**6):
        monkeypatch.setattr(merging, "NEXT_POINTS", n)
        out = merging.spaced_pick(spark.createDataFrame(rows, "id int, lon double, lat double, k int"), "k", [F.col("id")], 4, 25000.0)
        assert sorted((r.id, r.k, r.place) for r in out.collect()) == sorted(want)


def test_boxes_meet_in_one_bucket_without_a_broadcast(spark):
    rng = random.Random(2)
    rows = [(i, x, y, x + rng.randrange(1, 9), y + rng.randrange(1, 9)) for i in range(40) for x, y in [(rng.randrange(-15, 15), rng.randrange(-15, 15))]]
    b = spark.createDataFrame(rows, "box_id int, x0 int, y0 int, x1 int, y1 int")
    want = [(p[0], q[0]) for p in rows for q in rows if p[0] < q[0] and min(p[3], q[3]) >= max(p[1], q[1]) and min(p[4], q[4]) >= max(p[2], q[2])]
    found = lattice.overlaps(b, b, 3, True)
    assert sorted((r.a, r.b) for r in found.collect()) == sorted(want)
    assert "Broadcast" not in plan(found) and "HashAggregate" not in plan(found)


def test_areas_and_grids_are_dealt_out_from_a_small_file(spark):
    rows = [(k, -75.0 + k * 0.01, -40.0 + k * 0.01) for k in range(12)]
    corner = lambda x, y: F.struct((F.col("lon") + x).alias("lon"), (F.col("lat") + y).alias("lat"))
    one = spark.createDataFrame(rows, "id int, lon double, lat double").coalesce(1).withColumn("ring", F.array(*(corner(x, y) for x, y in ((0.0, 0.0), (0.1, 0.0), (0.1, 0.1), (0.0, 0.1)))))
    area = projection.own_zone_area_km2(one, "ring")
    assert area.rdd.getNumPartitions() == 3 and area.count() == 12
    tiles = one.select(F.col("id").cast("string").alias("tile"), "ring", F.lit(18).alias("zone"), F.lit(True).alias("south"))
    grid = tilegrid.metric_grid(tiles, 2000.0, F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y")), "2x2")
    assert grid.rdd.getNumPartitions() == 3
    x, y = projection.utm(F.col("p.lon"), F.col("p.lat"), F.lit(18), F.lit(True))
    on_map = one.withColumn("q", F.explode(F.arrays_zip("ring", projection.to_utm(F.col("ring"), F.lit(18), F.lit(True)).alias("m")))).select(F.col("q.ring").alias("p"), F.col("q.m").alias("m"))
    assert on_map.where((x != F.col("m.x")) | (y != F.col("m.y"))).count() == 0


def test_lists_of_scenes_keep_the_first_of_each_without_sorting_all(spark):
    box = "string, x0 int, y0 int, x1 int, y1 int"
    sources = spark.createDataFrame([("b", 0, 0, 5, 5), ("a", 5, 0, 9, 5), ("z", 90, 90, 95, 95)], f"name {box}")
    targets = spark.createDataFrame([("t", 2, 2, 7, 3), ("far", 50, 50, 51, 51)], f"tile {box}")
    lists = [("b", 2000, 0, 2, ["p", "q"]), ("b", 2000, 0, 1, ["r", None, "p"]), ("a", 2000, 0, 7, ["q", "s", "q"]), ("z", 2000, 1, 1, ["u"]), ("a", 2000, 1, 1, None)]
    out = scenes.transfer_lists(spark.createDataFrame(lists, "name string, year int, satellite int, seq int, scenes array<string>"), sources, targets, 4)
    assert {(r.tile, r.satellite): r.scenes for r in out.collect()} == {("t", 0): ["q", "s", "r", None, "p"], ("t", 1): [], ("far", 0): [], ("far", 1): []}
    assert "SortAggregate" not in plan(out)


def test_segments_are_connected_without_broadcasts(spark):
    df = spark.createDataFrame([(r, c, "xy"[(r // 2 + c // 3) % 2]) for r in range(8) for c in range(9)], "px_row int, px_col int, v string")
    out = connect_segments(df, "v")
    assert out.count() == 72 and "Broadcast" not in plan(out)


def test_stratified_split_is_of_the_panels_cells(spark, sf_dir):
    out = topup_queries.split(spark, sf_dir)
    cells = selection_queries.metrics(spark, sf_dir).select("grid_id").collect()
    assert sorted(r.grid_id for r in out.collect()) == sorted(r.grid_id for r in cells)


def test_tasks_of_conflicts_and_boxes_grow_with_them(spark, monkeypatch):
    monkeypatch.setattr(selection, "PAIRS_PER_TASK", 4)
    monkeypatch.setattr(lattice, "BOXES_PER_TASK", 2)
    pairs = spark.createDataFrame([(a, a + 1) for a in range(19)] + [(5, 4), (7, 7)], "a long, b long")
    both = selection.both_directions(pairs)
    assert both.rdd.getNumPartitions() == 10
    assert sorted(map(tuple, both.collect())) == sorted({(a, a + 1) for a in range(19)} | {(a + 1, a) for a in range(19)})
    ranked = spark.createDataFrame([(a, (a * 7) % 20) for a in range(20)], "id long, rank long")
    taken = set()
    for a in sorted(range(20), key=lambda a: a * 7 % 20):
        if not taken & {a - 1, a + 1}:
            taken.add(a)
    monkeypatch.setattr(selection, "LAST_PAIRS", -1)
    assert {r.id for r in selection.independent_prefix(ranked, pairs).collect()} == taken
    boxes = spark.createDataFrame([(k, k, 0, k + 2, 2) for k in range(20)], "box_id long, x0 long, y0 long, x1 long, y1 long")
    found = lattice.overlaps(boxes, boxes, 4, True)
    assert found.rdd.getNumPartitions() == 10 and found.where("area > 0").count() == 19


def test_national_plan_reads_the_panel_once(spark, sf_dir):
    assert "lineitem" not in audit_queries.national(spark, sf_dir)._jdf.queryExecution().toString()
