"""Operators without an oracle against plain loops, and traps of their semantics."""

import random

import pytest
from pyspark.sql import functions as F

from terrapanel.functions import geodesy
from terrapanel.operators import graph, labels, lattice, merging, panel, reviewplan, selection
from terrapanel.operators.components import connected_components
from terrapanel.operators.superpixels import superpixels


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def test_components_match_union_find(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(5, 5), (None, 3), (7, None)]
    parent = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(parent, a), find(parent, b)
            parent[max(x, y)] = min(x, y)
    for last in (0, 10**6):
        got = dict(connected_components(spark.createDataFrame(edges, "a int, b int"), "a", "b", last).collect())
        assert got == {n: find(parent, n) for n in parent}


def test_components_of_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "a int, b int"), "a", "b").collect() == []
    assert connected_components(spark.createDataFrame([], "a string, b string"), "a", "b", 9).collect() == []


@pytest.mark.parametrize("seed", range(3))
def test_independent_prefix_is_the_greedy_pick(spark, seed, monkeypatch):
    monkeypatch.setattr(selection, "LAST_PAIRS", (0, 20, 10**6)[seed % 3])
    rng = random.Random(seed)
    ids = list(range(25))
    rank = {i: k for k, i in enumerate(rng.sample(ids, len(ids)))}
    edges = {tuple(sorted(rng.sample(ids, 2))) for _ in range(30)}
    picked = set()
    for i in sorted(ids, key=rank.get):
        if not any({i, j} in map(set, edges) for j in picked):
            picked.add(i)
    found = selection.independent_prefix(spark.createDataFrame(list(rank.items()), "id int, rank int"), spark.createDataFrame(sorted(edges), "a int, b int"))
    assert {r.id for r in found.collect()} == picked


def test_independent_prefix_leaves_out_what_meets_the_taken(spark):
    found = selection.independent_prefix(spark.createDataFrame([(1, 1), (2, 2), (3, 3)], "id int, rank int"), spark.createDataFrame([(1, 9), (2, 3)], "a int, b int"), spark.createDataFrame([(9,)], "id int"))
    assert {r.id for r in found.collect()} == {2}


@pytest.mark.parametrize("available", [[1, 2, 50, 50], [10, 10, 10, 10], [0, 0, 3, 100], [5, 5, 5, 5]])
def test_capped_equal_fills_and_adds_up(spark, available):
    rows = [(0, k, a) for k, a in enumerate(available)]
    out = selection.capped_equal(spark.createDataFrame(rows, "g int, k int, a long"), ["g"], "a", 30, "k").collect()
    assert sum(r.quota for r in out) == min(30, sum(available))
    assert all(r.quota <= r.a for r in out)
    rest = [r.quota for r in out if r.quota < r.a]
    assert max(rest, default=0) - min(rest, default=0) <= 1


def test_balanced_years_use_each_year_as_often(spark):
    rows = [("z", float(k), k) for k in range(10)]
    out = selection.balanced_years(spark.createDataFrame(rows, "g string, s double, k long"), ["g"], ["s"], [1996, 1998, 2000], "k").collect()
    used = {1996: 0, 1998: 0, 2000: 0}
    for r in sorted(out, key=lambda r: r.k):
        least = min(used.values())
        ties = sorted(y for y, n in used.items() if n == least)
        assert r.ref_year == ties[r.k % len(ties)]
        used[r.ref_year] += 1


def test_no_task_holds_a_whole_group(spark, sf_dir):
    rows = [("a", float(k * 7 % 50), k) for k in range(50)]
    out = selection.balanced_years(spark.createDataFrame(rows, "g string, s double, k long"), ["g"], ["s"], [1996, 1998, 2000], "k")
    used, want = dict.fromkeys((1996, 1998, 2000), 0), {}
    for _, _, k in sorted(rows, key=lambda r: (r[1], r[2])):
        ties = [y for y in used if used[y] == min(used.values())]
        want[k] = ties[k % len(ties)]
        used[want[k]] += 1
    assert {r.k: r.ref_year for r in out.collect()} == want
    assert "row_number" in out._jdf.queryExecution().toString()
    from terrapanel.plans import registry

    assert "TakeOrderedAndProject" in registry.queries()["g21_seeded_shuffle"](spark, sf_dir)._jdf.queryExecution().toString()


def test_mode_ties_and_exclusion(spark):
    rows = [(0, 0, 1, 1, y, c) for y, c in enumerate((3, 3, 2, 2))] + [(0, 1, 1, 1, y, c) for y, c in enumerate((0, 0, 8, 5))] + [(0, 2, 1, 1, 0, 8)]
    p = spark.createDataFrame(rows, "px_row int, px_col int, grid_id int, area int, year int, class_id int")
    assert {r.px_col: r.mode_id for r in panel.temporal_mode(p).collect()} == {0: 2, 1: 0, 2: 8}
    assert {r.px_col: r.mode_id for r in panel.temporal_mode(p, (0, 8)).collect()} == {0: 2, 1: 5, 2: 0}


def test_longest_run_takes_the_first_of_equals(spark):
    rows = [(1, y, s) for y, s in zip(range(2000, 2007), (True, True, False, True, True, False, False), strict=True)] + [(2, 2000, False)]
    out = {r.grid_id: (r.max_run, r.run_start, r.run_end) for r in panel.longest_run(spark.createDataFrame(rows, "grid_id int, year int, stable boolean")).collect()}
    assert out == {1: (2, 2000, 2001), 2: (0, None, None)}


def test_sieve_matches_rounds(spark):
    rng = random.Random(5)
    size = 9
    grid = {(r, c): rng.choice([1, 1, 1, 2, 3]) for r in range(size) for c in range(size)}
    parent = {k: k for k in grid}
    near = [(r, c) for r in (-1, 0, 1) for c in (-1, 0, 1) if r or c]
    for r, c in grid:
        for dr, dc in near:
            q = (r + dr, c + dc)
            if grid.get(q) == grid[r, c]:
                parent[find(parent, q)] = find(parent, (r, c))
    size_of = {}
    for k in grid:
        size_of[find(parent, k)] = size_of.get(find(parent, k), 0) + 1
    now, settled = dict(grid), {k: size_of[find(parent, k)] >= 3 for k in grid}
    while True:
        new = {}
        for (r, c), ok in settled.items():
            votes = [now[r + dr, c + dc] for dr, dc in near if not ok and settled.get((r + dr, c + dc))]
            if votes:
                new[r, c] = min(set(votes), key=lambda v: (-votes.count(v), v))
        if not new:
            break
        now |= new
        settled |= dict.fromkeys(new, True)
    px = spark.createDataFrame([(r * 100 + c, r, c, v) for (r, c), v in grid.items()], "id int, px_row int, px_col int, v int")
    assert {r.id: r.new for r in graph.sieve(px, "v", 3).collect()} == {r * 100 + c: v for (r, c), v in now.items()}


def test_sieve_takes_the_nearest_where_no_vote_reaches(spark):
    rows = [(k, 0, k, 1) for k in range(4)] + [(10, 0, 20, 2), (11, 5, 1, 3), (12, 40, 40, 4)] + [(50 + k, 41 + k, 60, 5) for k in range(3)]
    out = {r.id: (r.new, r.resolved) for r in graph.sieve(spark.createDataFrame(rows, "id int, px_row int, px_col int, v int"), "v", 3).collect()}
    assert {k: out[k] for k in (10, 11, 12)} == {10: (1, True), 11: (1, True), 12: (5, True)}
    lone = graph.sieve(spark.createDataFrame(rows[4:6], "id int, px_row int, px_col int, v int"), "v", 3)
    assert {(r.id, r.new, r.resolved) for r in lone.collect()} == {(10, 2, False), (11, 3, False)}


def test_diagonal_pixels_join_with_eight_neighbours_only(spark):
    px = spark.createDataFrame([(0, 0, 0, 1), (11, 1, 1, 1)], "id int, px_row int, px_col int, v int")
    assert {r.patch for r in graph.patches(px, "v", 4).collect()} == {0, 11}
    assert {r.patch for r in graph.patches(px, "v", 8).collect()} == {0}


def test_contact_is_not_overlap(spark):
    b = spark.createDataFrame([(1, 0, 0, 2, 2), (2, 2, 0, 4, 2), (3, 1, 1, 3, 3), (4, 9, 9, 10, 10)], "box_id int, x0 int, y0 int, x1 int, y1 int")
    assert {(r.a, r.b, r.area) for r in lattice.overlaps(b, b, 3, True).collect()} == {(1, 2, 0), (1, 3, 1), (2, 3, 1)}


def test_areas_of_pixels_shrink_to_the_south(spark):
    d = 0.00026949458523585647
    out = spark.createDataFrame([(-17.5,), (-55.9,)], "lat double").select(F.round(geodesy.quad_area_ha(F.lit(-70.0), F.col("lat"), F.lit(-70.0) + d, F.col("lat") + d), 4)).collect()
    assert [r[0] for r in out] == pytest.approx([0.0854, 0.0506], abs=2e-4)


def test_geodesic_of_a_degree(spark):
    out = spark.createDataFrame([(0.0, 0.0, 1.0, 0.0), (0.0, 0.0, 0.0, 1.0), (5.0, 5.0, 5.0, 5.0)], "a double, b double, c double, d double").select(geodesy.geodesic_m("a", "b", "c", "d")).collect()
    assert [r[0] for r in out] == pytest.approx([111319.491, 110574.389, 0.0], abs=0.01)


PERIOD = "array<struct<y0:int,p:string,y1:int,mid:int,md_id:int,md_pct:double,n_stable:int>>"


def planned(spark, **cell):
    """The plan of one cell as (years, roles, method); periods are given as (md_id, md_pct, n_stable)."""
    of = [(1999, "P1", 2005, 2002), (2006, "P2", 2012, 2009), (2013, "P3", 2018, 2015), (2019, "P4", 2024, 2021)]
    ps = [(*p, *m) for p, m in zip(of, cell.pop("ps", [(3, 50.0, 2)] * 4), strict=True)]
    row = {"sample_type": None, "ref_year": None, "target_class": None, "run_start": None, "run_end": None, "transition_pct": None, "max_stab_run": None} | cell
    schema = f"sample_type string, ref_year int, target_class int, run_start int, run_end int, transition_pct double, max_stab_run int, periods {PERIOD}"
    r = reviewplan.review_years(spark.createDataFrame([(*row.values(), ps)], schema)).first()
    slots = [(r[f"rev_year{k}"], r[f"rev_role{k}"]) for k in (1, 2, 3)]
    assert r.rev_n_years == sum(y != -9999 for y, _ in slots) and all((y == -9999) == (role == "") for y, role in slots)
    return [x for x in slots if x[1]], r.rev_metodo


def test_review_years_of_every_rule(spark):
    during, changed = "durante_cambio", [(3, 50.0, 1), (None, 9.0, 1), (4, 50.0, 5), (4, 60.0, 5)]
    assert planned(spark, sample_type="anual_homogenea", ref_year=2009) == ([(2009, "anual")], "ref_year_directo")
    assert planned(spark, sample_type="anual_simple_media", ref_year=1990) == ([(2021, "anual")], "ref_year_directo")
    assert planned(spark, sample_type="anual_homogenea") == ([(2021, "anual")], "ref_year_directo")
    assert planned(spark, sample_type="estable_homogenea", run_start=1999, run_end=2024) == ([(2011, "ancla"), (2021, "control_sensor")], "estable_ancla_control")
    assert planned(spark, sample_type="estable_homogenea", run_start=2010, run_end=2004) == ([(2007, "ancla")], "estable_ancla_control")
    assert planned(spark, sample_type="estable_simple_media", run_start=2016, run_end=2001) == ([(2008, "ancla"), (2002, "control_sensor")], "estable_ancla_control")
    assert planned(spark, sample_type="estable_simple_media", run_start=2009, run_end=2009) == ([(2009, "ancla")], "estable_ancla_control")
    assert planned(spark, sample_type="transicion_homogenea", ps=changed) == ([(2013, during), (2002, "antes"), (2015, "despues")], "transicion_md_periodos")
    assert planned(spark, sample_type="transicion_homogenea", ref_year=2007) == ([(2007, during)], "transicion_fallback_sin_cambio_periodo")
    jump = [(3, 50.0, 1), (3, 90.0, 1), (3, 50.0, 1), (3, 60.0, 1)]
    assert planned(spark, sample_type="transicion_simple_media", ps=jump) == ([(2009, during)], "transicion_fallback_sin_cambio_periodo")
    assert planned(spark, sample_type="transicion_simple_media", ps=[(0, 1.0, 0)] * 4) == ([(2021, during)], "transicion_fallback_sin_cambio_periodo")
    assert planned(spark, sample_type="presencia_censo", target_class=4, ps=changed) == ([(2021, "representativo_clase")], "censo_refuerzo_periodo_dominante")
    assert planned(spark, sample_type="presencia_censo", target_class=9, ref_year=2004, ps=changed) == ([(2004, "representativo_clase")], "censo_refuerzo_fallback")
    assert planned(spark, sample_type="presencia_refuerzo", ref_year=1980, ps=jump) == ([(2009, "representativo_clase")], "censo_refuerzo_fallback")
    filler = {"sample_type": "relleno_presupuesto", "ps": changed}
    assert planned(spark, **filler, transition_pct=3.5) == ([(2013, during), (2002, "antes"), (2015, "despues")], "relleno_por_composicion")
    assert planned(spark, **filler, transition_pct=3.0, max_stab_run=6, run_start=2000, run_end=2003) == ([(2001, "ancla"), (2002, "control_sensor")][:1], "relleno_por_composicion")
    assert planned(spark, **filler, max_stab_run=5) == ([(2015, "representativo_clase")], "relleno_por_composicion")
    assert planned(spark, sample_type="other", ps=changed) == ([(2015, "representativo_clase")], "tipo_desconocido_fallback")
    assert planned(spark) == ([(2002, "representativo_clase")], "tipo_desconocido_fallback")


def test_kappa_is_null_where_chance_explains_all(spark):
    out = labels.agreement(spark.createDataFrame([(1, 1), (1, 1), (None, 1)], "t int, g int"), "t", "g").first()
    assert (out.n, out.accuracy, out.kappa) == (2, 1.0, None)


def test_near_pairs_are_all_pairs_within_reach(spark):
    rng = random.Random(8)
    rows = [(i, -70 + rng.random(), -40 + rng.random()) for i in range(40)]
    points = spark.createDataFrame(rows, "id int, lon double, lat double")
    every = points.toDF("a", "x1", "y1").crossJoin(points.toDF("b", "x2", "y2")).where("a < b").where(geodesy.geodesic_m("x1", "y1", "x2", "y2") < 20000)
    assert {(r.a, r.b) for r in merging.near_pairs(points, 20000.0).collect()} == {(r.a, r.b) for r in every.collect()}


def test_spaced_pick_keeps_its_distance(spark):
    rows = [(i, -70 + i * 0.1, -40.0, 0) for i in range(10)]
    picked = merging.spaced_pick(spark.createDataFrame(rows, "id int, lon double, lat double, k int"), "k", [F.col("id")], 3, 20000.0)
    assert sorted(r.id for r in picked.collect()) == [0, 3, 6]


def regions(spark, means, pairs, sizes=None):
    nodes = spark.createDataFrame([(i, (sizes or {}).get(i, 1), float(v)) for i, v in enumerate(means)], "region int, n long, v double")
    return nodes, spark.createDataFrame(pairs, "a int, b int")


def test_mutual_nearest_merge_follows_the_new_means(spark):
    nodes, pairs = regions(spark, [0, 1, 3, 20], [(0, 1), (1, 2), (2, 3)])
    out = {r.region: r.merged for r in merging.merge_mutual_nearest(nodes, pairs, ["v"], 2.6).collect()}
    assert out == {0: 0, 1: 0, 2: 0, 3: 3}
    out = {r.region: r.merged for r in merging.merge_mutual_nearest(nodes, pairs, ["v"], 2.4).collect()}
    assert out == {0: 0, 1: 0, 2: 2, 3: 3}


def test_small_regions_join_the_most_similar(spark):
    nodes, pairs = regions(spark, [0, 5, 6, 50], [(0, 1), (1, 2), (2, 3)], {0: 9, 1: 1, 2: 9, 3: 1})
    out = {r.region: r.merged for r in merging.absorb_small(nodes, pairs, ["v"], 3).collect()}
    assert out == {0: 0, 1: 1, 2: 1, 3: 1}


def test_superpixels_part_two_colours(spark):
    rows = [(r, c, 0.0 if c < 7 else 100.0) for r in range(10) for c in range(14)]
    out = superpixels(spark.createDataFrame(rows, "px_row int, px_col int, v double"), ["v"], 5, 3).groupBy("segment").agg(F.count_distinct("v").alias("n"), F.count("*").alias("px")).collect()
    assert {r.n for r in out} == {1} and sum(r.px for r in out) == len(rows)


def test_nearest_valid_takes_the_smallest_of_ties(spark):
    holes = spark.createDataFrame([(5, 5), (0, 40)], "px_row int, px_col int")
    valid = spark.createDataFrame([(5, 7, 1), (3, 5, 2), (7, 5, 3)], "px_row int, px_col int, value int")
    assert {(r.px_row, r.px_col): r.value for r in lattice.nearest_valid(holes, valid, 2).collect()} == {(5, 5): 2, (0, 40): 1}


def test_masked_metrics_count_pixels(spark):
    years = lambda r, c, *ids: [(r, c, 1, 9, 2000 + k, v) for k, v in enumerate(ids)]
    rows = years(0, 0, 3, 3, 4) + years(0, 1, 4, 4, 4) + years(0, 2, 0, 0, 3) + years(0, 3, 8, 8, 8) + years(0, 4, 3, 3, 3) + years(1, 0, 5, 5, 5) + [(9, 9, 2, 9, 2000, 8)]
    panel_ = spark.createDataFrame(rows, "px_row int, px_col int, grid_id int, area int, year int, class_id int")
    zones = spark.createDataFrame([(0, 0, 2), (0, 1, 2), (0, 4, 0), (9, 9, 1)], "px_row int, px_col int, eco_id int")
    mask = panel_.where("px_row <> 1").select("px_row", "px_col")
    got = {r.grid_id: r for r in panel.masked_metrics(panel_, zones, mask, spark.createDataFrame([(3, 4), (3, 7)], "dominant int, other int"), 2002).collect()}
    a, b = got[1], got[2]
    assert (a.valid_pct, a.nodata_pct, a.unobserved_pct, a.mode_id, a.mode_pct, a.last_id, a.n_mode_classes, a.eco_id, a.eco_pct, a.risk_pct) == (60.0, 20.0, 20.0, 3, 66.6667, 4, 2, 2, 100.0, 50.0)
    assert (b.valid_pct, b.unobserved_pct, b.mode_id, b.eco_id, b.risk_pct) == (0.0, 100.0, None, None, None) and a.shannon == 0.6365


def test_answers_need_a_shared_key(spark):
    ref = spark.createDataFrame([(1, "a", "4"), (2, "b", "x")], "review_id int, segment_uid string, truth string")
    by_uid = spark.createDataFrame([("a", 4.0, None), ("b", 5.0, "r1")], "segment_uid string, given double, reviewer_id string")
    out = labels.answers_with_reference({"t": by_uid, "u": spark.createDataFrame([(7, "9")], "review_id int, given string")}, ref, "truth", "given").collect()
    assert sorted((r.reviewer, r.truth, r.given) for r in out) == sorted([("r1", 4, 4), ("u", 4, None)], key=str)
    with pytest.raises(ValueError, match="no key"):
        labels.first_shared_key(ref, spark.createDataFrame([(1,)], "id int"))


def test_labels_are_cleaned_and_columns_prepared(spark):
    df = spark.createDataFrame([(1, "  a \t b "), (2, " NaN"), (3, None), (4, "")], "grid_id int, review_label string")
    out = labels.prepare_columns(df, ["review_label"])
    assert out.columns == list(labels.REVIEW_COLUMNS) and {(r.grid_id, r.review_label, r.sample_type) for r in out.collect()} == {("1", "a b", ""), ("2", "none", ""), ("3", "none", ""), ("4", "none", "")}
