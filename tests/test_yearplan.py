"""Plans of the earlier generation against a plain version, and the national plan's defaults."""

import random

import pytest

from terrapanel.operators import yearplan as yp

PERIODS = yp.PERIODS


def spread(years, most):
    years = sorted({y for y in years if 1999 <= y <= 2024})
    if most is None or len(years) <= most:
        return years
    return [years[i] for i in sorted({round(k * (len(years) - 1) / (most - 1)) for k in range(most)})]


def listed(text):
    return spread([int(p) for p in (text or "").split(",") if p.strip().isdigit()], None)


def nearest(target, years):
    return min(years, key=lambda y: (abs(y - target), y))


def plain(r):
    stable, ids = listed(r["stable_years"]), {p: -9999 if r[f"md_id_{p}"] is None else r[f"md_id_{p}"] for p, _, _ in PERIODS}
    dim, notes = (r["dim_temporal"] or "").strip(), []
    anchors = spread([1999 if 1999 in stable else nearest(2001, stable), 2013 if 2013 in stable else nearest(2013, stable), max(stable)], None) if stable else [1999, 2013, 2024]
    if dim == "anual":
        rule, years = "anual_ref_year", [r["ref_year"]] if r["ref_year"] and 1999 <= r["ref_year"] <= 2024 else []
        if not years:
            notes.append("anual_sin_ref_year_valido")
            if stable:
                rule, years = "anual_fallback_stable_year", [nearest(2019, stable)]
    elif dim == "transicion":
        borders = [y for (a, _, _), (b, s, _) in zip(PERIODS, PERIODS[1:]) if ids[a] != ids[b] for y in range(s - 2, s + 2)]
        around = [y + d for y in range(1999, 2025) if y not in stable for d in (-1, 0, 1)] if stable else []
        rule, years = ("transicion_cambio_modal_entre_periodos", spread(borders, 9)) if borders else ("transicion_anios_no_estables", spread(around, 9)) if spread(around, 9) else ("transicion_sin_anio_exacto_usar_anclas", [1999, 2005, 2012, 2018, 2024])
    else:
        rule, years = ("estable_anclas_temporales" if dim == "estable" else "fallback_anclas_temporales"), anchors
        if dim != "estable":
            notes.append("dim_temporal_no_reconocida")
    name, rare = (r["target_rare_class"] or "").strip(), []
    name = "" if name.lower() in ("nan", "none") else name
    number = r["target_rare_class_id"] or -9999
    for p, a, b in PERIODS:
        if (number > 0 and ids[p] == number) or (name and r[f"md_nm_{p}"] == name):
            own = listed(r[f"stb_yrs_{p}"])
            rare += [own[0], own[-1]] if own else [a, b]
    rare = spread(rare, 6)
    whole = spread(years + rare, 10) if rare else years
    if set(whole) != set(years):
        notes.append("incluye_anios_clase_rara")
    tier = 2 if r["review_tier"] is None else r["review_tier"]
    if name or dim == "transicion" or r["sample_type"] in ("transicion_homogenea", "anual_homogenea"):
        tier = min(tier, 1)
    return ",".join(map(str, whole)), len(whole), rule, tier, ";".join(notes)


SCHEMA = "id int, dim_temporal string, sample_type string, ref_year int, stable_years string, target_rare_class string, target_rare_class_id int, review_tier int, " + ", ".join(f"md_id_{p} int, md_nm_{p} string, stb_yrs_{p} string" for p, _, _ in PERIODS)


def rows(seed, n=120):
    rng = random.Random(seed)
    some = lambda a, b, k: ",".join(map(str, sorted(rng.sample(range(a, b + 1), k))))
    out = []
    for i in range(n):
        ids = [rng.choice([3, 3, 3, 5, None]) for _ in PERIODS] if rng.random() < 0.6 else [3] * 4
        own = [x for (p, a, b), c in zip(PERIODS, ids) for x in (c, None if c is None else f"c{c}", rng.choice([None, "", some(a, b, 3)]))]
        stable = rng.choice([None, "", "x, 1950", some(1999, 2024, 24), some(1999, 2024, 9), some(2003, 2010, 4) + ", 2024 ,abc", ",".join(map(str, range(1999, 2025)))])
        out.append((i, rng.choice(["anual", "estable", " transicion", "transicion", "otra", None]), rng.choice(["anual_homogenea", "mixta", None]), rng.choice([None, 1990, 2009, 2024]), stable, rng.choice([None, "nan", " c5", "", "c3"]), rng.choice([None, -1, 5]), rng.choice([None, 0, 1, 3]), *own))
    return out


@pytest.mark.parametrize("seed", range(2))
def test_plans_equal_the_plain_version(spark, seed):
    df = spark.createDataFrame(rows(seed), SCHEMA)
    want = {r.id: plain(r.asDict()) for r in df.collect()}
    out = yp.earlier_plan(df)
    assert out.columns[: len(df.columns)] == df.columns
    assert {r.id: (r.review_years, r.n_review_years, r.review_rule, r.review_priority, r.review_notes) for r in out.collect()} == want
    assert {v[2] for v in want.values()} == set(yp.RULES) and any("incluye" in v[4] for v in want.values()) and max(v[1] for v in want.values()) == 10


def test_a_table_without_any_column_takes_the_anchors(spark):
    r = yp.earlier_plan(spark.createDataFrame([(1,)], "id int")).first()
    assert (r.review_years, r.review_rule, r.review_priority, r.review_notes) == ("1999,2013,2024", "fallback_anclas_temporales", 2, "dim_temporal_no_reconocida")


def test_national_plan_fills_and_flags(spark):
    a = spark.createDataFrame([("x", "2001,1999,2001", "auto_sin_revision", "7"), ("y", None, None, "?")], "grid_id string, review_years string, review_desc string, review_priority string")
    b = spark.createDataFrame([(5, "UTM20", 0, " c ")], "grid_id int, utm string, review_priority int, target_rare_class string")
    plan = yp.national_plan({"plan_UTM18.csv": a, "other.csv": b})
    got = {r.grid_id: r for r in plan.collect()}
    assert [got["x"][c] for c in ("utm", "review_years", "n_review_years", "is_auto_sin_revision", "review_priority", "review_rule", "fuente_plan")] == ["UTM18", "1999,2001", 2, True, 7, "sin_regla", "plan_UTM18.csv"]
    assert (got["y"].review_priority, got["y"].has_review_years, got["5"].utm, got["5"].has_rare_class, got["x"].has_rare_class) == (3, False, "UTM20", True, False)
    assert [r.grid_id for r in yp.ordered(plan).collect()] == ["5", "y", "x"] and yp.manual_list(plan).count() == 3
    assert sorted((r.grid_id, r.year) for r in yp.plan_by_year(plan).collect()) == [("x", 1999), ("x", 2001)]
    assert {r.utm: (r.n, r.n_years, r.n_auto, r.n_rare) for r in yp.plan_summary(plan).collect()} == {"UTM18": (2, 2, 1, 0), "UTM20": (1, 0, 0, 1)}
