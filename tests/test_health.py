import numpy as np

from furrow.plans.health import cohort_health, plant_ids, rank_health


def test_rank_health_scores_and_blanks(spark):
    rng = np.random.default_rng(1)
    rows = [(f"p{i}", "NOISE" if i % 20 == 0 else "S01", float(x), float(y), None if i % 15 == 1 else float(v), float(v) / 2) for i, (x, y, v) in enumerate(zip(rng.uniform(0, 20, 150), rng.uniform(0, 20, 150), rng.uniform(0, 1, 150)))]
    got = {r.plant_id: r for r in rank_health(spark.createDataFrame(rows, "plant_id string, sector_label string, x double, y double, ndvi double, ndre double")).collect()}
    assert len(got) == 150
    for p, label, _, _, v, _ in rows:
        r = got[p]
        if label == "NOISE":
            assert r.health_status == "NOISE" and r.health_score is None and r.diagnosis is None and r.archetype == -1
        elif v is None:
            assert r.health_status == "Out of Boundary" and r.health_score is None
        else:
            assert 0 <= r.health_score <= 100 and r.archetype in range(4) and r.diagnosis and r.limiting_factor
    assert 0 < sum(r.is_anomaly for r in got.values()) <= 20


def test_cohorts_too_small_are_scored_by_the_index_alone(spark):
    rows = [(f"p{i}", "Mature", float(i), 0.0, v, 0.5, 0.3) for i, v in enumerate([0.2, 0.35, 0.5, 0.8, None])]
    got = {r.plant_id: r for r in cohort_health(spark.createDataFrame(rows, "plant_id string, stage string, x double, y double, osavi double, ndvi double, ndre double")).collect()}
    assert [got[f"p{i}"].health_score for i in range(5)] == [0.0, 50.0, 100.0, 100.0, None]
    assert [got[f"p{i}"].health_status for i in range(5)] == ["Critical", "Moderate", "Healthy", "Healthy", "Out of Boundary"]


def test_ids_number_rows_from_north_and_columns_along(spark):
    # two fields of three rows by four plants; the northern one is sector 0
    points = [(f"{s}-{r}-{c}", s, 10.0 * s + 1.0 * c, 100.0 * s - 0.5 * r + 0.1 * (c in (1, 2))) for s in (5, 9) for r in range(3) for c in range(4)] + [("lost", -1, 500.0, 500.0)]
    got = {r.id: r for r in plant_ids(spark.createDataFrame(points, "id string, sector int, x double, y double")).collect()}
    assert got["lost"].sector == -1 and got["lost"].row_index is None and got["lost"].plant_id.startswith("PLT-NOISE-R000-C000-")
    for s, number in ((9, 0), (5, 1)):
        for r in range(3):
            for c in range(4):
                row = got[f"{s}-{r}-{c}"]
                assert (row.sector, row.row_index, row.col_index) == (number, r + 1, c + 1)
                assert row.plant_id.startswith(f"PLT-S0{number}-R00{r + 1}-C00{c + 1}-")
