"""The seven-file archive end to end: land, conform, star, views, quality."""

import datetime as dt
import os
from decimal import Decimal

import pytest
import racing_files
from pyspark.sql import functions as F

from lapwise.operators import quality
from lapwise.plans import analysis, feeds, verification, views
from lapwise.plans.pipeline import Archive, NothingStaged
from lapwise.sources.entities import ENTITIES

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)
T1 = dt.datetime(2024, 1, 2, 12, 0, 0)


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.fixture(scope="module")
def staged(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("staged"))
    racing_files.write(root)
    return root


@pytest.fixture(scope="module")
def archive(spark, staged, tmp_path_factory):
    built = Archive(spark, str(tmp_path_factory.mktemp("archive")))
    for entity in ENTITIES.values():
        built.load(entity, staged, "b1", T0)
        built.conform(entity, T0)
        built.refresh(entity)
    return built


def test_landing_keeps_text_and_lineage(archive):
    drivers = archive.landing(ENTITIES["drivers"])
    assert rows(drivers, "driverId", "number", "forename", "nationality") == rows(
        archive.spark.createDataFrame(
            [("1", "11", "Ann", "Norlander"), ("2", None, "Bob", "Sudian"),
             ("3", None, None, None), ("4", "44", "Dan", "Sudian")],
            "a string, b string, c string, d string",
        ), "a", "b", "c", "d",
    )
    lineage = drivers.select("dw_file_name", "dw_file_row_number", "dw_loaded_at").collect()
    assert sorted(r[1] for r in lineage) == [1, 2, 3, 4]
    assert all(r[0].endswith("drivers/drivers.csv") and r[2] == T0 for r in lineage)
    circuits = {r["circuitId"]: r for r in archive.landing(ENTITIES["circuits"]).collect()}
    assert circuits["1"]["name"] == "North, Old Ring"
    assert circuits["2"]["name"] == 'The "South" Bowl'
    assert circuits["2"]["location"] == "Sudville"
    assert circuits["x"]["country"] is None


def test_short_long_and_broken_records(archive):
    results = {r["resultId"]: r for r in archive.landing(ENTITIES["results"]).collect()}
    assert "108" not in results and len(results) == 10
    assert results["106"]["driverId"] is None and results["106"]["raceId"] == "10"
    assert results["107"]["statusId"] == "6"
    rejected = archive.rejects().collect()
    assert [(r["target_table"], r["line_number"], r["rejected_record"]) for r in rejected] == [
        ("results", 10, '108,10,3,2,"33,1,1,1')
    ]


def test_audit(archive):
    audit = archive.audit().filter("target_table = 'results'")
    got = {os.path.basename(r["file_name"]): r for r in audit.collect()}
    packed, plain = got["results_2021.csv.gz"], got["results_2020.csv"]
    assert (plain["row_count"], plain["row_parsed"], plain["error_count"]) == (8, 9, 1)
    assert plain["load_status"] == "PARTIALLY_LOADED" and plain["first_error_message"]
    assert (packed["row_count"], packed["load_status"]) == (2, "LOADED")
    listed = verification.audit_tail(archive).collect()
    assert len(listed) == archive.audit().count() == 9
    assert rows(verification.reject_counts(archive), "target_table", "reject_count") == [
        ("results", 1)
    ]
    counts = dict(rows(verification.landed_counts(archive), "tbl", "row_count"))
    assert counts == {"circuits": 3, "constructors": 2, "drivers": 4, "pit_stops": 7,
                      "races": 3, "results": 10, "status": 7}


def test_typed_tables(archive):
    circuits = archive.typed(ENTITIES["circuits"])
    assert rows(circuits, "circuit_id", "longitude", "altitude_m") == [
        (1, 7.25, 600), (2, None, None)]
    drivers = archive.typed(ENTITIES["drivers"])
    assert rows(drivers, "driver_id", "full_name", "date_of_birth") == [
        (1, "Ann Alder", dt.date(1990, 5, 17)), (2, "Bob Birch", dt.date(1985, 12, 31)),
        (3, None, None), (4, "Dan Drift", dt.date(1999, 1, 1))]
    races = archive.typed(ENTITIES["races"])
    assert rows(races, "race_id", "race_start_utc") == [
        (10, "14:00:00"), (11, "09:05:01"), (20, None)]
    results = {r["result_id"]: r for r in archive.typed(ENTITIES["results"]).collect()}
    assert results[100]["fastest_lap_ms"] == 87452 and results[104]["fastest_lap_ms"] == 22879
    assert results[103]["fastest_lap_ms"] is None and results[102]["finish_position"] is None
    assert results[104]["points"] == Decimal("25.56")
    stops = archive.typed(ENTITIES["pit_stops"])
    assert rows(stops, "race_id", "driver_id", "stop_number", "duration_ms") == rows(
        archive.spark.createDataFrame(
            [(10, 1, 1, 999), (10, 1, 2, 1000), (10, 2, 1, 300000), (10, 2, 1, 22879),
             (10, 4, 1, 300001), (11, 1, 1, 62500)],
            "a bigint, b bigint, c int, d bigint"), "a", "b", "c", "d")
    assert stops.select("pit_stop_key").distinct().count() == 6
    statuses = dict(rows(archive.typed(ENTITIES["status"]), "status_id", "is_classified_finish"))
    assert statuses == {1: True, 2: False, 3: False, 4: False, 5: True, 6: False, 7: None}


def test_star(archive):
    star = archive.star()
    assert dict(rows(star.status, "status_id", "retirement_category")) == {
        1: "Classified", 2: "Disqualified", 3: "Incident", 4: "Did not start",
        5: "Classified", 6: "Mechanical", 7: "Mechanical"}
    assert rows(star.pit_stop, "duration_ms", "duration_seconds") == [
        (1000, Decimal("1.000")), (22879, Decimal("22.879")), (300000, Decimal("300.000")),
        (62500, Decimal("62.500"))]
    facts = {r["result_id"]: r for r in star.result.collect()}
    assert facts[101]["is_pit_lane_start"] and facts[101]["positions_gained"] is None
    assert facts[104]["positions_gained"] == 0 and facts[104]["is_win"] == 1
    assert facts[102]["positions_gained"] is None and facts[102]["is_podium"] == 0
    assert facts[106]["is_pit_lane_start"] is False
    assert rows(star.race, "race_id", "race_month", "race_day_name") == [
        (10, 3, "Sun"), (11, 6, "Sun"), (20, 3, "Sun")]


def test_views(archive):
    star = archive.star()
    wide = {r["result_id"]: r for r in views.race_result(star).collect()}
    # 105 has no driver, 106 neither driver nor team; an unknown status keeps 104.
    assert set(wide) == {100, 101, 102, 103, 104, 107, 200, 201}
    assert wide[104]["retirement_category"] is None
    progression = views.season_progression(star)
    got = rows(
        progression.filter("season_year = 2020"), "round_number", "driver_id",
        "cumulative_points", "championship_position", "previous_round_finish")
    assert got == [
        (1, 1, Decimal("25.00"), 2, None), (1, 2, Decimal("18.00"), 3, None),
        (1, 3, Decimal("51.00"), 1, None), (1, 4, Decimal("0.00"), 4, None),
        (2, 1, Decimal("43.00"), 2, 1), (2, 2, Decimal("43.56"), 1, 2)]
    standings = analysis.final_standings(progression.filter("season_year = 2020"))
    assert [(r["championship_position"], r["driver_id"]) for r in standings.collect()] == [
        (1, 2), (1, 3), (2, 1), (4, 4)]
    reliability = {
        (r["season_year"], r["constructor_name"]): r for r in views.reliability(star).collect()}
    blue = reliability[2020, "Blue Team"]
    assert (blue["entries"], blue["classified_finishes"], blue["mechanical_dnfs"],
            blue["incident_dnfs"], blue["finish_rate_pct"]) == (2, 0, 1, 1, 0.0)
    assert reliability[2020, "Red Team"]["finish_rate_pct"] == 75.0
    summary = {r["season_year"]: r for r in views.season_summary(star).collect()}
    assert (summary[2020]["rounds"], summary[2020]["drivers"]) == (2, 4)
    pit = views.pit_performance(star, min_stops=2).collect()
    assert [(r["constructor_name"], r["stop_count"], r["median_stop_seconds"],
             r["p90_stop_seconds"], r["season_rank"]) for r in pit] == [
        ("Red Team", 4, Decimal("42.690"), Decimal("228.750"), 1)]


def test_feeds(archive):
    star = archive.star()
    margins = {r["season_year"]: r for r in
               feeds.title_margin(views.season_progression(star)).collect()}
    assert margins[2020]["points"] == 51.0 and margins[2020]["margin"] == pytest.approx(7.44)
    assert margins[2021]["champion"] == "Bob Birch" and margins[2021]["rounds"] == 1
    headline = feeds.season_headline(views.season_progression(star), 1950).collect()
    assert [tuple(r) for r in headline] == [("—", 0.0, 0.0, 0)]
    top = feeds.top_contenders(views.season_progression(star), 1)
    assert {r["driver_name"] for r in top.filter("season_year = 2021").collect()} == {"Bob Birch"}
    assert [r["season_year"] for r in feeds.seasons(star).collect()] == [2021, 2020]
    assert feeds.progression(star, 2021).count() == 2
    assert feeds.reliability(star, 2020).count() == 2
    assert feeds.pit_performance(star, 2020, min_stops=1).count() == 1


def test_quality(archive):
    orphans = dict(rows(verification.integrity(archive), "relationship", "orphan_count"))
    assert orphans == {
        "results.race_id -> races": 0, "results.driver_id -> drivers": 2,
        "results.constructor_id -> constructors": 1, "races.circuit_id -> circuits": 0,
        "pit_stops.race_id -> races": 0}
    assert verification.orphan_results(archive).collect()[0][0] == 0
    history = verification.measure(archive, F.lit(T1))
    latest = {tuple(r)[:3]: (r["metric_value"], r["status"])
              for r in quality.latest_results(history).collect()}
    assert latest["results", "DMF_GRID_POSITION_OUT_OF_RANGE", "grid_position"] == (1, "BREACH")
    assert latest["results", "DMF_POINTS_OUT_OF_RANGE", "points"] == (1, "BREACH")
    assert latest["pit_stops", "DMF_IMPLAUSIBLE_PIT_DURATION", "duration_ms"] == (2, "BREACH")
    assert latest["results", "DUPLICATE_COUNT", "result_id"] == (0, "OK")
    assert latest["results", "NULL_COUNT", "driver_id"] == (1, "BREACH")
    assert latest["results", "ROW_COUNT", ""] == (10, "OK")
    assert latest["races", "FRESHNESS", "dw_updated_at"] == (86400, "OK")
    assert len(latest) == 14
    with pytest.raises(quality.QualityBreach) as caught:
        quality.enforce(quality.latest_results(history))
    assert caught.value.count == caught.value.breaches.count() > 0
    counts = {r["tbl"]: r for r in verification.typed_counts(archive).collect()}
    assert counts["results"]["row_count"] == 10 and counts["results"]["last_change"] == T0


def test_second_run_changes_nothing(archive, staged):
    for entity in ENTITIES.values():
        path = archive.typed_table(entity).path
        before = {b: os.listdir(f"{path}/{b}") for b in os.listdir(path) if "=" in b}
        assert archive.load(entity, staged, "b2", T1) == 0
        report = archive.conform(entity, T1)
        assert not report.changed and report.unchanged == archive.typed(entity).count()
        assert archive.refresh(entity) == 0
        assert before == {b: os.listdir(f"{path}/{b}") for b in os.listdir(path) if "=" in b}


def test_a_file_without_records_has_an_audit_row(spark, tmp_path):
    folder = tmp_path / "staged" / "status"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("statusId,status\n")
    (folder / "b.csv").write_text("statusId,status\n1,Finished\n")
    archive = Archive(spark, str(tmp_path / "a"))
    assert archive.load(ENTITIES["status"], str(tmp_path / "staged"), "b1", T0) == 2
    got = {os.path.basename(r["file_name"]): (r["row_count"], r["load_status"])
           for r in archive.audit().collect()}
    assert got == {"a.csv": (0, "LOADED"), "b.csv": (1, "LOADED")}


def test_a_wrong_prefix_is_not_a_successful_empty_load(spark, staged, tmp_path):
    empty = tmp_path / "staged" / "races"
    empty.mkdir(parents=True)
    (empty / "races_2020.txt").write_text("x\n")
    with pytest.raises(NothingStaged):
        Archive(spark, str(tmp_path / "a")).load(
            ENTITIES["races"], str(tmp_path / "staged"), "b", T0)
