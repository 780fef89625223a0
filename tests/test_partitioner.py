"""Season split of season-less facts."""

import pytest

from lapwise.sources import partitioner
from lapwise.sources.entities import ENTITIES

FACTS = "resultId,raceId,note\n01,10,\\N\n2,11,\n3,99,lost\n4,20, padded \n5,10,\"a,\"\"b\"\"\"\n"
RACES = "raceId,year\n10,2019\n11,2020\n20,2021\n"


def sources(spark, folder):
    (folder / "results.csv").write_text(FACTS)
    (folder / "races.csv").write_text(RACES)
    return (partitioner.read_source(spark, str(folder / "results.csv")),
            partitioner.read_source(spark, str(folder / "races.csv")))


def test_text_survives(spark, tmp_path):
    facts, _ = sources(spark, tmp_path)
    assert sorted(map(tuple, facts.collect())) == [
        ("01", "10", "\\N"), ("2", "11", ""), ("3", "99", "lost"), ("4", "20", " padded "),
        ("5", "10", 'a,"b"')]


def test_split_counts_unmatched_and_honours_the_window(spark, tmp_path):
    facts, races = sources(spark, tmp_path)
    split = partitioner.with_season(facts, races)
    assert [tuple(r) for r in split.unmatched.collect()] == [("3", "99", "lost")]
    assert sorted(r["season"] for r in split.rows.collect()) == [2019, 2019, 2020, 2021]
    late = partitioner.with_season(facts, races, min_season=2020)
    early = partitioner.with_season(facts, races, max_season=2020)
    both = partitioner.with_season(facts, races, min_season=2020, max_season=2020)
    assert (late.rows.count(), early.rows.count(), both.rows.count()) == (2, 3, 1)
    assert late.unmatched.count() == 1


def test_own_season_column_is_used(spark, tmp_path):
    _, races = sources(spark, tmp_path)
    split = partitioner.with_season(races, races)
    assert sorted((r["raceId"], r["season"]) for r in split.rows.collect()) == [
        ("10", 2019), ("11", 2020), ("20", 2021)]


def test_files_leave_the_season_out_and_rerun_replaces(spark, tmp_path):
    facts, races = sources(spark, tmp_path)
    target = str(tmp_path / "out")
    for _ in range(2):
        partitioner.write_seasons(partitioner.with_season(facts, races).rows, target)
    folders = sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir())
    assert folders == ["season=2019", "season=2020", "season=2021"]
    back = partitioner.read_source(spark, f"{target}/season=2019")
    assert back.columns == ["resultId", "raceId", "note"]
    assert sorted(r["note"] for r in back.collect()) == ["\\N", 'a,"b"']
    whole = str(tmp_path / "whole")
    partitioner.write_whole(races, whole)
    assert partitioner.read_source(spark, whole).count() == 3


def write_sources(spark, root, drop=None, without=None):
    for name, entity in ENTITIES.items():
        if name == drop:
            continue
        columns = [c for c in entity.landing if (name, c) != without]
        cells = {"raceId": "10", "year": "2020", "resultId": "01", "name": " padded ", "position": "\\N"}
        frame = spark.createDataFrame([tuple(cells.get(c, c) for c in columns)], columns)
        partitioner.write_whole(frame, f"{root}/{name}.csv")


def test_prepare_lays_out_seven_files(spark, tmp_path):
    write_sources(spark, str(tmp_path / "in"))
    target = str(tmp_path / "out")
    assert partitioner.prepare(spark, str(tmp_path / "in"), target, 2020, 2020) == 7
    result = partitioner.read_source(spark, f"{target}/results").first()
    assert (result["resultId"], result["position"]) == ("01", "\\N")
    assert partitioner.read_source(spark, f"{target}/circuits").first()["name"] == " padded "
    assert partitioner.prepare(spark, str(tmp_path / "in"), str(tmp_path / "none"), 2021) == 4


def test_prepare_names_what_is_missing(spark, tmp_path):
    write_sources(spark, str(tmp_path / "a"), drop="status")
    with pytest.raises(partitioner.SourceError, match="status.csv"):
        partitioner.prepare(spark, str(tmp_path / "a"), str(tmp_path / "out"))
    write_sources(spark, str(tmp_path / "b"), without=("races", "year"))
    with pytest.raises(partitioner.SourceError, match="races.csv lacks year"):
        partitioner.prepare(spark, str(tmp_path / "b"), str(tmp_path / "out"))
