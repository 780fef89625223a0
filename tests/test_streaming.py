"""File arrival: nothing twice, late files taken, replays harmless."""

import datetime as dt
import os

import pytest
import racing_files

from pyspark.sql import functions as F

from lapwise.plans import pipeline, verification
from lapwise.plans.pipeline import Archive
from lapwise.sources.entities import ENTITIES
from lapwise.streaming.ingest import arriving_files, ingest

RESULTS = ENTITIES["results"]


def clock():
    return dt.datetime(2024, 1, 1)


def test_two_arrivals_and_a_replay(spark, tmp_path):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    racing_files.write(staged, seasons=(2021,))
    ingest(archive, RESULTS, staged, clock, upserting=True).awaitTermination()
    assert archive.typed(RESULTS).count() == 2
    racing_files.write(staged, seasons=(2020,))
    # The older season arrives later and with an old date.
    late = os.path.join(staged, "results", "season=2020", "results_2020.csv")
    os.utime(late, (1_000_000_000, 1_000_000_000))
    ingest(archive, RESULTS, staged, clock, upserting=True).awaitTermination()
    assert archive.landing(RESULTS).count() == archive.typed(RESULTS).count() == 10
    assert archive.star_table(RESULTS).read().count() == 10
    assert archive.rejects().count() == 1
    ingest(archive, RESULTS, staged, clock, upserting=True).awaitTermination()
    assert archive.landing(RESULTS).count() == 10 and archive.audit().count() == 2
    # The second batch again, as after a crash before its commit was recorded.
    lines = spark.read.text(late).selectExpr(
        "value", "_metadata.file_path", "_metadata.file_modification_time as file_modified",
        "_metadata.file_block_start as block_start")
    second = next(b for b in archive.batches(RESULTS) if b.endswith("-000000001"))
    archive.land(RESULTS, lines, second, clock())
    assert archive.landing(RESULTS).count() == 10 and archive.rejects().count() == 1
    assert not archive.conform(RESULTS, clock(), [second]).changed
    assert archive.refresh(RESULTS) == 0


def test_a_lost_checkpoint_replaces_no_batch(spark, tmp_path):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    racing_files.write(staged, seasons=(2021,))
    ingest(archive, RESULTS, staged, clock, upserting=True).awaitTermination()
    os.rename(f"{archive.root}/checkpoints", f"{archive.root}/old")
    racing_files.write(staged, seasons=(2020,))
    ingest(archive, RESULTS, staged, clock, upserting=True).awaitTermination()
    # The files of the first start land once more, under the new checkpoint's names.
    assert len(archive.batches(RESULTS)) == 2
    assert archive.landing(RESULTS).select("resultId").distinct().count() == 10
    assert archive.typed(RESULTS).count() == 10


def test_two_arrivals_under_one_name(spark, tmp_path):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    racing_files.write(staged, seasons=(2020,))
    archive.bring_up(staged, "b1", clock())
    racing_files.write(staged, seasons=(2021,))
    reports = archive.bring_up(staged, "b1", clock())
    assert archive.landing(RESULTS).select("resultId").distinct().count() == 10
    assert archive.typed(RESULTS).count() == 10
    assert reports["results"].inserted == 2
    assert archive.batches(RESULTS) == ["b1", "b1+2"]


def test_a_missed_refresh_is_caught_up(spark, tmp_path):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    racing_files.write(staged, seasons=(2021,))
    archive.load(RESULTS, staged, "a", clock())
    archive.conform(RESULTS, clock())
    archive.refresh(RESULTS)
    racing_files.write(staged)
    archive.load(RESULTS, staged, "b", clock())
    archive.conform(RESULTS, clock(), ["b"])
    # The driver died here; the next run finds nothing new to load but refreshes.
    assert archive.load(RESULTS, staged, "c", clock()) == 0
    assert archive.refresh(RESULTS) == 1
    assert archive.star_table(RESULTS).read().count() == 10


def test_a_rewritten_file_loads_again_and_force_reloads_all(spark, tmp_path):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    status = ENTITIES["status"]
    racing_files.write(staged)
    archive.load(status, staged, "a", clock())
    assert archive.load(status, staged, "b", clock()) == 0
    path = os.path.join(staged, "status", "status.csv")
    with open(path, "a", encoding="utf-8") as out:
        out.write("8,Brakes\n")
    assert archive.load(status, staged, "c", clock()) == 1
    assert archive.conform(status, clock()).inserted == 8
    assert archive.load(status, staged, "d", clock(), force=True) == 1
    assert archive.landing(status).count() == 7 + 8 + 8
    assert not archive.conform(status, clock()).changed


def test_the_stream_reads_only_matching_files(spark, tmp_path):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    racing_files.write(staged)
    assert arriving_files(archive, RESULTS, staged).isStreaming


def test_a_run_that_died_is_completed_by_the_next(spark, tmp_path, monkeypatch):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    racing_files.write(staged)
    status = ENTITIES["status"]

    def die(*_):
        raise RuntimeError("executor gone")

    # Before the batch is marked: nothing is visible and the files are still due.
    with monkeypatch.context() as patched:
        patched.setattr(archive, "_mark", die)
        with pytest.raises(RuntimeError):
            archive.load(status, staged, "a", clock())
    assert archive.landing(status).count() == archive.audit().count() == 0
    assert archive.load(status, staged, "b", clock()) == 1
    # After landing, before the upsert: the next run takes the batch along.
    assert archive.load(status, staged, "c", clock()) == 0
    assert archive.unconformed(status) == ["b"]
    reports = archive.bring_up(staged, "d", clock())
    assert reports["status"].inserted == 7 and archive.unconformed(status) == []
    assert archive.landing(status).count() == 7
    assert archive.star().status.count() == 7


def test_one_ledger_for_stream_and_batch(spark, tmp_path):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    status = ENTITIES["status"]
    racing_files.write(staged)
    empty = os.path.join(staged, "status", "empty.csv")
    with open(empty, "w", encoding="utf-8") as out:
        out.write("statusId,status\n")
    ingest(archive, status, staged, clock, upserting=True).awaitTermination()
    # A header alone is a loaded file, too.
    audit = {os.path.basename(r["file_name"]): r["row_count"] for r in archive.audit().collect()}
    assert audit == {"status.csv": 7, "empty.csv": 0}
    assert archive.load(status, staged, "after", clock()) == 0
    assert archive.landing(status).count() == 7 and len(archive.batches(status)) == 1
    # A rewritten file is new to the batch load, and then known to both.
    with open(empty, "a", encoding="utf-8") as out:
        out.write("9,Gearbox\n")
    assert archive.load(status, staged, "after", clock()) == 1
    assert archive.landing(status).count() == 8
    assert archive.catch_up(status, clock()).inserted == 1
    ingest(archive, status, staged, clock, upserting=True).awaitTermination()
    assert archive.landing(status).count() == 8 and archive.typed(status).count() == 8


def test_large_arrivals_land_as_several_batches(spark, tmp_path, monkeypatch):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    status = ENTITIES["status"]
    folder = tmp_path / "staged" / "status"
    folder.mkdir(parents=True)
    for i in range(9):
        (folder / f"s{i}.csv").write_text(f"statusId,status\n{i},Kind {i}\n")
    monkeypatch.setattr(pipeline, "FILES_AT_ONCE", 4)
    assert archive.load(status, staged, "b", clock()) == 9
    assert len(archive.batches(status)) > 2 and archive.landing(status).count() == 9
    assert archive.load(status, staged, "b", clock()) == 0
    assert archive.catch_up(status, clock()).inserted == 9


def test_any_number_of_batches_is_one_path(spark, tmp_path):
    archive, status = Archive(spark, str(tmp_path / "archive")), ENTITIES["status"]
    names = [f"b{i:04d}" for i in range(300)]
    rows = spark.createDataFrame(
        [("1", "x", "f", i, clock(), clock(), n) for i, n in enumerate(names)],
        pipeline.landing_schema(status).add("batch", "string"),
    )
    rows.write.partitionBy("batch").parquet(f"{archive.root}/landing/status")
    archive._mark("landed", status, archive._named(names[:200]))
    assert archive.landing(status).count() == 200
    assert archive.landing(status, ["b0007"]).count() == 1
    scans = [line for line in archive.landing(status)._jdf.queryExecution().toString().splitlines() if "Location:" in line]
    assert scans and all("[1 paths]" in line or "(1 paths)" in line for line in scans)
    assert archive.landing(status).inputFiles()


def test_a_run_measures_only_what_changed(spark, tmp_path):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    racing_files.write(staged, seasons=(2020,))
    archive.bring_up(staged, "a", clock())
    first = archive.metrics().count()
    # The same numbers as measuring the whole tables.
    whole = {tuple(r)[:4] for r in verification.measure(archive, F.lit(clock())).collect()}
    assert {tuple(r)[:4] for r in archive.metrics().collect()} == whole
    archive.bring_up(staged, "b", clock())
    assert archive.metrics().count() == first and archive.measure(clock()) == []
    racing_files.write(staged, seasons=(2021,))
    later = clock() + dt.timedelta(days=1)
    archive.bring_up(staged, "c", later)
    changed = archive.metrics().filter(F.col("measurement_time") == F.lit(later))
    assert {r["table_name"] for r in changed.select("table_name").distinct().collect()} == {"results", "races"}
    latest = {tuple(r)[:4] for r in verification.latest_metrics(archive).select(
        "table_name", "metric_name", "argument_names", "metric_value").collect() if r[1] != "FRESHNESS"}
    whole = {tuple(r)[:4] for r in verification.measure(archive, F.lit(later)).collect() if r[1] != "FRESHNESS"}
    assert latest == whole


def test_a_file_of_one_empty_line_is_audited(spark, tmp_path):
    staged, archive = str(tmp_path / "staged"), Archive(spark, str(tmp_path / "archive"))
    status = ENTITIES["status"]
    folder = tmp_path / "staged" / "status"
    folder.mkdir(parents=True)
    (folder / "nothing.csv").write_text("\n")
    assert archive.load(status, staged, "a", clock()) == 1
    assert [r["row_count"] for r in archive.audit().collect()] == [0]
    assert archive.landing(status).count() == 0 and archive.load(status, staged, "b", clock()) == 0
    assert not archive.catch_up(status, clock()).changed
