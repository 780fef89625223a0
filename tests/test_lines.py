"""Reading, numbering and judging text lines."""

import gzip
import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from lapwise.sources import lines
from lapwise.sources.entities import ENTITIES


def test_numbers_run_through_all_splits_of_a_file(spark, tmp_path):
    for name, count in (("a.csv", 4000), ("b.csv", 2500), ("c.csv", 1)):
        (tmp_path / name).write_text("".join(f"{i + 1},{'x' * 20}\n" for i in range(count)))
    with gzip.open(tmp_path / "d.csv.gz", "wt") as out:
        out.write("".join(f"{i + 1},packed\n" for i in range(1500)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        raw = lines.read_lines(spark, str(tmp_path))
        assert raw.select("file_path", "block_start").distinct().count() > 6
        numbered = lines.number_lines(raw)
        wrong = numbered.filter(
            F.split_part("value", F.lit(","), F.lit(1)).cast("bigint") != F.col("line_number")
        )
        assert wrong.count() == 0 and numbered.count() == 8001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    ("record", "good"),
    [("1,2,3", True), ("", True), ('"a,b",c', True), ('"a ""b"" c",d', True), ('a,"b', False),
     ('"a"b,c', False), ('5" pipe,x', True), (' "padded" ,x', True), ('a,"b"c",d', False),
     ('"', False), ("," * 5000, True), ('"' + '""' * 5000 + '"', True)],
)
def test_record_pattern(spark, record, good):
    frame = spark.createDataFrame([(record,)], "v string")
    assert frame.filter(F.col("v").rlike(lines.RECORD_PATTERN)).count() == int(good)


def test_blank_lines_keep_their_number(spark, tmp_path):
    (tmp_path / "status.csv").write_text("statusId,status\n1,Finished\n\n   \n2,N\n3,\"x\n")
    judged = lines.judged(lines.read_lines(spark, str(tmp_path)))
    got = {r["value"]: (r["line_number"], r["error"]) for r in judged.collect()}
    assert got == {"1,Finished": (2, None), "2,N": (5, None), '3,"x': (6, lines.UNCLOSED_QUOTE)}
    entity = ENTITIES["status"]
    good = judged.filter("error is null")
    assert sorted(map(tuple, lines.parse(good, entity).select("statusId", "status").collect())) == [
        ("1", "Finished"), ("2", None)]
    kept = lines.parse(good, entity, keep_tokens=True).select("status").collect()
    assert sorted(r[0] for r in kept) == ["Finished", "N"]


def test_file_patterns():
    pattern = ENTITIES["results"].file_pattern
    for path in ("s/results/season=2020/results_2020.csv", "s/results/season=2020/results_2020.csv.gz",
                 "s/results/season=2020/part-0001-x.csv.gz"):
        assert re.search(pattern, path)
    for path in ("s/results/results_2020.txt", "s/results/results_20.csv", "s/results/part-0.csv"):
        assert not re.search(pattern, path)


def test_a_very_wide_record_is_cut_to_its_first_fields(spark):
    entity = ENTITIES["status"]
    wide = '7,"a, ""b""",' + ",".join(["x"] * 21_000)
    frame = spark.createDataFrame([(wide,), ("8,plain",), ("9",)], "value string")
    got = {r["statusId"]: r["status"] for r in lines.parse(frame, entity).collect()}
    assert got == {"7": 'a, "b"', "8": "plain", "9": None}


def test_a_very_long_record_is_no_reject(spark, tmp_path):
    (tmp_path / "status.csv").write_text("statusId,status\n1," + "x" * 17_000_000 + "\n")
    judged = lines.judged(lines.read_lines(spark, str(tmp_path)))
    assert judged.filter("error is null").count() == 1


def test_position_of_the_first_unsound_field(spark):
    records = [('1,"open', 3), ('"', 1), ('a,b,"c"d,e', 5), ('"x, y",2, "z', 10)]
    frame = spark.createDataFrame(
        [(v, "f", 1, "bad") for v, _ in records], "value string, file_path string, line_number long, error string")
    got = lines.rejects(frame, ENTITIES["status"], dt.datetime(2024, 1, 1)).collect()
    assert {r["rejected_record"]: r["character_pos"] for r in got} == dict(records)
