"""Records over several lines: against a reader that goes through each file line by line."""

import gzip
import random
import re

import pytest

from lapwise.sources import lines
from lapwise.sources.entities import ENTITIES

STATUS = ENTITIES["status"]


def by_hand(text):
    """``[(line number, record)]``: a break inside a quoted field goes on, unless it is broken."""

    def sound(record):
        return re.search(lines.RECORD_PATTERN[:-1] + r"\Z", record) is not None

    def opens(line):
        return re.search(lines._OPENS[:-1] + r"\Z", line) is not None

    rows = text.split("\n")[:-1]
    out, at = [], 0
    while at < len(rows):
        end, whole = at, rows[at]
        while opens(whole) and end + 1 < len(rows):
            end += 1
            whole += "\n" + rows[end]
        if end > at and sound(whole):
            out.append((at + 1, whole))
            at = end + 1
        else:
            # The line that broke the field is read afresh; the file's end breaks it, too.
            after = end if end > at and not opens(whole) else end + 1
            out += [(n + 1, rows[n]) for n in range(at, max(after, at + 1))]
            at = max(after, at + 1)
    return out


def test_the_second_half_of_a_record_is_no_record(spark, tmp_path):
    text = 'k,t,f,x\n1,a,"one",Y\n3,b,"two\n4,lines",Y,u\n5,c,"three ""x""\n\n  ,y",N\n6,d,"open\n7,e,f,g\n'
    for name in ("plain.csv", "packed.csv.gz"):
        opener = gzip.open if name.endswith("gz") else open
        with opener(tmp_path / name, "wt") as out:
            out.write(text)
    judged = lines.judged(lines.read_lines(spark, str(tmp_path))).collect()
    for name in ("plain.csv", "packed.csv.gz"):
        got = {(r["line_number"], r["value"], r["error"]) for r in judged if r["file_path"].endswith(name)}
        assert got == {
            (2, '1,a,"one",Y', None), (3, '3,b,"two\n4,lines",Y,u', None),
            (5, '5,c,"three ""x""\n\n  ,y",N', None), (8, '6,d,"open', lines.UNCLOSED_QUOTE), (9, "7,e,f,g", None),
        }


def test_a_broken_field_keeps_its_line_breaks(spark, tmp_path):
    (tmp_path / "status.csv").write_text('statusId,status\n1,"two\nlines"\n"2","a ""b""\n\n,c" \n3,plain\n')
    good = lines.judged(lines.read_lines(spark, str(tmp_path)))
    got = sorted(map(tuple, lines.landed(good, STATUS, None).select("statusId", "status", "dw_file_row_number").collect()))
    assert got == [("1", "two\nlines", 1), ("2", 'a "b"\n\n,c', 3), ("3", "plain", 6)]


@pytest.mark.parametrize("seed", range(4))
def test_any_split_finds_its_records(spark, tmp_path, seed):
    rng = random.Random(seed)
    parts = ['"', '""', ",", "a", "bc", " ", "\n", '"x"', ',"', '",', "1,2\n", 'k,"t\n', 'u",v\n']
    texts = {}
    for name in ("a.csv", "b.csv", "c.csv"):
        count = 400 if seed % 2 else 60
        weights = [rng.choice([1, 1, 3, 12]) for _ in parts]
        texts[name] = "".join(rng.choices(parts, weights, k=count)) + "\n"
        (tmp_path / name).write_text(texts[name])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        raw = lines.read_lines(spark, str(tmp_path))
        got = lines.read_records(raw).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    for name, text in texts.items():
        mine = sorted((r["line_number"], r["value"]) for r in got if r["file_path"].endswith(name))
        assert mine == by_hand(text)


def test_the_text_is_read_once_and_nothing_is_hinted(spark, tmp_path, monkeypatch):
    (tmp_path / "a.csv").write_text('k,v\n1,"x\ny"\n2,z\n')
    written = []
    keep = lines.stored
    monkeypatch.setattr(lines, "stored", lambda df, label: written.append((label, plan(df))) or keep(df, label))
    out = lines.judged(lines.read_lines(spark, str(tmp_path)))
    assert sum("Scan text" in p for _, p in written) == 1 and "Scan text" not in plan(out)
    assert "ResolvedHint" not in out._jdf.queryExecution().toString()


def test_no_row_for_every_line_of_a_record_is_broadcast(spark, tmp_path):
    """Few records of many lines: their table is small, a table of their lines is not."""
    text = "k,v\n" + "".join(f'{i},"{"x" + chr(10)}{(f"line{chr(10)}" * 999)}"\n' for i in range(5))
    (tmp_path / "a.csv").write_text(text)
    out = lines.judged(lines.read_lines(spark, str(tmp_path)))
    assert "explode(sequence(from_line" not in plan(out)
    assert sorted(r["line_number"] for r in out.collect()) == [2 + 1001 * i for i in range(5)]


@pytest.mark.parametrize("chunk", [1, 2, 3])
def test_records_run_across_chunks(spark, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(lines, "CHUNK_LINES", chunk)
    text = 'k,v\n1,"a\nb\nc\nd"\n2,e\n3,"f\ng"\n4,"h\n\ni"\n5,"j\n'
    (tmp_path / "a.csv").write_text(text)
    got = {(r["line_number"], r["value"]) for r in lines.read_records(lines.read_lines(spark, str(tmp_path))).collect()}
    assert got == set(by_hand(text))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
