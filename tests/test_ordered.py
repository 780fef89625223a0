"""The ordered operators against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lapwise.functions import descending
from lapwise.operators import ordered

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for i in range(600):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        value = rng.choice([None, 0.0, 1.5, -2.25, 10.0, 99.99, 1234.5, 1234.51])
        out.append((i, key, START + dt.timedelta(minutes=rng.randrange(6000)), value, i % 7 == 0))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(
        [(i, k, t, v, int(w)) for i, k, t, v, w in rows],
        "id bigint, k string, ts timestamp, v double, win int",
    )


def by_key(rows):
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    for group in groups.values():
        group.sort(key=lambda r: (r[2], r[0]))
    return groups


def test_running_sums(frame, rows):
    got = ordered.running_sums(
        frame, ["k"], ["ts", "id"], {"wins": "win", "total": "v"}
    )
    actual = {r["id"]: (r["wins"], r["total"]) for r in got.collect()}
    for group in by_key(rows).values():
        wins, total = 0, None
        for i, _, _, v, w in group:
            wins += int(w)
            if v is not None:
                total = (total or 0.0) + v
            assert actual[i][0] == wins
            assert (actual[i][1] is None) == (total is None)
            if total is not None:
                assert actual[i][1] == pytest.approx(total)
    assert len(actual) == len(rows)


@pytest.mark.parametrize("chunk_rows", [10_000, 20, 1])
def test_sliding_frame(frame, rows, chunk_rows):
    got = ordered.sliding(
        frame, ["k"], ["ts", "id"], 4,
        {"form": F.avg("v"), "n": F.count("*")}, chunk_rows,
    )
    actual = {r["id"]: (r["form"], r["n"]) for r in got.collect()}
    assert len(actual) == len(rows) == got.count()
    for group in by_key(rows).values():
        for at, row in enumerate(group):
            window = group[max(0, at - 4): at + 1]
            known = [r[3] for r in window if r[3] is not None]
            assert actual[row[0]][1] == len(window)
            if known:
                assert actual[row[0]][0] == pytest.approx(sum(known) / len(known))
            else:
                assert actual[row[0]][0] is None


@pytest.mark.parametrize("largest_first", [True, False])
def test_rank(frame, rows, largest_first):
    got = ordered.rank_by(frame, ["k"], "v", "place", largest_first)
    actual = {r["id"]: r["place"] for r in got.collect()}
    assert len(actual) == len(rows)
    for group in by_key(rows).values():
        values = [float("inf") if r[3] is None else r[3] for r in group]
        for row, value in zip(group, values):
            ahead = sum(o > value if largest_first else o < value for o in values)
            assert actual[row[0]] == ahead + 1


def test_tiles_over_the_whole_frame(frame, rows):
    got = ordered.tiles(frame, 4, ["v", "id"], "quartile")
    ranked = sorted(rows, key=lambda r: (float("inf") if r[3] is None else r[3], r[0]))
    expected = {r[0]: at * 4 // len(rows) + 1 for at, r in enumerate(ranked)}
    assert {r["id"]: r["quartile"] for r in got.collect()} == expected
    few = ordered.tiles(frame.filter("id < 3"), 4, ["id"], "q")
    assert sorted(r["q"] for r in few.collect()) == [1, 2, 3]


def test_group_value(frame, rows):
    got = ordered.group_value(frame, ["k"], {"top": F.max("v")})
    best = {k: max(r[3] for r in g if r[3] is not None) for k, g in by_key(rows).items()}
    assert all(r["top"] == best[r["k"]] for r in got.collect())
    assert {r["n"] for r in ordered.group_value(frame, [], {"n": F.count("*")}).collect()} == {600}


def test_types_are_those_of_the_plain_window_and_any_number_ranks(spark):
    frame = spark.createDataFrame(
        [("a", 1, 1e36), ("a", 2, -1e36), ("a", 3, 0.5), ("a", 4, None)], "k string, i int, v double"
    ).selectExpr("k", "i", "v", "cast(i as decimal(18,2)) as d")
    plain = dict(frame.selectExpr("sum(d) over (order by i) as t", "sum(i) over (order by i) as n").dtypes)
    got = dict(ordered.running_sums(frame, ["k"], ["i"], {"t": "d", "n": "i"}).dtypes)
    assert got["t"] == plain["t"] and got["n"] == plain["n"]
    ranked = ordered.rank_by(frame, ["k"], "v", "place").collect()
    assert {r["i"]: r["place"] for r in ranked} == {4: 1, 1: 2, 3: 3, 2: 4}


def test_composing_starts_no_job(spark, frame):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    ordered.sliding(ordered.running_sums(frame, ["k"], ["ts", "id"], {"t": "v"}), ["k"], ["ts", "id"], 4, {"n": F.count("*")})
    ordered.tiles(ordered.rank_by(frame, ["k"], "v", "place"), 4, ["v", "id"], "q")
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_a_group_tied_on_its_first_column_spreads(spark):
    """One group of equal times, a third of them NULL: slices follow rows, not values."""
    data = [(i, "k", START if i % 3 else None, float(i % 5)) for i in range(3000)]
    frame = spark.createDataFrame(data, "id bigint, k string, ts timestamp, v double")
    sliced = ordered._row_slices(frame, ["k"], ["ts", "id"], 200)
    sizes = [r["count"] for r in sliced.groupBy(ordered.SLICE).count().collect()]
    assert len(sizes) > 10 and max(sizes) < 700
    got = {r["id"]: (r["n"], r["t"]) for r in ordered.running_sums(
        ordered.row_index(frame, ["k"], ["ts", "id"], "n", 200), ["k"], ["ts", "id"], {"t": "v"}, 200).collect()}
    total, expected = 0.0, {}
    for n, (i, *_, v) in enumerate(sorted(data, key=lambda r: (r[2] is None, r[0])), 1):
        total += v
        expected[i] = (n, total)
    assert got == expected
    form = ordered.sliding(frame, ["k"], ["ts", "id"], 4, {"n": F.count("*")}, 100, 200)
    assert sorted(r["n"] for r in form.collect()) == [1, 2, 3, 4] + [5] * 2996


def test_small_groups_are_one_slice(frame):
    sliced = ordered._row_slices(frame, ["k"], ["ts"], 500)
    assert sliced.select(ordered.SLICE).distinct().count() == 1


@pytest.mark.parametrize("slice_rows", [20, 500_000])
def test_exact_percentiles(frame, rows, slice_rows):
    got = ordered.exact_percentiles(frame, ["k"], "v", {"mid": 0.5, "high": 0.9}, slice_rows)
    actual = {r["k"]: (r["mid"], r["high"]) for r in got.collect()}
    for key, group in by_key(rows).items():
        values = sorted(r[3] for r in group if r[3] is not None)
        for fraction, mine in zip((0.5, 0.9), actual[key]):
            place = (len(values) - 1) * fraction
            low, high = values[int(place)], values[min(int(place) + 1, len(values) - 1)]
            assert mine == pytest.approx(low + (high - low) * (place - int(place)))
    whole = ordered.exact_percentiles(frame, [], "v", {"least": 0.0, "most": 1.0}).collect()
    assert [tuple(r) for r in whole] == [(-2.25, 1234.51)]


def test_rank_within(frame, rows):
    got = {r["id"]: r["place"] for r in ordered.rank_within(frame, ["k"], "v", "place").collect()}
    assert got == {r["id"]: r["place"] for r in ordered.rank_by(frame, ["k"], "v", "place").collect()}


def test_newest_is_limited_before_the_shuffle(frame, rows):
    got = ordered.newest(frame, ["k"], [descending("ts"), descending("id")])
    expected = {g[-1][0] for g in by_key(rows).values()}
    assert {r["id"] for r in got.collect()} == expected
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and "WindowGroupLimit" in plan
