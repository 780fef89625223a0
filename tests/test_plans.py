"""Parts agree with the whole, and physical plans keep their shape."""

import os
import re

import pytest
from pyspark.sql import functions as F

from lapwise.bindings import registry, sales, star_queries, text_queries
from lapwise.plans import analysis, feeds, views
from lapwise.plans.star import Star

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    return sales.sales_star(spark, FOLDER)


@pytest.fixture(scope="module")
def progression(star):
    return views.season_progression(star)


def test_one_season_equals_its_part_of_all(star, progression):
    season = 1997
    part = F.col("season_year") == season
    assert content(views.season_progression(star, season)) == content(progression.filter(part))
    assert content(views.reliability(star, season)) == content(views.reliability(star).filter(part))
    assert content(views.pit_performance(star, season)) == content(
        views.pit_performance(star).filter(part))
    assert analysis.classification(views.race_result(star), season, "Round 05").count() == (
        star.result.filter("race_id = 199705").count())


def test_running_total_ends_at_the_plain_sum(star, progression):
    last = analysis.final_rows(progression).agg(F.sum("cumulative_points")).first()[0]
    assert last == star.result.agg(F.sum("points")).first()[0]


def test_composing_a_view_starts_no_job(spark, star):
    def jobs():
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))

    # Opening the tables lists files; that is done by the fixture.
    for table in ("driver", "constructor", "circuit", "race", "status", "result", "pit_stop"):
        getattr(star, table)
    before = jobs()
    progression = views.season_progression(star, 1997)
    for built in (
        feeds.title_margin(progression), feeds.top_contenders(progression),
        feeds.season_headline(progression, 1997), analysis.pit_spread(views.pit_performance(star)),
        analysis.leader_gap(progression), analysis.rank_divergence(views.reliability(star)),
    ):
        assert built.columns
    assert jobs() == before


def test_floor_of_stops_bites(star):
    every = views.pit_performance(star, min_stops=1)
    floor = views.pit_performance(star)
    assert floor.count() == every.filter(F.col("stop_count") >= views.MIN_STOPS).count()
    assert views.pit_performance(star, min_stops=10**9).count() == 0


def test_an_empty_season_has_a_headline(star):
    row = feeds.season_headline(views.season_progression(star), 1066).collect()
    assert [tuple(r) for r in row] == [("—", 0.0, 0.0, 0)]


def test_plans_stay_in_the_jvm_without_cross_joins(spark):
    for name in ("season_standings", "stop_performance", "reliability", "wide_result"):
        text = plan(star_queries.QUERIES[name](spark, FOLDER))
        assert "Python" not in text and "Cartesian" not in text and "NestedLoop" not in text


def test_scans_read_only_what_is_used(spark, star):
    text = plan(views.reliability(star))
    scans = re.findall(r"ReadSchema: struct<([^>]*)", text)
    assert scans and all("o_orderkey" not in s and "c_name" not in s for s in scans)
    shape = plan(text_queries.orphan_checks(spark, FOLDER))
    assert "l_extendedprice" not in shape


def test_season_reaches_the_scan(spark, tmp_path, star):
    folder = str(tmp_path / "result")
    star.result.repartitionByRange(8, "race_id").write.parquet(folder)
    held = Star({**star.sources, "result": lambda: spark.read.parquet(folder)})
    text = plan(views.reliability(held, 1997))
    assert re.search(r"PushedFilters: \[[^\]]*race_id", text)


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    text = plan(text_queries.QUERIES["conform_status"](spark, FOLDER))
    partial = [at for at, line in enumerate(text.splitlines())
               if "WindowGroupLimit" in line and "Partial" in line]
    exchange = [at for at, line in enumerate(text.splitlines()) if "Exchange hashpart" in line]
    assert partial and exchange and partial[0] > exchange[0]


def test_title_margin_and_leader_gap_rank_nobody(spark, star):
    """Neither reports a standing, so no round is sliced and ranked for them."""
    for name in ("title_margin", "leader_gap"):
        assert "percentile_approx" not in plan(star_queries.QUERIES[name](spark, FOLDER))
    ranked = views.season_progression(star)
    assert content(feeds.title_margin(ranked)) == content(feeds.title_margin(views.running_points(star)))


def test_shuffles_begin_with_many_partitions(spark):
    """A task's sorts and hash tables stay small however few partitions the session names."""
    first = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "4")
    registry.QUERIES["price_percentiles"](session, FOLDER)
    assert int(session.conf.get(first)) >= 192
    session.conf.set(first, "7")
    registry.QUERIES["price_percentiles"](session, FOLDER)
    assert session.conf.get(first) == "7"
