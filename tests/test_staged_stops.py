import datetime as dt

from lapwise import session
from lapwise.bindings import storage_queries


def test_stops_without_a_duration_are_kept(spark, tmp_path):
    """No stop is taken for a file's header, and the longest stop of a key is its last line."""
    orders = [(1, 7, dt.datetime(1995, 3, 1)), (2, 8, dt.datetime(1995, 4, 1)), (3, 9, dt.datetime(1996, 4, 1))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    lines = [(1, 1, 5000.0), (1, 1, 70000.0), (1, 1, 9000.0), (1, 2, None), (2, 1, None), (3, 1, None), (3, 1, 4000.0)]
    spark.createDataFrame(
        [(k, 1, 1, n, 2.0, price, dt.datetime(1997, 1, 1)) for k, n, price in lines],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        " l_extendedprice double, l_shipdate timestamp",
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    found = storage_queries.newest_stops(spark, str(tmp_path)).collect()
    assert sorted((r.race_id, r.driver_id, r.stop_number, r.duration_ms, r.staged) for r in found) == [
        (199503, 7, 1, 70000, 3), (199503, 7, 2, None, 1), (199504, 8, 1, None, 1), (199604, 9, 1, 4000, 2),
    ]


def test_a_stored_file_holds_a_bounded_number_of_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "FILE_ROWS", 10)
    kept = session.stored(spark.range(0, 95, 1, 1), "few")
    assert kept.count() == 95 and len(kept.inputFiles()) == 10


def test_scans_are_widened_and_own_sizes_left_alone(spark):
    own = spark.newSession()
    read = "spark.sql.files.maxPartitionBytes"
    assert session.widen(own).conf.get(read) == str(session.READ_BYTES)
    own.conf.set(read, "33554432b")
    assert session.widen(own).conf.get(read) == "33554432b"
