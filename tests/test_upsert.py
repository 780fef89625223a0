"""Upserts: idempotent, order-insensitive, untouched buckets stay."""

import datetime as dt
import importlib
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapwise.functions import exact_hash
from lapwise.operators.incremental import NotIncremental, require_row_local
from lapwise.operators.tables import BUCKET, BucketTable
from lapwise.operators.upsert import only_buckets, upsert
from lapwise.plans import conform
from lapwise.sources.entities import ENTITIES
from lapwise.session import scratch_path

upsert_module = importlib.import_module("lapwise.operators.upsert")

SCHEMA = T.StructType(
    [T.StructField("k", T.LongType()), T.StructField("v", T.StringType()),
     T.StructField("row_hash", T.StringType()), T.StructField("dw_inserted_at", T.TimestampType()),
     T.StructField("dw_updated_at", T.TimestampType())])


def batch(spark, pairs):
    rows = spark.createDataFrame(pairs, "k bigint, v string")
    return rows.withColumn("row_hash", exact_hash(["v"])).withColumn(
        BUCKET, F.floor(F.col("k") / 10).cast("bigint"))


def at(day):
    return F.lit(dt.datetime(2024, 1, day)).cast("timestamp")


def state(table):
    return {r["k"]: (r["v"], r["dw_inserted_at"].day, r["dw_updated_at"].day)
            for r in table.read().collect()}


def files(table):
    return {b: sorted(os.listdir(f"{table.path}/{b}")) for b in sorted(os.listdir(table.path)) if "=" in b}


@pytest.fixture
def table(spark):
    return BucketTable(spark, scratch_path(spark, "table"), SCHEMA)


def test_insert_update_keep(spark, table):
    assert upsert(table, batch(spark, [(1, "a"), (2, None), (11, "c"), (25, "d")]), "k", at(1)) \
        .inserted == 4
    before = files(table)
    report = upsert(table, batch(spark, [(1, "A"), (2, None), (12, "n")]), "k", at(2))
    assert (report.inserted, report.updated, report.unchanged) == (1, 1, 1)
    assert state(table) == {1: ("A", 1, 2), 2: (None, 1, 1), 11: ("c", 1, 1),
                            12: ("n", 2, 2), 25: ("d", 1, 1)}
    # Bucket 2 was not rewritten, and a batch without changes writes nothing.
    after = files(table)
    assert [b for b in after if after[b] == before[b]] == [f"{BUCKET}=2"]
    again = upsert(table, batch(spark, [(1, "A"), (2, None), (12, "n")]), "k", at(3))
    assert not again.changed and files(table) == after


def test_a_failed_write_leaves_the_table(spark, table):
    upsert(table, batch(spark, [(1, "a"), (11, "b")]), "k", at(1))
    broken = table.read().withColumn(
        "v", F.when(F.col("k") == 11, F.raise_error(F.lit("stop"))).otherwise(F.lit("half")))
    with pytest.raises(Exception, match="stop"):
        table.replace(broken, table.read().select(BUCKET).distinct())
    assert state(table) == {1: ("a", 1, 1), 11: ("b", 1, 1)}


def test_buckets_are_announced_before_the_table_changes(spark, table):
    upsert(table, batch(spark, [(1, "a"), (11, "b")]), "k", at(1))
    seen = []
    upsert(
        table, batch(spark, [(1, "a"), (12, "n")]), "k", at(2),
        lambda buckets: seen.append((sorted(r[0] for r in buckets.collect()), set(state(table)))),
    )
    assert seen == [([1], {1, 11})]


def test_emptied_bucket(spark, table):
    upsert(table, batch(spark, [(1, "a"), (11, "b")]), "k", at(1))
    table.replace(table.read().limit(0), spark.createDataFrame([(0,)], f"{BUCKET} bigint"))
    assert set(state(table)) == {11}


def test_dedup_ignores_arrival_order(spark):
    """Shuffled landing rows of one batch give the same typed table."""
    entity = ENTITIES["status"]
    rng = random.Random(3)
    rows = [(str(i % 7), rng.choice(["Finished", "+1 Lap", None]), f"f{i % 3}", i % 4,
             dt.datetime(2024, 1, 1 + i % 2)) for i in range(80)] + [("x", "bad", "f", 1, None)]
    schema = "statusId string, status string, dw_file_name string, " \
             "dw_file_row_number bigint, dw_loaded_at timestamp"
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        typed = conform.conformed(spark.createDataFrame(rows, schema).repartition(3 + seed), entity)
        results.append(sorted(map(tuple, typed.collect())))
    assert results[0] == results[1] == results[2] and len(results[0]) == 7
    newest = {r[0]: r for r in results[0]}
    for key, row in newest.items():
        of_key = [r for r in rows if r[0] == str(key)]
        best = max(of_key, key=lambda r: (r[4], r[3], r[2]))
        assert row[3] == best[2]


def test_narrow_hash_misses_what_the_full_one_sees(spark):
    entity = ENTITIES["results"]
    full, narrow = entity.hash_columns(), entity.hash_columns(narrow=True)
    assert set(full) - set(narrow) == {
        "car_number", "fastest_lap_number", "fastest_lap_rank", "fastest_lap_speed_kph"}
    assert "result_id" not in full


@pytest.mark.parametrize(
    "query",
    [lambda d: d.groupBy("id").count(), lambda d: d.join(d.select("id"), "id"),
     lambda d: d.orderBy("id"), lambda d: d.limit(3), lambda d: d.distinct(),
     lambda d: d.withColumn("r", F.rand()), lambda d: d.union(d),
     lambda d: d.selectExpr("sum(id) over () as s")],
)
def test_only_row_local_queries_may_be_incremental(spark, query):
    source = spark.range(5).withColumn("v", F.lit(1))
    with pytest.raises(NotIncremental):
        require_row_local(query(source_table(spark, source)))


def test_projection_and_filter_are_row_local(spark):
    source = source_table(spark, spark.range(5))
    assert require_row_local(source.filter("id > 1").selectExpr("id + 1 as x")).count() == 3


def source_table(spark, frame):
    path = scratch_path(spark, "source")
    frame.write.parquet(path)
    return spark.read.parquet(path)


def test_only_reached_buckets_are_opened(spark, table):
    upsert(table, batch(spark, [(k, "a") for k in range(0, 400, 5)]), "k", at(1))
    buckets = spark.createDataFrame([(3,), (7,)], f"{BUCKET} bigint")
    reached = only_buckets(table.read(), buckets)
    plan = reached._jdf.queryExecution().executedPlan().toString()
    filters = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    assert f"{BUCKET}#" in filters.split("PartitionFilters")[1] and ">= 3" in filters and "<= 7" in filters
    assert {r[BUCKET] for r in reached.collect()} == {3, 7}
    assert only_buckets(table.read(), buckets.limit(0)).count() == 0


def test_hashed_buckets_spread_an_entity_without_a_range(spark):
    status = ENTITIES["status"]
    rows = spark.range(1000).selectExpr("id as status_id").withColumn(BUCKET, conform.bucket(status, 8))
    sizes = [r["count"] for r in rows.groupBy(BUCKET).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 200


def test_a_first_load_is_neither_joined_nor_stored(spark, table, monkeypatch):
    """Nothing to compare with: only the list of buckets is stored, and long digests are not shuffled."""
    stored, plans = [], []
    keep, write = upsert_module.stored, BucketTable.replace
    monkeypatch.setattr(upsert_module, "stored", lambda df, label: stored.append(label) or keep(df, label))

    def replace(self, rows, buckets, gathered=False):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, buckets, gathered)

    monkeypatch.setattr(BucketTable, "replace", replace)
    raw = batch(spark, [(1, "a"), (2, None), (11, "c")]).drop("row_hash")
    report = upsert(
        table, raw, "k", at(1), finish=lambda rows: rows.withColumn("row_hash", exact_hash(["v"])), buckets=raw)
    assert (report.inserted, report.updated, report.unchanged) == (3, 0, 0)
    assert state(table) == {1: ("a", 1, 1), 2: (None, 1, 1), 11: ("c", 1, 1)}
    assert stored == ["upsert-buckets"] and "Join" not in plans[0]
    assert plans[0].index("sha2") < plans[0].index("Exchange")
    # The same rows again change nothing; a bucket the table lacks is added beside the others.
    finish = lambda rows: rows.withColumn("row_hash", exact_hash(["v"]))
    assert not upsert(table, raw, "k", at(2), finish=finish, buckets=raw).changed
    more = batch(spark, [(95, "z")]).drop("row_hash")
    assert upsert(table, more, "k", at(3), finish=finish, buckets=more).inserted == 1
    assert set(state(table)) == {1, 2, 11, 95}


def test_tables_are_written_with_a_codec_that_shrinks_digests(spark, table):
    upsert(table, batch(spark, [(1, "a"), (11, "c")]), "k", at(1))
    names = [n for b in files(table).values() for n in b if n.startswith("part")]
    assert names and all(n.endswith(".zstd.parquet") for n in names)


def test_a_batch_goes_part_by_part_and_leaves_no_scratch(spark, table, monkeypatch):
    """Few rows a part: the same table and report, each part announced and written by itself."""
    monkeypatch.setattr(upsert_module, "PART_ROWS", 4)
    upsert(table, batch(spark, [(k, "a") for k in range(0, 60, 5)]), "k", at(1))
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/lapwise"
    before, kept = files(table), {n for n in os.listdir(folder)}
    seen = []
    changed = [(k, "A" if k == 25 else "a") for k in range(0, 50, 5)] + [(3, "n"), (47, "n"), (99, "n")]
    report = upsert(
        table, batch(spark, changed), "k", at(2), lambda buckets: seen.append(sorted(r[0] for r in buckets.collect()))
    )
    assert (report.inserted, report.updated, report.unchanged) == (3, 1, 9)
    assert len(seen) > 1 and sorted(sum(seen, [])) == [0, 2, 4, 9]
    want = {k: ("a", 1, 1) for k in range(0, 60, 5)} | {25: ("A", 1, 2), 3: ("n", 2, 2), 47: ("n", 2, 2), 99: ("n", 2, 2)}
    assert state(table) == want
    after = files(table)
    assert [b for b in before if after[b] == before[b]] == [f"{BUCKET}={b}" for b in (1, 3, 5)]
    assert set(os.listdir(folder)) == kept
    hashes = dict(table.read().select("k", "row_hash").collect())
    assert hashes == dict(table.read().select("k", exact_hash(["v"])).collect())


def test_packed_texts_come_back(spark):
    digest = "0123456789abcdef" * 4
    texts = [digest, digest.upper(), digest + "\n", digest[1:], "", "é", "\x01" + digest, None, "g" * 64]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k bigint, t string")
    packed = upsert_module.packed(rows, "k", "t")
    assert dict(packed.dtypes) == {"k": "bigint", "t": "binary"}
    assert [len(r["t"]) for r in packed.orderBy("k").limit(2).collect()] == [33, 65]
    assert [r["t"] for r in upsert_module.unpacked(packed, "k", "t").orderBy("k").collect()] == texts


def test_text_keys_meet_as_bytes(spark):
    """Digests as keys, and a key that is none, update their rows and are stored as the texts they are."""
    schema = T.StructType([T.StructField("k", T.StringType()), *SCHEMA.fields[1:]])
    table = BucketTable(spark, scratch_path(spark, "texts"), schema)

    def rows(value):
        keys = spark.createDataFrame([("x",), ("y",)], "n string").select(F.sha2("n", 256).alias("k"), F.lit(value).alias("v"))
        both = keys.unionByName(spark.createDataFrame([("plain", value)], "k string, v string"))
        return both.withColumns({"row_hash": exact_hash(["v"]), BUCKET: F.lit(0).cast("bigint")})

    upsert(table, rows("a"), "k", at(1))
    assert upsert(table, rows("b"), "k", at(2)).updated == 3
    assert {(r["k"], r["v"], r["row_hash"]) for r in table.read().collect()} == {
        (r["k"], "b", r["row_hash"]) for r in rows("b").collect()}
