"""Registered queries for casts, dates, hashes, typed tables, quality and masking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise import functions as fx
from lapwise.bindings.sales import (
    duration_text,
    month_id,
    outcome,
    sales_star,
    status_id,
    table,
    typed_table,
)
from lapwise.operators import quality
from lapwise.operators.masking import PRIVILEGED_ROLES
from lapwise.plans import conform, verification
from lapwise.sources import audit, inventory
from lapwise.sources.entities import ENTITIES

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2002-06-30"
MEASURED = ("2024-01-01 00:00:00", "2024-01-02 00:00:00")
AUDIT_NOW = "2024-01-02 06:00:00"


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def duration_parse(spark: SparkSession, folder: str) -> DataFrame:
    """Event values written as durations in several shapes, junk included, and parsed back."""
    kind = F.col("event_type")
    ms = F.round(F.col("value") * 1000).cast("bigint")
    minutes = duration_text(ms)
    text = (
        F.when(kind == "purchase", minutes)
        .when(kind == "view", F.concat(minutes, F.lit(":ignored")))
        .when(kind == "click", duration_text(ms, minutes=False))
        .when(kind == "error", F.concat(F.lit("n/a "), kind))
    )
    events = table(spark, folder, "events").select("event_id", text.alias("duration"))
    return events.withColumn("duration_ms", fx.duration_to_ms("duration"))


def safe_casts(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    kind, value = F.col("event_type"), F.col("value")
    tag = F.split_part(F.split_part("props", F.lit(": "), F.lit(2)), F.lit("}"), F.lit(1))
    day = F.date_format("ts", "yyyy-MM-dd")
    clock = F.date_format("ts", "HH:mm:ss")
    text = F.when(kind == "error", kind).otherwise(value.cast("string"))
    return events.select(
        "event_id",
        fx.try_number(tag).alias("tag"),
        fx.try_number(F.concat(F.lit(" "), text, F.lit(" "))).alias("whole"),
        fx.try_double(text).alias("real"),
        fx.try_decimal(F.concat(text, F.lit("5"))).cast("double").alias("rounded"),
        fx.try_date(F.when(kind == "view", F.lit("2024-02-30")).otherwise(day)).alias("day"),
        fx.try_time(F.when(kind == "click", F.lit("25:00:00")).otherwise(clock)).alias("clock"),
        F.coalesce(fx.try_number(text), fx.try_number(tag), F.lit(-1)).alias("first_known"),
        F.nullif(kind, F.lit("signup")).alias("not_signup"),
        fx.flag(value > 100).alias("is_large"),
        F.position(F.lit(":"), F.col("props")).cast("bigint").alias("colon_at"),
    )


def date_parts(spark: SparkSession, folder: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    as_of = F.lit(AS_OF).cast("date")
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.month(day).alias("month"),
        fx.day_name(day).alias("day_name"),
        F.date_diff(as_of, day).cast("bigint").alias("days"),
        fx.year_boundaries(day, as_of).alias("years"),
        fx.first_of_year(day).alias("year_start"),
    )


def change_hash(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").withColumn(
        "credit", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    )
    columns = ["c_name", "credit", "c_nationkey", "c_mktsegment"]
    return customers.select("c_custkey", fx.change_hash(columns).alias("row_hash"))


# -- the seven typed tables out of text ---------------------------------------------


def _landing(rows: DataFrame, name: str, cells: dict[str, Column], *lineage: Column) -> DataFrame:
    """Shape rows as landed text; lineage is file name, row number, load time."""
    entity = ENTITIES[name]
    file_name, row_number, loaded_at = lineage
    nothing = F.lit(None).cast("string")
    return rows.select(
        *[cells.get(c, nothing).cast("string").alias(c) for c in entity.landing],
        file_name.alias("dw_file_name"),
        row_number.cast("bigint").alias("dw_file_row_number"),
        loaded_at.cast("timestamp").alias("dw_file_last_modified"),
        loaded_at.cast("timestamp").alias("dw_loaded_at"),
    )


def landing_rows(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Sales tables written as landed text of one entity, with repeated keys where they occur."""
    loaded = F.lit("2024-01-01 00:00:00")

    def read(source: str) -> DataFrame:
        return table(spark, folder, source)

    if name == "circuits":
        balance = F.col("s_acctbal")
        return _landing(
            read("supplier"), name,
            {
                "circuitId": F.col("s_suppkey"), "circuitRef": F.lower("s_name"),
                "name": F.col("s_name"), "location": F.lit(None),
                "country": F.concat(F.lit("country "), F.col("s_nationkey")),
                "lat": F.when(balance < 0, F.lit("south")).otherwise(
                    (F.col("s_nationkey") / 4).cast("string")
                ),
                "lng": F.col("s_nationkey") * -2, "alt": balance, "url": F.col("s_name"),
            },
            F.lit("circuits.csv"), F.col("s_suppkey"), loaded,
        )
    if name == "constructors":
        return _landing(
            read("nation"), name,
            {
                "constructorId": F.col("n_nationkey"), "constructorRef": F.lower("n_name"),
                "name": F.col("n_name"), "nationality": F.col("n_regionkey"),
            },
            F.lit("constructors.csv"), F.col("n_nationkey"), loaded,
        )
    if name == "drivers":
        balance = F.col("c_acctbal")
        return _landing(
            read("customer"), name,
            {
                "driverId": F.col("c_custkey"), "driverRef": F.lower("c_name"),
                "number": F.col("c_nationkey"), "code": F.substring("c_mktsegment", 1, 3),
                "forename": F.when(balance >= 0, F.split_part("c_name", F.lit("#"), F.lit(1))),
                "surname": F.split_part("c_name", F.lit("#"), F.lit(2)),
                "dob": F.concat(F.lit("1980-02-"), F.col("c_nationkey") + 10),
                "nationality": F.col("c_mktsegment"),
            },
            F.lit("drivers.csv"), F.col("c_custkey"), loaded,
        )
    orders = read("orders")
    code = status_id(F.col("o_orderstatus"), F.col("o_orderpriority"))
    order_lineage = (
        F.concat(F.lit("orders-"), F.year("o_orderdate")), F.col("o_orderkey"),
        F.col("o_orderdate"),
    )
    if name == "status":
        return _landing(orders, name, {"statusId": code, "status": outcome(code)}, *order_lineage)
    if name == "races":
        day = F.col("o_orderdate").cast("date")
        return _landing(
            orders, name,
            {
                "raceId": month_id(F.col("o_orderdate")), "year": F.year(day),
                "round": F.month(day), "circuitId": F.col("o_custkey"),
                "name": F.col("o_orderpriority"), "date": day,
                "time": F.concat(F.col("o_orderkey") % 30, F.lit(":15:00")),
            },
            *order_lineage,
        )
    if name == "results":
        line = read("lineitem")
        ms = F.round(F.col("l_extendedprice")).cast("bigint")
        return _landing(
            line, name,
            {
                "resultId": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
                "raceId": F.col("l_orderkey"), "driverId": F.col("l_suppkey"),
                "constructorId": F.col("l_partkey"), "number": F.col("l_suppkey"),
                "grid": F.col("l_quantity").cast("int"),
                "position": F.when(F.col("l_returnflag") != "R", F.col("l_linenumber")),
                "positionText": F.col("l_returnflag"), "positionOrder": F.col("l_linenumber"),
                "points": F.col("l_quantity").cast("decimal(8,2)") / 2,
                "laps": F.col("l_quantity").cast("int"),
                "milliseconds": ms,
                "fastestLapTime": duration_text(ms),
                "fastestLapSpeed": F.col("l_quantity").cast("int") / 4,
                "statusId": F.when(F.col("l_linestatus") == "O", F.lit("open")).otherwise(
                    F.col("l_linenumber").cast("string")
                ),
            },
            F.concat_ws("-", F.lit("lines"), F.col("l_returnflag"), F.col("l_suppkey")),
            F.col("l_partkey"), F.col("l_shipdate"),
        )
    if name == "pit_stops":
        events = read("events")
        ms = F.round(F.col("value") * 1000).cast("bigint")
        return _landing(
            events, name,
            {
                "raceId": F.date_format("ts", "yyyyMMdd"),
                "driverId": F.when(F.col("event_type") == "signup", F.lit("unknown")).otherwise(
                    F.col("user_id").cast("string")
                ),
                "stop": F.hour("ts"), "lap": F.minute("ts"),
                "time": F.date_format("ts", "HH:mm:ss"),
                "duration": duration_text(ms, minutes=False),
                "milliseconds": F.when(F.col("event_type") == "purchase", ms),
            },
            F.lit("events.csv"), F.col("event_id"), F.col("ts"),
        )
    raise KeyError(name)


def _conform(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        entity = ENTITIES[name]
        rows = conform.typed(landing_rows(spark, folder, name), entity)
        return fx.to_serving(conform.with_hash(rows, entity, text=True))

    return query


def typed_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Change hash of the newest copy of every line, over the short column list as well."""
    entity = ENTITIES["results"]
    rows = conform.typed(landing_rows(spark, folder, "results"), entity)
    full = conform.with_hash(rows, entity, text=True)
    narrow = fx.change_hash(entity.hash_columns(narrow=True))
    return full.select("result_id", "dw_source_file", narrow.alias("narrow_hash"))


# -- quality, audit, masking ----------------------------------------------------------


def orphan_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Lines and orders against parents of which some are left out by a business rule."""
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    customer, supplier = table(spark, folder, "customer"), table(spark, folder, "supplier")
    in_credit = customer.filter("c_acctbal >= 0")
    checks = [
        ("lineitem -> orders not pending", lines, orders.filter("o_orderstatus <> 'P'"),
         "l_orderkey", "o_orderkey"),
        ("lineitem -> suppliers in credit", lines, supplier.filter("s_acctbal >= 0"),
         "l_suppkey", "s_suppkey"),
        ("orders -> customers in credit", orders, in_credit, "o_custkey", "c_custkey"),
        ("events -> customers in credit", table(spark, folder, "events"), in_credit,
         "user_id", "c_custkey"),
        ("nation -> region", table(spark, folder, "nation"), table(spark, folder, "region"),
         "n_regionkey", "r_regionkey"),
    ]
    return quality.integrity(checks)


def _history(spark: SparkSession, folder: str, measured: str, late: bool) -> DataFrame:
    """Metrics of the sales-derived typed tables at one time."""
    lines = table(spark, folder, "lineitem").withColumn(
        "shipped", F.when(F.col("l_linestatus") == "F", F.col("l_shipdate"))
    )
    at = F.lit(measured).cast("timestamp")
    newest_order = F.lit("2002-01-01 00:00:00" if not late else "2003-01-01 00:00:00")
    suites = [
        ("lineitem", lines,
         [quality.null_count("shipped"), quality.row_count(),
          quality.out_of_range("DMF_QUANTITY_OUT_OF_RANGE", "l_quantity", 2, 49)],
         [["l_orderkey", "l_linenumber"]]),
        ("orders", table(spark, folder, "orders"),
         [quality.row_count(), quality.freshness("o_orderdate", newest_order)],
         [["o_orderkey"], ["o_custkey"]]),
        ("results", typed_table(spark, folder, "results"),
         [quality.null_count("finish_position"),
          quality.out_of_range("DMF_GRID_POSITION_OUT_OF_RANGE", "grid_position", 0, 40)], []),
        ("pit_stops", typed_table(spark, folder, "pit_stops"),
         [quality.out_of_range("DMF_IMPLAUSIBLE_PIT_DURATION", "duration_ms", 1000, 300000)],
         []),
    ]
    parts = [quality.measure_table(n, df, m, u, at) for n, df, m, u in suites]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def _plain_time(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def quality_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return _plain_time(_history(spark, folder, MEASURED[0], late=False), "measurement_time")


def quality_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Verdicts on the newer of two measurements."""
    both = _history(spark, folder, MEASURED[0], late=False).unionByName(
        _history(spark, folder, MEASURED[1], late=True)
    )
    return _plain_time(quality.latest_results(both), "measurement_time")


def _load_rows(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents as landed rows, their source as the file, toxic ones as rejects."""
    documents = table(spark, folder, "documents")
    number = F.substring("source", 4, 9).cast("int")
    loaded_at = F.timestamp_add("HOUR", number, F.lit("2024-01-01 00:00:00").cast("timestamp"))
    rows = documents.select(
        F.col("lang").alias("target_table"), F.col("source").alias("file_name"),
        loaded_at.alias("last_load_time"), F.col("doc_id").alias("line_number"),
    )
    toxic = table(spark, folder, "labels").filter("toxic = 1").select(
        F.col("doc_id").alias("line_number"),
        F.concat(F.lit("quality "), F.col("quality")).alias("error_message"),
    )
    rejected = rows.join(toxic, "line_number")
    return rows.join(toxic, "line_number", "left_anti"), rejected


def audit_append(spark: SparkSession, folder: str) -> DataFrame:
    """Load history of the last day that an older audit, of English tables, lacks."""
    rows, rejected = _load_rows(spark, folder)
    history = audit.load_history(rows, rejected)
    recorded = rows.filter("target_table = 'en'").select(*audit.AUDIT_KEY).distinct()
    now = F.lit(AUDIT_NOW).cast("timestamp")
    return _plain_time(audit.unrecorded(history, recorded, now, 24), "last_load_time")


def audit_tail(spark: SparkSession, folder: str) -> DataFrame:
    rows, rejected = _load_rows(spark, folder)
    return _plain_time(audit.latest(audit.load_history(rows, rejected)), "last_load_time")


def load_reconcile(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as staged files against labels and benchmark items as loaded ones."""

    def names(source: str, prefix: str, key: str) -> DataFrame:
        return table(spark, folder, source).select(
            F.concat(F.lit(prefix), F.col(key)).alias("file_name")
        )

    loaded = names("labels", "doc-", "doc_id").unionByName(
        names("benchmark", "item-", "item_id")
    )
    return inventory.reconcile(names("documents", "doc-", "doc_id"), loaded)


def masked_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The driver profile as an engineer and as an analyst see it."""
    star = sales_star(spark, folder)
    as_of = F.lit(AS_OF).cast("date")
    seen = [
        verification.profile(star, roles, as_of).withColumn("seen_by", F.lit(label))
        for label, roles in (("engineer", PRIVILEGED_ROLES), ("analyst", {"analyst"}))
    ]
    return seen[0].unionByName(seen[1])


def masked_sample(spark: SparkSession, folder: str) -> DataFrame:
    return verification.profile_sample(sales_star(spark, folder), {"analyst"})


ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table_counts(spark: SparkSession, folder: str) -> DataFrame:
    return audit.table_counts({n: table(spark, folder, n) for n in ALL_TABLES})


def table_changes(spark: SparkSession, folder: str) -> DataFrame:
    times = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    return audit.table_counts(
        {n: table(spark, folder, n).withColumnRenamed(c, "changed") for n, c in times.items()},
        last_change="changed",
    )


QUERIES: dict[str, Query] = {
    "duration_parse": duration_parse,
    "safe_casts": safe_casts,
    "date_parts": date_parts,
    "change_hash": change_hash,
    "typed_dedup": typed_dedup,
    **{f"conform_{name}": _conform(name) for name in ENTITIES},
    "orphan_checks": orphan_checks,
    "quality_metrics": quality_metrics,
    "quality_latest": quality_latest,
    "audit_append": audit_append,
    "audit_tail": audit_tail,
    "load_reconcile": load_reconcile,
    "masked_profile": masked_profile,
    "masked_sample": masked_sample,
    "table_counts": table_counts,
    "table_changes": table_changes,
}
