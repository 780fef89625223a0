"""Sales tables read as a racing archive.

An order is a result: its customer is the driver, the customer's nation the team, its
month the race, the region the circuit, its price the points, its status and priority
the outcome.  A line item is a pit stop of that order's customer, its price the
milliseconds.  Everything is derived by Spark from the stored tables, so the star grows
with them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapwise.plans import star as star_plans
from lapwise.plans.star import Star

# Outcome text by order status and priority digit.
OUTCOMES = {
    ("F", 1): "Finished",
    ("F", 2): "+1 Lap",
    ("F", 3): "+2 Laps",
    ("F", 4): "+3 Laps",
    ("F", 5): "+4 Laps",
    ("O", 1): "Disqualified",
    ("O", 2): "Accident",
    ("O", 3): "Collision",
    ("O", 4): "Spun off",
    ("O", 5): "Withdrew",
    ("P", 1): "Did not qualify",
    ("P", 2): "Engine",
    ("P", 3): "Gearbox",
    ("P", 4): "Did not start",
    ("P", 5): "Brakes",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def month_id(date: Column) -> Column:
    return (F.year(date) * 100 + F.month(date)).cast("bigint")


def status_id(status: Column, priority: Column) -> Column:
    """1..15: five priorities within each of the three statuses, in the order F, O, P."""
    letter = F.position(status, F.lit("FOP"))
    return ((letter - 1) * 5 + F.substring(priority, 1, 1).cast("int")).cast("bigint")


def outcome(status: Column) -> Column:
    """Outcome text of a status id; ``OUTCOMES`` lists them in id order."""
    return F.element_at(F.array(*[F.lit(t) for t in OUTCOMES.values()]), status.cast("int"))


def duration_text(ms: Column, minutes: bool = True) -> Column:
    """Milliseconds as ``m:ss.SSS``, or ``s.SSS`` without minutes."""
    fraction = F.lpad((ms % 1000).cast("string"), 3, "0")
    if not minutes:
        return F.concat(F.floor(ms / 1000), F.lit("."), fraction)
    seconds = F.lpad(F.floor(ms % 60000 / 1000).cast("string"), 2, "0")
    return F.concat(F.floor(ms / 60000), F.lit(":"), seconds, F.lit("."), fraction)


def races(orders: DataFrame) -> DataFrame:
    """Typed races: one per month with orders."""
    months = orders.select(
        F.year("o_orderdate").alias("season_year"), F.month("o_orderdate").alias("round_number")
    ).distinct()
    year, month = F.col("season_year"), F.col("round_number")
    return months.select(
        (year * 100 + month).cast("bigint").alias("race_id"),
        "season_year",
        "round_number",
        ((year * 12 + month) % 5).cast("bigint").alias("circuit_id"),
        F.concat(F.lit("Round "), F.lpad(month.cast("string"), 2, "0")).alias("race_name"),
        F.make_date(year, month, F.lit(1)).alias("race_date"),
        F.lit(None).cast("string").alias("race_start_utc"),
    )


def statuses(orders: DataFrame) -> DataFrame:
    """Typed outcomes: the status and priority pairs that occur."""
    seen = orders.select(
        status_id(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("status_id")
    ).distinct()
    described = seen.select("status_id", outcome(F.col("status_id")).alias("status_description"))
    return described.withColumn(
        "is_classified_finish",
        (F.col("status_id") == 1) | F.col("status_description").ilike("+%Lap%"),
    )


def drivers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(
        nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left"
    ).select(
        F.col("c_custkey").alias("driver_id"),
        F.lower("c_name").alias("driver_ref"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("driver_code"),
        F.col("c_nationkey").alias("permanent_number"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("forename"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("surname"),
        F.col("c_name").alias("full_name"),
        # A birth date out of the balance, within 1960..1990.
        F.date_add(F.lit("1960-01-01").cast("date"), F.floor(F.abs("c_acctbal")).cast("int")).alias(
            "date_of_birth"
        ),
        F.col("n_name").alias("nationality"),
    )


def constructors(nation: DataFrame, region: DataFrame) -> DataFrame:
    return nation.join(
        region.select(F.col("r_regionkey").alias("n_regionkey"), "r_name"), "n_regionkey", "left"
    ).select(
        F.col("n_nationkey").cast("bigint").alias("constructor_id"),
        F.lower("n_name").alias("constructor_ref"),
        F.col("n_name").alias("constructor_name"),
        F.col("r_name").alias("nationality"),
    )


def circuits(region: DataFrame) -> DataFrame:
    key = F.col("r_regionkey")
    return region.select(
        key.cast("bigint").alias("circuit_id"),
        F.lower("r_name").alias("circuit_ref"),
        F.col("r_name").alias("circuit_name"),
        F.col("r_name").alias("location"),
        F.upper("r_name").alias("country"),
        (key * 10.5).alias("latitude"),
        (key * -20.25).alias("longitude"),
        (key * 100).cast("int").alias("altitude_m"),
    )


def results(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Typed results; only finished orders (status F) have a position."""
    teams = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    order, driver = F.col("o_orderkey"), F.col("o_custkey")
    place = ((order + driver) % 20 + 1).cast("int")
    return orders.join(teams, "o_custkey").select(
        order.alias("result_id"),
        month_id(F.col("o_orderdate")).alias("race_id"),
        driver.alias("driver_id"),
        F.col("c_nationkey").cast("bigint").alias("constructor_id"),
        status_id(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("status_id"),
        (order % 25).cast("int").alias("grid_position"),
        F.when(F.col("o_orderstatus") == "F", place).alias("finish_position"),
        place.alias("position_order"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("points"),
        (order % 70).cast("int").alias("laps_completed"),
        F.round(F.col("o_totalprice")).cast("bigint").alias("race_duration_ms"),
        (order % 9000 + 70000).cast("bigint").alias("fastest_lap_ms"),
        (order % 300).cast("double").alias("fastest_lap_speed_kph"),
    )


def pit_stops(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Typed pit stops: a line item during its order's race."""
    races_run = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        month_id(F.col("o_orderdate")).alias("race_id"),
        F.col("o_custkey").alias("driver_id"),
    )
    return lineitem.join(races_run, "l_orderkey").select(
        F.sha2(
            F.concat_ws(
                "||", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
            ),
            256,
        ).alias("pit_stop_key"),
        "race_id",
        "driver_id",
        F.col("l_linenumber").alias("stop_number"),
        F.col("l_quantity").cast("int").alias("lap_number"),
        F.round(F.col("l_extendedprice")).cast("bigint").alias("duration_ms"),
    )


def reader(spark: SparkSession, folder: str) -> Callable[[str], DataFrame]:
    """Stored tables by name, each opened once: opening one costs a job for its schema."""
    return cache(lambda name: table(spark, folder, name))


def typed_table(
    spark: SparkSession, folder: str, name: str, read: Callable[[str], DataFrame] | None = None
) -> DataFrame:
    """One of the seven typed tables; ``read`` shares opened tables between several."""
    read = read or reader(spark, folder)
    if name == "drivers":
        return drivers(read("customer"), read("nation"))
    if name == "constructors":
        return constructors(read("nation"), read("region"))
    if name == "circuits":
        return circuits(read("region"))
    if name == "races":
        return races(read("orders"))
    if name == "status":
        return statuses(read("orders"))
    if name == "results":
        return results(read("orders"), read("customer"))
    if name == "pit_stops":
        return pit_stops(read("lineitem"), read("orders"))
    raise KeyError(name)


def sales_star(spark: SparkSession, folder: str) -> Star:
    read = reader(spark, folder)
    return star_plans.build_star(lambda name: typed_table(spark, folder, name, read))


def shipping_star(spark: SparkSession, folder: str) -> Star:
    """Orders as races and their line items as entries: suppliers of a region are team-mates."""
    orders, lineitem = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    supplier = table(spark, folder, "supplier").join(
        nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey"), "s_nationkey"
    )
    entries = lineitem.join(
        supplier.select(F.col("s_suppkey").alias("l_suppkey"), "n_regionkey"), "l_suppkey"
    )
    return Star(
        {
            "driver": lambda: supplier.select(
                F.col("s_suppkey").alias("driver_id"), F.col("s_name").alias("full_name")
            ),
            "constructor": lambda: region.select(
                F.col("r_regionkey").alias("constructor_id"),
                F.col("r_name").alias("constructor_name"),
            ),
            "race": lambda: orders.select(
                F.col("o_orderkey").alias("race_id"), F.year("o_orderdate").alias("season_year")
            ),
            "result": lambda: entries.select(
                F.col("l_orderkey").alias("race_id"),
                F.col("l_suppkey").alias("driver_id"),
                F.col("n_regionkey").alias("constructor_id"),
                F.col("l_linenumber").alias("position_order"),
            ),
        }
    )


def event_results(spark: SparkSession, folder: str) -> DataFrame:
    """Events as a driver's results in time order: a purchase wins, an error does not finish."""
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("driver_name")
    )
    return (
        table(spark, folder, "events")
        .join(customer, "user_id")
        .select(
            F.col("event_id").alias("result_id"),
            F.col("user_id").alias("driver_id"),
            "driver_name",
            F.col("event_type").alias("race_name"),
            F.col("ts").alias("race_date"),
            F.year("ts").alias("season_year"),
            F.when(F.col("event_type") != "error", F.ceil("value").cast("int")).alias(
                "finish_position"
            ),
            F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("is_win"),
        )
    )
