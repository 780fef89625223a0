"""Ordered operators that stay parallel when one group holds most of the rows.

A Spark window runs each key group in one task.  Here a large group is first cut into *slices*
of its order.  For sums, numbers and frames a group has a slice for so many rows: bounds are
picked from a sample of its rows, compared on the whole order with a hash of the row behind
it, so rows tied on the first columns, or NULL there, still spread.  For ranks the distinct
values are cut at approximate quantiles.  Slices are windowed on their own, and the small
table of slice totals carries the running state from one slice to the next.  No job runs
while a plan is composed, and results have the types of the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lapwise.functions.ordering import ascending, descending

SLICE = "__slice"
BEFORE = "__before"
ALL = "__all"

PLACE = "__place"

# Slices of a group's distinct values when they are ranked.
SLICES = 32

# Rows of a slice, most slices of a group, and sampled rows for each bound between two.
SLICE_ROWS = 500_000
MOST_SLICES = 4096
SAMPLED = 16

# Consecutive rows that one task takes for a sliding frame.
CHUNK_ROWS = 100_000


def as_number(value: Column, kind: str) -> Column:
    """A number that never falls where ``value`` rises; ``kind`` is its type's name."""
    if kind.startswith("timestamp"):
        return F.unix_micros(value.cast("timestamp")).cast("double")
    if kind == "date":
        return F.unix_date(value).cast("double")
    return value.cast("double")


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join on ``keys`` where NULL meets NULL; right keys are dropped."""
    right_keys = {k: f"__right_{k}" for k in keys}
    renamed = right.withColumnsRenamed(right_keys)
    condition = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(r)) for k, r in right_keys.items()],
        F.lit(True),
    )
    return left.join(renamed, condition, how).drop(*right_keys.values())


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A frame without keys gets a constant one, so that every join has a key."""
    return (df, list(keys)) if keys else (df.withColumn(ALL, F.lit(0)), [ALL])


def _sliced(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Add the slice number of the column ``by``; NULL, the largest value, has the last."""
    number = as_number(F.col(by), dict(df.dtypes)[by])
    steps = F.array(*[F.lit(i / SLICES) for i in range(1, SLICES)])
    bounds = df.groupBy(*keys).agg(
        F.percentile_approx(number, steps, F.lit(1000)).alias("__bounds")
    )
    below = F.size(F.filter(F.col("__bounds"), lambda b: b <= number))
    return (
        null_safe_join(df, bounds, keys)
        .withColumn(SLICE, F.when(number.isNull(), SLICES).otherwise(below))
        .drop("__bounds")
    )


def _row_slices(df: DataFrame, keys: Sequence[str], order: Sequence[str], slice_rows: int) -> DataFrame:
    """Add each row's place in its group's whole order and its slice number.

    Groups of more than ``slice_rows`` rows are sampled by a hash of the row, about `SAMPLED` rows
    for each slice, and cut at evenly chosen places of the sample; all others are one slice.
    """
    marks = [F.struct(F.col(c).isNull().alias("absent"), F.col(c).alias("value")) for c in order]
    tie = F.xxhash64(*[F.col(c) for c in df.columns])
    placed = df.withColumn(PLACE, F.struct(*[m.alias(f"p{i}") for i, m in enumerate(marks)], tie.alias("tie")))
    steps = 1 << 40
    slices = F.least(F.ceil(F.col("__n") / slice_rows), F.lit(MOST_SLICES)).cast("int")
    large = placed.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") > slice_rows).select(
        *keys, slices.alias("__slices"), (slices * SAMPLED * steps / F.col("__n")).alias("__rate")
    )
    sampled = null_safe_join(placed.select(*keys, PLACE), large, keys).filter(
        F.pmod(F.xxhash64(PLACE, F.lit(1)), F.lit(steps)) < F.col("__rate")
    )
    bounds = sampled.groupBy(*keys, "__slices").agg(F.sort_array(F.collect_list(PLACE)).alias("__sample")).select(
        *keys,
        F.expr(
            "transform(sequence(1, __slices - 1),"
            " i -> __sample[cast(floor(i * size(__sample) / __slices) as int)])"
        ).alias("__bounds"),
    )
    # How many bounds lie below the row's place, by halving.
    below = F.expr(
        f"aggregate(sequence(0, {MOST_SLICES.bit_length()}), named_struct('low', 0, 'high', size(__bounds)),"
        " (s, i) -> if(s.low >= s.high, s,"
        f" if(__bounds[(s.low + s.high) div 2] < {PLACE},"
        " named_struct('low', cast((s.low + s.high) div 2 as int) + 1, 'high', s.high),"
        " named_struct('low', s.low, 'high', cast((s.low + s.high) div 2 as int)))),"
        " s -> s.low)"
    )
    return (
        null_safe_join(placed, bounds, keys, "left")
        .withColumn(SLICE, F.when(F.col("__bounds").isNull(), 0).otherwise(below))
        .drop("__bounds")
    )


def _carry(
    sliced: DataFrame, keys: Sequence[str], amounts: dict[str, Column], descending_: bool = False
) -> DataFrame:
    """Per (keys, slice): the total of each amount over all earlier slices of the group."""
    totals = sliced.groupBy(*keys, SLICE).agg(*[a.alias(n) for n, a in amounts.items()])
    order = F.col(SLICE).desc() if descending_ else F.col(SLICE).asc()
    earlier = W.partitionBy(*keys).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return totals.select(
        *keys,
        SLICE,
        *[F.sum(n).over(earlier).alias(n) for n in amounts],
    )


def _sum_type(df: DataFrame, column: str):
    return df.select(F.sum(column)).schema[0].dataType


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, str],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Running totals ``{output: input column}`` from the group's first row to this one.

    ``order`` names ascending columns, NULL last; a hash of the row settles ties.
    """
    kinds = {out: _sum_type(df, c) for out, c in sums.items()}
    keyed, keys = _keyed(df, keys)
    sliced = _row_slices(keyed, keys, order, slice_rows)
    carry = _carry(sliced, keys, {f"{BEFORE}_{out}": F.sum(c) for out, c in sums.items()})
    frame = (
        W.partitionBy(*keys, SLICE)
        .orderBy(PLACE)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    local = sliced.withColumns({out: F.sum(c).over(frame) for out, c in sums.items()})
    joined = null_safe_join(local, carry, [*keys, SLICE], "left")
    # A total stays NULL only while every value so far is NULL.
    return joined.withColumns(
        {
            out: F.coalesce(
                F.col(out) + F.col(f"{BEFORE}_{out}"), F.col(out), F.col(f"{BEFORE}_{out}")
            ).cast(kind)
            for out, kind in kinds.items()
        }
    ).drop(SLICE, PLACE, ALL, *[f"{BEFORE}_{out}" for out in sums])


def row_index(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "row_index",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Row number from 1 within each group; a hash of the row settles ties of ``order``."""
    keyed, keys = _keyed(df, keys)
    sliced = _row_slices(keyed, keys, order, slice_rows)
    carry = _carry(sliced, keys, {BEFORE: F.count("*")})
    frame = W.partitionBy(*keys, SLICE).orderBy(PLACE)
    local = sliced.withColumn(out, F.row_number().over(frame).cast("bigint"))
    joined = null_safe_join(local, carry, [*keys, SLICE], "left")
    return joined.withColumn(
        out, F.col(out) + F.coalesce(F.col(BEFORE), F.lit(0))
    ).drop(SLICE, PLACE, BEFORE, ALL)


def sliding(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    preceding: int,
    measures: dict[str, Column],
    chunk_rows: int = CHUNK_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Aggregates over the current row and its ``preceding`` predecessors.

    Groups are cut into chunks of ``chunk_rows`` consecutive rows; the last ``preceding``
    rows of a chunk are repeated at the head of the next one and dropped again afterwards.
    """
    size = max(chunk_rows, preceding + 1)
    indexed = row_index(df, keys, order, "__row", slice_rows)
    position = F.col("__row") - 1
    chunk = F.floor(position / size)
    copies = F.when(
        position % size >= size - preceding, F.array(chunk, chunk + 1)
    ).otherwise(F.array(chunk))
    spread = indexed.withColumn("__chunk", F.explode(copies))
    frame = W.partitionBy(*keys, "__chunk").orderBy("__row").rowsBetween(-preceding, W.currentRow)
    return (
        spread.withColumns({out: m.over(frame) for out, m in measures.items()})
        .filter(F.floor((F.col("__row") - 1) / size) == F.col("__chunk"))
        .drop("__row", "__chunk")
    )


def rank_by(
    df: DataFrame, keys: Sequence[str], value: str, out: str, largest_first: bool = True
) -> DataFrame:
    """``RANK`` of ``value`` within each group, NULL counting as the largest value.

    Distinct values are ranked, weighted by how many rows hold each, so rows tied on one
    value never meet in a single task before the join back.
    """
    direction = descending if largest_first else ascending
    weights = df.groupBy(*keys, value).agg(F.count("*").alias("__weight"))
    sliced = _sliced(weights, keys, value)
    carry = _carry(sliced, keys, {BEFORE: F.sum("__weight")}, descending_=largest_first)
    ahead = (
        W.partitionBy(*keys, SLICE)
        .orderBy(direction(value))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    local = sliced.withColumn("__ahead", F.sum("__weight").over(ahead))
    ranks = null_safe_join(local, carry, [*keys, SLICE], "left").select(
        *keys,
        value,
        (
            F.coalesce(F.col("__ahead"), F.lit(0)) + F.coalesce(F.col(BEFORE), F.lit(0)) + 1
        ).cast("bigint").alias(out),
    )
    return null_safe_join(df, ranks, [*keys, value])


def tiles(df: DataFrame, count: int, order: Sequence[str], out: str) -> DataFrame:
    """``NTILE(count)`` over the whole frame; earlier tiles take the surplus rows."""
    total = df.agg(F.count("*").alias("__total")).withColumn(ALL, F.lit(0))
    indexed = row_index(df, [], order, out="__row").withColumn(ALL, F.lit(0)).join(total, ALL)
    base = F.floor(F.col("__total") / count)
    surplus = F.col("__total") % count
    in_surplus = surplus * (base + 1)
    position = F.col("__row") - 1
    tile = F.when(position < in_surplus, F.floor(position / (base + 1))).otherwise(
        surplus + F.floor((position - in_surplus) / F.nullif(base, F.lit(0)))
    )
    return indexed.withColumn(out, (tile + 1).cast("bigint")).drop("__row", "__total", ALL)


def rank_within(df: DataFrame, keys: Sequence[str], value: str, out: str, largest_first: bool = True) -> DataFrame:
    """As `rank_by`, by a plain window: for groups with a small stated bound."""
    direction = descending if largest_first else ascending
    frame = W.partitionBy(*keys).orderBy(direction(value))
    return df.withColumn(out, F.rank().over(frame).cast("bigint"))


def exact_percentiles(
    df: DataFrame, keys: Sequence[str], value: str, fractions: dict[str, float],
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Interpolated percentiles ``{output: fraction}`` of any number of distinct values, as doubles.

    Equal values are counted first.  Running counts over the sliced values tell which value
    stands at a place, and only the two places around each percentile are kept, so no task
    ever holds a group's values.  NULL values do not count; a group without any has no row.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__weight"))
    keyed, keys_ = (counted, list(keys)) if keys else (counted.withColumn("__one", F.lit(0)), ["__one"])
    totals = keyed.groupBy(*keys_).agg((F.sum("__weight") - 1).alias("__last"))
    upto = running_sums(keyed, keys_, [value], {"__upto": "__weight"}, slice_rows)
    rows = null_safe_join(upto, totals, keys_)

    def at(place: Column) -> Column:
        here = (place < F.col("__upto")) & (place >= F.col("__upto") - F.col("__weight"))
        return F.when(here, F.col(value).cast("double"))

    picked = {}
    for i, fraction in enumerate(fractions.values()):
        place = F.col("__last") * F.lit(fraction)
        picked[f"__low{i}"], picked[f"__high{i}"] = at(F.floor(place)), at(F.ceil(place))
    found = (
        rows.withColumns(picked)
        .filter(F.coalesce(*picked).isNotNull())
        .groupBy(*keys_)
        .agg(F.max("__last").alias("__last"), *[F.max(c).alias(c) for c in picked])
    )
    return found.select(
        *keys,
        *[
            (
                F.col(f"__low{i}")
                + (F.col(f"__high{i}") - F.col(f"__low{i}"))
                * (F.col("__last") * F.lit(fraction) - F.floor(F.col("__last") * F.lit(fraction)))
            ).alias(out)
            for i, (out, fraction) in enumerate(fractions.items())
        ],
    )


def group_value(df: DataFrame, keys: Sequence[str], measures: dict[str, Column]) -> DataFrame:
    """Attach a whole-group aggregate to every row of the group."""
    keyed, keys = _keyed(df, keys)
    totals = keyed.groupBy(*keys).agg(*[m.alias(out) for out, m in measures.items()])
    return null_safe_join(keyed, totals, keys).drop(ALL)


def newest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under ``order``.

    Spark keeps only one candidate per key and map task before the shuffle
    (window group limit), so a key with any number of copies stays cheap.
    """
    frame = W.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rn", F.row_number().over(frame)).filter(F.col("__rn") == 1).drop("__rn")
    )


def top_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], count: int
) -> DataFrame:
    """First ``count`` rows of each group under a tie-free ``order``; limited before the shuffle."""
    frame = W.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("__rn", F.row_number().over(frame))
        .filter(F.col("__rn") <= count)
        .drop("__rn")
    )
