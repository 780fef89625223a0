"""Head-to-head counts over members of the same group, each unordered pair once.

A pair is reported if it meets ``min_shared`` times.  A member's meetings with any one
other member are bounded by its entries in each group times the most that another name has
there, so members whose bound stays below the floor are left out before anybody is paired.
The entries of a large group are dealt to blocks, and every two blocks meet under a key of
their own, so no task has more than two blocks whatever the group's size; meetings are
summed up before pairs are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapwise.functions import flag
from lapwise.operators.ordered import null_safe_join

# Entries of a block; two blocks meet in one task.
BLOCK_ROWS = 2000


def _entries(rows: DataFrame, group: list[str]) -> DataFrame:
    """One row per group, member and position with its multiplicity."""
    return rows.groupBy(*group, "team", "member", "name", "position").agg(
        F.count("*").alias("n")
    )


def _blocked(entries: DataFrame, group: list[str], block_rows: int) -> DataFrame:
    """The entries with their block, by the member's hash, and how many blocks their group has.

    Groups of at most ``block_rows`` entries, the usual ones, have one block.
    """
    large = (
        entries.groupBy(*group).agg(F.count("*").alias("__n"))
        .filter(F.col("__n") > block_rows)
        .select(*group, F.ceil(F.col("__n") / block_rows).cast("int").alias("blocks"))
    )
    dealt = entries.join(large, group, "left").fillna(1, ["blocks"])
    return dealt.withColumn("block", F.pmod(F.xxhash64("member"), F.col("blocks")).cast("int"))


def _meet(entries: DataFrame, group: list[str]) -> DataFrame:
    """Meetings and who was ahead, per team and pair of names; the smaller member comes first."""
    later = F.explode(F.sequence("block", F.col("blocks") - 1))
    a = entries.withColumn("other", later).alias("a")
    b = entries.withColumn("other", F.explode(F.sequence(F.lit(0), "block"))).alias("b")
    on = (F.col("a.block") == F.col("b.other")) & (F.col("a.other") == F.col("b.block"))
    for c in group:
        on = on & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    # Within a block each pair is met in its order; two blocks have no member in common.
    on = on & ((F.col("a.member") < F.col("b.member")) | (F.col("a.block") < F.col("b.block")))
    first = F.col("a.member") < F.col("b.member")
    met = F.col("a.n") * F.col("b.n")
    a_wins = flag(F.col("a.position") < F.col("b.position"))
    b_wins = flag(F.col("b.position") < F.col("a.position"))

    def ordered(mine: Column, theirs: Column) -> Column:
        return F.when(first, mine).otherwise(theirs)

    return (
        a.join(b, on)
        .groupBy(
            F.col("a.team").alias("team"),
            ordered(F.col("a.name"), F.col("b.name")).alias("name_a"),
            ordered(F.col("b.name"), F.col("a.name")).alias("name_b"),
        )
        .agg(
            F.sum(met).alias("shared"),
            F.sum(met * ordered(a_wins, b_wins)).alias("a_ahead"),
            F.sum(met * ordered(b_wins, a_wins)).alias("b_ahead"),
        )
    )


def _able(entries: DataFrame, group: list[str], min_shared: int) -> DataFrame:
    """Names that could meet some other name ``min_shared`` times over all groups."""
    per_name = entries.groupBy(*group, "team", "name").agg(F.sum("n").alias("n"))
    most = per_name.groupBy(*group).agg(F.max("n").alias("most"))
    return (
        per_name.join(most, group)
        .groupBy("team", "name")
        .agg(F.sum(F.col("n") * F.col("most")).alias("reach"))
        .filter(F.col("reach") >= min_shared)
        .select("team", "name")
    )


def head_to_head(
    rows: DataFrame, group: list[str], min_shared: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Pairs with at least ``min_shared`` meetings.

    ``rows`` holds the ``group`` columns plus ``team`` (fixed within a group, reported
    with the pair), ``member`` (orders the pair), ``name`` (identifies it) and ``position``
    (smaller is ahead).  Repeated entries of a member in a group count once per combination.
    """
    entries = _entries(rows, group)
    strong = null_safe_join(entries, _able(entries, group, min_shared), ["team", "name"], "left_semi")
    return _meet(_blocked(strong, group, block_rows), group).filter(F.col("shared") >= min_shared)
