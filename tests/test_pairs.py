"""Head-to-head counts against brute force, with two groups that hold a third of the rows."""

import itertools
import random
from collections import Counter

import pytest

from lapwise.operators import pairs
from lapwise.operators.pairs import head_to_head

SCHEMA = "race int, team string, member int, name string, position int"


def brute(rows, floor):
    shared, a_ahead, b_ahead = Counter(), Counter(), Counter()
    groups = {}
    for race, team, member, name, position in rows:
        groups.setdefault((race, team), []).append((member, name, position))
    for (_, team), entries in groups.items():
        for x, y in itertools.product(entries, entries):
            if x[0] < y[0]:
                pair = (team, x[1], y[1])
                shared[pair] += 1
                a_ahead[pair] += x[2] < y[2]
                b_ahead[pair] += y[2] < x[2]
    return {p: (n, a_ahead[p], b_ahead[p]) for p, n in shared.items() if n >= floor}


def archive(seed):
    rng = random.Random(seed)
    # Members 30 and 31 share a name; member 32 has none.
    names = {m: f"n{m}" for m in range(60)} | {31: "n30", 32: None}
    rows = []
    for race in range(40):
        team = rng.choice(["red", "blue"])
        rows += [(race, team, m, names[m], rng.randrange(1, 9))
                 for m in rng.sample(range(60), rng.randrange(1, 6))]
    # A third of everything in two oversize groups, some members many times over.
    for race in (100, 101):
        rows += [(race, "red", m, names[m], rng.randrange(1, 9)) for m in range(0, 40)]
        rows += [(race, "red", 5, "n5", rng.randrange(1, 9)) for _ in range(6)]
    return rows


@pytest.mark.parametrize("block_rows", [2000, 7])
@pytest.mark.parametrize("floor", [1, 2, 3, 6])
def test_pairs(spark, floor, block_rows):
    rows = archive(floor)
    got = head_to_head(
        spark.createDataFrame(rows, SCHEMA), ["race"], floor, block_rows
    ).collect()
    found = {(r["team"], r["name_a"], r["name_b"]): (r["shared"], r["a_ahead"], r["b_ahead"])
             for r in got}
    assert len(got) == len(found)
    assert found == brute(rows, floor)


def test_a_group_of_20_000_members_is_spread(spark):
    """Every member enters once; the entries of a pair of blocks are all that shares a key."""
    members = spark.range(20_000).selectExpr(
        "1 as race", "'red' as team", "cast(id as int) as member", "concat('n', id) as name", "cast(id % 20 as int) as position"
    )
    dealt = pairs._blocked(pairs._entries(members, ["race"]), ["race"], 1000)
    per_block = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert len(per_block) == 20 and max(per_block) < 1300
    # Only the two members that meet twice can reach the floor; nobody else is paired.
    again = members.limit(0).unionByName(members.filter("member in (3, 17777)")).selectExpr("2 as race", "team", "member", "name", "position")
    got = head_to_head(members.unionByName(again), ["race"], 2, 1000).collect()
    assert [tuple(r) for r in got] == [("red", "n3", "n17777", 2, 2, 0)]
