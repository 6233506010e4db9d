import random

import pytest

from talkweave.llm.nearest import match_nearest


def brute(left, right, tol):
    out = set()
    for k, pos, t in left:
        near = [(abs(u - t), u, r) for k2, r, u in right if None not in (k, t, u, r) and k2 == k and abs(u - t) <= tol]
        if near:
            d, _, r = min(near)
            out.add((k, pos, r, d))
    return sorted(out)


def run(spark, left, right, tol, block_ms=100):
    a = spark.createDataFrame([(*x, "clash") for x in left], "k string, pos bigint, t bigint, left_id string")
    b = spark.createDataFrame([(*x, 1) for x in right], "k string, pos bigint, t bigint, _b int")
    return sorted(map(tuple, match_nearest(a, b, "k", "t", "pos", "t", "pos", tol, block_ms).collect()))


@pytest.mark.parametrize("seed,tol", [(0, 7), (1, 0), (2, 60), (3, 250)])
def test_same_as_brute_force(spark, seed, tol):
    rng = random.Random(seed)
    rows = lambda n: [(rng.choice(["a", "b", "b", None]), p, rng.choice([rng.randrange(-300, 1500), None] if rng.random() < 0.1 else [rng.randrange(-300, 1500)])) for p in range(n)]
    left, right = rows(150), rows(120)
    right += right[:20]
    left += left[:20]
    assert run(spark, left, right, tol) == brute(left, right, tol)


def test_ties_take_the_earlier_then_the_smaller_id(spark):
    assert run(spark, [("a", 1, 10)], [("a", 9, 8), ("a", 4, 12), ("a", 7, 8)], 5) == [("a", 1, 7, 2)]


def test_empty_sides(spark):
    assert run(spark, [], [("a", 1, 1)], 5) == [] and run(spark, [("a", 1, 1)], [], 5) == []


def test_no_cartesian_and_no_broadcast_nested_loop(spark):
    a = spark.createDataFrame([("a", 1, 1)], "k string, pos bigint, t bigint")
    plan = match_nearest(a, a, "k", "t", "pos", "t", "pos", 5)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
