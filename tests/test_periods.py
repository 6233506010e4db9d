import random

import pytest

from talkweave.operators.periods import periods_and_gaps, speaker_label

SCHEMA = "m string, who string, s bigint, e bigint, pos bigint, kind string, start_ms int"


def brute(rows):
    out = []
    keyed = {}
    for m, who, s, e, pos, *_ in set(rows):
        if None not in (m, who, s, e) and e >= s:
            keyed.setdefault((m, who), []).append((s, e))
    for key, spans in keyed.items():
        periods = []
        for s, e in sorted(spans):
            if periods and s <= periods[-1][1]:
                periods[-1][1] = max(periods[-1][1], e)
                periods[-1][2] += 1
            else:
                periods.append([s, e, 1])
        out += [(*key, "period", *p) for p in periods]
        out += [(*key, "gap", a[1], b[0], None) for a, b in zip(periods, periods[1:])]
    return sorted(out, key=repr)


def run(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, periods_and_gaps(df, ["m", "who"], "s", "e", "pos", **sizes).collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_same_as_one_pass_whatever_the_blocks(spark, seed):
    rng = random.Random(seed)
    rows = []
    for pos in range(600):
        s = rng.randrange(5000)
        e = s + rng.choice([0, 1, 5, 20, 20, rng.randrange(900) if rng.random() < 0.05 else 3])
        rows.append((rng.choice("ab"), rng.choice(["x", "y", None]), rng.choice([s] * 9 + [None]), rng.choice([e] * 9 + [None, s - 1]), pos, "k", 1))
    rows += rows[:50]
    assert run(spark, rows, block_ms=40, fan=3) == brute(rows)


def test_touching_nested_zero_length_and_negative(spark):
    rows = [("m", "x", s, e, i, None, None) for i, (s, e) in enumerate([(0, 10), (2, 5), (10, 12), (13, 13), (13, 13), (20, 19), (-5, -2)])]
    assert run(spark, rows) == brute(rows)


def test_an_interval_over_many_blocks_swallows_the_others(spark):
    rows = [("m", "x", 0, 10_000, 0, None, None)] + [("m", "x", i * 100, i * 100 + 5, i, None, None) for i in range(1, 101)] + [("m", "x", 10_050, 10_060, 500, None, None)]
    got = run(spark, rows, block_ms=100, fan=4)
    assert got == brute(rows) and ("m", "x", "gap", 10_005, 10_050, None) in got


def test_empty(spark):
    assert run(spark, []) == []


def test_labels(spark):
    df = spark.createDataFrame([("  SPEAKER_03 ",), ("speaker_1",), (" ",), (None,)], "a string")
    assert [r[0] for r in df.select(speaker_label("a")).collect()] == ["Speaker_03", "Speaker_1", None, None]
