import random

import pytest

from talkweave.llm.runs import bare, collapse_runs, double_pointers

SCHEMA = "m string, pos bigint, name string, s bigint, e bigint, root string"


def near(a, b):
    if a == b:
        return True
    if min(len(a), len(b)) < 5 or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    out = []
    keyed = {}
    for m, pos, name, s, e, _ in set(rows):
        if None not in (m, pos, s):
            keyed.setdefault(m, []).append((s, pos, s + 1000 if e is None else e, bare(name)))
    for m, events in keyed.items():
        runs, before = [], None
        for s, pos, e, n in sorted(events):
            if n and before and near(n, before) and s <= runs[-1]["end"] + 5000:
                runs[-1]["end"] = max(runs[-1]["end"], e)
                runs[-1]["pos"].append(pos)
            elif n:
                runs.append({"end": e, "pos": [pos], "start": s})
            before = n
        out += [(m, r["pos"][0], r["pos"][-1], len(r["pos"]), r["end"] - r["start"]) for r in runs]
    return sorted(out)


def run(spark, rows, **sizes):
    df = spark.createDataFrame(rows, SCHEMA)
    return sorted(map(tuple, collapse_runs(df, "m", "pos", "name", "s", "e", **sizes).collect()))


@pytest.mark.parametrize("seed", range(3))
def test_same_as_one_pass_whatever_the_blocks(spark, seed):
    rng = random.Random(seed)
    names = ["Zoë Abcde", "zoe abcd", "zoe-abcdef", "Ann", "Anne", "...", None, "Other Person"]
    rows, s = [], 0
    for pos in range(400):
        s += rng.choice([0, 10, 400, 3000, 7000])
        name = rows[-1][2] if rows and rng.random() < 0.7 else rng.choice(names)
        rows.append((rng.choice("aaab"), pos, name, s if rng.random() > 0.03 else None, rng.choice([None, s + 500, s + 9000, s]), "x"))
    rows += rows[:40]
    rng.shuffle(rows)
    assert run(spark, rows, block_ms=4000, fan=3) == brute(rows)


def test_one_run_over_many_blocks(spark):
    rows = [("m", i, "Some Body", i * 100, i * 100 + 50, "x") for i in range(300)]
    assert run(spark, rows, block_ms=200, fan=4) == [("m", 0, 299, 300, 29_950)] == brute(rows)


def test_a_long_event_keeps_its_run_open(spark):
    rows = [("m", 0, "Some Body", 0, 50_000, "x"), ("m", 1, "Some Body", 1000, 1100, "x"), ("m", 2, "Some Body", 54_000, 54_100, "x"), ("m", 3, "Some Body", 59_101, None, "x")]
    assert run(spark, rows, block_ms=1000, fan=4) == [("m", 0, 2, 3, 54_100), ("m", 3, 3, 1, 1000)] == brute(rows)


def test_empty_and_no_start(spark):
    assert run(spark, []) == [] and run(spark, [("m", 1, "A", None, 5, "x"), (None, 1, "A", 1, 5, "x")]) == []


def test_pointer_doubling_with_prefix(spark):
    rows = [(i, max(0, i - 1), 100 - i) for i in range(40)] + [(100, 100, 1)]
    got = {r["id"]: (r["root"], r["prefix"]) for r in double_pointers(spark.createDataFrame(rows, "id bigint, parent bigint, v bigint"), "v").collect()}
    assert got == {i: (0, 100 if i else None) for i in range(40)} | {100: (100, None)}


def test_bare():
    assert bare("Ｚoë  O’Brien-2 (½)") == "zoeobrien212" and bare(None) == "" and bare(" -…") == ""
