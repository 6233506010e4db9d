import random
import time
from collections import Counter

import numpy as np
import pytest

from talkweave.llm.packing import MOST_UNITS, Sums, pack, pack_all, plan, usage
from talkweave.llm.tokens import encoding, token_counts


def check(rows, items, capacity):
    """Conservation, no overlap, no overflow, no split that is not needed."""
    by_item, by_container = {}, {}
    for r in rows:
        by_item.setdefault(r.id, []).append((r.start, r.n_tokens, r.part))
        by_container.setdefault(r.container, []).append((r.offset, r.n_tokens))
    assert set(by_item) == {i for i, _ in items}
    for i, size in items:
        size = max(size or 0, 0)
        parts = sorted(by_item[i])
        at = 0
        for start, n, _ in parts:
            assert start == at
            at += n
        assert at == size and [p for *_, p in parts] == list(range(len(parts)))
        assert len(parts) == max(1, -(-size // capacity))
    for spans in by_container.values():
        at = 0
        for offset, n in sorted(s for s in spans if s[1]):
            assert offset == at
            at += n
        assert at <= capacity
    assert sorted(by_container) == list(range(len(by_container)))
    return len(by_container)


@pytest.mark.parametrize("seed,capacity", [(0, 50), (1, 200), (2, 7), (3, 1)])
def test_every_token_is_placed_once(spark, seed, capacity):
    rng = random.Random(seed)
    items = [(i, rng.choice([0, None, 1, capacity, capacity * 2, capacity * 3 + 1, rng.randrange(1, capacity + 1), rng.randrange(1, capacity // 3 + 2)])) for i in range(400)]
    df = spark.createDataFrame([(i, s, "x", 1) for i, s in items], "id bigint, size_in bigint, container string, part int")
    rows = pack(df, "id", "size_in", capacity).collect()
    used = check(rows, items, capacity)
    need = -(-sum(s or 0 for _, s in items) // capacity)
    assert used <= need * 1.05 + 1


def test_a_size_that_all_share_and_repeated_rows(spark):
    df = spark.createDataFrame([(i % 50, 30) for i in range(1000)], "id bigint, n bigint")
    per = Counter(r.container for r in pack(df, "id", "n", 100).collect())
    assert sum(per.values()) == 1000 and max(per.values()) == 3 and len(per) == 334


def test_no_items_and_wrong_capacity(spark):
    df = spark.createDataFrame([], "id bigint, n bigint")
    assert pack(df, "id", "n", 10).count() == 0
    with pytest.raises(ValueError):
        pack(df, "id", "n", 0)


def brute_fill(gap, free):
    sizes = [s for s in range(1, len(free)) if free[s]]
    for k in (1, 2, 3):
        for a in sizes:
            if k == 1 and a == gap:
                return True
            for b in sizes if k > 1 else ():
                if k == 2 and a + b == gap and Counter([a, b])[a] <= free[a]:
                    return True
                for c in sizes if k > 2 else ():
                    if a + b + c == gap and all(n <= free[s] for s, n in Counter([a, b, c]).items()):
                        return True
    return False


def test_exact_fill_finds_one_whenever_there_is_one():
    rng = random.Random(3)
    for _ in range(400):
        free = np.array([0] + [rng.choice([0, 0, 0, 1, 2]) for _ in range(14)])
        gap = rng.randrange(1, 30)
        got = Sums(np.append(free, np.zeros(30, np.int64))).fill(gap)
        assert (got is not None) == brute_fill(gap, free)
        if got:
            assert sum(got) == gap and all(n <= free[s] for s, n in Counter(got).items())


def test_plan_of_natural_sizes_wastes_next_to_nothing():
    rng = np.random.default_rng(1)
    sizes = np.clip(rng.lognormal(5.5, 0.9, 20000).astype(int), 1, 2048)
    counts = dict(zip(*[x.tolist() for x in np.unique(sizes, return_counts=True)]))
    p = plan(counts, 2048)
    assert sizes.sum() / (p.n_containers * 2048) > 0.995


def test_index_of_sums_stays_true_while_sizes_run_out():
    rng = random.Random(4)
    for _ in range(60):
        free = np.array([0] + [rng.choice([0, 0, 1, 1, 2, 3]) for _ in range(24)] + [0] * 20)
        sums = Sums(free)
        while free.any():
            gap = rng.randrange(1, 44)
            got = sums.fill(gap)
            assert (got is not None) == brute_fill(gap, free)
            for s in got or [rng.choice(np.flatnonzero(free).tolist())]:
                sums.take(int(s))


def test_plan_for_long_containers_is_fast():
    rng = np.random.default_rng(2)
    sizes = np.clip(rng.lognormal(9, 1.2, 25000).astype(int), 1, 131072)
    counts = dict(zip(*[x.tolist() for x in np.unique(sizes, return_counts=True)]))
    began = time.perf_counter()
    p = plan(counts, 131072)
    assert len(counts) > 14000 and time.perf_counter() - began < 20 and sizes.sum() / (p.n_containers * 131072) > 0.995


def test_capacity_beyond_the_units_of_the_plan(spark):
    rng = random.Random(6)
    capacity = 3 * MOST_UNITS + 2
    items = [(i, rng.choice([0, capacity, capacity - 1, 2 * capacity + 5, rng.randrange(1, capacity)])) for i in range(60)]
    rows = pack(spark.createDataFrame(items, "id bigint, n bigint"), "id", "n", capacity).collect()
    assert sum(r.n_tokens for r in rows) == sum(n for _, n in items)
    spans = {}
    for r in rows:
        spans.setdefault(r.container, []).append((r.offset, r.n_tokens))
    for parts in spans.values():
        at = 0
        for offset, n in sorted(p for p in parts if p[1]):
            assert offset >= at
            at = offset + n
        assert at <= capacity


def test_usage(spark):
    df = spark.createDataFrame([(1, 6), (2, 4), (3, 9)], "id bigint, n bigint")
    got = {r.pack_id: (r.n_containers, r.unused) for r in usage(pack_all(df, "id", "n", {1: 10, 2: 4}), {1: 10, 2: 4}).collect()}
    assert got == {1: (2, 1), 2: (5, 1)}


def test_tokens_of_whole_texts(spark):
    e = encoding()
    texts = ["Hello there, world.", "", None, "<|endoftext|>", "ab " * 200_000, "żółć 漢字"]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "i int, text string, n string")
    got = {r.i: r.n_tokens for r in token_counts(df, "text").collect()}
    assert got == {i: len(e.encode_ordinary(t)) if t else 0 for i, t in enumerate(texts)}
    assert e.decode(e.encode_ordinary(texts[5])) == texts[5]
