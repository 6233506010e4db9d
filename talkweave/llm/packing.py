"""Problem 6: filling containers of fixed capacity with items, leaving little space and splitting only what must be.

Which items go together depends on their sizes only. So the sizes are counted in parallel, the plan is made from the
counts, whose number is bounded by the capacity whatever the number of items, and items are then dealt to the plan by
their rank among items of their size.

The plan takes the largest size left and looks for what fills the gap exactly: a single size equal to the gap, then a
pair, then a triple that adds up to it. Sums are indexed: a table addressed by the sum tells which sums single sizes,
pairs and triples can have, and availability is updated in place. If nothing fits exactly, the largest size that fits is
added and the search goes on in the smaller gap: best fit for the residuals. The combination is then used as often as
the counts allow.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave.runtime import cut

#: Units that a capacity is divided into at most. Beyond so many tokens sizes are rounded up to whole units for the plan,
#: which leaves less than a unit unused per item; the driver never holds more counts than this.
MOST_UNITS = 1 << 20
#: Sizes looked at together in the search for a pair.
PROBES = 1024


class Sums:
    """Counts of sizes up to ``top`` with an index of the sums of one, two and three of them.

    The index is exact when it is built and only ever errs by holding sums that are no longer to be had, since sizes
    only run out: a sum that turns out to be gone is struck off, and the index is built anew when a quarter of the
    sizes have run out.
    """

    def __init__(self, free: np.ndarray):
        self.free = free
        self._index()

    def _index(self) -> None:
        self.sizes = np.flatnonzero(self.free)
        n = len(self.free)
        single = np.zeros(n)
        single[self.sizes] = 1.0
        length = 1 << (2 * n - 1).bit_length()
        spectrum = np.fft.rfft(single, length)
        self.pairs = np.fft.irfft(spectrum * spectrum, length)[:n] > 0.5
        self.triples = np.fft.irfft(np.fft.rfft(self.pairs.astype(float), length) * spectrum, length)[:n] > 0.5
        self.gone = 0

    def take(self, size: int, n: int = 1) -> None:
        self.free[size] -= n
        if not self.free[size]:
            self.gone += 1
            if 4 * self.gone > len(self.sizes):
                self._index()

    def largest(self, most: int) -> int:
        """The largest size left up to ``most``; 0 if there is none."""
        at = int(np.searchsorted(self.sizes, most, "right"))
        while at:
            low = max(0, at - PROBES)
            left = np.flatnonzero(self.free[self.sizes[low:at]])
            if len(left):
                return int(self.sizes[low + left[-1]])
            at = low
        return 0

    def pair(self, total: int, top: int, aside: bool = False) -> tuple[int, int] | None:
        """Two sizes up to ``top`` that add up to ``total``, the larger as large as can be.

        A sum without a pair is struck off, unless some of the sizes are only set ``aside``.
        """
        if total < 2 or not self.pairs[total]:
            return None
        low, high = int(np.searchsorted(self.sizes, (total + 1) // 2)), int(np.searchsorted(self.sizes, min(top, total - 1), "right"))
        for end in range(high, low, -PROBES):
            large = self.sizes[max(low, end - PROBES) : end]
            ok = (self.free[large] > 0) & (self.free[total - large] > 0)
            ok[(2 * large == total) & (self.free[large] < 2)] = False
            found = np.flatnonzero(ok)
            if len(found):
                a = int(large[found[-1]])
                return a, total - a
        if top >= total - 1 and not aside:
            self.pairs[total] = False
        return None

    def triple(self, total: int) -> tuple[int, int, int] | None:
        """Three sizes that add up to ``total``, the largest as large as can be."""
        if total < 3 or not self.triples[total]:
            return None
        low, high = int(np.searchsorted(self.sizes, -(-total // 3))), int(np.searchsorted(self.sizes, total - 2, "right"))
        lost = False
        for end in range(high, low, -PROBES):
            large = self.sizes[max(low, end - PROBES) : end]
            for a in large[(self.free[large] > 0) & self.pairs[total - large]][::-1]:
                a = int(a)
                if not self.pairs[total - a]:
                    continue
                self.free[a] -= 1
                rest = self.pair(total - a, a, aside=True)
                self.free[a] += 1
                if rest:
                    return (a, *rest)
                self.pair(total - a, total - a - 1)
                lost = lost or self.pairs[total - a]
        if not lost:
            self.triples[total] = False
        return None

    def fill(self, gap: int) -> tuple[int, ...] | None:
        """One, two or three sizes that add up to ``gap`` exactly, largest first."""
        if gap < len(self.free) and self.free[gap]:
            return (gap,)
        if gap >= len(self.free):
            return None
        return self.pair(gap, gap - 1) or self.triple(gap)


@dataclass
class Plan:
    """``size, first, count`` ranks of items of a size, dealt ``per`` to a container from ``container`` on, at ``offset``."""

    size: np.ndarray
    first: np.ndarray
    per: np.ndarray
    container: np.ndarray
    offset: np.ndarray
    n_containers: int


def plan(counts: dict[int, int], capacity: int) -> Plan:
    """The plan for ``counts`` items of each size from 1 to ``capacity``.

    Every combination leaves some size with less than its share, at most half of what there was, so there are at most
    64 combinations per size.
    """
    free = np.zeros(capacity + 1, dtype=np.int64)
    for size, n in counts.items():
        free[size] = n
    dealt = np.zeros(capacity + 1, dtype=np.int64)
    rows, containers = [], 0
    sums, largest = Sums(free), capacity
    while largest := sums.largest(largest):
        chosen, gap = [largest], capacity - largest
        free[largest] -= 1
        while gap:
            fill = sums.fill(gap)
            if fill is None:
                best = sums.largest(gap)
                if not best:
                    break
                fill = (best,)
            for s in fill:
                free[s] -= 1
                gap -= s
            chosen += fill
        sizes, per = np.unique(chosen, return_counts=True)
        free[sizes] += per
        times = int((free[sizes] // per).min())
        offset = 0
        for s, m in zip(sizes[::-1].tolist(), per[::-1].tolist()):
            sums.take(s, m * times)
            rows.append((s, dealt[s], m, containers, offset))
            dealt[s] += m * times
            offset += s * m
        containers += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return Plan(*table.T, containers)


def _ranked(items: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Add the rank, from 0, among items of one size. A size that a third of all items have is ranked in parts."""
    parts = max(64, rows // 1_000_000)
    d = items.withColumn("_part", F.pmod(F.xxhash64(*keys), F.lit(parts)))
    sums = d.groupBy("size", "_part").agg(F.count("*").alias("n"))
    before = sums.select("size", "_part", F.coalesce(F.sum("n").over(Window.partitionBy("size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("size", "_part").orderBy(*keys))
    return d.withColumn("_i", inside).join(before, ["size", "_part"]).withColumn("rank", F.col("before") + F.col("_i") - 1).drop("_part", "_i", "before")


def pack(items: DataFrame, item: str, size: str, capacity: int) -> DataFrame:
    """Assign items to containers: item, part, start, n_tokens, container, offset.

    An item above the capacity is split into parts of the capacity, which fill a container each, and a rest that is
    packed like any other; no other item is split. ``start`` is the part's first token in its item, ``offset`` its place
    in the container. Containers are numbered from 0; parts that fill a container alone come last. An item of size null,
    0 or less takes no space and goes to container 0. Beyond MOST_UNITS tokens of capacity, offsets are whole units. Items may be repeated rows: each is an item of its own. Null items
    are packed like others. No items, no rows.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    spark = items.sparkSession
    d = items.select(F.col(item).alias("id"), F.greatest(F.coalesce(F.col(size).cast("bigint"), F.lit(0)), F.lit(0)).alias("whole"))
    d = d.withColumn("parts", F.floor(F.col("whole") / capacity)).withColumn("size", F.col("whole") % capacity)
    rest = d.select("id", "size", F.col("parts").cast("int").alias("part"), (F.col("parts") * capacity).alias("start"))
    # The rest of an item that is a multiple of the capacity is nothing at all, unless the item itself is nothing.
    unit = -(-capacity // MOST_UNITS)
    whole = capacity // unit
    rest = rest.withColumn("tokens", F.col("size")).withColumn("size", F.least(F.ceil(F.col("size") / unit), F.lit(whole)))
    counts = {r["size"]: r["n"] for r in rest.where("size > 0").groupBy("size").agg(F.count("*").alias("n")).collect()}
    made = plan(counts, whole)
    shared = spark.sparkContext.broadcast(made)

    kind = rest.schema["id"].dataType.simpleString()
    schema = f"id {kind}, part int, start bigint, n_tokens bigint, container bigint, offset bigint"

    def deal(batches):
        p = shared.value
        for b in batches:
            s, r = b["size"].to_numpy(), b["rank"].to_numpy()
            # the last piece of the plan for this size that begins at or before the rank
            lo, hi = np.searchsorted(p.size, s, "left"), np.searchsorted(p.size, s, "right") - 1
            while (lo < hi).any():
                mid = (lo + hi + 1) // 2
                at = p.first[mid] <= r
                lo, hi = np.where(at, mid, lo), np.where(at, hi, mid - 1)
            k = r - p.first[lo]
            yield pd.DataFrame({"id": b["id"], "part": b["part"], "start": b["start"], "n_tokens": b["tokens"], "container": p.container[lo] + k // p.per[lo], "offset": (p.offset[lo] + k % p.per[lo] * s) * unit})

    packed = _ranked(rest.where("size > 0"), ["id", "start"], sum(counts.values())).select("id", "part", "start", "size", "tokens", "rank").mapInPandas(deal, schema)
    nothing = rest.where("size = 0 and start = 0").select("id", "part", "start", F.col("size").alias("n_tokens"), F.lit(0).cast("bigint").alias("container"), F.lit(0).cast("bigint").alias("offset"))
    # Full parts: the window without a key runs over the distinct numbers of parts, not over items. Numbered behind the planned containers by the rank of their item among items of its number of parts.
    full = d.where("parts > 0").select("id", F.col("parts").alias("size"))
    per = full.groupBy("size").agg(F.count("*").alias("n"))
    base = per.select("size", F.coalesce(F.sum(F.col("size") * F.col("n")).over(Window.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    numbered = _ranked(full, ["id"], sum(counts.values())).join(base, "size").select("id", F.explode(F.sequence(F.lit(0), F.col("size") - 1)).alias("part"), (F.lit(made.n_containers) + F.col("base") + F.col("rank") * F.col("size")).alias("from"))
    alone = numbered.select("id", F.col("part").cast("int").alias("part"), (F.col("part") * capacity).cast("bigint").alias("start"), F.lit(capacity).cast("bigint").alias("n_tokens"), (F.col("from") + F.col("part")).alias("container"), F.lit(0).cast("bigint").alias("offset"))
    return packed.unionByName(nothing).unionByName(alone).withColumnRenamed("id", item)


def pack_all(items: DataFrame, item: str, size: str, capacities: dict) -> DataFrame:
    """``pack`` for several capacities: {pack_id: capacity}; adds pack_id."""
    items = cut(items.select(item, size))
    out = None
    for pack_id, capacity in sorted(capacities.items()):
        one = pack(items, item, size, capacity).withColumn("pack_id", F.lit(pack_id).cast("int"))
        out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("no capacities")
    return out


def usage(packed: DataFrame, capacities: dict) -> DataFrame:
    """Per pack_id: containers, tokens, unused tokens and the share of space filled. Container 0 of nothing counts."""
    per = packed.groupBy("pack_id", "container").agg(F.sum("n_tokens").alias("used"))
    capacity = F.create_map(*[F.lit(x) for k, v in sorted(capacities.items()) for x in (k, v)])[F.col("pack_id")]
    total = per.groupBy("pack_id").agg(F.count("*").alias("n_containers"), F.sum("used").alias("n_tokens"), F.max("used").alias("fullest"))
    return total.select("pack_id", capacity.alias("capacity"), "n_containers", "n_tokens", "fullest", (F.col("n_containers") * capacity - F.col("n_tokens")).alias("unused"), (F.col("n_tokens") / (F.col("n_containers") * capacity)).alias("filled"))
