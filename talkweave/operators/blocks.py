"""Prefix scans over time blocks: running aggregates of a key that never put the whole key into one task.

A key (a meeting, a speaker of a meeting) may hold a third of all rows, so a window over the key alone would sort that
third in one task. Rows are first reduced to one row per (key, block) and blocks are grouped into super-blocks. The
scan runs inside each super-block, over the super-blocks' totals, and both are added up: the classic two-level scan.
One task sees at most ``fan`` blocks of a key, and one row per super-block in the upper level, whatever the row count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Width of a time block and number of blocks in a super-block: 10 minutes and about 11 hours.
BLOCK_MS = 600_000
FAN = 64

_AGGREGATES = {"max": (F.max, F.greatest), "min": (F.min, F.least), "sum": (F.sum, lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))}


def exclusive_scan(blocks: DataFrame, keys: list[str], values: dict[str, str], how: str = "max", block: str = "block", fan: int = FAN, later: bool = False) -> DataFrame:
    """Add to each (keys, block) row the aggregate of ``values`` over all earlier (or ``later``) blocks of its key.

    ``values`` maps new column -> existing column, ``how`` is 'max', 'min' or 'sum'. Values may be structs for max and
    min, which compare field by field: the *last* value is the maximum of struct(order, value). Nulls are skipped; where
    there is no other block, max and min are null and sum is 0. Keys must not be null. ``blocks`` must hold one row per
    (keys, block).
    """
    aggregate, both = _AGGREGATES[how]
    up = "_super"
    order = (lambda c: F.col(c).desc()) if later else F.col
    d = blocks.withColumn(up, F.floor(F.col(block) / fan))
    inner = Window.partitionBy(*keys, up).orderBy(order(block)).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.partitionBy(*keys).orderBy(order(up)).rowsBetween(Window.unboundedPreceding, -1)
    scanned = d.select("*", *[aggregate(v).over(inner).alias(f"_in_{n}") for n, v in values.items()])
    totals = d.groupBy(*keys, up).agg(*[aggregate(v).alias(f"_t_{n}") for n, v in values.items()])
    totals = totals.select(*keys, up, *[aggregate(f"_t_{n}").over(outer).alias(f"_out_{n}") for n in values])
    return scanned.join(totals, [*keys, up]).select(*blocks.columns, *[both(F.col(f"_in_{n}"), F.col(f"_out_{n}")).alias(n) for n in values])


def exclusive_max(blocks: DataFrame, keys: list[str], values: dict[str, str], block: str = "block", fan: int = FAN) -> DataFrame:
    """``exclusive_scan`` for the maximum over earlier blocks."""
    return exclusive_scan(blocks, keys, values, "max", block, fan)


def with_neighbour(rows: DataFrame, keys: list[str], time: str, order: list[str], columns: list[str], name: str, later: bool = False, block_ms: int = BLOCK_MS, fan: int = FAN) -> DataFrame:
    """Add struct ``name`` with ``columns`` of the row just before (or after, ``later``) in (time, order) of its key.

    Like lag and lead over the key, but by blocks of ``time`` (whole milliseconds). Rows with a null key or time must be
    left out before. The first (last) row of a key gets null.
    """
    d = rows.withColumn("_b", F.floor(F.col(time) / block_ms))
    place = F.struct(F.col(time).alias("_t"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], *[F.col(c).alias(f"_v{i}") for i, c in enumerate(columns)])
    direction = (lambda c: F.col(c).desc()) if later else F.col
    w = Window.partitionBy(*keys, "_b").orderBy(*[direction(c) for c in [time, *order]])
    edge = F.min if later else F.max
    far = exclusive_scan(d.groupBy(*keys, "_b").agg(edge(place).alias("_edge")), keys, {"_far": "_edge"}, "min" if later else "max", "_b", fan, later).select(*keys, "_b", "_far")
    d = d.withColumn("_near", F.lag(place).over(w)).join(far, [*keys, "_b"])
    found = F.coalesce("_near", "_far")
    return d.withColumn(name, F.when(found.isNotNull(), F.struct(*[found[f"_v{i}"].alias(c) for i, c in enumerate(columns)]))).drop("_b", "_near", "_far")


def running_count(rows: DataFrame, keys: list[str], time: str, order: list[str], flag: str, name: str, block_ms: int = BLOCK_MS, fan: int = FAN) -> DataFrame:
    """Add ``name``: how many rows of the key up to and including this one, in (time, order), have ``flag`` true."""
    one = F.col(flag).cast("bigint")
    d = rows.withColumn("_b", F.floor(F.col(time) / block_ms))
    w = Window.partitionBy(*keys, "_b").orderBy(time, *order).rowsBetween(Window.unboundedPreceding, 0)
    before = exclusive_scan(d.groupBy(*keys, "_b").agg(F.sum(one).alias("_n")), keys, {"_before": "_n"}, "sum", "_b", fan).select(*keys, "_b", "_before")
    return d.withColumn("_in", F.sum(one).over(w)).join(before, [*keys, "_b"]).withColumn(name, F.col("_in") + F.col("_before")).drop("_b", "_in", "_before")
