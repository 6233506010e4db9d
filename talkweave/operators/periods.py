"""Continuous periods and gaps of overlapping, nested, touching or gapped intervals.

The aggregate that is merged is a list of sorted disjoint intervals. Each (key, time block) forms a leaf whose list is
made by a linear pass over its sorted intervals. Leaves are combined in a reduction tree, but what goes up the tree is
only what can still change a neighbour: how far the intervals reach (their latest end) and where the last period
began. A leaf's list is then merged with what reaches in from the left. Lists never leave their block, so the feed
that holds a third of all rows costs no task more than a super-block of time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.operators.blocks import BLOCK_MS, FAN, exclusive_max
from talkweave.runtime import cut

_RUN = "array<struct<s:bigint,e:bigint,n:bigint>>"


def leaf_runs(intervals):
    """Sorted disjoint intervals with record counts from a sorted array of struct(s, e, ...); touching ones merge."""
    start = F.struct(F.array().cast(_RUN).alias("done"), F.lit(None).cast("bigint").alias("s"), F.lit(None).cast("bigint").alias("e"), F.lit(0).cast("bigint").alias("n"))

    def closed(acc):
        return F.when(acc["n"] > 0, F.concat(acc["done"], F.array(F.struct(acc["s"].alias("s"), acc["e"].alias("e"), acc["n"].alias("n"))))).otherwise(acc["done"])

    def step(acc, x):
        joins = (acc["n"] > 0) & (x["s"] <= acc["e"])
        return F.struct(
            F.when(joins, acc["done"]).otherwise(closed(acc)).alias("done"),
            F.when(joins, acc["s"]).otherwise(x["s"]).alias("s"),
            F.when(joins, F.greatest(acc["e"], x["e"])).otherwise(x["e"]).alias("e"),
            F.when(joins, acc["n"] + 1).otherwise(F.lit(1).cast("bigint")).alias("n"),
        )

    return F.aggregate(intervals, start, step, closed)


def periods_and_gaps(rows: DataFrame, keys: list[str], start: str, end: str, record: str, block_ms: int = BLOCK_MS, fan: int = FAN) -> DataFrame:
    """Periods (with their record counts) and gaps per key.

    ``start`` and ``end`` are whole milliseconds, ``record`` identifies a record within its key: rows that agree in
    key, start, end and record are one record. Rows with a null key, start or end, or with end < start, are left out;
    zero-length intervals count. Intervals that overlap or touch form one period. Columns besides those named are
    ignored, whatever their names. No rows in, no rows out.

    Returns keys, kind ('period' or 'gap'), start_ms, end_ms, n_records (null for gaps). A gap lies between two
    consecutive periods of a key and is at least 1 ms long.
    """
    valid = rows.select(*keys, F.col(start).cast("bigint").alias("_s"), F.col(end).cast("bigint").alias("_e"), F.col(record).alias("_r"))
    for k in keys:
        valid = valid.where(F.col(k).isNotNull())
    valid = valid.where("_s is not null and _e is not null and _e >= _s").withColumn("_block", F.floor(F.col("_s") / block_ms))
    leaves = cut(
        valid.groupBy(*keys, "_block")
        .agg(F.array_sort(F.collect_set(F.struct(F.col("_s").alias("s"), F.col("_e").alias("e"), F.col("_r").alias("r")))).alias("_all"))
        .select(*keys, "_block", leaf_runs(F.col("_all")).alias("runs"))
        .withColumn("reach", F.element_at("runs", -1)["e"])
    )
    # What reaches into a leaf from the left, then the part of its list that this absorbs. The list is disjoint, so
    # only intervals starting by `carry` can be absorbed, directly or through each other.
    merged = exclusive_max(leaves, keys, {"carry": "reach"}, "_block", fan).select(
        *keys,
        "_block",
        "carry",
        F.filter("runs", lambda r: F.coalesce(r["s"] <= F.col("carry"), F.lit(False))).alias("old"),
        F.filter("runs", lambda r: F.coalesce(r["s"] > F.col("carry"), F.lit(True))).alias("new"),
    )
    merged = merged.withColumn("last_new", F.try_element_at("new", F.lit(-1))["s"]).withColumn("old_end", F.greatest(F.col("carry"), F.try_element_at("old", F.lit(-1))["e"]))
    merged = exclusive_max(merged, keys, {"open": "last_new"}, "_block", fan)
    pieces = merged.select(
        *keys,
        F.explode(
            F.concat(
                F.transform("old", lambda r: F.struct(F.col("open").alias("p"), r["e"].alias("e"), r["n"].alias("n"), F.lit(None).cast("bigint").alias("g"))),
                F.transform("new", lambda r, i: F.struct(r["s"].alias("p"), r["e"].alias("e"), r["n"].alias("n"), F.when(i == 0, F.col("old_end")).otherwise(F.get("new", i - 1)["e"]).alias("g"))),
            )
        ).alias("x"),
    )
    # A period continued in later leaves has pieces there; its own leaf's piece carries the end of the period before.
    whole = pieces.groupBy(*keys, F.col("x.p").alias("start_ms")).agg(F.max("x.e").alias("end_ms"), F.sum("x.n").alias("n_records"), F.max("x.g").alias("before"))
    return whole.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.lit("period").alias("kind"), F.col("start_ms").alias("start_ms"), F.col("end_ms").alias("end_ms"), F.col("n_records").alias("n_records")),
                F.struct(F.lit("gap").alias("kind"), F.col("before").alias("start_ms"), F.col("start_ms").alias("end_ms"), F.lit(None).cast("bigint").alias("n_records")),
            )
        ).alias("y"),
    ).select(*keys, "y.*").where("start_ms is not null")


def speaker_label(col):
    """A speaker label without outer white space and case, written like ``Speaker_00``; blank gives null."""
    bare = F.lower(F.regexp_replace(F.col(col), r"(?U)^\s+|\s+$", ""))
    return F.when(bare != "", F.concat(F.upper(F.substring(bare, 1, 1)), F.substring(bare, 2, 2**31 - 1)))
