"""Problem 5: collapsing runs of consecutive like events, by pointer doubling.

An event that continues its predecessor points to it, any other to itself; self-joins replace pointers by their
targets' pointers until all reach a run's start, which takes as many joins as the logarithm of the longest chain.
Before that, chains inside one block of time are contracted by a window over the block, so that only one row per run
and block takes part, and a run that never ends is no longer than the blocks it spans.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkweave.operators.blocks import BLOCK_MS, FAN, exclusive_max
from talkweave.runtime import cut

#: Events this much after the latest end of a run still continue it.
GAP_MS = 5000
#: Names shorter than this must be equal; longer ones may differ by one character.
FUZZY_FROM = 5


def bare(name: str | None) -> str:
    """Letters and digits of a name, without case and accents, compatibility forms decomposed."""
    if not name:
        return ""
    folded = unicodedata.normalize("NFKD", unicodedata.normalize("NFKD", name).casefold())
    return "".join(c for c in folded if c.isalnum())


@F.pandas_udf(T.StringType())
def bare_names(names: pd.Series) -> pd.Series:
    known = {n: bare(n) for n in names.unique() if n is not None}
    return names.map(lambda n: known.get(n, ""))


def double_pointers(nodes: DataFrame, prefix: str | None = None) -> DataFrame:
    """Pointer doubling over (id, parent[, prefix]): the root of every node, in logarithmically many self-joins.

    A root has itself as parent. With ``prefix``, the result's ``prefix`` is the maximum of that column over all
    *proper* ancestors of the node, root included (null for roots). Nodes already at their root leave the joins.
    """
    value = F.col(prefix) if prefix else F.lit(None).cast("bigint")
    # up: the pointer; above: maximum over the nodes from the parent up to and including the pointer's target
    own = nodes.select("id", F.col("parent").alias("up"), value.alias("own"))
    state = own.join(own.select(F.col("id").alias("up"), F.col("own").alias("above"), F.col("up").alias("next")), "up").select(
        "id", "up", F.when(F.col("id") != F.col("up"), F.col("above")).alias("above"), (F.col("next") == F.col("up")).alias("done")
    )
    state = cut(state)
    finished = state.where("done")
    open_ = state.where("not done")
    rounds = [finished]
    while not open_.isEmpty():
        # every target is either finished or open itself, so the union of both is what pointers are looked up in
        lookup = state.select(F.col("id").alias("up"), F.col("up").alias("to"), F.col("above").alias("further"), F.col("done").alias("at_root"))
        moved = open_.join(lookup, "up").select("id", F.col("to").alias("up"), F.greatest("above", "further").alias("above"), F.col("at_root").alias("done"))
        moved = cut(moved)
        rounds.append(moved.where("done"))
        # the next lookup needs the moved rows and the finished ones
        finished = finished.unionByName(moved.where("done"))
        open_ = moved.where("not done")
        state = finished.unionByName(open_)
    result = rounds[0]
    for r in rounds[1:]:
        result = result.unionByName(r)
    return result.select("id", F.col("up").alias("root"), F.col("above").alias("prefix"))


def collapse_runs(events: DataFrame, entity: str, record: str, name: str, start: str, end: str, gap_ms: int = GAP_MS, block_ms: int = BLOCK_MS, fan: int = FAN) -> DataFrame:
    """Runs of consecutive events of an entity with equal or nearly equal names.

    Events are taken by (start, record); ``start`` and ``end`` are whole milliseconds. An event continues the run if
    its bare name equals that of the event just before, or, both having at least five characters, is one inserted,
    dropped or replaced character away, and if it starts at most ``gap_ms`` after the latest end in the run so far.
    Null entity, record or start: left out. Null end: start + 1 s. Nothing left of the name (null included): the event
    belongs to no run and ends one. Repeated records (same entity, record and content) are one. Other columns are
    ignored. Returns entity, first_record, last_record, n_rows, duration_ms for each run, single events included.
    """
    e = events.select(F.col(entity).alias("k"), F.col(record).alias("r"), F.col(start).cast("bigint").alias("s"), F.coalesce(F.col(end).cast("bigint"), F.col(start).cast("bigint") + 1000).alias("e"), bare_names(F.col(name)).alias("nm"))
    e = cut(e.where("k is not null and r is not null and s is not null").distinct().withColumn("_block", F.floor(F.col("s") / block_ms)))
    # The event just before: inside the block by a window, for a block's first event from the blocks before.
    w = Window.partitionBy("k", "_block").orderBy("s", "r")
    last = F.max(F.struct("s", "r", "nm"))
    before = exclusive_max(e.groupBy("k", "_block").agg(last.alias("last")), ["k"], {"prev_block": "last"}, "_block", fan).select("k", "_block", F.col("prev_block.nm").alias("far_nm"))
    e = e.withColumn("near_nm", F.lag("nm").over(w)).withColumn("i", F.row_number().over(w)).join(before, ["k", "_block"])
    e = e.withColumn("prev_nm", F.when(F.col("i") == 1, F.col("far_nm")).otherwise(F.col("near_nm")))
    alike = (F.col("nm") == F.col("prev_nm")) | ((F.length("nm") >= FUZZY_FROM) & (F.length("prev_nm") >= FUZZY_FROM) & (F.levenshtein("nm", "prev_nm", 1) >= 0))
    e = e.withColumn("like", (F.col("nm") != "") & F.coalesce(alike, F.lit(False)))
    # Fragments: stretches of like names inside a block, named by their number; 0 continues the block before.
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    e = cut(e.select("k", "_block", "i", "s", "e", "r", "nm", "like", F.sum(F.when(F.col("like"), 0).otherwise(1)).over(so_far).alias("frag")))
    e = _reach(e, "frag", fan)
    # Within a stretch of like names, a run also ends where the next start is too far from the latest end. Ends of an
    # earlier run of the stretch lie too far back to matter, so the latest end of the stretch may be taken.
    goes_on = F.col("like") & (F.col("s") <= F.col("reach") + gap_ms)
    e = e.withColumn("on", goes_on).withColumn("part", F.sum(F.when(F.col("on"), 0).otherwise(1)).over(so_far))
    parts = cut(e.where("nm <> ''").groupBy("k", "_block", "part").agg(F.count("*").alias("n"), F.min(F.struct("s", "r")).alias("first"), F.max(F.struct("s", "r")).alias("last"), F.max("e").alias("latest")))
    roots = double_pointers(_chain(parts, "part", "latest", fan))
    parts = parts.withColumn("id", F.struct("k", "_block", F.col("part").alias("f"))).join(roots, "id")
    runs = parts.groupBy("root").agg(F.sum("n").alias("n_rows"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("latest").alias("latest"))
    return runs.select(F.col("root.k").alias(entity), F.col("first.r").alias("first_record"), F.col("last.r").alias("last_record"), "n_rows", (F.col("latest") - F.col("first.s")).alias("duration_ms"))


def _chain(parts: DataFrame, number: str, latest: str, fan: int) -> DataFrame:
    """Nodes for pointer doubling: part 0 of a block points to the last part of the block before, others to themselves."""
    me = F.struct("k", "_block", F.col(number).alias("f"))
    ends = exclusive_max(parts.groupBy("k", "_block").agg(F.max(F.struct("_block", F.col(number).alias("f"))).alias("end")), ["k"], {"prev": "end"}, "_block", fan).select("k", "_block", "prev")
    return parts.join(ends, ["k", "_block"]).select(me.alias("id"), F.when(F.col(number) == 0, F.struct("k", F.col("prev._block").alias("_block"), F.col("prev.f").alias("f"))).otherwise(me).alias("parent"), F.col(latest).alias("latest"))


def _reach(e: DataFrame, number: str, fan: int) -> DataFrame:
    """Add ``reach``: the latest end of the events before this one in its stretch, over all blocks it spans."""
    frags = e.where("nm <> ''").groupBy("k", "_block", number).agg(F.max("e").alias("latest"))
    above = double_pointers(_chain(frags, number, "latest", fan), "latest").select("id.k", "id._block", F.col("id.f").alias(number), "prefix").where("prefix is not null")
    w = Window.partitionBy("k", "_block", number).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)
    return e.withColumn("inside", F.max("e").over(w)).join(above, ["k", "_block", number], "left").withColumn("reach", F.greatest("inside", "prefix"))
