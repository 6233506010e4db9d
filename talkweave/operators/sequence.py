"""Operators over ordered rows of a key: islands, capped runs, keyframes, ranks by first appearance."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkweave.functions.images import shows_change
from talkweave.operators.blocks import BLOCK_MS, exclusive_max, exclusive_scan, running_count, with_neighbour
from talkweave.runtime import cut


def next_start(frames: DataFrame, key: str, time: str, order: str, name: str = "end_ms") -> DataFrame:
    """Add the time of the next row of the key; the last one gets null."""
    d = with_neighbour(frames, [key], time, [order], [time], "_next", later=True)
    return d.withColumn(name, F.col(f"_next.{time}")).drop("_next")


def islands(rows: DataFrame, key: str, time: str, order: str, end: str, same: list[str], qualifies: Column, slack_ms: int = 0, name: str = "island") -> DataFrame:
    """Number stretches of consecutive qualifying rows that agree in ``same`` and follow without a gap.

    A row opens a new island unless the row just before qualifies, agrees in all of ``same`` and ends no more than
    ``slack_ms`` before this one starts. Rows that do not qualify break islands and are left out of the result.
    """
    d = rows.withColumn("_q", F.coalesce(qualifies, F.lit(False)))
    d = with_neighbour(d, [key], time, [order], ["_q", end, *same], "_p")
    agrees = F.col("_p._q") & (F.col(time) <= F.col(f"_p.{end}") + slack_ms)
    for c in same:
        agrees = agrees & (F.col(c) == F.col(f"_p.{c}"))
    d = d.withColumn("_new", F.col("_q") & ~F.coalesce(agrees, F.lit(False)))
    return running_count(d, [key], time, [order], "_new", name).where("_q").drop("_q", "_p", "_new")


def speaker_islands(rows: DataFrame, key: str, time: str, order: str, speaker: str, name: str = "island") -> DataFrame:
    """Number stretches of consecutive rows of one speaker, in (time, order)."""
    d = with_neighbour(rows, [key], time, [order], [speaker], "_p").withColumn("_new", ~F.coalesce(F.col(speaker) == F.col(f"_p.{speaker}"), F.lit(False)))
    return running_count(d, [key], time, [order], "_new", name).drop("_p", "_new")


def capped_runs(rows: DataFrame, key: str, time: str, order: str, speaker: str, start: str, end: str, cap_ms: int, name: str = "run", block_ms: int = BLOCK_MS) -> DataFrame:
    """Number runs of consecutive rows of one speaker that span no more than ``cap_ms``.

    Rows are taken in (time, order); ``start`` may not lie before ``time``. A row extends the run if the speaker is the
    same and its end lies at most ``cap_ms`` after the run's start; a single longer row is a run of its own. Numbers
    start at 0 in each stretch; ``island`` tells the stretches of a key apart.

    Where a run starts depends on where the one before did. Every row points to the first row that would not fit a run
    beginning at it; a stretch is cut into blocks of time, and in each block it is told for every row by which row such
    a chain leaves the block. Only those exits are followed from block to block, by pointer doubling.
    """
    d = speaker_islands(rows, key, time, order, speaker)
    stretch = [key, "island"]
    d = cut(d.withColumn("_b", F.floor(F.col(time) / max(block_ms, cap_ms + 1))))
    row = F.struct(F.col(time).alias("t"), F.col(order).alias("o"), F.col(start).cast("bigint").alias("s"), F.col(end).cast("bigint").alias("e"))
    blocks = cut(d.groupBy(*stretch, "_b").agg(F.array_sort(F.collect_list(row)).alias("_rows")))
    # A run that begins in a block ends in it, in the next one that has rows, or with the first row of the one after.
    ahead = exclusive_scan(blocks.select(*stretch, "_b"), stretch, {"_n1": "_b"}, "min", "_b", later=True)
    nexts = blocks.select(*stretch, F.col("_b").alias("_n1"), F.transform("_rows", lambda r: r["e"]).alias("_ends"))
    exits = cut(_exits(blocks.join(ahead, [*stretch, "_b"]).join(nexts, [*stretch, "_n1"], "left").join(ahead.withColumnRenamed("_n1", "_n2").withColumnRenamed("_b", "_n1"), [*stretch, "_n1"], "left"), stretch, cap_ms))
    # Blocks are entered at their first row if they are the first of their stretch, else where the exits lead.
    firsts = exits.groupBy(*stretch).agg(F.min("_b").alias("_b")).select(*stretch, "_b", F.lit(0).alias("_i"))
    jumps = exits.where("_to is not null").select(*stretch, "_b", F.posexplode("_to").alias("_i", "_t")).where("_t is not null").select(*stretch, "_b", "_i", "_t.b", "_t.i")
    entries = _reached(firsts, jumps, stretch)
    flagged = _flag_starts(exits.join(entries, [*stretch, "_b"], "left"), stretch, d.schema[time].dataType.simpleString(), d.schema[order].dataType.simpleString())
    flagged = flagged.groupBy(*stretch, F.col("_time").alias(time), F.col("_order").alias(order)).agg(F.max("_opens").alias("_opens"))
    d = d.drop("_b").join(flagged, [*stretch, time, order])
    counted = running_count(d, stretch, time, [order], "_opens", name, block_ms).withColumn(name, F.col(name) - 1)
    return counted.drop("_opens")


def _exits(blocks: DataFrame, stretch: list[str], cap_ms: int) -> DataFrame:
    """Add ``_next``, the next run's start inside the block for each row (null beyond it), and ``_to``, the first start beyond the block."""

    def walk(batches):
        for batch in batches:
            nexts, tos = [], []
            for rows, ends, n1, n2 in zip(batch["_rows"], batch["_ends"], batch["_n1"], batch["_n2"]):
                s, e = [r["s"] for r in rows], [r["e"] for r in rows]
                n, beyond = len(s), list(ends) if ends is not None else []
                following, to = [None] * n, [None] * n
                for k in range(n - 1, -1, -1):
                    at = next((j for j in range(k + 1, n) if e[j] - s[k] > cap_ms), None)
                    following[k] = at
                    if at is not None:
                        to[k] = to[at]
                    else:
                        j = next((j for j, x in enumerate(beyond) if x - s[k] > cap_ms), None)
                        if j is not None:
                            to[k] = {"b": int(n1), "i": j}
                        elif beyond and n2 == n2 and n2 is not None:
                            to[k] = {"b": int(n2), "i": 0}
                nexts.append(following)
                tos.append(to)
            yield batch.drop(columns=["_ends", "_n1", "_n2"]).assign(_next=nexts, _to=tos)

    kept = blocks.select(*stretch, "_b", "_rows", "_ends", "_n1", "_n2")
    schema = T.StructType([f for f in kept.schema if f.name not in ("_ends", "_n1", "_n2")])
    schema = schema.add("_next", T.ArrayType(T.IntegerType())).add("_to", T.ArrayType(T.StructType().add("b", T.LongType()).add("i", T.IntegerType())))
    return kept.mapInPandas(walk, schema)


def _reached(firsts: DataFrame, jumps: DataFrame, stretch: list[str]) -> DataFrame:
    """(stretch, _b, _i): the rows by which chains from ``firsts`` enter blocks; jumps are doubled until none is left."""
    reached, jumps = firsts.withColumn("_b", F.col("_b").cast("bigint")).withColumn("_i", F.col("_i").cast("int")), cut(jumps)
    while not jumps.isEmpty():
        on = jumps.withColumnRenamed("b", "_b2").withColumnRenamed("i", "_i2")
        reached = cut(reached.unionByName(reached.join(on, [*stretch, "_b", "_i"]).select(*stretch, F.col("_b2").alias("_b"), F.col("_i2").alias("_i"))).distinct())
        further = jumps.select(*stretch, F.col("_b").alias("b"), F.col("_i").alias("i"), F.col("b").alias("_b3"), F.col("i").alias("_i3"))
        jumps = cut(further.join(jumps.select(*stretch, F.col("_b").alias("_b3"), F.col("_i").alias("_i3"), F.col("b").alias("tb"), F.col("i").alias("ti")), [*stretch, "_b3", "_i3"]).select(*stretch, F.col("b").alias("_b"), F.col("i").alias("_i"), F.col("tb").alias("b"), F.col("ti").alias("i")))
    return reached


def _flag_starts(blocks: DataFrame, stretch: list[str], time: str, order: str) -> DataFrame:
    """(stretch, _time, _order, _opens): each row of the blocks, and whether a run starts at it."""

    def walk(batches):
        for batch in batches:
            flags = []
            for following, i in zip(batch["_next"], batch["_i"]):
                opens = [False] * len(following)
                k = None if i is None or i != i else int(i)
                while k is not None:
                    opens[k] = True
                    k = following[k]
                    k = None if k is None or k != k else int(k)
                flags.append(opens)
            yield batch.drop(columns=["_next", "_i"]).assign(_opens=flags)

    kept = blocks.select(*stretch, "_rows", "_next", "_i")
    schema = T.StructType([f for f in kept.schema if f.name not in ("_next", "_i")]).add("_opens", T.ArrayType(T.BooleanType()))
    both = kept.mapInPandas(walk, schema).select(*stretch, F.explode(F.arrays_zip("_rows", "_opens")).alias("_x"))
    return both.select(*stretch, F.col("_x._rows.t").cast(time).alias("_time"), F.col("_x._rows.o").cast(order).alias("_order"), F.col("_x._opens").alias("_opens"))


def keyframes(frames: DataFrame, key: str, order: str, pixels: str, height: int, width: int, threshold: float, regional_factor: float = 1.5, grid: int = 3, block: int = 256) -> DataFrame:
    """Keep a frame if it differs enough from the last one kept: the first of a key, then those whose whole-frame
    difference exceeds ``threshold`` or whose largest cell of a grid exceeds ``regional_factor`` times that.

    ``pixels`` is an array of height x width luma values 0-255; blocks are of ``block`` numbers of ``order``.
    """

    def differs(last, image):
        one, other = (np.asarray(x, dtype=np.int16).reshape(height, width) for x in (last, image))
        return shows_change(one, other, threshold, regional_factor, grid)

    return _kept(frames, key, [order], F.floor(F.col(order) / block), pixels, differs)


def value_keyframes(frames: DataFrame, key: str, time: str, order: str, value: str, threshold: float, block_ms: int = BLOCK_MS) -> DataFrame:
    """``keyframes`` for one number per frame: kept if it differs from the last kept one by more than ``threshold``."""
    return _kept(frames, key, [time, order], F.floor(F.col(time) / block_ms), value, lambda last, x: abs(x - last) > threshold)


def _kept(frames: DataFrame, key: str, order: list[str], block: Column, value: str, differs) -> DataFrame:
    """Rows of which each differs from the one kept before it, in order; the first of a key is kept.

    Blocks are walked in parallel, each from what the blocks before it kept last. At first that is not known and a block
    begins anew; it is walked again, with all that rest on it, as long as what it was entered with turns out otherwise.
    Walks from different frames soon keep the same ones, so few rounds are needed, at most as many as a key has blocks.
    Rows that agree in key and order are kept together or not at all; rows with a null key, order or value are left out.
    """
    d = frames
    for c in [key, *order, value]:
        d = d.where(F.col(c).isNotNull())
    d = cut(d.withColumn("_b", block))
    keys = [key, "_b"]
    schema = T.StructType([d.schema[key], d.schema["_b"], *[d.schema[c] for c in order]]).add("_v", d.schema[value].dataType)

    def placed(blocks: DataFrame, entries: DataFrame) -> DataFrame:
        """Rows of the blocks in order, each block led by what it is entered with."""
        rows = blocks.select(*keys, *order, F.col(value).alias("_v"), F.lit(1).alias("_e"))
        leads = entries.where("_entry is not null").select(*keys, *[F.lit(0).cast(d.schema[c].dataType).alias(c) for c in order], F.col("_entry").alias("_v"), F.lit(0).alias("_e"))
        return rows.unionByName(leads).repartition(*keys).sortWithinPartitions(*keys, "_e", *order)

    def walk(batches, every):
        """The rows kept, or only what each block kept last."""
        here, last = None, None
        for b in batches:
            out = []
            for row in b[[*schema.names, "_e"]].itertuples(index=False, name=None):
                if row[:2] != here:
                    if here is not None and not every:
                        out.append(last)
                    here, last = row[:2], None
                if not row[-1]:
                    last = row[:-1]
                elif last is None or differs(last[-1], row[-2]):
                    last = row[:-1]
                    if every:
                        out.append(last)
            yield pd.DataFrame(out, columns=schema.names)
        if here is not None and not every:
            yield pd.DataFrame([last], columns=schema.names)

    ends = cut(placed(d, d.select(*keys, F.col(value).alias("_entry")).limit(0)).mapInPandas(lambda x: walk(x, False), schema))
    entries = ends.select(*keys, F.lit(None).cast(d.schema[value].dataType).alias("_entry"))
    while True:
        before = exclusive_max(ends.select(*keys, F.struct("_b", "_v").alias("_at")), [key], {"_before": "_at"}, "_b").select(*keys, F.col("_before._v").alias("_new"))
        known = cut(entries.join(before, keys).withColumn("_moved", ~F.col("_entry").eqNullSafe(F.col("_new"))))
        entries, moved = known.select(*keys, F.col("_new").alias("_entry")), known.where("_moved").select(*keys, F.col("_new").alias("_entry"))
        if moved.isEmpty():
            break
        again = placed(d.join(moved.select(*keys), keys, "left_semi"), moved).mapInPandas(lambda x: walk(x, False), schema)
        ends = cut(ends.join(moved.select(*keys), keys, "left_anti").unionByName(again))
    kept = placed(d, entries).mapInPandas(lambda x: walk(x, True), schema).select(*keys, *order)
    return d.join(kept, [*keys, *order], "left_semi").drop("_b").select(*frames.columns)


def first_appearance(rows: DataFrame, key: str, label: str, order: list[str], name: str = "rank") -> DataFrame:
    """(key, label, rank): labels of a key numbered from 0 by where they first appear; null labels are left out."""
    first = rows.where(F.col(label).isNotNull()).groupBy(key, label).agg(F.min(F.struct(*order)).alias("_first"))
    return first.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy("_first", label)) - 1).select(key, label, name)


def sampling_grid(native_fps: Column, sample_fps: float) -> Column:
    """Every how many-th frame is sampled: at least every one; an unknown native rate counts as 25."""
    fps = F.when(native_fps > 0, native_fps).otherwise(25.0)
    return F.greatest(F.lit(1), F.bround(fps / sample_fps, 0).cast("int"))
