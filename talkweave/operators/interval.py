"""Joins on time: as-of, overlap, and the assignment of units to the interval that they overlap most.

Every join has an equality on the key and on a block of time, so that neither a long key nor a hot one becomes a
nested loop or a single task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from talkweave.operators.blocks import BLOCK_MS, FAN, exclusive_max

#: Width of a bucket of the range joins for short intervals, how much wider the buckets of the next level are, and how
#: many levels there are: the last one's are wider than any interval in milliseconds.
BUCKET_MS, LEVEL_FACTOR, LEVELS = 60_000, 32, 8


def asof_backward(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, right_order: list[str], payload: list[str], name: str = "active", block_ms: int = BLOCK_MS, fan: int = FAN) -> DataFrame:
    """Left outer as-of join: add struct ``name`` with ``payload`` of the last right row at or before ``left_time``.

    Times are whole milliseconds; of right rows at one time the last in ``right_order`` counts. Right rows with a null
    key or time match nothing; left rows always stay, with null where nothing matches. One pass over the union of both
    sides: a running maximum inside each block of time, and the last right row of the blocks before.
    """
    place = F.struct(F.col(right_time).cast("bigint").alias("t"), *[F.col(c).alias(f"o{i}") for i, c in enumerate(right_order)], *[F.col(c).alias(f"v{i}") for i, c in enumerate(payload)])
    r = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(F.col(key).alias("_k"), F.col(right_time).cast("bigint").alias("_t"), F.lit(0).alias("_side"), place.alias("_r"))
    usable = F.col("_k").isNotNull() & F.col("_t").isNotNull()
    sides = left.select(F.col(key).alias("_k"), F.col(left_time).cast("bigint").alias("_t"), F.lit(1).alias("_side"), F.struct(*left.columns).alias("_l"))
    # Rows that can match nothing stay out of the windows, where they would all fall into one.
    both = r.unionByName(sides.where(usable), allowMissingColumns=True).withColumn("_b", F.floor(F.col("_t") / block_ms))
    w = Window.partitionBy("_k", "_b").orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    edges = both.groupBy("_k", "_b").agg(F.max("_r").alias("_last"))
    before = exclusive_max(edges, ["_k"], {"_far": "_last"}, "_b", fan).select("_k", "_b", "_far")
    seen = both.withColumn("_near", F.max("_r").over(w)).where("_side = 1").join(before, ["_k", "_b"])
    found = F.coalesce("_near", "_far")
    struct = F.when(found.isNotNull(), F.struct(*[found[f"v{i}"].alias(c) for i, c in enumerate(payload)]))
    matched = seen.select("_l.*", struct.alias(name))
    return matched.unionByName(sides.where(~usable).select("_l.*", F.lit(None).cast(matched.schema[name].dataType).alias(name)))


def _level(start: str, end: str, width: int):
    """The level of an interval: the first whose buckets are at least as wide as it is long."""
    length = F.col(end) - F.col(start)
    return reduce(lambda at, k: F.when(length > width * LEVEL_FACTOR**k, k + 1).otherwise(at), range(LEVELS - 1), F.lit(0)).cast("int")


def _in_buckets(df: DataFrame, start: str, end: str, width: int, others: DataFrame) -> DataFrame:
    """Copies of the rows for each bucket that they touch at their own level and at the higher ones that ``others`` have.

    A row touches two buckets of a level at most. Whether it is ``_home`` there tells pairs that meet at the level of
    one of them from those that would meet again higher up.
    """
    d = df.withColumn("_own", _level(start, end, width))
    levels = F.array_intersect(F.sequence(F.col("_own"), F.lit(LEVELS - 1)), F.array_union(F.array("_own"), others.scalar()))
    d = d.withColumn("_level", F.explode(levels)).withColumn("_width", F.element_at(F.array(*[F.lit(width * LEVEL_FACTOR**k) for k in range(LEVELS)]), F.col("_level") + 1))
    return d.withColumn("_bucket", F.explode(F.sequence(F.floor(F.col(start) / F.col("_width")), F.floor(F.col(end) / F.col("_width"))))).withColumn("_home", F.col("_level") == F.col("_own")).drop("_own")


def overlap_join(left: DataFrame, right: DataFrame, key: str, left_span: tuple[str, str], right_span: tuple[str, str], touching: bool = False, width: int = BUCKET_MS) -> DataFrame:
    """All pairs of rows of one key whose intervals overlap (or only touch, with ``touching``), each pair once.

    Spans are names of start and end columns in whole milliseconds, distinct between the two sides, as must be all
    columns but the key; an end before its start counts as the start. Both sides are copied into the buckets that they
    touch, long intervals into wide ones, so that an interval has a handful of copies whatever its length. A pair meets
    at the level of the longer one and is kept in the bucket where its overlap begins.
    """
    (ls, le), (rs, re_) = left_span, right_span
    usable = lambda d, s, e: d.where(F.col(key).isNotNull() & F.col(s).isNotNull() & F.col(e).isNotNull()).withColumn("_end", F.greatest(F.col(s), F.col(e)))
    a, b = usable(left, ls, le).withColumnRenamed("_end", "_le"), usable(right, rs, re_).withColumnRenamed("_end", "_re")
    found = lambda d, s, e: d.select(F.collect_set(_level(s, e, width)))
    a, b = _in_buckets(a, ls, "_le", width, found(b, rs, "_re")), _in_buckets(b, rs, "_re", width, found(a, ls, "_le"))
    a, b = a.withColumnRenamed("_home", "_lh"), b.withColumnRenamed("_home", "_rh").drop("_width")
    first = F.floor(F.greatest(F.col(ls), F.col(rs)) / F.col("_width"))
    meets = (F.col(ls) <= F.col("_re")) & (F.col(rs) <= F.col("_le")) if touching else (F.col(ls) < F.col("_re")) & (F.col(rs) < F.col("_le"))
    return a.join(b, [key, "_level", "_bucket"]).where(meets & (F.col("_lh") | F.col("_rh")) & (F.col("_bucket") == first)).drop("_level", "_bucket", "_width", "_lh", "_rh", "_le", "_re")


def best_overlap(units: DataFrame, turns: DataFrame, key: str, unit_id: list[str], unit_span: tuple[str, str], turn_id: str, turn_span: tuple[str, str], width: int = BUCKET_MS) -> DataFrame:
    """For each unit the turn that it overlaps most: key, unit_id, turn id, overlap_ms, how.

    The largest overlap above 0 wins, of equal ones the turn that starts first, then the smaller turn id. A unit that
    overlaps none, one of zero length for example, goes to the first turn (in that order) that holds its midpoint, both
    ends included. ``how`` is 'overlap', 'midpoint' or 'none'; every unit gives one row. Times are whole milliseconds.
    """
    (us, ue), (ts, te) = unit_span, turn_span
    u = units.select(key, *unit_id, F.col(us).alias("_us"), F.col(ue).alias("_ue"))
    t = turns.select(key, F.col(turn_id).alias("_id"), F.col(ts).alias("_ts"), F.col(te).alias("_te"))
    pairs = overlap_join(u, t, key, ("_us", "_ue"), ("_ts", "_te"), touching=True, width=width)
    overlap = F.greatest(F.least("_ue", "_te") - F.greatest("_us", "_ts"), F.lit(0))
    middle = (2 * F.col("_ts") <= F.col("_us") + F.col("_ue")) & (F.col("_us") + F.col("_ue") <= 2 * F.col("_te"))
    # The maximum of a struct is an aggregate with partial results, so a unit's candidates are never sorted.
    rank = F.struct(overlap.alias("overlap"), (-F.col("_ts")).alias("s"), (-F.col("_id")).alias("i"))
    best = pairs.where((overlap > 0) | middle).groupBy(key, *unit_id).agg(F.max(rank).alias("_b"))
    out = u.join(best, [key, *unit_id], "left")
    how = F.when(F.col("_b").isNull(), "none").when(F.col("_b.overlap") > 0, "overlap").otherwise("midpoint")
    return out.select(key, *unit_id, (-F.col("_b.i")).alias(turn_id), F.coalesce("_b.overlap", F.lit(0)).alias("overlap_ms"), how.alias("how"))
