"""Problem 3: pairing records with the nearest record in time of the same entity, within a tolerance.

Right-side timestamps become nearest-neighbour intervals: each owns the time up to the midpoint to its neighbours, and
no more than the tolerance. Left timestamps are then range-joined to the one interval they fall into. Both sides are
cut into time blocks, which are the partitioned index: a right record is copied into a neighbouring block only if it
lies within the tolerance of it, so midpoints are known inside each block and no entity is sorted as a whole. The blocks
spread a hot entity over as many tasks as it has blocks of time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Width of an index block in tolerances: few right rows lie near its edges and are copied, few lie inside it and are compared.
TOLERANCES = 32


def match_nearest(left: DataFrame, right: DataFrame, entity: str, left_time: str, left_id: str, right_time: str, right_id: str, tolerance_ms: int, block_ms: int | None = None) -> DataFrame:
    """For each left row the nearest right row of the same entity at most ``tolerance_ms`` away, before or after.

    Times are whole milliseconds. Equally near: the earlier one, then the smaller right id. Rows with a null entity or
    time match nothing; left rows without a match give no row. Repeated rows (same entity, id and time) are one row.
    Other columns are ignored, whatever their names. Returns entity, left id, right id and distance in milliseconds,
    one row for each (entity, left id, left time) matched.
    """
    block_ms = max(1000, TOLERANCES * tolerance_ms) if block_ms is None else block_ms
    if tolerance_ms < 0 or block_ms <= 0:
        raise ValueError("tolerance_ms must not be negative and block_ms must be positive")
    lt = left.select(F.col(entity).alias("_k"), F.col(left_id).alias("_l"), F.col(left_time).cast("bigint").alias("_t")).where("_k is not null and _t is not null").distinct()
    lt = lt.withColumn("_b", F.floor(F.col("_t") / block_ms))
    rt = right.select(F.col(entity).alias("_k"), F.col(right_id).alias("_r"), F.col(right_time).cast("bigint").alias("_u")).where("_k is not null and _u is not null and _r is not null")
    # Every block that a right time lies in or near: the block itself and those within the tolerance.
    rt = rt.withColumn("_b", F.explode(F.sequence(F.floor((F.col("_u") - tolerance_ms) / block_ms), F.floor((F.col("_u") + tolerance_ms) / block_ms))))
    points = rt.groupBy("_k", "_b", "_u").agg(F.min("_r").alias("_r"))
    w = Window.partitionBy("_k", "_b").orderBy("_u")
    # Intervals in half milliseconds, so that midpoints are whole: a midpoint itself belongs to the earlier record.
    intervals = points.select(
        "_k",
        "_b",
        "_u",
        "_r",
        F.greatest(2 * F.col("_u") - 2 * tolerance_ms - 1, F.lag("_u").over(w) + F.col("_u")).alias("_after"),
        F.least(2 * F.col("_u") + 2 * tolerance_ms, F.lead("_u").over(w) + F.col("_u")).alias("_upto"),
    )
    hit = lt.join(intervals, ["_k", "_b"]).where("2 * _t > _after and 2 * _t <= _upto")
    return hit.select(F.col("_k").alias(entity), F.col("_l").alias("left_id"), F.col("_r").alias("right_id"), F.abs(F.col("_t") - F.col("_u")).alias("distance_ms"))
