"""Vision and naming: frames to visual speaker events, events and turns to names of speakers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.functions.text import LAYOUT_BY_SIGNAL, event_confidence, layout_of
from talkweave.operators.aggregate import one_name_per_key, weighted_share_argmax
from talkweave.operators.cluster import canonical_names
from talkweave.operators.interval import overlap_join
from talkweave.operators.sequence import islands

UNKNOWN = "Unknown"


def visual_events(frames: DataFrame) -> DataFrame:
    """Frames (meeting_id, pos, start_ms, end_ms, display_name, source, confidence) -> events of one name on screen.

    Only frames whose name comes from a border or badge count; others break events. A null end is one second after the
    start. Consecutive frames of equal name and source, without a gap, form an event that ends with its last frame.
    """
    d = frames.withColumn("end_ms", F.coalesce("end_ms", F.col("start_ms") + 1000))
    qualifies = F.col("source").isin(*LAYOUT_BY_SIGNAL) & (F.col("display_name") != "")
    grouped = islands(d, "meeting_id", "start_ms", "pos", "end_ms", ["display_name", "source"], qualifies).groupBy("meeting_id", "island").agg(
        F.min("start_ms").alias("start_ms"), F.max_by("end_ms", F.struct("start_ms", "pos")).alias("end_ms"), F.first("display_name").alias("display_name"), F.first("source").alias("signal"), F.avg(F.coalesce("confidence", F.lit(0.0))).alias("_mean"), F.count("*").alias("n_frames")
    )
    return grouped.select("meeting_id", "start_ms", "end_ms", "display_name", layout_of(F.col("signal")).alias("layout"), "signal", event_confidence(F.col("_mean"), F.col("signal"), F.col("n_frames")).alias("confidence"), "n_frames")


def evidence(events: DataFrame, turns: DataFrame, name: str = "name") -> DataFrame:
    """(meeting_id, name, speaker_id, weight, first_pos): how far each name was on screen while each speaker spoke.

    A pair of event and turn weighs the event's confidence times the share of the event that the turn covers;
    pairs that only touch weigh nothing and are left out. ``first_pos`` is the first event that gave evidence.
    """
    e = events.select("meeting_id", F.col(name).alias("name"), F.col("start_ms").alias("_es"), F.col("end_ms").alias("_ee"), F.col("confidence").alias("_c"), F.col("pos").alias("_pos"))
    t = turns.select("meeting_id", "speaker_id", F.col("start_ms").alias("_ts"), F.col("end_ms").alias("_te"))
    pairs = overlap_join(e, t, "meeting_id", ("_es", "_ee"), ("_ts", "_te"))
    shared = F.least("_ee", "_te") - F.greatest("_es", "_ts")
    weight = F.col("_c") * shared / F.greatest((F.col("_ee") - F.col("_es")).cast("double"), F.lit(1e-3))
    return pairs.groupBy("meeting_id", "name", "speaker_id").agg(F.sum(weight).alias("weight"), F.min("_pos").alias("first_pos"))


def speaker_names(turns: DataFrame, events: DataFrame, least_share: float = 0.6, similarity: float = 0.65) -> DataFrame:
    """(meeting_id, speaker_id, name) for every speaker with a turn; 'Unknown' where no name resolves.

    Names are clustered by similarity; a name resolves to the speaker with most of its evidence if that is at least
    ``least_share``; of several names for one speaker the one with most evidence wins and the others are dropped.
    """
    clusters = canonical_names(events, "meeting_id", "display_name", "confidence", "pos", similarity)
    named = events.join(clusters, ["meeting_id", "display_name"]).withColumn("name", F.col("canonical"))
    best = weighted_share_argmax(evidence(named, turns), ["meeting_id"], "name", "speaker_id", "weight", "first_pos", least_share)
    won = one_name_per_key(best, ["meeting_id"], "speaker_id", "best_weight", "first_pos").select("meeting_id", "speaker_id", "name")
    return complete_names(turns, won)


def complete_names(turns: DataFrame, won: DataFrame) -> DataFrame:
    """Every (meeting, speaker) of the turns with its name, or 'Unknown'."""
    return turns.select("meeting_id", "speaker_id").distinct().join(won, ["meeting_id", "speaker_id"], "left").withColumn("name", F.coalesce("name", F.lit(UNKNOWN)))
