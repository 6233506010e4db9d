"""Speech: words to turns, turns to transcript segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.operators.aggregate import majority_first, ordered_concat
from talkweave.operators.interval import best_overlap
from talkweave.operators.sequence import capped_runs


def units(segments: DataFrame) -> DataFrame:
    """Recognised segments -> the units that are assigned to turns: the words if there are any, else the whole text if
    it is not empty, else nothing. Adds unit (position of the word in its segment) and keeps meeting_id, pos, language."""
    words = F.transform("words", lambda w: F.struct(w["start"].alias("start"), w["end"].alias("end"), w["text"].alias("text")))
    whole = F.when(F.coalesce("text", F.lit("")) != "", F.array(F.struct(F.col("start").alias("start"), F.col("end").alias("end"), F.col("text").alias("text")))).otherwise(F.array())
    chosen = F.when(F.size(F.coalesce("words", F.array())) > 0, words).otherwise(whole)
    return segments.select("meeting_id", "pos", "language", F.posexplode(chosen).alias("unit", "_u")).select("meeting_id", "pos", "unit", F.round(F.col("_u.start") * 1000).cast("bigint").alias("start_ms"), F.round(F.col("_u.end") * 1000).cast("bigint").alias("end_ms"), F.col("_u.text").alias("text"), "language")


def utterances(unit_rows: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per turn that got units: meeting_id, turn_pos, speaker_id, start_ms, end_ms, text, language.

    Texts are joined in the order (start, segment, word), then stripped; the language is that of most units, the first
    encountered of equally frequent ones. Units that fit no turn are dropped, turns without units give no row.
    """
    order = ["start_ms", "pos", "unit"]
    t = turns.select("meeting_id", F.col("pos").alias("turn_pos"), "speaker_id", F.col("start_ms").alias("turn_start"), F.col("end_ms").alias("turn_end"))
    placed = best_overlap(unit_rows, t, "meeting_id", ["pos", "unit"], ("start_ms", "end_ms"), "turn_pos", ("turn_start", "turn_end")).where("how <> 'none'")
    joined = unit_rows.join(placed.select("meeting_id", "pos", "unit", "turn_pos"), ["meeting_id", "pos", "unit"])
    key = ["meeting_id", "turn_pos"]
    text = joined.groupBy(*key).agg(F.trim(ordered_concat(F.col("text"), [F.col(c) for c in order])).alias("text"))
    return t.join(text, key).join(majority_first(joined, key, "language", order, "language"), key).select("meeting_id", "turn_pos", "speaker_id", F.col("turn_start").alias("start_ms"), F.col("turn_end").alias("end_ms"), "text", "language")


def transcript(spoken: DataFrame, cap_ms: int = 120_000) -> DataFrame:
    """Utterances (meeting_id, pos, speaker_id, start_ms, end_ms, text, language) -> segments of one speaker.

    Consecutive utterances of a speaker are merged while the segment spans at most ``cap_ms``. A segment starts with its
    first utterance and ends with its last one's end; non-empty texts are joined in order; the language is that of most
    utterances, the first encountered of equally frequent ones.
    """
    key = ["meeting_id", "island", "run"]
    d = capped_runs(spoken, "meeting_id", "start_ms", "pos", "speaker_id", "start_ms", "end_ms", cap_ms)
    place = F.struct("start_ms", "pos")
    merged = d.groupBy(*key).agg(
        F.min("start_ms").alias("start_ms"),
        F.max_by("end_ms", place).alias("end_ms"),
        F.first("speaker_id").alias("speaker_id"),
        ordered_concat(F.when(F.coalesce("text", F.lit("")) != "", F.col("text")), [F.col("start_ms"), F.col("pos")]).alias("text"),
        F.count("*").alias("n_utterances"),
    )
    return merged.join(majority_first(d, key, "language", ["start_ms", "pos"], "language"), key).select("meeting_id", "start_ms", "end_ms", "speaker_id", "text", "language", "n_utterances")
