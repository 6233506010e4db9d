"""The meeting tables as the operators take them: each record once, times in whole milliseconds, unusable rows left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave.operators.periods import speaker_label
from talkweave.runtime import millis, table


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Turns with start, end and speaker that do not end before they start."""
    t = table(spark, folder, "speaker_turns").select("meeting_id", "pos", millis("start").alias("start_ms"), millis("end").alias("end_ms"), speaker_label("speaker_id").alias("speaker_id"))
    return t.where("start_ms is not null and end_ms >= start_ms and speaker_id is not null").distinct()


def utterances(spark: SparkSession, folder: str) -> DataFrame:
    """Transcript rows with times and a speaker."""
    t = table(spark, folder, "transcript").select("meeting_id", "pos", millis("start_s").alias("start_ms"), millis("end_s").alias("end_ms"), "speaker_id", "text", "language")
    return t.where("start_ms is not null and end_ms >= start_ms and speaker_id is not null").distinct()


def events(spark: SparkSession, folder: str) -> DataFrame:
    """Names seen on screen with start; a null end is one second later."""
    t = table(spark, folder, "visual_speaker_events").select("meeting_id", "pos", millis("start").alias("start_ms"), F.coalesce(millis("end"), millis("start") + 1000).alias("end_ms"), "display_name", "signal", "layout", "confidence")
    return t.where("start_ms is not null and end_ms >= start_ms").distinct()


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """Scenes with a timestamp; the frame's path stands for its title and text."""
    t = table(spark, folder, "scenes").select("meeting_id", "pos", millis("timestamp").alias("start_ms"), "frame_path").where("start_ms is not null").distinct()
    return t.select("*", F.regexp_extract("frame_path", r"([^/]+)$", 1).alias("title"), F.concat(F.regexp_extract("frame_path", r"([^/]+)$", 1), F.lit("\n"), F.col("meeting_id")).alias("raw_text"))


#: The same tables for DuckDB, as common table expressions.
SQL = r"""
turns as (
  select distinct meeting_id, pos, cast(round(start * 1000) as bigint) start_ms, cast(round("end" * 1000) as bigint) end_ms,
         upper(substr(lower(trim(speaker_id)), 1, 1)) || substr(lower(trim(speaker_id)), 2) speaker_id
  from speaker_turns where start is not null and "end" >= start and trim(speaker_id) <> ''),
utterances as (
  select distinct meeting_id, pos, cast(round(start_s * 1000) as bigint) start_ms, cast(round(end_s * 1000) as bigint) end_ms, speaker_id, text, language
  from transcript where start_s is not null and end_s >= start_s and speaker_id is not null),
seen as (
  select distinct meeting_id, pos, cast(round(start * 1000) as bigint) start_ms, coalesce(cast(round("end" * 1000) as bigint), cast(round(start * 1000) as bigint) + 1000) end_ms, display_name, signal, layout, confidence
  from visual_speaker_events where start is not null and ("end" is null or "end" >= start)),
frames as (
  select distinct meeting_id, pos, cast(round("timestamp" * 1000) as bigint) start_ms, frame_path, regexp_extract(frame_path, '([^/]+)$', 1) title,
         regexp_extract(frame_path, '([^/]+)$', 1) || chr(10) || meeting_id raw_text
  from scenes where "timestamp" is not null)"""
