"""Queries of problem 4: each speaker's continuous periods and gaps."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkweave.operators.periods import periods_and_gaps, speaker_label
from talkweave.runtime import millis, table


def _periods(spark, folder):
    turns = table(spark, folder, "speaker_turns").select("meeting_id", "pos", millis("start").alias("s"), millis("end").alias("e"), speaker_label("speaker_id").alias("speaker_id"))
    return periods_and_gaps(turns, ["meeting_id", "speaker_id"], "s", "e", "pos")


def p4_found(spark, folder):
    """Periods of two or more records, and gaps between consecutive periods."""
    return _periods(spark, folder).where("kind = 'gap' or n_records >= 2").select("meeting_id", "speaker_id", "kind", "start_ms", "end_ms")


def p4_speech_time(spark, folder):
    """Per speaker: number of periods, milliseconds of speech, number of gaps and their milliseconds."""
    p = _periods(spark, folder)
    is_period, length = F.col("kind") == "period", F.col("end_ms") - F.col("start_ms")
    return p.groupBy("meeting_id", "speaker_id").agg(
        F.count(F.when(is_period, 1)).alias("n_periods"),
        F.sum(F.when(is_period, length).otherwise(0)).alias("speech_ms"),
        F.count(F.when(~is_period, 1)).alias("n_gaps"),
        F.sum(F.when(~is_period, length).otherwise(0)).alias("gap_ms"),
    )


_PERIODS_SQL = """
with t as (
  select distinct meeting_id, pos, cast(round(start * 1000) as bigint) s, cast(round("end" * 1000) as bigint) e,
         upper(substr(lower(trim(speaker_id)), 1, 1)) || substr(lower(trim(speaker_id)), 2) speaker_id
  from speaker_turns where start is not null and "end" is not null and trim(speaker_id) <> ''),
r as (
  select *, max(e) over (partition by meeting_id, speaker_id order by s, e, pos rows between unbounded preceding and 1 preceding) reach
  from t where e >= s),
i as (select *, sum(case when reach is null or s > reach then 1 else 0 end) over (partition by meeting_id, speaker_id order by s, e, pos rows unbounded preceding) island from r),
p as (select meeting_id, speaker_id, island, min(s) start_ms, max(e) end_ms, count(*) n from i group by 1, 2, 3),
g as (select *, lag(end_ms) over (partition by meeting_id, speaker_id order by start_ms) before from p)
"""

QUERIES = {"p4_found": p4_found, "p4_speech_time": p4_speech_time}

SQL = {
    "p4_found": _PERIODS_SQL
    + """
select meeting_id, speaker_id, 'period' kind, start_ms, end_ms from g where n >= 2
union all
select meeting_id, speaker_id, 'gap', before, start_ms from g where before is not null""",
    "p4_speech_time": _PERIODS_SQL
    + """
select meeting_id, speaker_id, count(*) n_periods, cast(sum(end_ms - start_ms) as bigint) speech_ms, count(before) n_gaps,
       cast(coalesce(sum(start_ms - before), 0) as bigint) gap_ms
from g group by 1, 2""",
}
