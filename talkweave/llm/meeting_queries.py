"""Queries of problems 3 and 5, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkweave.llm.nearest import TOLERANCES, match_nearest
from talkweave.llm.runs import collapse_runs
from talkweave.runtime import millis, table

#: Greatest distance of a match, by table.
TURN_MS, SCENE_MS = 1500, 1000


def p3_found(spark, folder):
    """Nearest turn and nearest scene of each event."""
    events = table(spark, folder, "visual_speaker_events").select("meeting_id", "pos", millis("start").alias("t"))
    out = None
    block_ms = TOLERANCES * max(TURN_MS, SCENE_MS)  # one for both, so that the events are cut into blocks once
    for name, time, tolerance in (("speaker_turns", "start", TURN_MS), ("scenes", "timestamp", SCENE_MS)):
        right = table(spark, folder, name).select("meeting_id", "pos", millis(time).alias("t"))
        found = match_nearest(events, right, "meeting_id", "t", "pos", "t", "pos", tolerance, block_ms).select("meeting_id", F.col("left_id").alias("event_pos"), F.lit(name).alias("matched_table"), F.col("right_id").alias("matched_pos"))
        out = found if out is None else out.unionByName(found)
    return out


def _runs(spark, folder):
    events = table(spark, folder, "visual_speaker_events").select("meeting_id", "pos", "display_name", millis("start").alias("s"), millis("end").alias("e"))
    return collapse_runs(events, "meeting_id", "pos", "display_name", "s", "e")


def p5_found(spark, folder):
    """Runs of two or more records."""
    return _runs(spark, folder).where("n_rows >= 2").select("meeting_id", F.col("first_record").alias("first_pos"), F.col("last_record").alias("last_pos"), "n_rows", "duration_ms")


QUERIES = {"p3_found": p3_found, "p5_found": p5_found}

_SIDE = """
  select '{table}' matched_table, e.meeting_id, e.pos event_pos, r.pos matched_pos,
         row_number() over (partition by e.meeting_id, e.pos order by abs(e.t - r.t), r.t, r.pos) k
  from (select distinct meeting_id, pos, cast(round(start * 1000) as bigint) t from visual_speaker_events where start is not null) e
  join (select distinct meeting_id, pos, cast(round({time} * 1000) as bigint) t from {table} where {time} is not null) r
    on e.meeting_id = r.meeting_id and r.t between e.t - {ms} and e.t + {ms}"""

SQL = {
    "p3_found": "select meeting_id, event_pos, matched_table, matched_pos from ("
    + _SIDE.format(table="speaker_turns", time="start", ms=TURN_MS)
    + "\n  union all"
    + _SIDE.format(table="scenes", time='"timestamp"', ms=SCENE_MS)
    + "\n) where k = 1",
    # A run's end depends on all its events before, so the events are walked one by one, all meetings at once.
    "p5_found": """
with recursive n as (
  select distinct meeting_id, pos, cast(round(start * 1000) as bigint) s, coalesce(cast(round("end" * 1000) as bigint), cast(round(start * 1000) as bigint) + 1000) e,
         regexp_replace(lower(strip_accents(coalesce(display_name, ''))), '[^a-z0-9]', '', 'g') nm
  from visual_speaker_events where start is not null),
o as (select *, row_number() over w i, lag(nm) over w p from n window w as (partition by meeting_id order by s, pos)),
f as (select *, nm <> '' and (coalesce(nm = p, false) or (length(nm) >= 5 and length(p) >= 5 and levenshtein(nm, p) <= 1)) likely from o),
step as (
  select meeting_id, i, s, e reach, 1 run from f where i = 1
  union all
  select f.meeting_id, f.i, f.s, case when likely and f.s <= reach + 5000 then greatest(reach, f.e) else f.e end, run + case when likely and f.s <= reach + 5000 then 0 else 1 end
  from step join f on f.meeting_id = step.meeting_id and f.i = step.i + 1)
select meeting_id, arg_min(f.pos, f.i) first_pos, arg_max(f.pos, f.i) last_pos, count(*) n_rows, max(f.e) - min(f.s) duration_ms
from step join f using (meeting_id, i) where nm <> '' group by meeting_id, run having count(*) >= 2""",
}
