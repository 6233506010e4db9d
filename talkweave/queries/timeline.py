"""Queries of the operators on time: joins, islands, runs, naming and fusion, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkweave.functions.text import confidence_of, layout_of, round3, speaker_label
from talkweave.operators.aggregate import majority_first, one_name_per_key, weighted_share_argmax
from talkweave.operators.cluster import canonical_names
from talkweave.operators.interval import asof_backward, best_overlap
from talkweave.operators.sequence import first_appearance, next_start, sampling_grid, value_keyframes
from talkweave.plans.fusion import chunk_prompts, timeline, unsupported_quotes
from talkweave.plans.naming import complete_names, evidence, speaker_names, visual_events
from talkweave.plans.speech import transcript, units, utterances as utterances_of
from talkweave.runtime import table
from talkweave.sources import tables as T

_WITH = "with recursive " + T.SQL
LEAST_SHARE, CAP_MS, KEYFRAME = 0.6, 120_000, 0.1

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


@query(
    _WITH
    + """
select u.meeting_id, u.pos, u.start_ms, u.end_ms, coalesce(n.name, u.speaker_id) speaker, u.text transcript, u.language, f.title, f.raw_text slide_text
from utterances u
asof left join (select meeting_id, start_ms, max_by(title, pos) title, max_by(raw_text, pos) raw_text from frames group by all) f on u.meeting_id = f.meeting_id and u.end_ms >= f.start_ms
left join (select meeting_id, speaker_id, arg_min(display_name, p) as name from (
    select t.meeting_id, t.speaker_id, s.display_name, min(s.pos) p, row_number() over (partition by t.meeting_id, t.speaker_id order by sum(least(t.end_ms, s.end_ms) - greatest(t.start_ms, s.start_ms)) desc, min(s.pos)) k
    from turns t join seen s on t.meeting_id = s.meeting_id and t.start_ms < s.end_ms and s.start_ms < t.end_ms where s.display_name is not null group by 1, 2, 3) where k = 1 group by 1, 2) n
  on n.meeting_id = u.meeting_id and n.speaker_id = u.speaker_id"""
)
def fused_timeline(spark, folder):
    """Transcript with the slide active at each segment's end and the name most on screen per speaker."""
    from talkweave.operators.interval import overlap_join

    seen = T.events(spark, folder).where("display_name is not null").select("meeting_id", "display_name", F.col("pos").alias("p"), F.col("start_ms").alias("es"), F.col("end_ms").alias("ee"))
    t = T.turns(spark, folder).select("meeting_id", "speaker_id", "start_ms", "end_ms")
    shared = overlap_join(t, seen, "meeting_id", ("start_ms", "end_ms"), ("es", "ee")).groupBy("meeting_id", "speaker_id", "display_name").agg(F.sum(F.least("end_ms", "ee") - F.greatest("start_ms", "es")).alias("w"), F.min("p").alias("p"))
    names = shared.groupBy("meeting_id", "speaker_id").agg(F.max_by("display_name", F.struct("w", -F.col("p"))).alias("name"))
    d = timeline(T.utterances(spark, folder), T.frames(spark, folder), names)
    return d.select("meeting_id", "pos", "start_ms", "end_ms", "speaker", "transcript", "language", F.col("slide.title").alias("title"), F.array_join("slide.ocr_text", "\n").alias("slide_text"))


@query(
    _WITH
    + """
select u.meeting_id, u.pos, f.pos frame_pos, f.start_ms frame_ms
from utterances u asof left join (select meeting_id, start_ms, max(pos) pos from frames group by 1, 2) f on u.meeting_id = f.meeting_id and u.end_ms >= f.start_ms"""
)
def asof_active_frame(spark, folder):
    """The frame active at each utterance's end."""
    frames = T.frames(spark, folder).select("meeting_id", "pos", "start_ms")
    d = asof_backward(T.utterances(spark, folder).select("meeting_id", "pos", "end_ms"), frames, "meeting_id", "end_ms", "start_ms", ["pos"], ["pos", "start_ms"], "f")
    return d.select("meeting_id", "pos", F.col("f.pos").alias("frame_pos"), F.col("f.start_ms").alias("frame_ms"))


@query(
    _WITH
    + """
select u.meeting_id, u.pos, f.title || ', ' || f.meeting_id prompt
from utterances u asof left join (select meeting_id, start_ms, max_by(title, pos) title from frames group by 1, 2) f on u.meeting_id = f.meeting_id and u.end_ms >= f.start_ms"""
)
def chunk_prompt_hints(spark, folder):
    """Prompt of each chunk from the slide active at its end."""
    return chunk_prompts(T.utterances(spark, folder), T.frames(spark, folder).select("meeting_id", "pos", "start_ms", "raw_text")).select("meeting_id", "pos", "prompt")


@query(_WITH + "select meeting_id, pos, start_ms, lead(start_ms) over (partition by meeting_id order by start_ms, pos) end_ms from frames")
def frame_end_times(spark, folder):
    """Each frame ends where the next one starts."""
    return next_start(T.frames(spark, folder).select("meeting_id", "pos", "start_ms"), "meeting_id", "start_ms", "pos")


@query(
    _WITH
    + """,
o as (select *, coalesce(display_name <> '' and signal in ('active_speaker_border', 'presentation_badge'), false) q from seen),
p as (select *, lag(q) over w pq, lag(display_name) over w pn, lag(signal) over w ps, lag(end_ms) over w pe from o window w as (partition by meeting_id order by start_ms, pos)),
i as (select *, sum(case when q and not coalesce(pq and display_name = pn and signal = ps and start_ms <= pe, false) then 1 else 0 end) over (partition by meeting_id order by start_ms, pos rows unbounded preceding) island from p)
select meeting_id, min(start_ms) start_ms, max_by(end_ms, (start_ms, pos)) end_ms, any_value(display_name) display_name,
       case any_value(signal) when 'active_speaker_border' then 'gallery_view' else 'shared_screen' end layout, any_value(signal) signal,
       round(0.5 * avg(coalesce(confidence, 0)) + 0.3 * case any_value(signal) when 'active_speaker_border' then 0.85::double else 0.65::double end + 0.2 * least(1.0::double, count(*) / 3.0::double) + 1e-9, 3) confidence, count(*) n_frames
from i where q group by meeting_id, island"""
)
def visual_event_islands(spark, folder):
    """Names on consecutive frames become events."""
    return visual_events(T.events(spark, folder).withColumnRenamed("signal", "source"))


@query("select signal, case signal when 'active_speaker_border' then 'gallery_view' when 'presentation_badge' then 'shared_screen' end layout_of, case signal when 'active_speaker_border' then 0.85::double when 'presentation_badge' then 0.65::double end weight, count(*) n from visual_speaker_events group by 1")
def signal_layout_map(spark, folder):
    """Layout and confidence of each signal."""
    return table(spark, folder, "visual_speaker_events").groupBy("signal").agg(F.count("*").alias("n")).select("signal", layout_of(F.col("signal")).alias("layout_of"), confidence_of(F.col("signal")).alias("weight"), "n")


_RUNS = """,
o as (select *, row_number() over (partition by meeting_id order by start_ms, pos) i from utterances),
step as (
  select meeting_id, i, speaker_id, start_ms run_start, 0 run from o where i = 1
  union all
  select o.meeting_id, o.i, o.speaker_id, case when go then run_start else o.start_ms end, run + case when go then 0 else 1 end
  from (select o.*, s.run_start, s.run, o.speaker_id = s.speaker_id and o.end_ms - s.run_start <= {cap} go from step s join o on o.meeting_id = s.meeting_id and o.i = s.i + 1) o),
r as (select o.*, step.run from o join step using (meeting_id, i)),
v as (select meeting_id, run, language, row_number() over (partition by meeting_id, run order by language is null or language = '', count(*) desc, min((start_ms, pos))) k from r group by 1, 2, 3)
""".format(cap=CAP_MS)


@query(
    _WITH
    + _RUNS
    + """
select r.meeting_id, min(r.start_ms) start_ms, arg_max(r.end_ms, r.i) end_ms, any_value(r.speaker_id) speaker_id, coalesce(string_agg(nullif(r.text, ''), ' ' order by r.i), '') text,
       any_value(nullif(v.language, '')) as language, count(*) n_utterances
from r join v on v.meeting_id = r.meeting_id and v.run = r.run and v.k = 1 group by r.meeting_id, r.run"""
)
def transcript_capped_runs(spark, folder):
    """Utterances of a speaker merged up to the cap."""
    return transcript(T.utterances(spark, folder), CAP_MS)


_BEST = """,
c as (
  select u.meeting_id, u.pos, t.pos turn_pos, greatest(least(u.end_ms, t.end_ms) - greatest(u.start_ms, t.start_ms), 0) ov, t.start_ms ts, 2 * t.start_ms <= u.start_ms + u.end_ms and u.start_ms + u.end_ms <= 2 * t.end_ms mid
  from {units} u join turns t on t.meeting_id = u.meeting_id and t.start_ms <= u.end_ms and u.start_ms <= t.end_ms),
b as (select *, row_number() over (partition by meeting_id, pos order by ov desc, ts, turn_pos) k from c where ov > 0 or mid)
"""
_POINTS = ", points as (select meeting_id, pos, start_ms, start_ms end_ms, display_name from seen)"


@query(
    _WITH
    + _BEST.format(units="utterances")
    + """
select u.meeting_id, u.pos, b.turn_pos, coalesce(b.ov, 0) overlap_ms, case when b.ov is null then 'none' when b.ov > 0 then 'overlap' else 'midpoint' end how
from utterances u left join b on b.meeting_id = u.meeting_id and b.pos = u.pos and b.k = 1"""
)
def best_overlap_turn(spark, folder):
    """The turn that each utterance overlaps most, else the one that holds its midpoint."""
    t = T.turns(spark, folder).select("meeting_id", F.col("pos").alias("turn_pos"), F.col("start_ms").alias("ts"), F.col("end_ms").alias("te"))
    return best_overlap(T.utterances(spark, folder), t, "meeting_id", ["pos"], ("start_ms", "end_ms"), "turn_pos", ("ts", "te"))


def _points(spark, folder):
    """Names seen on screen as points in time: units of zero length."""
    points = T.events(spark, folder).select("meeting_id", "pos", "start_ms", F.col("start_ms").alias("end_ms"))
    t = T.turns(spark, folder).select("meeting_id", F.col("pos").alias("turn_pos"), F.col("start_ms").alias("ts"), F.col("end_ms").alias("te"))
    return best_overlap(points, t, "meeting_id", ["pos"], ("start_ms", "end_ms"), "turn_pos", ("ts", "te"))


@query(_WITH + _POINTS + _BEST.format(units="points") + "select meeting_id, pos, turn_pos from b where k = 1")
def midpoint_fallback(spark, folder):
    """Units of zero length go to the first turn around them."""
    return _points(spark, folder).where("how = 'midpoint'").select("meeting_id", "pos", "turn_pos")


@query(_WITH + _POINTS + "select meeting_id, pos from points p where not exists (from turns t where t.meeting_id = p.meeting_id and p.start_ms between t.start_ms and t.end_ms)")
def unmatched_units(spark, folder):
    """Units that no turn holds."""
    return _points(spark, folder).where("how = 'none'").select("meeting_id", "pos")


@query(_WITH + _BEST.format(units="utterances") + "select meeting_id, pos, speaker_id from turns t where exists (from b where b.meeting_id = t.meeting_id and b.turn_pos = t.pos and b.k = 1)")
def turns_with_words(spark, folder):
    """Turns that at least one unit went to."""
    won = best_overlap_turn(spark, folder).where("how <> 'none'").select("meeting_id", F.col("turn_pos").alias("pos"))
    return T.turns(spark, folder).join(won, ["meeting_id", "pos"], "left_semi").select("meeting_id", "pos", "speaker_id")


@query(
    _WITH
    + _BEST.format(units="utterances")
    + """,
v as (select b.meeting_id, b.turn_pos, u.language, row_number() over (partition by b.meeting_id, b.turn_pos order by u.language is null or u.language = '', count(*) desc, min((u.start_ms, u.pos))) k
  from b join utterances u on u.meeting_id = b.meeting_id and u.pos = b.pos where b.k = 1 group by 1, 2, 3)
select t.meeting_id, t.pos turn_pos, t.speaker_id, t.start_ms, t.end_ms, trim(coalesce(string_agg(u.text, ' ' order by u.start_ms, u.pos), ''), ' ') text, any_value(nullif(v.language, '')) as language
from turns t join b on b.meeting_id = t.meeting_id and b.turn_pos = t.pos and b.k = 1 join utterances u on u.meeting_id = b.meeting_id and u.pos = b.pos
join v on v.meeting_id = t.meeting_id and v.turn_pos = t.pos and v.k = 1 group by 1, 2, 3, 4, 5"""
)
def utterance_text(spark, folder):
    """merge_words_into_turns: A1, A2, J1, J9, J11, O1, O2: what was said in each turn, and its language."""
    u = T.utterances(spark, folder).withColumn("unit", F.lit(0))
    return utterances_of(u, T.turns(spark, folder))


@query(
    _WITH
    + """, w as (select meeting_id, pos, start_ms, end_ms, language, text, string_split(text, ' ') ws from utterances)
select meeting_id, pos, cast(i - 1 as integer) unit, start_ms, end_ms, case when language = 'en' then ws[i] else text end text, language
from w, unnest(range(1, case when language = 'en' then len(ws) + 1 when coalesce(text, '') <> '' then 2 else 1 end)) x(i)"""
)
def units_union(spark, folder):
    """Words where a segment has them, else its whole text, else nothing (English rows stand for those with words)."""
    d = T.utterances(spark, folder)
    word = lambda w: F.struct((F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"), w.alias("text"))
    segments = d.select("meeting_id", "pos", (F.col("start_ms") / 1000).alias("start"), (F.col("end_ms") / 1000).alias("end"), "text", "language", F.when(F.col("language") == "en", F.transform(F.split("text", " "), word)).alias("words"))
    return units(segments)


@query(
    _WITH
    + """,
v as (select meeting_id, speaker_id, language, row_number() over (partition by meeting_id, speaker_id order by language is null or language = '', count(*) desc, min((start_ms, pos))) k from utterances group by 1, 2, 3)
select meeting_id, speaker_id, nullif(language, '') as language from v where k = 1"""
)
def language_vote_first(spark, folder):
    """A2: the language that each speaker used most, the first used of equally frequent ones."""
    return majority_first(T.utterances(spark, folder), ["meeting_id", "speaker_id"], "language", ["start_ms", "pos"], "language")


_EVIDENCE = """,
e as (
  select s.meeting_id, s.display_name as name, t.speaker_id, round(sum(s.confidence * (least(t.end_ms, s.end_ms) - greatest(t.start_ms, s.start_ms)) / greatest(s.end_ms - s.start_ms, 0.001)), 6) weight, min(s.pos) first_pos
  from seen s join turns t on t.meeting_id = s.meeting_id and t.start_ms < s.end_ms and s.start_ms < t.end_ms where s.display_name is not null group by 1, 2, 3),
f as (select *, sum(weight) over (partition by meeting_id, name) total, row_number() over (partition by meeting_id, name order by weight desc, first_pos) k from e),
n as (select meeting_id, name, speaker_id, weight best_weight, weight / total share, first_pos from f where k = 1 and total > 0 and weight / total >= 0.6),
one as (select *, row_number() over (partition by meeting_id, speaker_id order by best_weight desc, first_pos) k from n)
"""


def _evidence(spark, folder):
    seen = T.events(spark, folder).where("display_name is not null")
    return evidence(seen, T.turns(spark, folder), "display_name").withColumn("weight", F.round("weight", 6))


@query(_WITH + _EVIDENCE + "select * from e")
def overlap_evidence(spark, folder):
    """Weight of each name for each speaker."""
    return _evidence(spark, folder)


def _shares(spark, folder):
    return weighted_share_argmax(_evidence(spark, folder), ["meeting_id"], "name", "speaker_id", "weight", "first_pos", LEAST_SHARE)


@query(_WITH + _EVIDENCE + "select meeting_id, name, speaker_id, best_weight, round(share, 6) share, first_pos from n")
def name_share_argmax(spark, folder):
    """The speaker that most of a name's evidence points to, if it is enough."""
    return _shares(spark, folder).withColumn("share", F.round("share", 6))


def _won(spark, folder):
    return one_name_per_key(_shares(spark, folder), ["meeting_id"], "speaker_id", "best_weight", "first_pos")


@query(_WITH + _EVIDENCE + "select meeting_id, speaker_id, name, best_weight from one where k = 1")
def speaker_slot_dedupe(spark, folder):
    """One name per speaker."""
    return _won(spark, folder).select("meeting_id", "speaker_id", "name", "best_weight")


@query(_WITH + _EVIDENCE + "select t.meeting_id, t.speaker_id, coalesce(one.name, 'Unknown') as name from (select distinct meeting_id, speaker_id from turns) t left join one on one.meeting_id = t.meeting_id and one.speaker_id = t.speaker_id and one.k = 1")
def speaker_map_complete(spark, folder):
    """Every speaker with a name or 'Unknown'."""
    return complete_names(T.turns(spark, folder), _won(spark, folder).select("meeting_id", "speaker_id", "name"))


@query()
def speaker_name_map(spark, folder):
    """build_speaker_name_map: A4, A6, J4, A5, A7, W7, J7 with clustered names."""
    return speaker_names(T.turns(spark, folder), T.events(spark, folder).where("display_name is not null"))


@query()
def name_clusters(spark, folder):
    """Names with the leaders of their clusters."""
    return canonical_names(T.events(spark, folder), "meeting_id", "display_name", "confidence", "pos")


@query(
    _WITH
    + """, a as (select meeting_id, trim(speaker_id) raw, min((start, pos)) f from (select distinct meeting_id, pos, start, speaker_id from speaker_turns where start is not null) where speaker_id is not null group by 1, 2)
select meeting_id, raw raw_label, row_number() over (partition by meeting_id order by f, raw) - 1 as rank, printf('Speaker_%02d', row_number() over (partition by meeting_id order by f, raw) - 1) label from a"""
)
def speaker_label_rank(spark, folder):
    """Labels as delivered, numbered by first appearance."""
    t = table(spark, folder, "speaker_turns").where("start is not null").select("meeting_id", F.trim("speaker_id").alias("raw_label"), "start", "pos")
    return first_appearance(t, "meeting_id", "raw_label", ["start", "pos"]).select("meeting_id", "raw_label", F.col("rank").cast("bigint").alias("rank"), speaker_label(F.col("rank")).alias("label"))


@query(_WITH + "select meeting_id, display_name, round(sum(confidence) + 1e-9, 3) total, count(*) n from seen where display_name is not null group by 1, 2")
def total_name_confidence(spark, folder):
    """A4: total confidence of every name."""
    return T.events(spark, folder).where("display_name is not null").groupBy("meeting_id", "display_name").agg(round3(F.sum("confidence")).alias("total"), F.count("*").alias("n"))


@query(_WITH + "select distinct meeting_id, speaker_id from turns")
def distinct_speakers(spark, folder):
    """Speakers of each meeting."""
    return T.turns(spark, folder).select("meeting_id", "speaker_id").distinct()


@query(
    _WITH
    + f""",
o as (select *, row_number() over (partition by meeting_id order by start_ms, pos) i from seen),
step as (
  select meeting_id, pos, start_ms, confidence, i, confidence kept, true keep from o where i = 1
  union all
  select o.meeting_id, o.pos, o.start_ms, o.confidence, o.i, case when abs(o.confidence - kept) > {KEYFRAME} then o.confidence else kept end, abs(o.confidence - kept) > {KEYFRAME}
  from step s join o on o.meeting_id = s.meeting_id and o.i = s.i + 1)
select meeting_id, pos, start_ms, confidence from step where keep"""
)
def keyframe_fold(spark, folder):
    """Rows whose confidence differs enough from that of the last row kept."""
    d = T.events(spark, folder).select("meeting_id", "pos", "start_ms", "confidence")
    return value_keyframes(d, "meeting_id", "start_ms", "pos", "confidence", KEYFRAME)


@query("select distinct meeting_id, greatest(1, cast(round_even(case when sample_rate > 0 then sample_rate / 640.0::double else 25.0::double end / 2.0::double, 0) as integer)) every from recordings")
def frame_sampling_grid(spark, folder):
    """Every how many-th frame is sampled; the sample rate stands in for the frame rate."""
    return table(spark, folder, "recordings").select("meeting_id", sampling_grid(F.col("sample_rate") / 640.0, 2.0).alias("every")).distinct()


@query(
    _WITH
    + """, q as (select meeting_id, pos quote_id, lower(text) quote, ' ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ' qs from utterances where text is not null)
select meeting_id, quote_id, quote from q
where trim(qs) = '' or not exists (from utterances u where u.meeting_id = q.meeting_id and contains(' ' || trim(regexp_replace(u.text, '[^\\p{L}\\p{N}]+', ' ', 'g')) || ' ', q.qs))"""
)
def evidence_check(spark, folder):
    """Grounding: quotes (transcript in lower case) that no segment of their meeting holds word for word."""
    u = T.utterances(spark, folder)
    return unsupported_quotes(u.where("text is not null").select("meeting_id", F.col("pos").alias("quote_id"), F.lower("text").alias("quote")), u)


@query(_WITH + _BEST.format(units="utterances") + "select (select count(*) from utterances) n_units, (select count(*) from b where k = 1) n_matched, (select count(distinct (meeting_id, turn_pos)) from b where k = 1) n_turns, (select count(*) from utterances) - (select count(*) from b where k = 1) n_unmatched")
def merge_counters(spark, folder):
    """How many units were matched, to how many turns."""
    d = best_overlap_turn(spark, folder)
    return d.agg(F.count("*").alias("n_units"), F.count("turn_pos").alias("n_matched"), F.countDistinct("meeting_id", "turn_pos").alias("n_turns"), F.count(F.when(F.col("turn_pos").isNull(), 1)).alias("n_unmatched"))
