"""Queries that write and read stored artifacts, run model seams with stand-ins, and compare pixels, with their SQL."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkweave import seams
from talkweave.functions import ocr
from talkweave.functions.images import regional_difference, whole_difference
from talkweave.functions.text import round3_exact
from talkweave.plans.fusion import slides
from talkweave.runtime import shared_folder, table
from talkweave.sources import tables
from talkweave.sources.artifacts import artifact_path, read_artifact

QUERIES: dict = {}
SQL: dict = {}
#: Rows of a meeting in one file.
PER_FILE = 500


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


def _written(spark, rows, fields, name, wrapper=None):
    """Write rows as JSON artifacts, a file for each PER_FILE places of a meeting, and read them back."""
    out = f"{shared_folder(spark)}/artifacts-{uuid.uuid4().hex}"
    part = F.floor(F.col("pos") / PER_FILE)
    made = rows.groupBy("meeting_id", part.alias("part")).agg(F.array_sort(F.collect_list(F.struct("pos", F.struct(*fields).alias("r")))).alias("x"))
    listed = F.transform("x", lambda x: x["r"])
    keep_nulls = {"ignoreNullFields": "false"}
    text = F.to_json(listed, keep_nulls) if wrapper is None else F.to_json(F.struct(listed.alias(wrapper)), keep_nulls)
    made.select("meeting_id", "part", text.alias("value")).write.partitionBy("part", "meeting_id").text(out)
    read = read_artifact(spark, name, [f"{out}/*/*/*", artifact_path(f"{out}/none", name)], optional=True)
    return read.withColumn("meeting_id", F.regexp_extract("meeting_id", "([^=]+)$", 1))


@query('select distinct meeting_id, pos, speaker_id, start, "end" from speaker_turns where start is not null and "end" is not null and speaker_id is not null')
def artifact_arrays(spark, folder):
    """Bare arrays, one of the paths missing; each row's place in the meeting travels as its speaker's suffix."""
    t = table(spark, folder, "speaker_turns").where("start is not null and end is not null and speaker_id is not null").select("meeting_id", "pos", "start", "end", "speaker_id").distinct()
    named = t.withColumn("speaker_id", F.concat_ws("\n", F.col("pos").cast("string"), "speaker_id"))
    back = _written(spark, named, ["start", "end", "speaker_id"], "speaker_turns")
    return back.select("meeting_id", F.substring_index("speaker_id", "\n", 1).cast("bigint").alias("pos"), F.regexp_extract("speaker_id", r"(?s)^\d+\n(.*)$", 1).alias("speaker_id"), "start", "end")


@query("select meeting_id, count(*) n, cast(count(text) as bigint) n_texts, cast(sum(coalesce(length(text), 0)) as bigint) n_characters, round(sum(start_s), 3) total_s from (select distinct meeting_id, pos, start_s, end_s, speaker_id, text, language from transcript where start_s is not null and end_s is not null) group by 1")
def artifact_objects(spark, folder):
    """Rows wrapped in an object."""
    t = table(spark, folder, "transcript").where("start_s is not null and end_s is not null").select("meeting_id", "pos", "start_s", "end_s", "speaker_id", "text", "language").distinct()
    back = _written(spark, t, ["start_s", "end_s", "speaker_id", "text", "language"], "transcript", "segments")
    return back.groupBy("meeting_id").agg(F.count("*").alias("n"), F.count("text").alias("n_texts"), F.sum(F.coalesce(F.length("text"), F.lit(0))).alias("n_characters"), F.round(F.sum("start_s"), 3).alias("total_s"))


@F.pandas_udf(T.StructType().add("whole", T.DoubleType()).add("regional", T.DoubleType()))
def _differences(a: pd.Series, b: pd.Series) -> pd.DataFrame:
    pairs = [(x.reshape(8, 8), y.reshape(8, 8)) for x, y in zip(a, b)]
    return pd.DataFrame({"whole": [whole_difference(x, y) for x, y in pairs], "regional": [regional_difference(x, y) for x, y in pairs]})


_CELLS = [(range(0, 2), range(2, 4), range(4, 8))[k] for k in range(3)]
_MEANS = ", ".join(f"({' + '.join(f'd[{8 * y + x + 1}]' for y in rows for x in cols)}) / {len(rows) * len(cols)}.0::double" for rows in _CELLS for cols in _CELLS)


@query(
    f"""with g as (select vec_id, list_transform(embedding, lambda e: ((cast(floor(e::double * 1000) as bigint) % 256) + 256) % 256) p from embeddings),
d as (select b.vec_id, list_transform(range(1, 65), lambda i: abs(a.p[i] - b.p[i])) d from g a join g b on b.vec_id = a.vec_id + 1)
select vec_id, round(list_sum(d) / 64.0::double / 255.0::double, 9) whole, round(greatest({_MEANS}) / 255.0::double, 9) regional from d"""
)
def frame_difference(spark, folder):
    """Rows as grey pictures of 8 x 8, each compared with the one before."""
    grey = F.transform("embedding", lambda e: F.pmod(F.floor(e.cast("double") * 1000), F.lit(256)).cast("int"))
    e = table(spark, folder, "embeddings").select("vec_id", grey.alias("p"))
    before = e.select((F.col("vec_id") + 1).alias("vec_id"), F.col("p").alias("q"))
    d = e.join(before, "vec_id").select("vec_id", _differences("q", "p").alias("d"))
    return d.select("vec_id", F.round("d.whole", 9).alias("whole"), F.round("d.regional", 9).alias("regional"))


@query("select distinct meeting_id, cast(0 as bigint) pos, 0.0::double start, round(coalesce(duration_sec, 0.0::double) + 1e-9, 3) \"end\", 'Speaker_00' speaker_id from recordings")
def diarization_fallback(spark, folder):
    """M2: recordings on which the model fails get one turn of one speaker over their duration."""
    r = table(spark, folder, "recordings").select("meeting_id", "wav_path", "duration_sec").distinct()
    return seams.diarize(r, _failing).distinct()


def _failing():
    def model(wav):
        raise OSError("no model")

    return model


_WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


@query(
    "with recursive "
    + tables.SQL
    + rf""", f as (select meeting_id, pos, layout, coalesce(display_name, '') shown, confidence >= 0.3 has_lines, case when confidence >= 0.8 then display_name end border,
    regexp_matches(regexp_replace(regexp_replace(coalesce(display_name, ''), '^{_WS}+', ''), '{_WS}+$', ''), '^(?:(?:Dr|Mr|Ms|Mrs)\.?{_WS}+)?[A-Z][a-z]+(?:{_WS}+[A-Z]\.)?{_WS}+[A-Z][a-z]+(?:{_WS}+[A-Z][a-z]+)?$') and len(list_filter(regexp_split_to_array(coalesce(display_name, ''), '{_WS}+'), lambda w: w <> '')) <= 4 shaped from seen)
select meeting_id, pos, case when border is not null then 'active_speaker_border' when has_lines and shaped then 'layout_heuristic' end source,
       case when has_lines then cast(case when border is null and shaped then 0 else 1 end as bigint) else 0 end n_bullets, case when has_lines then layout || chr(10) || shown else '' end raw_text
from f where has_lines or border is not null"""
)
def slide_rows(spark, folder):
    """Frames without lines and name are dropped, a line taken for a name is left out of the content."""
    d = tables.events(spark, folder)
    shown, lines_there = F.coalesce("display_name", F.lit("")), F.col("confidence") >= 0.3
    page = F.when(lines_there, ocr.plain_lines(F.array("layout", shown))).otherwise(F.array().cast(f"array<{ocr.LINE}>"))
    border = F.when(F.col("confidence") >= 0.8, F.col("display_name"))
    nothing = F.lit(None).cast("string")
    frames = d.select("meeting_id", "pos", "start_ms", F.lit("f").alias("frame_path"), page.alias("page"), F.lit(None).cast("array<string>").alias("fallback"), border.alias("border_name"), F.col("confidence").alias("border_confidence"), nothing.alias("badge_name"), F.lit(None).cast("double").alias("badge_confidence"), nothing.alias("vision_name"))
    s = slides(frames, False)
    return s.select("meeting_id", "pos", F.col("display_name_source").alias("source"), F.size("content.bullet_points").cast("bigint").alias("n_bullets"), "content.raw_text")


@query("select p_partkey, cast(printf('%.3f', p_partkey / 16.0::double) as double) a, cast(printf('%.3f', p_partkey / 2000.0::double) as double) b from part")
def round3_ties(spark, folder):
    """Three decimals of exact ties and of what only looks like one."""
    return table(spark, folder, "part").select("p_partkey", round3_exact(F.col("p_partkey") / 16.0).alias("a"), round3_exact(F.col("p_partkey") / 2000.0).alias("b"))
