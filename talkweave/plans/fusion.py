"""Fusion: transcript segments with the slide on screen and the speaker's name; slides from recognised frames; checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from talkweave.functions import ocr
from talkweave.functions.text import lines, prompt, slide_id
from talkweave.operators.interval import asof_backward
from talkweave.operators.sequence import next_start
from talkweave.runtime import cut

#: Words in the longest stretches by which quotes are looked up.
GRAM = 3


def timeline(transcript: DataFrame, frames: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Segments (meeting_id, pos, start_ms, end_ms, speaker_id, text, language) with the slide active at their end.

    ``frames`` has meeting_id, pos, start_ms, title, raw_text. Slide is null before the first frame. A speaker without a
    name keeps the id. Adds speaker, title, ocr_text (lines).
    """
    d = asof_backward(transcript, frames, "meeting_id", "end_ms", "start_ms", ["pos"], ["title", "raw_text"], "_f")
    if names is not None:
        d = d.join(names.select("meeting_id", "speaker_id", F.col("name").alias("_name")), ["meeting_id", "speaker_id"], "left")
    else:
        d = d.withColumn("_name", F.lit(None).cast("string"))
    slide = F.when(F.col("_f").isNotNull(), F.struct(F.col("_f.title").alias("title"), lines(F.col("_f.raw_text")).alias("ocr_text")))
    return d.select("meeting_id", "pos", "start_ms", "end_ms", F.coalesce("_name", "speaker_id").alias("speaker"), F.col("text").alias("transcript"), "language", slide.alias("slide"))


def chunk_prompts(chunks: DataFrame, frames: DataFrame) -> DataFrame:
    """Add ``prompt``: the lines of the slide active at a chunk's end, joined for a recogniser; null without text."""
    d = asof_backward(chunks, frames, "meeting_id", "end_ms", "start_ms", ["pos"], ["raw_text"], "_f")
    return d.withColumn("prompt", F.when(F.coalesce("_f.raw_text", F.lit("")) != "", prompt(lines(F.col("_f.raw_text"))))).drop("_f")


def slides(frames: DataFrame, fallback_enabled: bool | Column = True) -> DataFrame:
    """Recognised frames -> slides with content and the name found on screen.

    ``frames`` has meeting_id, pos, start_ms, frame_path, page, fallback (array of texts, null if it failed or was not
    asked), border_name, border_confidence, badge_name, badge_confidence, vision_name. Frames without lines and name
    are dropped; a line taken for the name by its layout is left out of the content. Adds the start of the next frame kept.
    """
    enabled = F.lit(fallback_enabled) if isinstance(fallback_enabled, bool) else fallback_enabled
    d = frames.withColumn("ocr_confidence", ocr.mean_confidence(F.col("page"))).withColumn("page", ocr.after_fallback(F.col("page"), ocr.needs_fallback(F.col("page"), enabled), F.col("fallback")))
    d = d.withColumn("found", ocr.display_name(F.col("border_name"), F.col("border_confidence"), F.col("badge_name"), F.col("badge_confidence"), F.col("page"), F.col("vision_name")))
    d = d.where((F.size("page") > 0) | F.col("found").isNotNull())
    excluded = F.when(F.col("found.source") == "layout_heuristic", ocr.layout_name_index(F.col("page")))
    d = d.withColumn("content", ocr.content(F.col("page"), excluded)).withColumn("slide_id", slide_id(F.col("start_ms") / 1000))
    return next_start(d, "meeting_id", "start_ms", "pos").select("meeting_id", "pos", "slide_id", "start_ms", "end_ms", "frame_path", "content", F.col("found.name").alias("display_name"), F.col("found.source").alias("display_name_source"), "ocr_confidence", F.col("found.confidence").alias("detection_confidence"))


def spaced_words(text: Column) -> Column:
    """The words of a text, each between single blanks."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def _grams(words: Column, least: Column) -> Column:
    """Hashes of all stretches of ``least`` to GRAM words in a row, of each length."""
    def of(n: int) -> Column:
        starts = F.when((F.size(words) >= n) & (least <= n), F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(words, i, n), " ")))

    return F.array_distinct(F.concat(*[of(n) for n in range(1, GRAM + 1)]))


def unsupported_quotes(quotes: DataFrame, transcript: DataFrame) -> DataFrame:
    """Quotes (meeting_id, quote_id, quote) that no segment of their meeting holds word for word.

    Punctuation between words does not matter, case does. Segments are indexed by hashes of their stretches of words. Of
    a quote's longest stretches the one that fewest segments of the meeting hold is looked up, and only the segments that
    hold it are compared, by their text, which is fetched after the match. Quotes without words are unsupported.
    Repeated segments and quotes are looked up once.
    """
    split = lambda c: F.split(F.trim(c), " ")
    q = quotes.select("meeting_id", spaced_words(F.col("quote")).alias("_q")).where("trim(_q) <> ''").distinct()
    segments = transcript.where("text is not null").select("meeting_id", spaced_words(F.col("text")).alias("_t")).where("trim(_t) <> ''").distinct().withColumn("_s", F.xxhash64("_t"))
    held = segments.select("meeting_id", "_s", F.explode(ocr.bound(split(F.col("_t")), lambda w: _grams(w, F.lit(1)))).alias("_h"))
    longest = ocr.bound(split(F.col("_q")), lambda w: _grams(w, F.least(F.size(w), F.lit(GRAM))))
    asked = cut(q.select("meeting_id", F.xxhash64("_q").alias("_k"), F.explode(longest).alias("_h")))
    wanted = cut(held.join(asked.select("meeting_id", "_h").distinct(), ["meeting_id", "_h"], "left_semi"))
    many = wanted.groupBy("meeting_id", "_h").agg(F.count("*").alias("_n"))
    rarest = asked.join(many, ["meeting_id", "_h"], "left").groupBy("meeting_id", "_k").agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("_n"), "_h")).alias("_x")).where("_x._n > 0").select("meeting_id", "_k", F.col("_x._h").alias("_h"))
    met = rarest.join(wanted, ["meeting_id", "_h"]).select("meeting_id", "_k", "_s")
    texts = met.join(q.withColumn("_k", F.xxhash64("_q")), ["meeting_id", "_k"]).join(segments, ["meeting_id", "_s"])
    found = texts.where(F.col("_t").contains(F.col("_q"))).select("meeting_id", "_q").distinct()
    return quotes.select("meeting_id", "quote_id", "quote", spaced_words(F.col("quote")).alias("_q")).join(found, ["meeting_id", "_q"], "left_anti").select("meeting_id", "quote_id", "quote")
