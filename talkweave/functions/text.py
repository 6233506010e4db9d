"""Column functions on text, numbers and geometry."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns and constants that results depend on.
NAME_LINE = r"^(?:(?:Dr|Mr|Ms|Mrs)\.?\s+)?[A-Z][a-z]+(?:\s+[A-Z]\.)?\s+[A-Z][a-z]+(?:\s+[A-Z][a-z]+)?$"
NAME_LINE_MAX_WORDS = 4
BULLET_PREFIX = r"(?U)^(?:[•‣◦⁃∙*\-]|\d+[.)]|[a-zA-Z][.)])\s+"
PARAGRAPH_WORDS = 8
LINE_BREAK = r"(?:\r\n|[\n\r\x0B\x0C\x1C\x1D\x1E\x{85}\x{2028}\x{2029}])"
LAYOUT_BY_SIGNAL = {"active_speaker_border": "gallery_view", "presentation_badge": "shared_screen"}
SIGNAL_CONFIDENCE = {"active_speaker_border": 0.85, "presentation_badge": 0.65}

_SPACE = r"[\s\x1C-\x1F]"


def round3(x: Column) -> Column:
    """Three decimals; the tiny shift makes ties round alike in every engine."""
    return F.round(x + 1e-9, 3)


@F.pandas_udf(T.DoubleType())
def round3_exact(x: pd.Series) -> pd.Series:
    """Three decimals of the exact binary value, ties to even, as Python rounds. Arrow-batched; use where it must agree."""
    return x.map(lambda v: round(v, 3) if v == v and v is not None else v)


def strip(t: Column) -> Column:
    """Without white space at both ends, all of Unicode's."""
    return F.regexp_replace(t, rf"(?U)^{_SPACE}+|{_SPACE}+\z", "")


def words(t: Column) -> Column:
    """The stretches without white space."""
    return F.filter(F.split(t, rf"(?U){_SPACE}+"), lambda w: w != "")


def lines(t: Column) -> Column:
    """The lines of a text, as Python splits them: none of an empty text, no empty one at the end."""
    cut = F.split(F.regexp_replace(t, LINE_BREAK + r"\z", ""), LINE_BREAK, -1)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(cut)


def is_name_shaped(t: Column) -> Column:
    """A short line like 'Dr. First M. Last'."""
    s = strip(t)
    return (F.size(words(s)) <= NAME_LINE_MAX_WORDS) & s.rlike(NAME_LINE)


def has_letter(t: Column) -> Column:
    return t.rlike(r"\p{L}")


def is_bullet(t: Column) -> Column:
    """Starts with a bullet or number, or has few words."""
    return t.rlike(BULLET_PREFIX) | (F.size(words(t)) <= PARAGRAPH_WORDS)


def without_marker(t: Column) -> Column:
    return strip(F.regexp_replace(t, BULLET_PREFIX, ""))


def prompt(hints: Column) -> Column:
    """Hints joined by commas, each once in order, without blanks; null if nothing is left."""
    clean = F.filter(F.transform(hints, strip), lambda h: h.isNotNull() & (h != ""))
    return F.nullif(F.array_join(F.array_distinct(clean), ", "), F.lit(""))


def segment_id(start_s: Column, end_s: Column) -> Column:
    """seg_SSSSSS-EEEEEE in hundredths of a second, half to even."""
    return F.format_string("seg_%06d-%06d", F.bround(start_s * 100, 0).cast("long"), F.bround(end_s * 100, 0).cast("long"))


def slide_id(start_s: Column) -> Column:
    return F.format_string("slide_%06d", F.bround(start_s * 100, 0).cast("long"))


def speaker_label(rank: Column) -> Column:
    return F.format_string("Speaker_%02d", rank)


def samples_to_seconds(sample: Column, rate: int = 16000) -> Column:
    return sample / rate


def audio_slice(samples: Column, start_s: Column, end_s: Column, rate: int = 16000) -> Column:
    """Samples from start to end, both cut down to whole samples; null if there are none."""
    first, last = (start_s * rate).cast("int"), F.least((end_s * rate).cast("int"), F.size(samples))
    return F.when(last > first, F.slice(samples, first + 1, F.greatest(last - first, F.lit(0))))


def shift_words(word_list: Column, offset: Column) -> Column:
    """Words with times relative to their chunk -> absolute; rounded before and after."""
    return F.transform(word_list, lambda w: F.struct(round3(round3(w["start"]) + offset).alias("start"), round3(round3(w["end"]) + offset).alias("end"), w["text"].alias("text"), w["probability"].alias("probability")))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """How much two intervals share; 0 if they only touch or lie apart."""
    return F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0))


def box_of(quad: Column) -> Column:
    """Bounding box (left, top, width, height) of a polygon's points."""
    x, y = F.transform(quad, lambda p: p[0]), F.transform(quad, lambda p: p[1])
    return F.struct(F.array_min(x).alias("left"), F.array_min(y).alias("top"), (F.array_max(x) - F.array_min(x)).alias("width"), (F.array_max(y) - F.array_min(y)).alias("height"))


def layout_of(signal: Column) -> Column:
    return F.create_map(*[F.lit(x) for p in LAYOUT_BY_SIGNAL.items() for x in p])[signal]


def confidence_of(signal: Column) -> Column:
    return F.create_map(*[F.lit(x) for p in SIGNAL_CONFIDENCE.items() for x in p])[signal]


def event_confidence(mean_detection: Column, signal: Column, n: Column) -> Column:
    """Half the mean detection confidence, three tenths the signal's, two tenths how far three frames agree."""
    return round3(0.5 * mean_detection + 0.3 * confidence_of(signal) + 0.2 * F.least(F.lit(1.0), n / 3.0))


def badge_geometry(width: Column, height: Column, layout) -> Column:
    """Badge box and its name strip for a frame size: x, y, w, h, label_y, label_h."""
    w, h = F.floor(width * layout.badge_right_fraction).cast("int"), F.floor(height * layout.badge_top_fraction).cast("int")
    label = F.greatest(F.lit(1), F.floor(h * layout.badge_name_height_fraction).cast("int"))
    return F.struct((width - w).alias("x"), F.lit(0).alias("y"), w.alias("w"), h.alias("h"), (h - label).alias("label_y"), label.alias("label_h"))


def tile_label_geometry(x: Column, y: Column, w: Column, h: Column, layout) -> Column:
    """The name's box at the bottom left of a tile."""
    label_h = F.greatest(F.lit(1), F.floor(h * layout.name_label_height_fraction).cast("int"))
    label_w = F.greatest(F.lit(1), F.floor(w * layout.name_label_width_fraction).cast("int"))
    top = F.greatest(F.lit(0), y + h - label_h)
    return F.struct(x.alias("x"), top.alias("y"), label_w.alias("w"), (y + h - top).alias("h"))


def vision_answer(t: Column) -> Column:
    """A model's answer for a name: null if blank, 'none' in any case, or without a letter."""
    s = strip(t)
    return F.when((s != "") & (F.upper(s) != "NONE") & has_letter(s), s)
