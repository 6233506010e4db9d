"""Column functions on the lines that a text recogniser finds in a frame.

A line is struct(text, confidence, left, top, width, height); a page is an array of lines in reading order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from talkweave.functions.text import box_of, has_letter, is_bullet, is_name_shaped, strip, without_marker

LINE = "struct<text:string,confidence:double,left:double,top:double,width:double,height:double>"
#: Pages read with less confidence than this are read again by the fallback.
LOW_CONFIDENCE = 0.5
#: Lines of at least this share of the greatest height may be the title.
TITLE_SHARE = 0.7


def bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row, not once for every element that ``body`` goes through."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def page_lines(texts: Column, scores: Column, boxes: Column, polygons: Column) -> Column:
    """Lines of a recogniser's parallel arrays; the shorter of texts and scores counts, blank texts are dropped.

    A line's box comes from ``boxes`` (left, top, right, bottom), else from ``polygons``, else it is one unit high at
    the line's position among all lines.
    """
    n = F.least(F.size(texts), F.size(scores))
    indexed = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.struct(i.alias("i"), strip(F.get(texts, i)).alias("text"), F.get(scores, i).alias("confidence")))).otherwise(F.array())

    def line(x):
        b, p = F.get(boxes, x["i"]), F.get(polygons, x["i"])
        box = box_of(p)
        i = x["i"].cast("double")
        pick = lambda from_box, from_polygon, made: F.when(b.isNotNull(), from_box).when(p.isNotNull(), from_polygon).otherwise(made)
        return F.struct(
            x["text"].alias("text"),
            x["confidence"].alias("confidence"),
            pick(b[0], box["left"], F.lit(0.0)).alias("left"),
            pick(b[1], box["top"], i).alias("top"),
            pick(b[2] - b[0], box["width"], F.lit(0.0)).alias("width"),
            pick(b[3] - b[1], box["height"], F.lit(1.0)).alias("height"),
        )

    return F.transform(F.filter(indexed, lambda x: x["text"] != ""), line)


def plain_lines(texts: Column) -> Column:
    """Lines of texts alone: sure, one unit high, at their position."""
    return F.transform(texts, lambda t, i: F.struct(t.alias("text"), F.lit(1.0).alias("confidence"), F.lit(0.0).alias("left"), i.cast("double").alias("top"), F.lit(0.0).alias("width"), F.lit(1.0).alias("height")))


def mean_confidence(page: Column) -> Column:
    """Mean confidence of a page's lines, whatever their order; null without lines, null confidences do not count.

    Confidences are added as decimals: sums of doubles depend on the order, which tips means that are ties or at a limit.
    Only those that decimals cannot hold (10^12 and more, infinite, not a number) are added as doubles.
    """
    known = F.filter(F.transform(page, lambda x: x["confidence"].cast("double")), lambda c: c.isNotNull())
    exact = F.aggregate(known, F.lit(0).cast("decimal(37,18)"), lambda acc, c: (acc + c.try_cast("decimal(30,18)")).cast("decimal(37,18)"))
    total = F.aggregate(known, F.lit(0.0), lambda acc, c: acc + c)
    return F.when(F.size(known) > 0, F.coalesce((exact / F.size(known)).cast("double"), total / F.size(known)))


def title_index(page: Column) -> Column:
    """Position from 0 of the first line that is nearly as high as the highest; null without lines."""
    tallest = F.array_max(F.transform(page, lambda x: x["height"]))

    def first(top: Column) -> Column:
        at = F.transform(page, lambda x, i: F.when(x["height"] >= TITLE_SHARE * top, i))
        return F.get(F.filter(at, lambda i: i.isNotNull()), F.lit(0))

    return bound(tallest, first)


def layout_name_index(page: Column) -> Column:
    """Position of the first name-shaped line that is not the title; null if there is none."""

    def first(title: Column) -> Column:
        at = F.transform(page, lambda x, i: F.when(is_name_shaped(x["text"]) & (i != title), i))
        return F.get(F.filter(at, lambda i: i.isNotNull()), F.lit(0))

    return bound(title_index(page), first)


def crop_name(page: Column) -> Column:
    """The first line with a letter, of the lines read in a crop."""
    return F.get(F.filter(F.transform(page, lambda x: strip(x["text"])), has_letter), F.lit(0))


def needs_fallback(page: Column, enabled: Column, mean: Column | None = None) -> Column:
    """Whether a page is to be read again: nothing found, or mean confidence too low. ``mean`` stands for the page's own, if given."""
    mean = mean_confidence(page) if mean is None else mean
    return enabled & ((F.size(page) == 0) | (F.coalesce(mean, F.lit(0.0)) < LOW_CONFIDENCE))


def after_fallback(page: Column, tried: Column, answer: Column) -> Column:
    """The page after the fallback was ``tried``: its ``answer``, even an empty one; a null answer failed and keeps the page."""
    return F.when(tried & answer.isNotNull(), plain_lines(answer)).otherwise(page)


def content(page: Column, excluded: Column) -> Column:
    """struct(title, bullet_points, paragraphs, raw_text): lines sorted by kind, without the title and the line at
    ``excluded`` (a position, may be null). raw_text has all lines. A page without lines has no title and empty parts."""

    def sorted_out(place: Column) -> Column:
        title = place["title"]
        rest = F.filter(F.transform(page, lambda x, i: F.struct(x["text"].alias("t"), i.alias("i"))), lambda x: (x["i"] != title) & F.coalesce(x["i"] != place["excluded"], F.lit(True)))
        marked = F.transform(rest, lambda x: F.struct(x["t"].alias("t"), is_bullet(x["t"]).alias("b")))
        return F.struct(
            F.get(F.transform(page, lambda x: x["text"]), title).alias("title"),
            F.transform(F.filter(marked, lambda x: x["b"]), lambda x: without_marker(x["t"])).alias("bullet_points"),
            F.transform(F.filter(marked, lambda x: ~x["b"]), lambda x: x["t"]).alias("paragraphs"),
            F.coalesce(F.array_join(F.transform(page, lambda x: x["text"]), "\n"), F.lit("")).alias("raw_text"),
        )

    return bound(F.struct(title_index(page).alias("title"), excluded.cast("int").alias("excluded")), sorted_out)


def display_name(border_name: Column, border_confidence: Column, badge_name: Column, badge_confidence: Column, page: Column, vision_name: Column) -> Column:
    """struct(name, confidence, source) by the first detector that found a name: border, badge, layout, vision model."""
    at = layout_name_index(page)
    line = F.get(page, at)
    found = lambda name, confidence, source: F.when(name.isNotNull(), F.struct(name.alias("name"), confidence.cast("double").alias("confidence"), F.lit(source).alias("source")))
    return F.coalesce(
        found(border_name, border_confidence, "active_speaker_border"),
        found(badge_name, badge_confidence, "presentation_badge"),
        found(strip(line["text"]), line["confidence"], "layout_heuristic"),
        found(vision_name, F.lit(None).cast("double"), "gpt4o_vision"),
    )
