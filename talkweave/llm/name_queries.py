"""Queries of problem 2. Rewriting rules have no SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from talkweave.llm.entities import link_names, variant_pairs
from talkweave.runtime import table


def _linked(spark, folder):
    return link_names(table(spark, folder, "visual_speaker_events").select("meeting_id", "display_name"), "meeting_id", "display_name")


def p2_found(spark, folder):
    """Pairs of spellings of one person or organisation, by meeting."""
    return variant_pairs(_linked(spark, folder), "meeting_id", "display_name")


def p2_entities(spark, folder):
    """Every spelling with its entity, and the number of spellings of that entity."""
    linked = _linked(spark, folder)
    sizes = linked.groupBy("meeting_id", "entity").agg(F.count("*").alias("n_spellings"))
    return linked.join(sizes, ["meeting_id", "entity"]).select("meeting_id", "display_name", "entity", "kind", "n_spellings", "score")


QUERIES = {"p2_found": p2_found, "p2_entities": p2_entities}
SQL: dict = {}
