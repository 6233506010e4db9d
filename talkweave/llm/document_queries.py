"""Queries of problem 8. Their result comes from trained models, so they have no SQL."""

from __future__ import annotations

from talkweave.llm.truncation import cut_rates, score_endings
from talkweave.runtime import table


def _scored(spark, folder):
    return score_endings(table(spark, folder, "documents"), "doc_id", "text", "lang")


def p8_found(spark, folder):
    """Documents whose text was cut off."""
    return _scored(spark, folder).where("is_cut").select("doc_id").distinct()


def p8_rates(spark, folder):
    """For every source its rows, how many of them were cut, and their share."""
    return cut_rates(_scored(spark, folder), table(spark, folder, "documents"), "doc_id", "source")


QUERIES = {"p8_found": p8_found, "p8_rates": p8_rates}
SQL: dict = {}
