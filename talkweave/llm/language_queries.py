"""Queries of problem 1. Their result comes from trained models, so they have no SQL."""

from __future__ import annotations

from talkweave.llm.language import detect, relabelled, wrong_labels
from talkweave.runtime import table

_KEYS = ["meeting_id", "pos"]


def _stretches(spark, folder):
    rows = table(spark, folder, "transcript").select(*_KEYS, "text", "language")
    return detect(rows, _KEYS, "text", "language")


def p1_found(spark, folder):
    """Languages of the rows that are mixed or whose label is missing or wrong."""
    return wrong_labels(_stretches(spark, folder), _KEYS)


def p1_rows(spark, folder):
    """Main language, its confidence and all languages present, for each row; 'und' for rows without words."""
    return relabelled(table(spark, folder, "transcript"), _stretches(spark, folder), _KEYS)


def p1_stretches(spark, folder):
    """Each stretch of one language inside a sentence, with offsets and confidence."""
    return _stretches(spark, folder).select(*_KEYS, "seq", "first", "last", "n_words", "lang", "confidence").distinct()


QUERIES = {"p1_found": p1_found, "p1_rows": p1_rows, "p1_stretches": p1_stretches}
SQL: dict = {}
