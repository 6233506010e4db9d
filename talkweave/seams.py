"""Where models plug in. Each seam is a small protocol; a table goes through it in batches, one model per Python worker.

The package brings no models. ``Fake`` implementations answer from what they are given, for tests and dry runs.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkweave.functions.text import segment_id, speaker_label
from talkweave.operators.sequence import first_appearance


class VoiceDetector(Protocol):
    def __call__(self, wav_path: str) -> list[tuple[int, int]]:
        """Speech as ranges of samples."""


class Diarizer(Protocol):
    def __call__(self, wav_path: str) -> list[tuple[float, float, str]]:
        """Turns as start, end and the model's own label."""


class Recogniser(Protocol):
    def __call__(self, wav_path: str, start: float, end: float, prompt: str | None) -> dict | None:
        """text, language and words (start, end, text, probability, relative to the chunk); null for an empty chunk."""


class PageReader(Protocol):
    def __call__(self, image_path: str) -> dict:
        """rec_texts, rec_scores and, if known, rec_boxes and rec_polys."""


class VisionModel(Protocol):
    def read_lines(self, image_path: str) -> list[str]: ...

    def read_name(self, image_path: str) -> str | None: ...


class Writer(Protocol):
    provider: str
    model: str

    def __call__(self, timeline_json: str) -> dict:
        """summary, topics and action_items of a meeting."""


def through(rows: DataFrame, schema: str, load: Callable, answer: Callable) -> DataFrame:
    """Rows through a model: ``load()`` once per worker, ``answer(model, row) -> list of output tuples`` per row."""

    def run(batches):
        model = load()
        names = [c.strip().split(" ")[0] for c in _top_level(schema)]
        for b in batches:
            out = [t for row in b.itertuples(index=False) for t in answer(model, row)]
            yield pd.DataFrame(out, columns=names)

    return rows.mapInPandas(run, schema)


def _top_level(ddl: str) -> list[str]:
    parts, depth, part = [], 0, ""
    for c in ddl:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            parts.append(part)
            part = ""
        else:
            part += c
    return [*parts, part]


def detect_speech(recordings: DataFrame, load: Callable[[], VoiceDetector], rate: int = 16000) -> DataFrame:
    """Recordings -> vad_segments with self-describing ids."""
    ranges = through(recordings.select("meeting_id", "wav_path"), "meeting_id string, pos bigint, first bigint, last bigint", load, lambda model, r: [(r.meeting_id, i, a, b) for i, (a, b) in enumerate(model(r.wav_path))])
    s, e = F.col("first") / rate, F.col("last") / rate
    return ranges.select("meeting_id", "pos", segment_id(s, e).alias("segment_id"), F.round(s + 1e-9, 3).alias("start_s"), F.round(e - s + 1e-9, 3).alias("duration"))


def diarize(recordings: DataFrame, load: Callable[[], Diarizer]) -> DataFrame:
    """Recordings -> turns labelled Speaker_00, Speaker_01, ... by first appearance.

    A recording on which the model fails or finds nothing gets one turn of Speaker_00 over its whole duration.
    """

    def answer(model, r):
        try:
            turns = model(r.wav_path)
        except Exception:
            turns = []
        whole = float(r.duration_sec) if pd.notna(r.duration_sec) else 0.0
        return [(r.meeting_id, i, float(s), float(e), x) for i, (s, e, x) in enumerate(turns)] or [(r.meeting_id, 0, 0.0, whole, "only")]

    def safe_load():
        try:
            return load()
        except Exception:
            return lambda wav: []

    raw = through(recordings.select("meeting_id", "wav_path", "duration_sec"), "meeting_id string, pos bigint, start double, end double, label string", safe_load, answer)
    ranked = first_appearance(raw, "meeting_id", "label", ["pos"])
    return raw.join(ranked, ["meeting_id", "label"]).select("meeting_id", "pos", F.round(F.col("start") + 1e-9, 3).alias("start"), F.round(F.col("end") + 1e-9, 3).alias("end"), speaker_label(F.col("rank")).alias("speaker_id"))


def recognise(chunks: DataFrame, load: Callable[[], Recogniser]) -> DataFrame:
    """Chunks (meeting_id, pos, wav_path, segment_id, start, end, prompt) -> asr_segments; chunks without samples are left out."""
    word = "struct<start:double,end:double,text:string,probability:double>"

    def answer(model, r):
        found = model(r.wav_path, r.start, r.end, r.prompt)
        if found is None:
            return []
        words = [{"start": round(round(w[0], 3) + r.start, 3), "end": round(round(w[1], 3) + r.start, 3), "text": w[2], "probability": w[3]} for w in found.get("words", [])]
        return [(r.meeting_id, r.pos, r.segment_id, r.start, r.end, found["text"], words, found.get("language"))]

    return through(chunks.select("meeting_id", "pos", "wav_path", "segment_id", "start", "end", "prompt"), f"meeting_id string, pos bigint, segment_id string, start double, end double, text string, words array<{word}>, language string", load, answer)


def read_pages(scenes: DataFrame, load: Callable[[], PageReader]) -> DataFrame:
    """Scenes -> rec_texts, rec_scores, rec_boxes, rec_polys of each frame."""

    def answer(model, r):
        p = model(r.frame_path)
        return [(r.meeting_id, r.pos, r.start_ms, r.frame_path, p.get("rec_texts", []), p.get("rec_scores", []), p.get("rec_boxes"), p.get("rec_polys"))]

    return through(scenes.select("meeting_id", "pos", "start_ms", "frame_path"), "meeting_id string, pos bigint, start_ms bigint, frame_path string, rec_texts array<string>, rec_scores array<double>, rec_boxes array<array<double>>, rec_polys array<array<array<double>>>", load, answer)


def read_again(frames: DataFrame, load: Callable[[], VisionModel], *more: str) -> DataFrame:
    """(meeting_id, pos, more keys, fallback) for images that need it: a failed call gives null, so they keep their lines."""

    def answer(model, r):
        key = (r.meeting_id, r.pos, *[getattr(r, c) for c in more])
        try:
            return [(*key, list(model.read_lines(r.frame_path)))]
        except Exception:
            return [(*key, None)]

    keys = ", ".join(["meeting_id string", "pos bigint", *[f"{c} string" for c in more]])
    return through(frames.select("meeting_id", "pos", *more, "frame_path"), f"{keys}, fallback array<string>", load, answer)


def look_for_names(frames: DataFrame, load: Callable[[], VisionModel]) -> DataFrame:
    """(meeting_id, pos, answer) for frames whose name no detector found; a failed call gives null."""

    def answer(model, r):
        try:
            return [(r.meeting_id, r.pos, model.read_name(r.frame_path))]
        except Exception:
            return [(r.meeting_id, r.pos, None)]

    return through(frames.select("meeting_id", "pos", "frame_path"), "meeting_id string, pos bigint, answer string", load, answer)


INSTRUCTION = "Use only what the timeline says. Connect speech with the slides shown. Answer in the language of the meeting. Quote evidence word for word."


def enrich(timelines: DataFrame, load: Callable[[], Writer], attempts: int = 3, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """Timelines (meeting_id, timeline_json) -> insights, stamped with provider and model.

    A call is tried ``attempts`` times with growing pauses of 1 to 10 seconds; the last error is raised.
    """

    def answer(model, r):
        for attempt in range(attempts):
            try:
                found = model(r.timeline_json)
                if not found:
                    raise ValueError("the model gave no answer")
                break
            except Exception:
                if attempt == attempts - 1:
                    raise
                wait(min(10.0, max(1.0, 2.0**attempt)))
        return [(r.meeting_id, found.get("summary"), json.dumps(found.get("topics", []), ensure_ascii=False), json.dumps(found.get("action_items", []), ensure_ascii=False), model.provider, model.model)]

    from talkweave.schemas import ARTIFACTS

    raw = through(timelines.select("meeting_id", "timeline_json"), "meeting_id string, summary string, topics string, action_items string, llm_provider string, llm_model string", load, answer)
    parts = {p.strip().split(" ", 1)[0]: p.strip().split(" ", 1)[1] for p in _top_level(ARTIFACTS["insights"][2])}
    return raw.withColumn("topics", F.from_json("topics", parts["topics"])).withColumn("action_items", F.from_json("action_items", parts["action_items"]))


@dataclass
class FakeModel:
    """Answers from a table by the first argument; raises for keys marked with an exception."""

    answers: dict = field(default_factory=dict)
    provider: str = "fake"
    model: str = "fake-1"

    def __call__(self, key, *rest):
        return self._get(key if not rest else (key, *rest[:2]) if (key, *rest[:2]) in self.answers else key)

    def _get(self, key):
        found = self.answers.get(key)
        if isinstance(found, Exception):
            raise found
        return found if found is not None or key in self.answers else []

    read_lines = read_name = _get
