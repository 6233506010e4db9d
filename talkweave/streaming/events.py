"""Frames as a stream: visual speaker events are emitted as soon as later frames show that they have ended."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from talkweave.functions.text import LAYOUT_BY_SIGNAL, SIGNAL_CONFIDENCE

FRAMES = "meeting_id string, pos bigint, start_ms bigint, end_ms bigint, display_name string, source string, confidence double"
EVENTS = "meeting_id string, start_ms bigint, end_ms bigint, display_name string, layout string, signal string, confidence double, n_frames bigint"
_STATE = "start_ms bigint, end_ms bigint, display_name string, signal string, total double, n bigint"


def _close(meeting: str, s: tuple) -> tuple:
    start, end, name, signal, total, n = s
    confidence = 0.5 * total / n + 0.3 * SIGNAL_CONFIDENCE[signal] + 0.2 * min(1.0, n / 3)
    return meeting, start, end, name, LAYOUT_BY_SIGNAL[signal], signal, round(confidence + 1e-9, 3), n


def step(meeting: str, open_event: tuple | None, frames: pd.DataFrame) -> tuple[tuple | None, list[tuple]]:
    """The open event after more frames, in order of time, and the events that they closed."""
    done = []
    for f in frames.sort_values(["start_ms", "pos"]).itertuples():
        end = int(f.end_ms) if not pd.isna(f.end_ms) else int(f.start_ms) + 1000
        confidence = 0.0 if pd.isna(f.confidence) else float(f.confidence)
        counts = f.source in LAYOUT_BY_SIGNAL and bool(f.display_name) and not pd.isna(f.display_name)
        if open_event and counts and open_event[2] == f.display_name and open_event[3] == f.source and f.start_ms <= open_event[1]:
            open_event = (open_event[0], end, open_event[2], open_event[3], open_event[4] + confidence, open_event[5] + 1)
            continue
        if open_event:
            done.append(_close(meeting, open_event))
        open_event = (int(f.start_ms), end, f.display_name, f.source, confidence, 1) if counts else None
    return open_event, done


def visual_events_stream(frames: DataFrame, idle_ms: int = 60_000) -> DataFrame:
    """A streaming DataFrame of frames (FRAMES) -> closed events, in append mode.

    One open event is held per meeting. A meeting without frames for ``idle_ms`` of processing time closes its event.
    Frames of a meeting must arrive in order of time from batch to batch; inside a batch they are sorted.
    """

    def update(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        meeting = key[0]
        held = tuple(state.get) if state.exists else None
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([_close(meeting, held)] if held else [], columns=[c.split()[0] for c in EVENTS.split(", ")])
            return
        held, done = step(meeting, held, pd.concat(list(batches)))
        if held:
            state.update(held)
            state.setTimeoutDuration(idle_ms)
        elif state.exists:
            state.remove()
        yield pd.DataFrame(done, columns=[c.split()[0] for c in EVENTS.split(", ")])

    return frames.select(*[F.col(c.split()[0]) for c in FRAMES.split(", ")]).groupBy("meeting_id").applyInPandasWithState(update, EVENTS, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def talk_time_stream(turns: DataFrame, window: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """A streaming DataFrame of turns (meeting_id, speaker_id, ts, start_ms, end_ms) -> speech per speaker and tumbling
    window of event time; rows later than the watermark are dropped, repeated rows counted once."""
    d = turns.withWatermark("ts", late).dropDuplicates(["meeting_id", "speaker_id", "ts", "start_ms", "end_ms"])
    return d.groupBy(F.window("ts", window), "meeting_id", "speaker_id").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("speech_ms"), F.count("*").alias("n_turns"))
