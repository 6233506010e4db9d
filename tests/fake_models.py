"""Loaders of deterministic stand-ins for every model, for the command line tests."""

import numpy as np


class _Reader:
    def fps(self, path):
        return 4.0

    def frames(self, path, every):
        for i in range(0, 12, every):
            with open("/tmp/talkweave-frames-read.txt", "a") as f:
                f.write(f"{i}\n")
            frame = np.full((360, 640, 3), 0 if i < 6 else 200, np.uint8)
            frame[40:240, 100:420] = (0, 255, 0)  # a tile with a green border
            frame[44:236, 104:416] = 30
            yield i, frame


class _Vision:
    def read_lines(self, path):
        if path.endswith("_badge.png"):
            return ["12", "Bo Chen"]
        raise OSError("no network")

    def read_name(self, path):
        return "NONE"


class _Writer:
    provider, model = "fake", "fake-1"

    def __call__(self, timeline):
        return {"summary": f"{len(timeline)} characters", "topics": [{"topic": "t", "summary": "s", "evidence": {"timestamps": [0.0], "speakers": ["Ana Lima"], "visual_reference": None}}], "action_items": []}


def page_reader():
    def read(path):
        if path.endswith("_border.png"):
            return {"rec_texts": ["Ana Lima"], "rec_scores": [0.8]} if "frame_00001" in path else {}
        if path.endswith("_badge.png"):
            return {"rec_texts": ["B0 Ch"], "rec_scores": [0.2]}
        return {"rec_texts": ["Quarter results", "- first point"], "rec_scores": [0.9, 0.95]}

    return read


frame_reader = _Reader
vision_model = _Vision
writer = _Writer


def voice_detector():
    return lambda wav: [(0, 16000), (24000, 40000)]


def diarizer():
    return lambda wav: [(0.0, 1.0, "B"), (1.5, 2.5, "A")]


def recogniser():
    return lambda wav, start, end, prompt: {"text": "hello there", "language": "en", "words": [(0.0, 0.4, "hello", 0.9), (0.4, 0.9, "there", 0.8)]}
