"""Settings with defaults and bounds; each may be overridden by an environment variable of the same name."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields


@dataclass(frozen=True)
class Layout:
    """Where a conferencing client shows who speaks: a coloured tile border, or a badge at the top right."""

    enable_active_speaker_border: bool = True
    enable_presentation_badge: bool = True
    border_hue_min: int = 35
    border_hue_max: int = 65
    border_sat_min: int = 100
    border_val_min: int = 100
    border_min_area_fraction: float = 0.03
    border_max_area_fraction: float = 0.6
    border_close_kernel_size: int = 5
    name_label_height_fraction: float = 0.18
    name_label_width_fraction: float = 0.65
    badge_top_fraction: float = 0.22
    badge_right_fraction: float = 0.22
    badge_name_height_fraction: float = 0.4


def _bounded(default, low=None, high=None, above=None):
    return field(default=default, metadata={"low": low, "high": high, "above": above})


@dataclass(frozen=True)
class Settings:
    """All settings. ``Settings.load()`` reads the environment anew each time; unknown variables are ignored."""

    log_level: str = "INFO"
    whisper_model_size: str = "large-v3"
    whisper_device: str = "cpu"
    use_openai_whisper_api: bool = False
    huggingface_token: str | None = None
    asr_use_initial_prompt: bool = True
    transcript_max_segment_duration_sec: float = _bounded(120.0, above=0)
    scene_sample_fps: float = _bounded(2.0, above=0)
    scene_diff_threshold: float = _bounded(0.06, 0, 1)
    ocr_gpt4o_fallback: bool = True
    zoom_active_speaker_detection: bool = True
    zoom_presentation_badge_detection: bool = True
    zoom_border_hue_min: int = _bounded(35, 0, 179)
    zoom_border_hue_max: int = _bounded(65, 0, 179)
    zoom_border_sat_min: int = _bounded(100, 0, 255)
    zoom_border_val_min: int = _bounded(100, 0, 255)
    zoom_border_close_kernel_size: int = _bounded(5, 0)
    zoom_name_label_height_fraction: float = _bounded(0.18, high=1, above=0)
    zoom_name_label_width_fraction: float = _bounded(0.65, high=1, above=0)
    zoom_badge_top_fraction: float = _bounded(0.22, high=1, above=0)
    zoom_badge_right_fraction: float = _bounded(0.22, high=1, above=0)
    zoom_badge_name_height_fraction: float = _bounded(0.4, high=1, above=0)
    llm_provider: str = "openai"
    openai_api_key: str | None = None
    openai_model: str = "gpt-4o"
    gemini_api_key: str | None = None
    gemini_model: str = "gemini-3.5-flash"
    speaker_naming_min_confidence: float = _bounded(0.6, 0, 1)
    speaker_naming_name_similarity_threshold: float = _bounded(0.65, 0, 1)

    def __post_init__(self):
        for f in fields(self):
            value, m = getattr(self, f.name), f.metadata
            if m and not ((m["low"] is None or value >= m["low"]) and (m["high"] is None or value <= m["high"]) and (m["above"] is None or value > m["above"])):
                raise ValueError(f"{f.name}={value} is out of bounds")
        if self.llm_provider not in ("openai", "gemini"):
            raise ValueError(f"llm_provider={self.llm_provider}")

    @classmethod
    def load(cls, **overrides) -> "Settings":
        """Defaults, then the environment (names in any case), then ``overrides`` that are not None."""
        env = {k.lower(): v for k, v in os.environ.items()}
        found = {}
        for f in fields(cls):
            if f.name in env:
                text, kind = env[f.name], type(f.default)
                found[f.name] = text.strip().lower() in ("1", "true", "yes", "on") if kind is bool else kind(text) if f.default is not None else text
        return cls(**(found | {k: v for k, v in overrides.items() if v is not None}))

    def layout(self) -> Layout:
        """The layout that the settings describe: each setting whose name ends like a field of it, and two switches."""
        named = {f.name: getattr(self, f"zoom_{f.name}") for f in fields(Layout) if hasattr(self, f"zoom_{f.name}")}
        return Layout(self.zoom_active_speaker_detection, self.zoom_presentation_badge_detection, **named)
