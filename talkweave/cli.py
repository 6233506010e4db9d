"""Command line: one subcommand per stage, and the composites vision, speech and pipeline.

``--models package.module`` names a module with loaders (voice_detector, diarizer, recogniser, page_reader,
vision_model, writer, frame_reader, decode_image); stages that need none run without it. Any error ends with code 1.
"""

from __future__ import annotations

import argparse
import dataclasses
import importlib
import logging
import sys

from talkweave.plans.pipeline import COMPOSITES, STAGES, Models, Run
from talkweave.settings import Layout, Settings

INPUTS = {"scenes_json": "scenes", "vision_json": "frames", "vad_json": "vad_segments", "asr_json": "asr_segments", "turns_json": "speaker_turns", "visual_events_json": "visual_speaker_events", "transcript_json": "transcript", "speaker_map_json": "speaker_names", "timeline_json": "timeline", "wav_path": "wav"}
OPTIONS = {"sample_fps": float, "diff_threshold": float, "duration_sec": float, "max_segment_sec": float, "min_confidence": float, "similarity": float}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="talkweave")
    commands = p.add_subparsers(dest="command", required=True)
    for name in [*STAGES, *COMPOSITES]:
        c = commands.add_parser(name)
        c.add_argument("--output_dir", default="work_dir")
        c.add_argument("--models", default=None)
        c.add_argument("--skip_if_exists", action="store_true")
        c.add_argument("--video_path", default=None, required=name in ("ingest", "scene-detect", "vision", "pipeline"))
        for flag in INPUTS:
            c.add_argument(f"--{flag}", default=None)
        for flag, kind in OPTIONS.items():
            c.add_argument(f"--{flag.replace('_', '-')}", type=kind, default=None)
        c.add_argument("--no-initial-prompt", dest="initial_prompt", action="store_false", default=None)
        c.add_argument("--no-active-speaker-detection", action="store_true")
        c.add_argument("--no-presentation-badge-detection", action="store_true")
        c.add_argument("--llm-provider", choices=["openai", "gemini"], default=None)
        c.add_argument("--model-size", default=None)
        c.add_argument("--device", default=None)
        c.add_argument("--use-openai-api", action="store_true", default=None)
        for f in dataclasses.fields(Layout):
            if f.name.startswith(("border_", "name_", "badge_")) and "area" not in f.name:
                c.add_argument(f"--{f.name.replace('_', '-')}", type=type(f.default), default=None)
    return p


def layout_of(args: argparse.Namespace, settings: Settings) -> Layout:
    """The settings' layout with the command line's values over it."""
    changes = {f.name: v for f in dataclasses.fields(Layout) if (v := getattr(args, f.name, None)) is not None}
    if args.no_active_speaker_detection:
        changes["enable_active_speaker_border"] = False
    if args.no_presentation_badge_detection:
        changes["enable_presentation_badge"] = False
    return dataclasses.replace(settings.layout(), **changes)


def models_of(module: str | None) -> Models:
    if module is None:
        return Models()
    m = importlib.import_module(module)
    return Models(**{f.name: getattr(m, f.name) for f in dataclasses.fields(Models) if hasattr(m, f.name)})


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    try:
        settings = Settings.load(llm_provider=args.llm_provider, whisper_model_size=args.model_size, whisper_device=args.device, use_openai_whisper_api=args.use_openai_api)
        logging.basicConfig(level=settings.log_level)
        if spark is None:
            from pyspark.sql import SparkSession

            spark = SparkSession.builder.appName("talkweave").getOrCreate()
        explicit = {name: v for flag, name in INPUTS.items() if (v := getattr(args, flag)) is not None}
        run = Run(spark, args.output_dir, settings, models_of(args.models), explicit, layout_of(args, settings))
        options = {k: getattr(args, k) for k in [*OPTIONS, "initial_prompt", "video_path"]}
        for path in run.composite(COMPOSITES.get(args.command, [args.command]), skip_if_exists=args.skip_if_exists, **options):
            print(f"Wrote {path}")
        return 0
    except Exception:
        logging.getLogger(__name__).exception("%s failed", args.command)
        return 1


if __name__ == "__main__":
    sys.exit(main())
