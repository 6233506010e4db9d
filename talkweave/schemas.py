"""Schemas of the stored artifacts. Every table also carries meeting_id and pos (arrival order) once it is read."""

from __future__ import annotations

WORD = "struct<start:double,end:double,text:string,probability:double>"
SLIDE_CONTENT = "struct<title:string,bullet_points:array<string>,paragraphs:array<string>,raw_text:string>"
EVIDENCE = "struct<timestamps:array<double>,speakers:array<string>,visual_reference:string>"

#: Table -> (file, field that wraps the rows or None for a bare array or object, row schema).
ARTIFACTS: dict[str, tuple[str, str | None, str]] = {
    "recordings": ("ingestion.json", None, "video_path string, wav_path string, duration_sec double, sample_rate int, channels int"),
    "scenes": ("scenes.json", None, "timestamp double, frame_path string"),
    "frames": ("vision_track.json", "frames", f"slide_id string, start_time double, end_time double, frame_path string, content {SLIDE_CONTENT}, display_name string, display_name_source string, ocr_confidence double, detection_confidence double"),
    "visual_speaker_events": ("visual_speaker_events.json", "events", "start double, end double, display_name string, layout string, signal string, confidence double"),
    "vad_segments": ("vad_segments.json", "segments", "segment_id string, start_s double, duration double"),
    "speaker_turns": ("speaker_turns.json", None, "start double, end double, speaker_id string"),
    "asr_segments": ("asr_segments.json", None, f"segment_id string, start double, end double, text string, words array<{WORD}>, language string"),
    "transcript": ("transcript.json", "segments", "start_s double, end_s double, speaker_id string, text string, language string"),
    "speaker_names": ("speaker_name_map.json", "mapping", "mapping map<string,string>"),
    "timeline": ("fused_timeline.json", "segments", "start double, end double, speaker string, transcript string, language string, slide struct<title:string,ocr_text:array<string>>"),
    "insights": ("insights.json", None, f"summary string, topics array<struct<topic:string,summary:string,evidence:{EVIDENCE}>>, action_items array<struct<task:string,assignee:string,evidence_quote:string>>, llm_provider string, llm_model string"),
}

#: Fields that a stored row must have.
REQUIRED: dict[str, list[str]] = {
    "recordings": ["video_path", "wav_path", "duration_sec"],
    "scenes": ["timestamp", "frame_path"],
    "frames": ["slide_id", "start_time", "frame_path"],
    "visual_speaker_events": ["start", "end", "display_name", "layout", "signal", "confidence"],
    "vad_segments": ["segment_id", "start_s", "duration"],
    "speaker_turns": ["start", "end", "speaker_id"],
    "asr_segments": ["segment_id", "start", "end", "text"],
    "transcript": ["start_s", "end_s", "speaker_id", "text"],
    "timeline": ["start", "end", "speaker", "transcript"],
    "insights": ["summary"],
}
