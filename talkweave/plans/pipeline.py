"""The stages over stored artifacts, from a video to its insights. Every stage reads artifacts and writes one.

A folder holds one meeting; its name is the meeting's id. Models come from an object with loaders (see ``Models``).
"""

from __future__ import annotations

import asyncio
import logging
import os
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkweave import seams
from talkweave.functions import ocr, png
from talkweave.functions.images import badge_box, badge_label_box, crop, highlighted_tile, name_label_box, upscale_for_reading
from talkweave.functions.text import round3, vision_answer
from talkweave.plans import fusion, naming, speech
from talkweave.runtime import cut
from talkweave.settings import Settings
from talkweave.sources import artifacts as A
from talkweave.sources import files, media

log = logging.getLogger(__name__)

#: Stages in order with the artifact that each writes.
STAGES = {"ingest": "recordings", "scene-detect": "scenes", "ocr": "frames", "visual-speaker": "visual_speaker_events", "vad": "vad_segments", "diarize": "speaker_turns", "asr": "asr_segments", "merge": "transcript", "speaker-name": "speaker_names", "fuse": "timeline", "llm": "insights"}


@dataclass
class Models:
    """Loaders of the models that a run uses; a stage whose loader is missing fails with an error."""

    voice_detector: Any = None
    diarizer: Any = None
    recogniser: Any = None
    page_reader: Any = None
    vision_model: Any = None
    writer: Any = None
    frame_reader: Any = None
    decode_image: Any = field(default=media.decode_image)

    def need(self, name: str):
        found = getattr(self, name)
        if found is None:
            raise RuntimeError(f"no {name} is plugged in")
        return found


class Run:
    """One meeting's folder. ``explicit`` maps artifact names to paths used instead of the usual ones."""

    def __init__(self, spark: SparkSession, folder: str, settings: Settings | None = None, models: Models | None = None, explicit: dict | None = None, layout=None):
        self.spark, self.folder = spark, files.absolute(folder)
        self.settings, self.models, self.explicit = settings or Settings.load(), models or Models(), explicit or {}
        self.layout = layout or self.settings.layout()
        self.meeting = os.path.basename(self.folder)

    def path(self, name: str) -> str:
        return A.artifact_path(self.folder, name, self.explicit.get(name))

    def read(self, name: str, optional: bool = False) -> DataFrame:
        if optional and not files.exists(self.path(name)):
            log.warning("%s is missing, going on without it", self.path(name))
        rows = A.read_artifact(self.spark, name, self.path(name), optional)
        return A.checked(rows, name).withColumn("meeting_id", F.lit(self.meeting))

    def stage(self, name: str, skip_if_exists: bool = False, **options) -> str:
        """Run a stage and return the path of what it wrote; an existing result is kept if asked, whatever its age."""
        out = A.artifact_path(self.folder, STAGES[name])
        if skip_if_exists and files.exists(out):
            log.info("%s exists, skipped", out)
            return out
        A.write_artifact(getattr(self, name.replace("-", "_"))(**options), STAGES[name], out)
        return out

    def ingest(self, video_path: str, **_) -> DataFrame:
        return media.ingest(self.spark, [video_path], self.folder).select("video_path", "wav_path", "duration_sec", "sample_rate", "channels")

    def scene_detect(self, video_path: str, sample_fps: float | None = None, diff_threshold: float | None = None, **_) -> DataFrame:
        load, fps = self.models.need("frame_reader"), sample_fps or self.settings.scene_sample_fps
        threshold, folder = diff_threshold or self.settings.scene_diff_threshold, f"{self.folder}/frames"
        videos = self.spark.createDataFrame([(self.meeting, video_path)], "meeting_id string, video_path string")
        keep = lambda reader, r: [(r.meeting_id, n, t, p) for n, t, p in media.kept_frames(reader, r.video_path, fps, threshold, f"{folder}/{r.meeting_id}")]
        # Frames are written while the video is read, so what was kept is materialised before anything reads it again.
        kept = cut(seams.through(videos, "meeting_id string, number bigint, seconds double, frame_path string", load, keep))
        return kept.select((F.col("number") - 1).alias("pos"), round3(F.col("seconds")).alias("timestamp"), "frame_path")

    def ocr(self, **_) -> DataFrame:
        scenes = self.read("scenes").withColumn("start_ms", F.round(F.col("timestamp") * 1000).cast("bigint"))
        pages = seams.read_pages(scenes, self.models.need("page_reader"))
        pages = cut(pages.withColumn("page", ocr.page_lines(F.col("rec_texts"), F.col("rec_scores"), F.col("rec_boxes"), F.col("rec_polys"))))
        enabled = F.lit(self.settings.ocr_gpt4o_fallback and self.models.vision_model is not None)
        crops = self._crop_names(pages)
        # Detectors run in steps, each on the frames that the ones before left over, since a model's call is never free.
        need = pages.where(ocr.needs_fallback(F.col("page"), enabled))
        again = seams.read_again(need, self.models.vision_model) if self.models.vision_model else need.select("meeting_id", "pos", F.lit(None).cast("array<string>").alias("fallback"))
        d = pages.join(again, ["meeting_id", "pos"], "left").join(crops, ["meeting_id", "pos"], "left")
        nameless = d.where(F.col("border_name").isNull() & F.col("badge_name").isNull() & ocr.layout_name_index(ocr.after_fallback(F.col("page"), ocr.needs_fallback(F.col("page"), enabled), F.col("fallback"))).isNull())
        asked = seams.look_for_names(nameless, self.models.vision_model) if self.models.vision_model else nameless.select("meeting_id", "pos", F.lit(None).cast("string").alias("answer"))
        d = d.join(asked.select("meeting_id", "pos", vision_answer(F.col("answer")).alias("vision_name")), ["meeting_id", "pos"], "left")
        s = fusion.slides(d, enabled)
        return s.select("pos", "slide_id", (F.col("start_ms") / 1000).alias("start_time"), (F.col("end_ms") / 1000).alias("end_time"), "frame_path", "content", "display_name", "display_name_source", "ocr_confidence", "detection_confidence")

    def _crop_names(self, pages: DataFrame) -> DataFrame:
        """Names in the border tile's label and in the badge, by reading those crops.

        A crop whose lines are missing or read with low confidence is read again by the vision model, if there is one
        and it may be asked; if that fails its lines stay. The confidence is that of the first reading.
        """
        load, decode, layout = self.models.need("page_reader"), self.models.decode_image, self.layout

        def crops(reader, r):
            frame = decode(files.read_bytes(r.frame_path))
            found = []
            if frame is not None:
                boxes = []
                if layout.enable_active_speaker_border and (tile := highlighted_tile(frame, layout)):
                    boxes.append(("border", name_label_box(tile, layout)))
                if layout.enable_presentation_badge:
                    boxes.append(("badge", badge_label_box(badge_box(*frame.shape[:2], layout), layout)))
                for kind, box in boxes:
                    part = crop(frame, box)
                    if part.size:
                        path = files.write_bytes(f"{r.frame_path.rsplit('.', 1)[0]}_{kind}.png", png.encode(upscale_for_reading(part)))
                        p = reader(path)
                        found.append((r.meeting_id, r.pos, kind, path, p.get("rec_texts", []), p.get("rec_scores", [])))
            return found

        read = seams.through(pages.select("meeting_id", "pos", "frame_path"), "meeting_id string, pos bigint, kind string, frame_path string, texts array<string>, scores array<double>", load, crops)
        nothing = F.lit(None)
        page = ocr.page_lines(F.col("texts"), F.col("scores"), nothing.cast("array<array<double>>"), nothing.cast("array<array<array<double>>>"))
        read = cut(read.withColumn("page", page).withColumn("confidence", ocr.mean_confidence(page)))
        enabled = F.lit(self.settings.ocr_gpt4o_fallback and self.models.vision_model is not None)
        need = ocr.needs_fallback(F.col("page"), enabled)
        if self.models.vision_model is not None:
            again = seams.read_again(read.where(need).select("meeting_id", "pos", "kind", "frame_path"), self.models.vision_model, "kind")
            read = read.join(again, ["meeting_id", "pos", "kind"], "left")
        else:
            read = read.withColumn("fallback", nothing.cast("array<string>"))
        named = read.withColumn("page", ocr.after_fallback(F.col("page"), need, F.col("fallback"))).select("meeting_id", "pos", "kind", ocr.crop_name(F.col("page")).alias("name"), "confidence").where("name is not null")
        pick = lambda kind, c: F.max(F.when(F.col("kind") == kind, F.col(c)))
        return named.groupBy("meeting_id", "pos").agg(pick("border", "name").alias("border_name"), pick("border", "confidence").alias("border_confidence"), pick("badge", "name").alias("badge_name"), pick("badge", "confidence").alias("badge_confidence"))

    def visual_speaker(self, **_) -> DataFrame:
        f = self.read("frames").select("meeting_id", "pos", _ms("start_time").alias("start_ms"), _ms("end_time").alias("end_ms"), "display_name", F.col("display_name_source").alias("source"), F.col("detection_confidence").alias("confidence"))
        e = naming.visual_events(f)
        return e.withColumn("pos", F.row_number().over(_by_time("start_ms"))).select("pos", _s("start_ms").alias("start"), _s("end_ms").alias("end"), "display_name", "layout", "signal", "confidence")

    def vad(self, **_) -> DataFrame:
        return seams.detect_speech(self._recording(), self.models.need("voice_detector")).drop("meeting_id")

    def diarize(self, duration_sec: float | None = None, **_) -> DataFrame:
        r = self._recording()
        if duration_sec is not None:
            r = r.withColumn("duration_sec", F.lit(float(duration_sec)))
        return seams.diarize(r, self.models.need("diarizer")).drop("meeting_id")

    def _recording(self) -> DataFrame:
        if (wav := self.explicit.get("wav")) is not None:
            return self.spark.createDataFrame([(self.meeting, 0, wav, None)], "meeting_id string, pos bigint, wav_path string, duration_sec double")
        return self.read("recordings")

    def asr(self, initial_prompt: bool | None = None, **_) -> DataFrame:
        chunks = self.read("vad_segments").select("meeting_id", "pos", "segment_id", F.col("start_s").alias("start"), F.round(F.col("start_s") + F.col("duration") + 1e-9, 3).alias("end"))
        chunks = chunks.withColumn("end_ms", _ms("end")).join(self._recording().select("meeting_id", "wav_path"), "meeting_id")
        hints = self.settings.asr_use_initial_prompt if initial_prompt is None else initial_prompt
        if hints:
            chunks = fusion.chunk_prompts(chunks, self._slide_frames())
        else:
            chunks = chunks.withColumn("prompt", F.lit(None).cast("string"))
        return seams.recognise(chunks, self.models.need("recogniser")).drop("meeting_id")

    def _slide_frames(self) -> DataFrame:
        return self.read("frames", optional=True).select("meeting_id", "pos", _ms("start_time").alias("start_ms"), F.col("content.title").alias("title"), F.coalesce("content.raw_text", F.lit("")).alias("raw_text"))

    def _turns(self) -> DataFrame:
        return self.read("speaker_turns").select("meeting_id", "pos", _ms("start").alias("start_ms"), _ms("end").alias("end_ms"), "speaker_id")

    def merge(self, max_segment_sec: float | None = None, **_) -> DataFrame:
        u = speech.utterances(speech.units(self.read("asr_segments")), self._turns()).withColumnRenamed("turn_pos", "pos")
        cap = self.settings.transcript_max_segment_duration_sec if max_segment_sec is None else max_segment_sec
        t = speech.transcript(u, round(cap * 1000))
        return t.withColumn("pos", F.row_number().over(_by_time("start_ms"))).select("pos", _s("start_ms").alias("start_s"), _s("end_ms").alias("end_s"), "speaker_id", "text", "language")

    def speaker_name(self, min_confidence: float | None = None, similarity: float | None = None, **_) -> DataFrame:
        e = self.read("visual_speaker_events", optional=True).select("meeting_id", "pos", _ms("start").alias("start_ms"), _ms("end").alias("end_ms"), "display_name", "confidence")
        s = self.settings
        n = naming.speaker_names(self._turns(), e, s.speaker_naming_min_confidence if min_confidence is None else min_confidence, s.speaker_naming_name_similarity_threshold if similarity is None else similarity)
        return n.withColumn("pos", F.row_number().over(_by_time("speaker_id"))).select("pos", "speaker_id", "name")

    def fuse(self, **_) -> DataFrame:
        t = self.read("transcript").select("meeting_id", "pos", _ms("start_s").alias("start_ms"), _ms("end_s").alias("end_ms"), "speaker_id", "text", "language")
        names = self.read("speaker_names") if files.exists(self.path("speaker_names")) else None
        d = fusion.timeline(t, self._slide_frames(), names)
        return d.withColumn("pos", F.row_number().over(_by_time("start_ms", "pos"))).select("pos", _s("start_ms").alias("start"), _s("end_ms").alias("end"), "speaker", "transcript", "language", "slide")

    def llm(self, **_) -> DataFrame:
        t = self.read("timeline")
        line = F.struct("pos", F.struct("start", "end", "speaker", "transcript", "language", "slide").alias("s"))
        doc = F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["s"]).alias("segments")))
        return seams.enrich(t.groupBy("meeting_id").agg(doc.alias("timeline_json")), self.models.need("writer")).drop("meeting_id")

    def composite(self, names: list[str], **options) -> list[str]:
        return [self.stage(n, **options) for n in names]

    async def stage_async(self, name: str, **options) -> str:
        """``stage`` beside other work; Spark runs the jobs of several threads together."""
        return await asyncio.to_thread(self.stage, name, **options)

    async def composite_async(self, names: list[str], **options) -> list[str]:
        """``composite`` beside other work, such as the speech track beside the vision track."""
        return await asyncio.to_thread(self.composite, names, **options)


#: Stages that run several others.
COMPOSITES = {"vision": ["scene-detect", "ocr"], "speech": ["vad", "diarize", "asr", "merge"], "pipeline": list(STAGES)}


def _ms(column: str):
    return F.round(F.col(column) * 1000).cast("bigint")


def _s(column: str):
    return F.round(F.col(column) / 1000, 3)


def _by_time(*order: str):
    from pyspark.sql import Window

    return Window.partitionBy("meeting_id").orderBy(*order)
