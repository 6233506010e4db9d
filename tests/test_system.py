"""Settings, images, media, seams, streaming and the command line."""

import io
import json
import os
import pathlib
import sys
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from talkweave import cli, seams
from talkweave.functions import images as I
from talkweave.plans.naming import visual_events
from talkweave.settings import Layout, Settings
from talkweave.functions import png
from talkweave.sources import files, media
from talkweave.streaming import events as S

HERE = os.path.dirname(__file__)


def test_settings(monkeypatch):
    assert Settings.load().scene_sample_fps == 2.0
    monkeypatch.setenv("SCENE_SAMPLE_FPS", "0.5")
    monkeypatch.setenv("zoom_border_hue_min", "20")
    monkeypatch.setenv("OCR_GPT4O_FALLBACK", "false")
    s = Settings.load()
    assert s.scene_sample_fps == 0.5 and s.layout().border_hue_min == 20 and not s.ocr_gpt4o_fallback
    for bad in ({"scene_diff_threshold": 1.5}, {"scene_sample_fps": 0}, {"llm_provider": "other"}):
        with pytest.raises(ValueError):
            Settings(**bad)


def test_highlighted_tile_and_labels():
    frame = np.zeros((200, 200, 3), np.uint8)
    frame[40:120, 50:130] = (0, 255, 0)
    frame[44:116, 54:126] = 0
    frame[70:73, 50:54] = 0  # a gap in the outline
    frame[5:8, 5:8] = (0, 255, 0)  # noise
    tile = I.highlighted_tile(frame, Layout())
    assert tile == (50, 40, 80, 80)
    assert I.name_label_box(tile, Layout()) == (50, 106, 52, 14) and I.crop(frame, tile).shape == (80, 80, 3)
    assert I.highlighted_tile(np.zeros((20, 20, 3), np.uint8), Layout()) is None
    full = np.full((50, 50, 3), (0, 255, 0), np.uint8)
    assert I.highlighted_tile(full, Layout()) is None
    assert I.badge_box(100, 200, Layout()) == (156, 0, 44, 22) and I.badge_label_box((156, 0, 44, 22), Layout()) == (156, 14, 44, 8)


def test_a_part_inside_a_hole_is_no_outer_part():
    mask = np.zeros((12, 12), bool)
    mask[1:11, 1:11] = True
    mask[2:10, 2:10] = False
    mask[5:7, 5:7] = True
    assert I.outer_boxes(mask) == [(1, 1, 10, 10)]
    assert I.close_gaps(mask, 0) is mask


def test_differences_and_sizes():
    a, b = np.zeros((30, 30), np.uint8), np.zeros((30, 30), np.uint8)
    b[:10, :10] = 255
    assert I.whole_difference(a, b) == pytest.approx(1 / 9) and I.regional_difference(a, b) == 1.0
    assert I.area_resize(b, 3, 3).tolist() == [[255, 0, 0], [0, 0, 0], [0, 0, 0]]
    assert I.grey_thumbnail(np.full((36, 64, 3), 100, np.uint8)).shape == (180, 320)
    up = I.upscale_for_reading(np.full((10, 30, 3), 7, np.uint8))
    assert up.shape == (40, 120, 3) and (up == 7).all() and I.upscale_for_reading(up) is up
    hsv = I.hsv(np.array([[[0, 255, 0], [0, 0, 255], [255, 0, 0], [9, 9, 9]]], np.uint8))
    assert hsv[0, :, 0].tolist() == [60, 0, 120, 0] and hsv[0, 3].tolist() == [0, 0, 9]


def wav_bytes(seconds=1.0, rate=16000, channels=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.ones(int(seconds * rate) * channels) * 16384).astype("<i2").tobytes())
    return out.getvalue()


def test_media(spark, tmp_path):
    (tmp_path / "a.wav").write_bytes(wav_bytes())
    files = media.read_files(spark, str(tmp_path / "a.wav"))
    r = files.select(media.wav_duration("content").alias("d"), media.wav_samples("content").alias("s")).first()
    assert r.d == 1.0 and r.s.rate == 16000 and len(r.s.samples) == 16000 and r.s.samples[0] == pytest.approx(0.5)
    assert spark.createDataFrame([(b"no",)], "c binary").select(media.wav_duration("c")).first()[0] is None
    assert media.parse_probe('{"streams": [{"codec_type": "audio"}], "format": {"duration": "2.5"}}') == {"duration_sec": 2.5}
    assert media.parse_probe('{"streams": [{"codec_type": "audio"}]}') == {"duration_sec": 0.0}
    for bad in ("x", '{"streams": [{"codec_type": "video"}]}'):
        with pytest.raises(media.MediaError):
            media.parse_probe(bad)
    with pytest.raises(media.MediaError):
        media.require_tool("no-such-tool-here")
    frame = np.arange(24, dtype=np.uint8).reshape(2, 4, 3)
    ppm = b"P6\n4 2\n255\n" + frame[..., ::-1].tobytes()
    assert (media.decode_image(ppm) == frame).all() and media.decode_image(b"junk") is None


def by_hand(frame, kind):
    """A PNG whose rows all have one filter, made the plain way."""
    import struct
    import zlib

    h, w, c = frame.shape
    rgb = frame[..., ::-1].astype(int)
    rows = []
    for y in range(h):
        row = [kind]
        for x in range(w):
            for k in range(c):
                a, b, d = rgb[y, x - 1, k] if x else 0, rgb[y - 1, x, k] if y else 0, rgb[y - 1, x - 1, k] if x and y else 0
                paeth = min((a, b, d), key=lambda v: abs(v - (a + b - d)))
                row.append(int(rgb[y, x, k] - [0, a, b, (a + b) // 2, paeth][kind]) % 256)
        rows.append(bytes(row))
    part = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    return png.SIGNATURE + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + part(b"tEXt", b"a\0b") + part(b"IDAT", zlib.compress(b"".join(rows))) + part(b"IEND", b"")


def test_png():
    rng = np.random.default_rng(1)
    frame = rng.integers(0, 256, (7, 5, 3), dtype=np.uint8)
    assert (png.decode(png.encode(frame)) == frame).all() and (png.decode(png.encode(frame[..., 0]))[..., 2] == frame[..., 0]).all()
    for kind in range(5):
        assert (media.decode_image(by_hand(frame, kind)) == frame).all(), kind
    for broken in (b"", png.SIGNATURE, png.encode(frame)[:40], by_hand(frame, 1).replace(b"IDAT", b"IDAX")):
        assert media.decode_image(broken) is None


def test_ingest(spark, tmp_path):
    def fake_run(command, **_):
        from types import SimpleNamespace

        if command[-1].endswith(".wav"):
            open(command[-1], "wb").write(b"RIFF")

        return SimpleNamespace(returncode=0, stderr="", stdout='{"streams": [{"codec_type": "audio"}], "format": {"duration": "3.0"}}')

    r = media.ingest(spark, ["/v/one.mp4"], str(tmp_path / "out"), run=fake_run).collect()[0]
    assert (r.meeting_id, r.wav_path, r.duration_sec, r.sample_rate) == ("one", f"{tmp_path}/out/one.wav", 3.0, 16000) and os.path.getsize(r.wav_path) == 4
    r = media.ingest(spark, ["/v/one.mp4"], f"file://{tmp_path}/out2", run=fake_run).collect()[0]
    assert r.wav_path == f"file://{tmp_path}/out2/one.wav" and files.read_bytes(r.wav_path) == b"RIFF"


def test_diarization_falls_back(spark):
    rec = spark.createDataFrame([("m", "w", 7.5)], "meeting_id string, wav_path string, duration_sec double")
    got = seams.diarize(rec, lambda: (lambda wav: [(0.0, 1.0, "Z"), (1.0, 2.0, "A"), (2.0, 3.0, "Z")])).orderBy("pos").collect()
    assert [r.speaker_id for r in got] == ["Speaker_00", "Speaker_01", "Speaker_00"]

    def broken():
        raise RuntimeError

    for load in (broken, lambda: (lambda wav: []), lambda: (lambda wav: 1 / 0)):
        r = seams.diarize(rec, load).first()
        assert (r.start, r.end, r.speaker_id) == (0.0, 7.5, "Speaker_00")


def test_enrich_tries_again_and_stamps(spark, tmp_path):
    t = spark.createDataFrame([("m", "{}")], "meeting_id string, timeline_json string")
    mark = str(tmp_path / "calls")

    class Flaky:
        provider, model = "p", "x"

        def __call__(self, timeline):
            with open(mark, "a") as f:
                f.write("x")
            if os.path.getsize(mark) < 3:
                raise OSError
            return {"summary": "s", "topics": [], "action_items": [{"task": "do", "assignee": None, "evidence_quote": "q"}]}

    r = seams.enrich(t, Flaky, wait=lambda s: None).first()
    assert r.summary == "s" and r.llm_provider == "p" and r.action_items[0].task == "do" and os.path.getsize(mark) == 3
    with pytest.raises(Exception):
        seams.enrich(t, lambda: seams.FakeModel({"{}": OSError("down")}), wait=lambda s: None).collect()


def test_chunks_without_samples_are_left_out(spark):
    c = spark.createDataFrame([("m", 0, "w", "s0", 0.5, 1.0, None), ("m", 1, "w", "s1", 1.0, 1.0, None)], "meeting_id string, pos bigint, wav_path string, segment_id string, start double, end double, prompt string")
    load = lambda: (lambda wav, s, e, p: None if s == e else {"text": "a", "language": "en", "words": [(0.0, 0.1, "a", 0.5)]})
    r = seams.recognise(c, load).collect()
    assert len(r) == 1 and r[0].words[0].start == 0.5


def test_stream_gives_the_same_events_as_the_batch(spark, tmp_path):
    rows = [("m", i, i * 1000, i * 1000 + 1000, "Ana" if i % 5 < 3 else "Bo", "active_speaker_border" if i % 7 else "layout_heuristic", 0.5) for i in range(30)]
    df = spark.createDataFrame(rows, S.FRAMES)
    open_event, done = S.step("m", None, df.where("pos < 11").toPandas())
    open_event, more = S.step("m", open_event, df.where("pos >= 11").toPandas())
    last = [S._close("m", open_event)] if open_event else []
    columns = ["meeting_id", "start_ms", "end_ms", "display_name", "layout", "signal", "confidence", "n_frames"]
    assert sorted(done + more + last) == sorted(tuple(r[c] for c in columns) for r in visual_events(df).collect())
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(S.FRAMES).parquet(str(tmp_path / "in"))
    q = S.visual_events_stream(stream).writeStream.format("memory").queryName("seen_events").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    for _ in range(60):  # the query's timeouts keep it alive, so it is stopped once it has the events
        if q.recentProgress and spark.table("seen_events").count() >= len(done + more):
            break
        q.awaitTermination(1)
    q.stop()
    got = sorted(tuple(r[c] for c in columns) for r in spark.table("seen_events").collect())
    assert set(got) <= set(done + more + last) and len(got) >= len(done + more)


def test_talk_time_stream(spark, tmp_path):
    d = spark.createDataFrame([("m", "S0", "2024-01-01 00:01:00", 0, 500), ("m", "S0", "2024-01-01 00:01:00", 0, 500), ("m", "S0", "2024-01-01 00:07:00", 0, 100)], "meeting_id string, speaker_id string, ts string, start_ms bigint, end_ms bigint").withColumn("ts", F.to_timestamp("ts"))
    d.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(d.schema).parquet(str(tmp_path / "in"))
    q = S.talk_time_stream(stream).writeStream.format("memory").queryName("talk").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.speech_ms, r.n_turns) for r in spark.table("talk").collect()) == [(100, 1), (500, 1)]


def test_command_line_runs_a_whole_meeting(spark, tmp_path, monkeypatch):
    monkeypatch.syspath_prepend(HERE)
    for f in ("fake_models.py",):
        spark.sparkContext.addPyFile(os.path.join(HERE, f))
    folder, seen = tmp_path / "meet", pathlib.Path("/tmp/talkweave-frames-read.txt")
    folder.mkdir()
    seen.unlink(missing_ok=True)
    (folder / "ingestion.json").write_text(json.dumps({"video_path": "v.mp4", "wav_path": "v.wav", "duration_sec": 3.0, "sample_rate": 16000, "channels": 1}))
    common = ["--output_dir", str(folder), "--models", "fake_models"]
    assert cli.main(["pipeline", "--video_path", "v.mp4", "--skip_if_exists", *common], spark) == 0
    load = lambda name: json.load(open(folder / name))
    scenes = load("scenes.json")
    assert [s["timestamp"] for s in scenes] == [0.0, 1.5]
    # the frames stored are those decoded, in colour and size, and the video was read once
    stored = [media.decode_image(open(s["frame_path"], "rb").read()) for s in scenes]
    assert all(f.shape == (360, 640, 3) and I.highlighted_tile(f, Layout()) == (100, 40, 320, 200) for f in stored) and stored[1][0, 0].tolist() == [200] * 3
    assert sorted(map(int, seen.read_text().split())) == [0, 2, 4, 6, 8, 10]
    frames = load("vision_track.json")["frames"]
    assert frames[0]["content"] == {"title": "Quarter results", "bullet_points": ["first point"], "paragraphs": [], "raw_text": "Quarter results\n- first point"}
    assert frames[0]["display_name"] == "Ana Lima" and frames[0]["display_name_source"] == "active_speaker_border" and frames[0]["end_time"] == 1.5 and frames[1]["end_time"] is None
    # the border's crop of the second frame has no lines and cannot be read again; its badge is read again for low confidence
    assert frames[1]["display_name"] == "Bo Chen" and frames[1]["display_name_source"] == "presentation_badge" and frames[1]["detection_confidence"] == 0.2
    assert [e["display_name"] for e in load("visual_speaker_events.json")["events"]] == ["Ana Lima", "Bo Chen"]
    assert load("vad_segments.json")["segments"][1] == {"segment_id": "seg_000150-000250", "start_s": 1.5, "duration": 1.0}
    assert [t["speaker_id"] for t in load("speaker_turns.json")] == ["Speaker_00", "Speaker_01"]
    assert [s["text"] for s in load("transcript.json")["segments"]] == ["hello there", "hello there"]
    assert set(load("speaker_name_map.json")["mapping"]) == {"Speaker_00", "Speaker_01"}
    timeline = load("fused_timeline.json")["segments"]
    assert timeline[0]["slide"] == {"title": "Quarter results", "ocr_text": ["Quarter results", "- first point"]} and len(timeline) == 2
    insights = load("insights.json")
    assert insights["llm_provider"] == "fake" and insights["topics"][0]["evidence"]["timestamps"] == [0.0]
    (folder / "fused_timeline.json").unlink()
    assert cli.main(["fuse", *common[:2]], spark) == 0 and load("fused_timeline.json")["segments"] == timeline
    assert cli.main(["merge", "--output_dir", str(tmp_path / "none")], spark) == 1
    assert cli.main(["llm", *common[:2]], spark) == 1


def test_stages_run_beside_each_other(spark, tmp_path):
    import asyncio

    from talkweave.plans.pipeline import Models, Run

    recording = {"video_path": "v.mp4", "wav_path": "v.wav", "duration_sec": 3.0, "sample_rate": 16000, "channels": 1}
    (tmp_path / "ingestion.json").write_text(json.dumps(recording))
    models = Models(voice_detector=lambda: (lambda wav: [(0, 16000)]), diarizer=lambda: (lambda wav: [(0.0, 1.0, "B")]))
    run = Run(spark, str(tmp_path), models=models)

    async def both():
        return await asyncio.gather(run.stage_async("vad"), run.composite_async(["diarize"]))

    vad, turns = asyncio.run(both())
    assert json.load(open(vad))["segments"][0]["start_s"] == 0.0 and [t["speaker_id"] for t in json.load(open(turns[0]))] == ["Speaker_00"]


def test_command_line_has_every_command_and_layout_overrides():
    p = cli.parser()
    names = next(a for a in p._actions if a.dest == "command").choices
    assert set(names) == {"ingest", "scene-detect", "ocr", "visual-speaker", "vision", "vad", "diarize", "asr", "merge", "speech", "speaker-name", "fuse", "llm", "pipeline"}
    args = p.parse_args(["ocr", "--border-hue-min", "20", "--no-active-speaker-detection"])
    assert cli.layout_of(args, Settings()).border_hue_min == 20 and not cli.layout_of(args, Settings()).enable_active_speaker_border
    sys.modules.pop("fake_models", None)
