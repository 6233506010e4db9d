"""Media files: what their headers tell, their samples, and the tools that decode them."""

from __future__ import annotations

import io
import json
import shutil
import subprocess
import tempfile
import wave

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from talkweave.functions import png
from talkweave.functions.images import grey_thumbnail, shows_change
from talkweave.sources import files


class MediaError(RuntimeError):
    """A media file that is missing, unreadable or without audio, or a missing tool."""


def require_tool(name: str) -> str:
    """Path of a command, or an error before any work starts."""
    found = shutil.which(name)
    if not found:
        raise MediaError(f"{name} is not installed")
    return found


def parse_probe(output: str) -> dict:
    """duration_sec and has_audio from a probe's JSON; raises if there is no audio stream or no JSON."""
    try:
        found = json.loads(output)
    except ValueError as e:
        raise MediaError("the probe gave no JSON") from e
    if not any(s.get("codec_type") == "audio" for s in found.get("streams", [])):
        raise MediaError("no audio stream")
    return {"duration_sec": float(found.get("format", {}).get("duration", 0.0) or 0.0)}


def probe_video(path: str, run=subprocess.run) -> dict:
    """Streams and duration of a video, by ffprobe."""
    tool = require_tool("ffprobe") if run is subprocess.run else "ffprobe"
    done = run([tool, "-v", "error", "-print_format", "json", "-show_streams", "-show_format", path], capture_output=True, text=True)
    if done.returncode:
        raise MediaError(f"{path}: {done.stderr}")
    return parse_probe(done.stdout)


def extract_audio(path: str, out: str, rate: int = 16000, channels: int = 1, run=subprocess.run) -> str:
    """Decode a video's audio to 16-bit PCM, by ffmpeg."""
    tool = require_tool("ffmpeg") if run is subprocess.run else "ffmpeg"
    done = run([tool, "-y", "-i", path, "-vn", "-acodec", "pcm_s16le", "-ar", str(rate), "-ac", str(channels), out], capture_output=True, text=True)
    if done.returncode:
        raise MediaError(f"{path}: {done.stderr}")
    return out


def ingest(spark: SparkSession, videos: list[str], out_folder: str, rate: int = 16000, channels: int = 1, run=subprocess.run) -> DataFrame:
    """Recordings of videos: each is probed and its audio extracted, one file per task."""
    rows = spark.createDataFrame([(v,) for v in videos], "video_path string").repartition(max(1, len(videos)))

    def work(batches):
        for b in batches:
            made = []
            for v in b["video_path"]:
                stem = v.rsplit("/", 1)[-1].rsplit(".", 1)[0]
                duration = probe_video(v, run)["duration_sec"]
                with tempfile.TemporaryDirectory() as own:  # the tool writes to a disk of its own, the result is shared
                    wav = extract_audio(v, f"{own}/{stem}.wav", rate, channels, run)
                    with open(wav, "rb") as f:
                        shared = files.write_bytes(f"{out_folder}/{stem}.wav", f.read())
                made.append((stem, v, shared, duration, rate, channels))
            yield pd.DataFrame(made, columns=["meeting_id", "video_path", "wav_path", "duration_sec", "sample_rate", "channels"])

    return rows.mapInPandas(work, "meeting_id string, video_path string, wav_path string, duration_sec double, sample_rate int, channels int")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """Files as they are: path, content."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


@F.pandas_udf(T.DoubleType())
def wav_duration(content: pd.Series) -> pd.Series:
    """Seconds of a WAV file by its header; null if it is none."""

    def one(data):
        try:
            with wave.open(io.BytesIO(data)) as w:
                return w.getnframes() / w.getframerate()
        except (wave.Error, EOFError):
            return None

    return content.map(one)


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Samples from -1 to 1, averaged over channels, and the sample rate."""
    with wave.open(io.BytesIO(data)) as w:
        kind = {1: np.uint8, 2: np.int16, 4: np.int32}[w.getsampwidth()]
        x = np.frombuffer(w.readframes(w.getnframes()), kind).astype(np.float32).reshape(-1, w.getnchannels())
        x = (x - 128) / 128 if kind is np.uint8 else x / float(np.iinfo(kind).max + 1)
        return x.mean(axis=1), w.getframerate()


@F.pandas_udf(T.StructType([T.StructField("samples", T.ArrayType(T.FloatType())), T.StructField("rate", T.IntegerType())]))
def wav_samples(content: pd.Series) -> pd.DataFrame:
    decoded = [decode_wav(c) for c in content]
    return pd.DataFrame({"samples": [d[0] for d in decoded], "rate": [d[1] for d in decoded]})


def decode_image(data: bytes) -> np.ndarray | None:
    """A PNG, or binary PPM or PGM, image as BGR rows; null if it is none. Other formats need a decoder at the seam."""
    if data.startswith(png.SIGNATURE):
        return png.decode(data)
    try:
        kind, size, depth, rest = data.split(b"\n", 3)
        w, h = map(int, size.split())
        if kind not in (b"P5", b"P6") or int(depth) != 255:
            return None
        pixels = np.frombuffer(rest, np.uint8, count=w * h * (3 if kind == b"P6" else 1))
        return pixels.reshape(h, w, 3)[..., ::-1] if kind == b"P6" else np.repeat(pixels.reshape(h, w, 1), 3, axis=2)
    except ValueError:
        return None


def kept_frames(reader, video_path: str, sample_fps: float, threshold: float, folder: str, thumbnail: tuple[int, int] = (320, 180)):
    """(number, seconds, path) of the frames of a video that show a new scene, each written whole as it is kept.

    Frames are sampled at ``sample_fps`` and told apart by their grey thumbnails; the frame that is written is the one
    that was decoded. A video is read once, by one decoder, and one thumbnail is held.
    """
    native = reader.fps(video_path) or 25.0
    last, number = None, 0
    for i, frame in reader.frames(video_path, max(1, round(native / sample_fps))):
        frame = np.asarray(frame)
        small = grey_thumbnail(frame, *thumbnail)
        if last is None or shows_change(last, small, threshold):
            last, number = small, number + 1
            yield number, i / native, files.write_bytes(f"{folder}/frame_{number:05d}.png", png.encode(frame))
