"""Images as PNG files: 8 bits a channel, grey, RGB, palette or with transparency, not interlaced."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the file format.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode(frame: np.ndarray) -> bytes:
    """A BGR or grey image; each row is stored as its difference to the row above."""
    rows = frame[..., ::-1] if frame.ndim == 3 else frame[..., None]
    h, w, c = rows.shape
    flat = np.ascontiguousarray(rows, np.uint8).reshape(h, w * c)
    up = np.vstack([flat[:1], flat[1:] - flat[:-1]])
    data = zlib.compress(np.hstack([np.full((h, 1), 2, np.uint8), up]).tobytes(), 3)
    return SIGNATURE + _chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2 if c == 3 else 0, 0, 0, 0)) + _chunk(b"IDAT", data) + _chunk(b"IEND", b"")


def _unfilter(lines: np.ndarray, step: int) -> np.ndarray:
    kinds, out = lines[:, 0], lines[:, 1:].copy()
    above = np.zeros(out.shape[1], np.uint8)
    for kind, row in zip(kinds, out):
        if kind == 1:
            pixels = row.reshape(-1, step)
            np.cumsum(pixels, axis=0, dtype=np.uint8, out=pixels)
        elif kind == 2:
            row += above
        elif kind in (3, 4):
            left, corner, up = [0] * step, [0] * step, above.tolist()
            values = row.tolist()
            for i, v in enumerate(values):
                a, b, c, k = left[i % step], up[i], corner[i % step], i % step
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    pa, pb, pc = abs(b - c), abs(a - c), abs(a + b - 2 * c)
                    guess = a if pa <= pb and pa <= pc else b if pb <= pc else c
                values[i] = left[k] = (v + guess) & 255
                corner[k] = b
            row[:] = values
        elif kind:
            raise ValueError("unknown filter")
        above = row
    return out


def decode(data: bytes) -> np.ndarray | None:
    """BGR rows of a PNG file; null if it is none, broken or of a kind not read here. Transparency is dropped."""
    if not data.startswith(SIGNATURE):
        return None
    at, packed, palette, head = len(SIGNATURE), [], None, None
    try:
        while at < len(data):
            size, kind = struct.unpack(">I4s", data[at : at + 8])
            body = data[at + 8 : at + 8 + size]
            at += 12 + size
            if kind == b"IHDR":
                head = struct.unpack(">IIBBBBB", body)
            elif kind == b"PLTE":
                palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
            elif kind == b"IDAT":
                packed.append(body)
            elif kind == b"IEND":
                break
        w, h, depth, colour, _, _, interlaced = head
        if depth != 8 or interlaced or colour not in CHANNELS:
            return None
        c = CHANNELS[colour]
        lines = np.frombuffer(zlib.decompress(b"".join(packed)), np.uint8).reshape(h, 1 + w * c)
        pixels = _unfilter(lines, c).reshape(h, w, c)
        if colour == 3:
            pixels = palette[pixels[..., 0]]
        return pixels[..., 2::-1].copy() if pixels.shape[2] >= 3 else np.repeat(pixels[..., :1], 3, axis=2)
    except (ValueError, TypeError, IndexError, struct.error, zlib.error):
        return None
