"""Pixel functions on numpy arrays."""

from __future__ import annotations

import numpy as np


def crop(frame: np.ndarray, box: tuple[int, int, int, int]) -> np.ndarray:
    """The part of a frame inside (x, y, width, height)."""
    x, y, w, h = box
    return frame[y : y + h, x : x + w]


def luma(frame: np.ndarray) -> np.ndarray:
    """Grey values of a BGR frame, rounded."""
    b, g, r = (frame[..., i].astype(np.float64) for i in range(3))
    return np.rint(0.114 * b + 0.587 * g + 0.299 * r).astype(np.uint8)


def area_resize(image: np.ndarray, width: int, height: int) -> np.ndarray:
    """Shrink or stretch by averaging the area that each target pixel covers."""

    def weights(n: int, m: int) -> np.ndarray:
        edges = np.arange(m + 1) * n / m
        cells = np.arange(n)
        return np.clip(np.minimum(edges[1:, None], cells + 1) - np.maximum(edges[:-1, None], cells), 0, None) * m / n

    return np.rint(weights(image.shape[0], height) @ image.astype(np.float64) @ weights(image.shape[1], width).T).astype(np.uint8)


def grey_thumbnail(frame: np.ndarray, width: int = 320, height: int = 180) -> np.ndarray:
    return area_resize(luma(frame) if frame.ndim == 3 else frame, width, height)


def upscale_for_reading(image: np.ndarray, least_height: int = 40) -> np.ndarray:
    """Enlarge an image that is lower than ``least_height``, keeping its proportions, by cubic interpolation."""
    h, w = image.shape[:2]
    if not 0 < h < least_height or not w:
        return image
    new_h, new_w = least_height, int(round(w * least_height / h))

    def matrix(n: int, m: int) -> np.ndarray:
        at = (np.arange(m) + 0.5) * n / m - 0.5
        base = np.floor(at).astype(int)
        out = np.zeros((m, n))
        for k in range(-1, 3):
            d = np.abs(at - (base + k))
            a = -0.75
            value = np.where(d <= 1, (a + 2) * d**3 - (a + 3) * d**2 + 1, np.where(d < 2, a * d**3 - 5 * a * d**2 + 8 * a * d - 4 * a, 0))
            np.add.at(out, (np.arange(m), np.clip(base + k, 0, n - 1)), value)
        return out

    planes = image.reshape(h, w, -1).astype(np.float64)
    big = np.einsum("ih,hwc,jw->ijc", matrix(h, new_h), planes, matrix(w, new_w))
    return np.clip(np.rint(big), 0, 255).astype(image.dtype).reshape(new_h, new_w, *image.shape[2:])


def whole_difference(a: np.ndarray, b: np.ndarray) -> float:
    """Mean absolute difference of two grey images as a share of 255."""
    return float(np.abs(b.astype(np.int16) - a.astype(np.int16)).mean() / 255.0)


def regional_difference(a: np.ndarray, b: np.ndarray, grid: int = 3) -> float:
    """The largest difference over the cells of a grid; the last row and column take what is left over."""
    delta = np.abs(b.astype(np.int16) - a.astype(np.int16))
    rows = [i * (delta.shape[0] // grid) for i in range(grid)] + [delta.shape[0]]
    cols = [i * (delta.shape[1] // grid) for i in range(grid)] + [delta.shape[1]]
    return max(float(delta[r0:r1, c0:c1].mean()) for r0, r1 in zip(rows, rows[1:]) for c0, c1 in zip(cols, cols[1:])) / 255.0


def shows_change(last: np.ndarray, image: np.ndarray, threshold: float, regional_factor: float = 1.5, grid: int = 3) -> bool:
    """Whether a grey image differs from the last one kept: as a whole, or in one cell of a grid by ``regional_factor`` as much."""
    return whole_difference(last, image) > threshold or regional_difference(last, image, grid) > regional_factor * threshold


def hsv(frame: np.ndarray) -> np.ndarray:
    """Hue 0-179, saturation and value 0-255 of a BGR frame."""
    b, g, r = (frame[..., i].astype(np.float64) for i in range(3))
    top, low = np.maximum(np.maximum(b, g), r), np.minimum(np.minimum(b, g), r)
    span = np.where(top == low, 1, top - low)
    hue = np.where(top == r, (g - b) / span % 6, np.where(top == g, (b - r) / span + 2, (r - g) / span + 4)) * 30
    hue = np.where(top == low, 0, hue)
    saturation = np.where(top == 0, 0, (top - low) * 255 / np.where(top == 0, 1, top))
    return np.rint(np.stack([hue % 180, saturation, top], axis=-1)).astype(np.int16)


def _slide(mask: np.ndarray, size: int, pick, outside: bool) -> np.ndarray:
    before, after = size // 2, size - 1 - size // 2
    for axis in (0, 1):
        pads = [(0, 0), (0, 0)]
        pads[axis] = (before, after)
        wide = np.pad(mask, pads, constant_values=outside)
        mask = pick(np.stack([np.take(wide, range(k, k + mask.shape[axis]), axis) for k in range(size)]), axis=0)
    return mask


def close_gaps(mask: np.ndarray, size: int) -> np.ndarray:
    """Morphological closing with a square: grow, then shrink; 0 leaves the mask as it is."""
    if size <= 0:
        return mask
    return _slide(_slide(mask, size, np.any, False), size, np.all, True)


def _runs(mask: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of set pixels as (row, first, end) and the part that each belongs to, numbered by their first run.

    Runs of neighbouring rows belong together if they overlap, widened by ``reach`` pixels: 1 joins diagonals, 0 does not.
    """
    edges = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, first = np.nonzero(edges == 1)
    end = np.nonzero(edges == -1)[1]
    part = np.arange(len(row))

    def find(k: int) -> int:
        while part[k] != k:
            part[k] = part[part[k]]
            k = part[k]
        return k

    begin = np.searchsorted(row, np.arange(mask.shape[0] + 1))
    for y in range(1, mask.shape[0]):
        a, b = begin[y - 1], begin[y]
        while a < begin[y] and b < begin[y + 1]:
            if first[a] < end[b] + reach and first[b] < end[a] + reach:
                one, other = find(a), find(b)
                part[max(one, other)] = min(one, other)
            if end[a] < end[b]:
                a += 1
            else:
                b += 1
    return row, first, end, np.array([find(k) for k in range(len(row))], dtype=np.int64)


def outer_boxes(mask: np.ndarray) -> list[tuple[int, int, int, int]]:
    """Bounding boxes (x, y, width, height) of the connected parts of a mask, diagonals included, none inside another part's hole."""
    wide = np.pad(mask, 1)
    row, first, end, part = _runs(~wide, 0)
    around = np.zeros(wide.shape, bool)  # what the space around the frame reaches without crossing the mask
    for y, a, b in zip(row[part == 0], first[part == 0], end[part == 0]):
        around[y, a:b] = True
    beside = np.zeros(wide.shape, bool)
    for axis in (0, 1):
        for step in (1, -1):
            beside |= np.roll(around, step, axis)
    row, first, end, part = _runs(wide, 1)
    boxes = []
    for p in np.unique(part):
        y, a, b = row[part == p], first[part == p], end[part == p]
        if any(beside[r, c:d].any() for r, c, d in zip(y, a, b)):
            boxes.append((int(a.min()) - 1, int(y.min()) - 1, int(b.max() - a.min()), int(y.max() - y.min() + 1)))
    return boxes


def highlighted_tile(frame: np.ndarray, layout) -> tuple[int, int, int, int] | None:
    """The largest box of the highlight colour whose share of the frame lies within the layout's bounds."""
    h = hsv(frame)
    mask = (h[..., 0] >= layout.border_hue_min) & (h[..., 0] <= layout.border_hue_max) & (h[..., 1] >= layout.border_sat_min) & (h[..., 2] >= layout.border_val_min)
    area = frame.shape[0] * frame.shape[1]
    fits = [b for b in outer_boxes(close_gaps(mask, layout.border_close_kernel_size)) if layout.border_min_area_fraction <= b[2] * b[3] / area <= layout.border_max_area_fraction]
    return max(fits, key=lambda b: b[2] * b[3], default=None)


def name_label_box(tile: tuple[int, int, int, int], layout) -> tuple[int, int, int, int]:
    """Bottom left of a tile, where the name stands."""
    x, y, w, h = tile
    label = max(1, int(h * layout.name_label_height_fraction))
    top = max(0, y + h - label)
    return x, top, max(1, int(w * layout.name_label_width_fraction)), y + h - top


def badge_box(height: int, width: int, layout) -> tuple[int, int, int, int]:
    """Top right of a frame, where the badge of the speaker stands."""
    w = int(width * layout.badge_right_fraction)
    return width - w, 0, w, int(height * layout.badge_top_fraction)


def badge_label_box(badge: tuple[int, int, int, int], layout) -> tuple[int, int, int, int]:
    """The strip at the bottom of a badge that holds the name."""
    x, y, w, h = badge
    label = max(1, int(h * layout.badge_name_height_fraction))
    return x, y + h - label, w, label
