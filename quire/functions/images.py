"""Image kernels on arrays: thresholds, components, frames, illumination, overlay marks, ink boxes and crops.

They work on one image at a time inside Arrow-batched functions (a page image is the unit). There is no codec here: pages come as grey or
BGR arrays, from Spark's image source or from a decoder that is given.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def to_gray(image: np.ndarray) -> np.ndarray:
    """Grey levels of a BGR or grey image."""
    if image.ndim == 2:
        return image.astype(np.uint8)
    return np.clip(image[..., 0] * 0.114 + image[..., 1] * 0.587 + image[..., 2] * 0.299 + 0.5, 0, 255).astype(np.uint8)


def otsu(gray: np.ndarray) -> int:
    """The level that separates dark from bright with the greatest variance between them."""
    n = np.bincount(gray.ravel(), minlength=256).astype(float)
    w = np.cumsum(n)
    m = np.cumsum(n * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (m[-1] * w / w[-1] - m) ** 2 / (w * (w[-1] - w))
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1)))


def components(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labels of 8-connected regions (0 is outside) and their boxes x, y, w, h, area, by runs and union-find."""
    labels = np.zeros(mask.shape, np.int32)
    up = [0]

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    before: list[tuple[int, int, int]] = []
    for y in range(mask.shape[0]):
        edges = np.flatnonzero(np.diff(np.r_[0, mask[y].astype(np.int8), 0]))
        now = []
        for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            own = 0
            for a, b, k in before:
                if a <= hi and b >= lo:
                    root = find(k)
                    if not own:
                        own = root
                    elif root != own:
                        up[max(root, own)] = own = min(root, own)
            if not own:
                own = len(up)
                up.append(own)
            labels[y, lo:hi] = own
            now.append((lo, hi, own))
        before = now
    roots = np.array([find(i) for i in range(len(up))])
    _, dense = np.unique(roots, return_inverse=True)
    labels = dense[labels].astype(np.int32)
    n = int(labels.max())
    if not n:
        return labels, np.zeros((0, 5), int)
    ys, xs = np.nonzero(labels)
    k = labels[ys, xs] - 1
    area = np.bincount(k, minlength=n)
    x0, y0, x1, y1 = np.full(n, mask.shape[1]), np.full(n, mask.shape[0]), np.zeros(n, int), np.zeros(n, int)
    np.minimum.at(x0, k, xs)
    np.minimum.at(y0, k, ys)
    np.maximum.at(x1, k, xs + 1)
    np.maximum.at(y1, k, ys + 1)
    return labels, np.column_stack([x0, y0, x1 - x0, y1 - y0, area])


def parchment_frame(gray: np.ndarray, margin: float = 0.01) -> tuple[int, int, int, int]:
    """x, y, w, h of the largest bright region and a margin; the whole image if none is bright."""
    _, boxes = components(gray > otsu(gray))
    h, w = gray.shape
    if not len(boxes):
        return 0, 0, w, h
    x, y, bw, bh, _ = boxes[boxes[:, 4].argmax()].tolist()
    dx, dy = int(w * margin), int(h * margin)
    x0, y0 = max(0, x - dx), max(0, y - dy)
    return x0, y0, min(w, x + bw + dx) - x0, min(h, y + bh + dy) - y0


def trim_gutter(gray: np.ndarray, share: float = 0.12, drop: float = 0.6) -> tuple[int, int]:
    """First and last column to keep: dark columns near an edge, against the median column, are cut with what is outside them."""
    levels = np.median(gray, axis=0)
    edge = max(1, int(gray.shape[1] * share))
    dark = levels < np.median(levels) * drop
    left, right = np.flatnonzero(dark[:edge]), np.flatnonzero(dark[-edge:])
    return (int(left[-1]) + 1 if len(left) else 0), (gray.shape[1] - edge + int(right[0]) if len(right) else gray.shape[1])


def blur(values: np.ndarray, sigma: float) -> np.ndarray:
    """A Gaussian field by separable convolution with reflected edges."""
    r = max(1, int(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    out = values.astype(float)
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (r, r)
        out = np.apply_along_axis(lambda v: np.convolve(v, kernel, "valid"), axis, np.pad(out, pad, mode="symmetric"))
    return out


def flatten_illumination(gray: np.ndarray, sigma: float = 25.0, white: float = 235.0) -> np.ndarray:
    """Grey levels divided by their slow field."""
    return np.clip(gray / np.maximum(blur(gray, sigma), 1) * white, 0, 255).astype(np.uint8)


def attenuate_light(gray: np.ndarray, ink: int, keep: float = 0.45) -> np.ndarray:
    """What is lighter than ink moves to the background, keeping a share of its depth."""
    ground = float(np.median(gray))
    light = (gray > ink) & (gray < ground)
    return np.where(light, ground - (ground - gray) * keep, gray).astype(np.uint8)


def local_mean(gray: np.ndarray, side: int = 35) -> np.ndarray:
    """Grey levels averaged by a Gaussian window of an odd side, edges repeated, rounded."""
    sigma, r = 0.3 * ((side - 1) * 0.5 - 1) + 0.8, side // 2
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    out = gray.astype(np.float64)
    for axis in (0, 1):
        pad = [(0, 0), (0, 0)]
        pad[axis] = (r, r)
        wide, n = np.pad(out, pad, mode="edge"), out.shape[axis]
        out = sum(k * np.take(wide, range(i, i + n), axis) for i, k in enumerate(kernel))
    return np.rint(out)


def marks(gray: np.ndarray, depth: int = 18) -> np.ndarray:
    """What is darker than its surroundings by a depth, whatever the light."""
    return gray <= local_mean(gray) - depth


def ink_masks(gray: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dark ink, and small faint marks.

    Dark marks lie far below the background; a component of them whose darkest point is not deeper still shows through from the other side and
    counts as light. Of the light marks only low components that are no specks are kept.
    """
    ground, all_ = float(np.median(gray)), marks(gray)
    dark = all_ & (gray < ground - 50)
    labels, _ = components(dark)
    deep = np.zeros(int(labels.max()) + 1, bool)
    deep[labels[gray < ground - 85]] = True
    dark &= deep[labels]
    labels, boxes = components(all_ & ~dark)
    short = min(gray.shape)
    keep = np.r_[False, (boxes[:, 3] <= max(2, int(short * 0.015))) & (boxes[:, 4] >= max(6, int((short * 0.002) ** 2)))]
    return dark, keep[labels]


def resized(gray: np.ndarray, scale: float) -> np.ndarray:
    """A smaller image whose pixels are the averages of the areas that they cover."""
    out = gray.astype(np.float64)
    for axis in (0, 1):
        n = gray.shape[axis]
        m = max(1, round(n * scale))
        edges = np.arange(m + 1) * (n / m)
        total = np.concatenate([np.zeros_like(np.take(out, [0], axis)), np.cumsum(out, axis)], axis)
        low = np.minimum(edges.astype(int), n - 1)
        part = (edges - low).reshape((-1, 1) if axis == 0 else (1, -1))
        at = np.take(total, low, axis) + part * np.take(out, low, axis)
        out = np.diff(at, axis=axis) / (n / m)
    return np.rint(out).astype(np.uint8)


def grown(mask: np.ndarray, width: int, height: int) -> np.ndarray:
    """A mask widened to a rectangle around each of its points."""
    out = mask
    for axis, size in ((1, width), (0, height)):
        before = size // 2
        pad = [(0, 0), (0, 0)]
        pad[axis] = (before + 1, size - 1 - before)
        total = np.cumsum(np.pad(out.astype(np.int32), pad), axis)
        n = out.shape[axis]
        out = (np.take(total, range(size, size + n), axis) - np.take(total, range(n), axis)) > 0
    return out


def opened(mask: np.ndarray) -> np.ndarray:
    """A mask without what is thinner than two points."""
    whole = mask.copy()
    whole[1:] &= mask[:-1]
    whole[:, 1:] &= mask[:, :-1]
    whole[1:, 1:] &= mask[:-1, :-1]
    whole[0, :] = whole[:, 0] = False
    out = whole.copy()
    out[:-1] |= whole[1:]
    out[:, :-1] |= whole[:, 1:]
    out[:-1, :-1] |= whole[1:, 1:]
    return out


def remove_overlay(gray: np.ndarray, low: int, high: int, tall: float = 0.3, spread: float = 12.0) -> np.ndarray:
    """Light-band components that are tall and even in level are painted with the background."""
    out, band = gray.copy(), (gray >= low) & (gray <= high)
    labels, boxes = components(band)
    for i, (_, _, _, h, _) in enumerate(boxes.tolist(), 1):
        if h >= tall * gray.shape[0]:
            inside = labels == i
            if gray[inside].std() <= spread:
                out[inside] = int(np.median(gray))
    return out


def glyph_height(boxes: np.ndarray) -> float:
    """The median height of the taller half of ink boxes; 0 without any."""
    h = np.sort(boxes[:, 3]) if len(boxes) else np.zeros(0)
    return float(np.median(h[len(h) // 2 :])) if len(h) else 0.0


def ink_blobs(gray: np.ndarray, least: int = 4) -> np.ndarray:
    """Boxes x, y, w, h, area of ink, without specks."""
    _, boxes = components(gray <= otsu(gray))
    return boxes[boxes[:, 4] >= least]


#: Sides of the image that regions are sought in, at most; ink and density of a region, at least; lines of one, at most.
SIDE, LEAST_INK, LEAST_DENSITY, MOST_LINES = 1600, 60, 0.03, 14
#: What a page may have at most, and the ink that it must have, to be read as a whole; levels by which ink of the other side is lighter.
WHOLE_INK, WHOLE_REGIONS, WHOLE_LINES, LIGHTER = 15_000, 3, 30, 22


def _at_an_edge(x: int, y: int, w: int, h: int, shape: tuple[int, int]) -> bool:
    """Whether a box is what a frame leaves at an edge: a thin strip or a band along it."""
    height, width = shape
    side = x <= max(3, int(width * 0.005)) or x + w >= width - max(3, int(width * 0.005))
    end = y <= max(3, int(height * 0.005)) or y + h >= height - max(3, int(height * 0.005))
    strip = side and (w < width * 0.07 or (h > height * 0.8 and w < width * 0.25))
    return strip or (end and (h < height * 0.03 or (w > width * 0.8 and h < height * 0.25)))


def _united(boxes: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    from quire.functions.geometry import merge_boxes

    return [(a, b, c - a, d - b) for a, b, c, d in merge_boxes([(x, y, x + w, y + h) for x, y, w, h in boxes])]


def _cut_tall(ink: np.ndarray, box: tuple[int, int, int, int], line: float, glyph: float) -> list[tuple[int, int, int, int]]:
    """A box of too many lines, cut at the emptiest rows near equal parts."""
    x, y, w, h = box
    if h / line <= MOST_LINES:
        return [box]
    profile, n = ink[y : y + h, x : x + w].sum(1), math.ceil(h / line / MOST_LINES)
    near = lambda k: (max(0, int(h * k / n) - int(line * 2)), min(h - 1, int(h * k / n) + int(line * 2)))
    cuts = sorted(lo + int(profile[lo : hi + 1].argmin()) for lo, hi in map(near, range(1, n)))
    edges = [0, *cuts, h]
    return [(x, y + a, w, b - a) for a, b in zip(edges, edges[1:], strict=False) if b - a > glyph]


def regions(gray: np.ndarray, faint: bool = False, whole_ink: int = WHOLE_INK, whole_regions: int = WHOLE_REGIONS, whole_lines: int = WHOLE_LINES, lighter: float = LIGHTER) -> dict:
    """A page's regions in reading order and how it is read: blank, full_page or segmented.

    Images that are no pages by their form are blank. Ink is fused to blobs by the height of its characters; drawings (large, nearly empty
    components) become figures that swallow what lies in them; frame residue, specks and ink of the other side go; tall blobs are cut.
    """
    height, width = gray.shape
    out = {"image": {"width": width, "height": height}, "glyph_height_px": 0.0, "regions": [], "route": "blank", "ink_px": 0, "est_lines": 0}
    if not 0.35 <= width / height <= 3:
        return out
    scale = min(1.0, SIDE / max(height, width))
    gray = resized(gray, scale) if scale < 1 else gray
    dark, light = ink_masks(gray)
    ink = dark | light if faint and light.sum() <= max(3 * dark.sum(), gray.size * 0.005) else dark
    ink, glyph = opened(ink), glyph_height(components(dark)[1]) or 1.0
    line, back = glyph * 1.7, lambda box: [int(v / scale) for v in box]
    labels, boxes = components(ink)
    drawn = (boxes[:, 2] > 4 * glyph) & (boxes[:, 3] > 4 * glyph) & (boxes[:, 4] < 0.15 * boxes[:, 2] * boxes[:, 3])
    figures, writing = _united([tuple(b[:4]) for b in boxes[drawn].tolist()]), ink & ~np.r_[False, drawn][labels]
    fused = grown(writing, max(3, int(glyph * 2.2)), max(3, int(glyph * 0.8)))
    fused = grown(fused, max(3, int(glyph * 0.8)), max(3, int(line)))
    blobs = [tuple(b[:4]) for b in components(fused)[1].tolist() if b[4] >= gray.size * 0.0004]
    blobs = _united([b for b in blobs if not _at_an_edge(*b, gray.shape)])
    found = []
    for x, y, w, h in (part for b in blobs for part in _cut_tall(writing, b, line, glyph)):
        inside = writing[y : y + h, x : x + w]
        n = int(inside.sum())
        if n < max(LEAST_INK, LEAST_DENSITY * w * h):
            continue
        cx, cy = (x + w / 2) / gray.shape[1], (y + h / 2) / gray.shape[0]
        main, rim = w * h >= 0.1 * gray.size and 0.2 <= cx <= 0.8, not (0.16 <= cx <= 0.84 and 0.1 <= cy <= 0.9)
        depth = float(np.median(gray[y : y + h, x : x + w][inside]))
        found.append({"kind": "main_text" if main else "marginalia" if rim else "block", "bbox": back((x, y, w, h)), "est_lines": max(1, round(h / line)), "ink_px": n, "depth": depth})
    if len(found) > 1:
        most = float(np.median(gray[writing])) + lighter
        found = [r for r in found if r["depth"] <= most]
    for x, y, w, h in figures:

        def within(r: dict, x: int = x, y: int = y, w: int = w, h: int = h) -> bool:
            a, b, c, d = (int(v * scale) for v in r["bbox"])
            return max(0, min(a + c, x + w) - max(a, x)) * max(0, min(b + d, y + h) - max(b, y)) >= 0.7 * c * d

        found = [r for r in found if not within(r)] + [{"kind": "figure", "bbox": back((x, y, w, h)), "est_lines": 1, "ink_px": int(ink[y : y + h, x : x + w].sum()), "depth": 0.0}]
    found.sort(key=lambda r: (r["kind"] == "marginalia", r["bbox"][1], r["bbox"][0]))
    found = [{"region_id": f"r{i:02d}", "reading_order": i} | r for i, r in enumerate(found)]
    total, lines = sum(r["ink_px"] for r in found), sum(r["est_lines"] for r in found)
    whole = total >= whole_ink and len(found) <= whole_regions and lines <= whole_lines
    route = "blank" if not found else "full_page" if whole else "segmented"
    return out | {"glyph_height_px": round(glyph / scale, 1), "regions": found, "route": route, "ink_px": total, "est_lines": lines}


def padded_tile(image: np.ndarray, box: tuple[int, int, int, int], pad: int) -> np.ndarray:
    """A crop with a margin, on a white square."""
    x, y, w, h = box
    crop = image[max(0, y - pad) : y + h + pad, max(0, x - pad) : x + w + pad]
    side = max(crop.shape[:2])
    out = np.full((side, side, *image.shape[2:]), 255, image.dtype)
    top, left = (side - crop.shape[0]) // 2, (side - crop.shape[1]) // 2
    out[top : top + crop.shape[0], left : left + crop.shape[1]] = crop
    return out


def map_images(images: DataFrame, kernel: Callable[[np.ndarray], dict], schema: str) -> DataFrame:
    """kernel over each image of Spark's image source (struct image: height, width, nChannels, data) or of such rows."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for origin, h, w, c, data in f[["origin", "height", "width", "nChannels", "data"]].itertuples(index=False):
                array = np.frombuffer(data, np.uint8).reshape((h, w, c) if c > 1 else (h, w))
                rows.append({"origin": origin} | kernel(array))
            yield pd.DataFrame(rows)

    return images.select("image.origin", "image.height", "image.width", "image.nChannels", "image.data").mapInPandas(run, schema)
