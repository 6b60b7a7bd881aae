"""Kernels on full-size images: numpy, called from Arrow batches, one image at a time.

Images are uint8 arrays; masks are uint8 with 0 and 255. Semantics are those of the named operations, not the bits of
any imaging library: rectangles of minimal area come from convex hulls and edge directions, warps from inverse mapping.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

Rotated = tuple[tuple[float, float], tuple[float, float], float]


def to_mask_stack(raw: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """[N,H,W] with 0 and 255, from (N,1,H,W), (H,W), (H,W,C) or (N,H,W)."""
    width, height = size
    m = np.asarray(raw)
    if m.ndim == 4 and m.shape[1] == 1:
        m = m[:, 0]
    if m.ndim == 2:
        m = m[None]
    if m.ndim == 3 and m.shape[1:] != (height, width) and m.shape[:2] == (height, width):
        m = np.moveaxis(m, -1, 0)
    if m.ndim != 3 or m.shape[1:] != (height, width):
        raise ValueError(f"mask shape {np.shape(raw)} does not fit an image of {width} x {height}")
    return np.where(m > 0, 255, 0).astype(np.uint8)


def combine(masks: np.ndarray, boxes: list[tuple[int, int, int, int]], shape: tuple[int, int]) -> np.ndarray:
    """Pixelwise maximum; without masks, the filled boxes."""
    if len(masks):
        return np.max(masks, axis=0)
    out = np.zeros(shape, np.uint8)
    for x, y, w, h in boxes:
        out[max(0, y) : min(shape[0], y + h + 1), max(0, x) : min(shape[1], x + w + 1)] = 255
    return out


def _window_sums(on: np.ndarray, reach: int) -> np.ndarray:
    """How many of each pixel's square are on, from an integral image: independent of the reach."""
    h, w = on.shape
    total = np.zeros((h + 1, w + 1), np.int64)
    total[1:, 1:] = on.cumsum(0).cumsum(1)
    y, x = np.arange(h), np.arange(w)
    top, bottom = np.maximum(y - reach, 0), np.minimum(y + reach + 1, h)
    left, right = np.maximum(x - reach, 0), np.minimum(x + reach + 1, w)
    return total[bottom][:, right] - total[top][:, right] - total[bottom][:, left] + total[top][:, left]


def open_mask(mask: np.ndarray, kernel: int, iterations: int) -> np.ndarray:
    """Erosions, then dilations. n rounds of a k-square equal one square of n (k - 1) + 1."""
    if kernel < 1 or kernel % 2 == 0 or iterations < 1:
        raise ValueError("kernel must be odd and positive, iterations positive")
    reach = iterations * (kernel // 2)
    eroded = _window_sums(mask == 0, reach) == 0
    return np.where(_window_sums(eroded, reach) > 0, 255, 0).astype(np.uint8)


def label(on: np.ndarray) -> tuple[np.ndarray, int]:
    """8-connected components, by union of runs of neighbouring rows."""
    parent: list[int] = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    runs: list[tuple[int, int, int, int]] = []
    above: list[tuple[int, int, int, int]] = []
    for y, line in enumerate(np.pad(on.astype(np.int8), ((0, 0), (1, 1)))):
        edges = np.flatnonzero(np.diff(line))
        here = []
        k = 0
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            run = (y, a, b, len(parent))
            parent.append(len(parent))
            while k < len(above) and above[k][2] < a:
                k += 1
            j = k
            while j < len(above) and above[j][1] <= b:
                r, s = root(run[3]), root(above[j][3])
                parent[max(r, s)] = min(r, s)
                j += 1
            here.append(run)
        runs += here
        above = here
    out = np.zeros(on.shape, np.int32)
    names: dict[int, int] = {}
    for y, a, b, i in runs:
        out[y, a:b] = names.setdefault(root(i), len(names) + 1)
    return out, len(names)


def outer_components(mask: np.ndarray) -> list[np.ndarray]:
    """Pixel coordinates (y, x) of the components that do not lie in a hole of another."""
    labels, n = label(mask > 0)
    outside = label_background(mask > 0)
    found = []
    grown = np.pad(outside, 1, constant_values=True)
    near = np.zeros(mask.shape, bool)
    for dy in range(3):
        for dx in range(3):
            near |= grown[dy : dy + mask.shape[0], dx : dx + mask.shape[1]]
    for k in range(1, n + 1):
        own = labels == k
        if (near & own).any():
            found.append(np.argwhere(own))
    return found


def label_background(on: np.ndarray) -> np.ndarray:
    """Pixels that are off and reach the border by 4-neighbours."""
    open_ = np.pad(~on, 1, constant_values=True)
    reached = np.zeros_like(open_)
    reached[0, 0] = True
    while True:
        grown = reached.copy()
        for axis in (0, 1):
            for side in (1, -1):
                grown |= np.roll(reached, side, axis) & open_
        # Runs are filled along rows and columns at once, so the loop turns only where the background does.
        grown = _fill_runs(grown, open_)
        grown = _fill_runs(grown.T, open_.T).T
        if (grown == reached).all():
            return reached[1:-1, 1:-1]
        reached = grown


def _fill_runs(seed: np.ndarray, open_: np.ndarray) -> np.ndarray:
    run = np.cumsum(~open_, axis=1) + np.arange(len(open_))[:, None] * (open_.shape[1] + 1)
    hit = np.zeros(int(run.max()) + 1, bool)
    hit[run[seed]] = True
    return hit[run] & open_


def box_of(pixels: np.ndarray) -> tuple[int, int, int, int]:
    (y1, x1), (y2, x2) = pixels.min(axis=0).tolist(), pixels.max(axis=0).tolist()
    return x1, y1, x2 - x1 + 1, y2 - y1 + 1


def extract_boxes(mask: np.ndarray) -> list[tuple[int, int, int, int]]:
    return sorted(map(box_of, outer_components(mask)), key=lambda b: -b[2] * b[3])


def hull(points: np.ndarray) -> np.ndarray:
    """Convex hull, counter-clockwise, by the monotone chain."""
    p = sorted(set(map(tuple, points.tolist())))
    if len(p) < 3:
        return np.array(p, float)

    def half(order):
        chain: list = []
        for q in order:
            while len(chain) > 1 and (chain[-1][0] - chain[-2][0]) * (q[1] - chain[-2][1]) - (chain[-1][1] - chain[-2][1]) * (q[0] - chain[-2][0]) <= 0:
                chain.pop()
            chain.append(q)
        return chain[:-1]

    return np.array(half(p) + half(p[::-1]), float)


def min_area_rect(points: np.ndarray) -> Rotated:
    """((cx, cy), (w, h), degrees) of the smallest rectangle around (x, y) points: one side lies on a hull edge."""
    h = hull(points)
    if len(h) < 3:
        lo, hi = h.min(axis=0), h.max(axis=0)
        d = hi - lo
        return tuple(((lo + hi) / 2).tolist()), (float(np.hypot(*d)), 0.0), math.degrees(math.atan2(d[1], d[0]))
    edges = np.roll(h, -1, axis=0) - h
    best = None
    for angle in np.unique(np.arctan2(edges[:, 1], edges[:, 0]) % (math.pi / 2)):
        c, s = math.cos(angle), math.sin(angle)
        turned = h @ np.array([[c, -s], [s, c]])
        lo, hi = turned.min(axis=0), turned.max(axis=0)
        area = float(np.prod(hi - lo))
        if best is None or area < best[0] - 1e-9:
            mx, my = ((lo + hi) / 2).tolist()
            best = (area, (c * mx - s * my, s * mx + c * my), tuple((hi - lo).tolist()), math.degrees(angle))
    return best[1], best[2], best[3]


def corners(r: Rotated) -> np.ndarray:
    (cx, cy), (w, h), degrees = r
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    half = np.array([(-w, -h), (w, -h), (w, h), (-w, h)]) / 2
    return half @ np.array([[c, s], [-s, c]]) + (cx, cy)


def inside_polygon(shape: tuple[int, int], polygon: np.ndarray) -> np.ndarray:
    """Pixels whose centre lies in a convex polygon or on its edge."""
    y, x = np.mgrid[: shape[0], : shape[1]]
    sides = [(b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0]) for a, b in zip(polygon, np.roll(polygon, -1, axis=0), strict=True)]
    return np.all([s >= -1e-9 for s in sides], axis=0) | np.all([s <= 1e-9 for s in sides], axis=0)


def fit_inside(mask: np.ndarray, r: Rotated, steps: int = 24) -> Rotated | None:
    """The largest copy of the rectangle about its centre that lies in the mask, by bisection of its scale in (0, 1)."""
    low, high, best = 0.0, 1.0, None
    off = mask == 0
    for _ in range(steps):
        scale = (low + high) / 2
        trial = (r[0], (r[1][0] * scale, r[1][1] * scale), r[2])
        c = corners(trial)
        fits = c.min() >= 0 and c[:, 0].max() < mask.shape[1] and c[:, 1].max() < mask.shape[0] and not (off & inside_polygon(mask.shape, c)).any()
        if fits:
            low, best = scale, trial
        else:
            high = scale
    return best


def largest_fitting(mask: np.ndarray) -> Rotated | None:
    """Of each outer component's rectangle, fitted inside, the one with the largest area; the first of equals."""
    best, most = None, 0.0
    for pixels in outer_components(mask):
        if len(pixels) < 2:
            continue
        fitted = fit_inside(mask, min_area_rect(pixels[:, ::-1]))
        if fitted and (area := fitted[1][0] * fitted[1][1]) > most:
            best, most = fitted, area
    return best


def rotation_to_zero(r: Rotated) -> float:
    c = corners(r)
    edges = np.roll(c, -1, axis=0) - c
    dx, dy = edges[int(np.argmax(np.round((edges**2).sum(axis=1), 9)))].tolist()
    angle = math.degrees(math.atan2(dy, dx))
    angle = angle - 180 if angle > 90 else angle + 180 if angle <= -90 else angle
    return 90 - angle if angle > 45 else -90 - angle if angle < -45 else -angle


def _cubic(t: np.ndarray, a: float = -0.75) -> list[np.ndarray]:
    def weight(x: np.ndarray) -> np.ndarray:
        x = np.abs(x)
        return np.where(x <= 1, (a + 2) * x**3 - (a + 3) * x**2 + 1, np.where(x < 2, a * x**3 - 5 * a * x**2 + 8 * a * x - 4 * a, 0))

    return [weight(t + 1), weight(t), weight(1 - t), weight(2 - t)]


def rotate(image: np.ndarray, center: tuple[float, float], degrees: float, smooth: bool) -> np.ndarray:
    """Turned about a centre, same size. smooth: bicubic with repeated borders; else nearest with zero beyond."""
    h, w = image.shape[:2]
    c, s = math.cos(math.radians(degrees)), math.sin(math.radians(degrees))
    y, x = np.mgrid[:h, :w].astype(float)
    dx, dy = x - center[0], y - center[1]
    sx, sy = c * dx - s * dy + center[0], s * dx + c * dy + center[1]
    if not smooth:
        ix, iy = np.rint(sx).astype(int), np.rint(sy).astype(int)
        sound = (ix >= 0) & (ix < w) & (iy >= 0) & (iy < h)
        out = np.zeros_like(image)
        out[sound] = image[iy[sound], ix[sound]]
        return out
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    wx, wy = _cubic(sx - x0), _cubic(sy - y0)
    planes = image.reshape(h, w, -1).astype(float)
    total = np.zeros_like(planes)
    for j in range(4):
        line = np.clip(y0 + j - 1, 0, h - 1)
        for i in range(4):
            total += planes[line, np.clip(x0 + i - 1, 0, w - 1)] * (wy[j] * wx[i])[..., None]
    return np.clip(np.rint(total), 0, 255).astype(np.uint8).reshape(image.shape)


def crop(image: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The bounds of all pixels that are on; the whole image if none is."""
    pixels = np.argwhere(mask > 0)
    if not len(pixels):
        return image.copy()
    x, y, w, h = box_of(pixels)
    return image[y : y + h, x : x + w].copy()


def draw_boxes(image: np.ndarray, boxes: list[tuple[int, int, int, int]], color: tuple[int, ...] = (0, 0, 255), thickness: int = 3, fill: bool = False) -> np.ndarray:
    """Boxes outlined (which leaves their text readable) or filled (which does not). Gray images are drawn black."""
    out = image.copy()
    ink = 0 if image.ndim == 2 else np.array(color, np.uint8)
    for x, y, w, h in boxes:
        if fill:
            out[max(0, y) : y + h + 1, max(0, x) : x + w + 1] = ink
            continue
        r = thickness // 2
        for a, b, c, d in ((y - r, y + r + 1, x - r, x + w + r + 1), (y + h - r, y + h + r + 1, x - r, x + w + r + 1), (y - r, y + h + r + 1, x - r, x + r + 1), (y - r, y + h + r + 1, x + w - r, x + w + r + 1)):
            out[max(0, a) : max(0, b), max(0, c) : max(0, d)] = ink
    return out


def blur_region(image: np.ndarray, box: tuple[int, int, int, int], kernel: int) -> np.ndarray:
    """Gaussian blur of one region (x1, y1, x2, y2); borders are mirrored."""
    x1, y1, x2, y2 = box
    out = image.copy()
    part = image[y1:y2, x1:x2].astype(float)
    if part.size == 0:
        return out
    sigma, r = 0.3 * ((kernel - 1) * 0.5 - 1) + 0.8, kernel // 2
    weights = np.exp(-((np.arange(kernel) - r) ** 2) / (2 * sigma * sigma))
    weights /= weights.sum()
    for axis in (0, 1):
        size = part.shape[axis]
        place = np.arange(-r, size + r)
        span = max(1, 2 * size - 2)
        place = np.abs(place) % span
        place = np.where(place >= size, span - place, place)
        wide = np.take(part, place, axis=axis)
        part = sum(weight * np.take(wide, np.arange(k, k + size), axis=axis) for k, weight in enumerate(weights))
    out[y1:y2, x1:x2] = np.clip(np.rint(part), 0, 255).astype(np.uint8)
    return out


def adaptive_threshold(gray: np.ndarray, block: int = 201, c: float = 2.0) -> np.ndarray:
    """Inverse threshold against the Gaussian mean of a block, less c."""
    sigma, r = 0.3 * ((block - 1) * 0.5 - 1) + 0.8, block // 2
    weights = np.exp(-((np.arange(block) - r) ** 2) / (2 * sigma * sigma))
    weights /= weights.sum()
    mean = gray.astype(float)
    for axis in (0, 1):
        wide = np.pad(mean, [(r, r) if k == axis else (0, 0) for k in (0, 1)], mode="edge")
        mean = np.apply_along_axis(lambda v: np.convolve(v, weights, "valid"), axis, wide)
    return np.where(gray > np.rint(mean) - c, 0, 255).astype(np.uint8)


def straighten(image: np.ndarray, block: int = 201) -> np.ndarray:
    """The older path: threshold, largest component, its rectangle turned upright and cut out."""
    gray = image if image.ndim == 2 else np.rint(image @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
    parts = outer_components(adaptive_threshold(gray, min(block, 2 * (min(gray.shape) // 2) - 1)))
    if not parts:
        return image.copy()
    center, (w, h), degrees = min_area_rect(max(parts, key=len)[:, ::-1])
    if w < h:
        w, h, degrees = h, w, degrees + 90
    turned = rotate(image, center, degrees, smooth=True)
    x, y = round(center[0] - w / 2), round(center[1] - h / 2)
    return turned[max(0, y) : max(1, y + round(h) + 1), max(0, x) : max(1, x + round(w) + 1)]


def encode_png(image: np.ndarray) -> bytes:
    """Gray or RGB, 8 bits, without filters."""
    h, w = image.shape[:2]
    kind = 0 if image.ndim == 2 else 2
    lines = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(image).reshape(h, -1)], axis=1)
    chunk = lambda name, data: struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))
    head = struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def from_spark_image(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """RGB or gray from the bytes of Spark's image source, whose channels are B, G, R."""
    flat = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return flat[..., 0].copy() if channels == 1 else flat[..., 2::-1].copy()
