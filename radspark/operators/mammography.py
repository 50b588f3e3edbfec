"""Mammogram kernels: orientation, breast and pectoral masks, implants, contrast, cropping."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

LEFT, RIGHT, UNKNOWN = "left", "right", "unknown"
VIEWS = ("CC", "MLO", "ML", "LM")


@dataclass
class Config:
    target: str = LEFT
    auto_detect: bool = True
    threshold: str = "otsu"  # otsu, percentile, fixed
    threshold_percentile: float = 5.0
    min_area: float = 0.05
    kernel: int = 25
    remove_artifacts: bool = True
    pectoral: bool = True
    pectoral_margin: int = 10
    min_angle: float = 20.0
    max_angle: float = 75.0
    clahe: bool = True
    clip_limit: float = 2.0
    grid: tuple[int, int] = (8, 8)
    implants: bool = True
    implant_level: float = 0.95
    crop: bool = True
    padding: int = 10


@dataclass
class Analysis:
    orientation: str = UNKNOWN
    was_flipped: bool = False
    breast_mask: np.ndarray | None = None
    breast_bbox: tuple[int, int, int, int] | None = None
    breast_area_pixels: int = 0
    breast_area_fraction: float = 0.0
    pectoral_mask: np.ndarray | None = None
    pectoral_area_fraction: float = 0.0
    implant_detected: bool = False
    implant_mask: np.ndarray | None = field(default=None)
    view_position: str = "OTHER"


def to_u8(a: np.ndarray) -> np.ndarray:
    return a if a.dtype == np.uint8 else np.clip(a.astype(np.float64) * 255, 0, 255).astype(np.uint8)


def detect_orientation(a: np.ndarray) -> str:
    if a.ndim != 2:
        raise ValueError("a 2-D image is needed")
    half = a.shape[1] // 2
    cols = a.sum(axis=0, dtype=np.float64)
    left, right = cols[:half].sum(), cols[half:].sum()
    if left + right < 1e-8:
        return UNKNOWN
    ratio = left / max(right, 1e-8)
    if ratio > 1.1:
        return LEFT
    if ratio < 0.9:
        return RIGHT
    return LEFT if (cols * np.arange(len(cols))).sum() / cols.sum() < half else RIGHT


def normalise_laterality(a: np.ndarray, laterality: str | None, target: str = LEFT, auto: bool = True) -> tuple[np.ndarray, bool]:
    now = {"L": LEFT, "R": RIGHT}.get((laterality or "").upper()) or (detect_orientation(a) if auto else UNKNOWN)
    if now in (UNKNOWN, target):
        return a, False
    return np.ascontiguousarray(a[:, ::-1]), True


def ellipse(k: int) -> list[tuple[int, int]]:
    """(row offset, half width) of each row of a k x k ellipse."""
    r = k // 2
    return [(y, int(round(r * np.sqrt(max(0.0, 1 - (y / r) ** 2)))) if r else 0) for y in range(-r, k - r)]


def dilate(m: np.ndarray, k: int) -> np.ndarray:
    """Rows are widened by running sums, then shifted; outside counts as empty."""
    h, w = m.shape
    total = np.concatenate([np.zeros((h, 1), np.int64), np.cumsum(m, axis=1)], axis=1)
    out = np.zeros((h, w), bool)
    cols = np.arange(w)
    for y, half in ellipse(k):
        wide = total[:, np.minimum(cols + half + 1, w)] - total[:, np.maximum(cols - half, 0)] > 0
        lo, hi = max(0, y), min(h, h + y)
        out[lo:hi] |= wide[lo - y : hi - y]
    return out


def erode(m: np.ndarray, k: int) -> np.ndarray:
    """Outside counts as full."""
    return ~dilate(~m, k)


def close_open(m: np.ndarray, k: int) -> np.ndarray:
    m = erode(dilate(m, k), k)
    return dilate(erode(m, k), k)


def otsu(u8: np.ndarray) -> int:
    p = np.bincount(u8.ravel(), minlength=256) / u8.size
    w = np.cumsum(p)
    m = np.cumsum(p * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (m[-1] * w - m) ** 2 / (w * (1 - w))
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1)))


def components(m: np.ndarray) -> tuple[np.ndarray, int]:
    """8-connected labels from 1, by joining the runs of neighbouring rows."""
    h, w = m.shape
    edge = np.diff(np.pad(m.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, starts = np.nonzero(edge == 1)
    _, ends = np.nonzero(edge == -1)
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first = np.searchsorted(rows, np.arange(h + 1))
    for y in range(1, h):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if starts[i] <= ends[j] and starts[j] <= ends[i]:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
            if ends[i] < ends[j]:
                i += 1
            else:
                j += 1
    roots = np.array([find(k) for k in range(len(rows))], dtype=np.int64)
    names, at = np.unique(roots, return_inverse=True) if len(roots) else (roots, roots)
    out = np.zeros((h, w), np.int32)
    for y, s, e, n in zip(rows, starts, ends, at):
        out[y, s:e] = n + 1
    return out, len(names)


def fill_holes(m: np.ndarray) -> np.ndarray:
    outside = np.pad(~m, 1, constant_values=True)
    lab, _ = _four(outside)
    return (lab != lab[0, 0])[1:-1, 1:-1]


def _four(m: np.ndarray) -> tuple[np.ndarray, int]:
    """4-connected labels: background joins only through edges."""
    h, w = m.shape
    edge = np.diff(np.pad(m.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    rows, starts = np.nonzero(edge == 1)
    _, ends = np.nonzero(edge == -1)
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    first = np.searchsorted(rows, np.arange(h + 1))
    for y in range(1, h):
        i, j = first[y - 1], first[y]
        while i < first[y] and j < first[y + 1]:
            if starts[i] < ends[j] and starts[j] < ends[i]:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
            if ends[i] < ends[j]:
                i += 1
            else:
                j += 1
    out = np.zeros((h, w), np.int32)
    for k, (y, s, e) in enumerate(zip(rows, starts, ends)):
        out[y, s:e] = find(k) + 1
    return out, len(rows)


def outline_area(filled: np.ndarray) -> float:
    """Area of the polygon through the centres of the outline's pixels (Pick's theorem)."""
    p = np.pad(filled, 1)
    inner = p[1:-1, 1:-1] & p[:-2, 1:-1] & p[2:, 1:-1] & p[1:-1, :-2] & p[1:-1, 2:]
    return max(0.0, filled.sum() - (filled & ~inner).sum() / 2 - 1)


def segment_breast(a: np.ndarray, c: Config = Config()) -> np.ndarray:
    """Mask (0/255) of the largest bright region, holes filled; small other regions are erased."""
    u8 = to_u8(a)
    some = u8[u8 > 0]
    if c.threshold == "otsu":
        level = otsu(u8)
    elif c.threshold == "percentile":
        level = float(np.percentile(some, c.threshold_percentile)) if some.size else 0.0
    else:
        level = 10
    m = close_open(u8 > level, c.kernel)
    lab, n = components(m)
    if not n:
        return m.astype(np.uint8) * 255
    regions = [fill_holes(lab == k) for k in range(1, n + 1)]
    areas = [outline_area(r) for r in regions]
    best = int(np.argmax(areas))
    out = regions[best]
    if c.remove_artifacts and areas[best] < 0.1 * c.min_area * a.size:
        out = np.zeros_like(out)
    return out.astype(np.uint8) * 255


def _edges(u8: np.ndarray, low: int = 50, high: int = 150) -> np.ndarray:
    """Canny edges: 3x3 Sobel, L1 strength, thinning, hysteresis."""
    p = np.pad(u8.astype(np.int32), 1, mode="edge")
    gx = p[:-2, 2:] + 2 * p[1:-1, 2:] + p[2:, 2:] - p[:-2, :-2] - 2 * p[1:-1, :-2] - p[2:, :-2]
    gy = p[2:, :-2] + 2 * p[2:, 1:-1] + p[2:, 2:] - p[:-2, :-2] - 2 * p[:-2, 1:-1] - p[:-2, 2:]
    mag = np.abs(gx) + np.abs(gy)
    q = np.pad(mag, 1)
    at = lambda dy, dx: q[1 + dy : 1 + dy + mag.shape[0], 1 + dx : 1 + dx + mag.shape[1]]
    ax, ay = np.abs(gx), np.abs(gy)
    flat, steep = ay < 0.4142 * ax, ay > 2.4142 * ax
    same = (gx >= 0) == (gy >= 0)
    before = np.where(flat, at(0, -1), np.where(steep, at(-1, 0), np.where(same, at(-1, -1), at(-1, 1))))
    after = np.where(flat, at(0, 1), np.where(steep, at(1, 0), np.where(same, at(1, 1), at(1, -1))))
    thin = (mag > before) & (mag >= after) & (mag > low)
    lab, n = components(thin)
    strong = np.zeros(n + 1, bool)
    strong[np.unique(lab[thin & (mag > high)])] = True
    strong[0] = False
    return strong[lab]


def _lines(edges: np.ndarray, votes: int) -> np.ndarray:
    """(rho, theta) of local peaks above ``votes`` in the Hough plane, one degree by one pixel."""
    y, x = np.nonzero(edges)
    theta = np.arange(180) * np.pi / 180
    span = edges.shape[0] + edges.shape[1]
    rho = np.rint(np.outer(x, np.cos(theta)) + np.outer(y, np.sin(theta))).astype(np.int64) + span
    acc = np.zeros((181 + 1, 2 * span + 3), np.int64)
    for t in range(180):
        acc[t + 1, 1:-1] = np.bincount(rho[:, t], minlength=2 * span + 1)[: 2 * span + 1]
    mid = acc[1:-1, 1:-1]
    peak = (mid > votes) & (mid > acc[1:-1, :-2]) & (mid >= acc[1:-1, 2:]) & (mid > acc[:-2, 1:-1]) & (mid >= acc[2:, 1:-1])
    t, r = np.nonzero(peak)
    return np.stack([r - span, t * np.pi / 180], axis=1).astype(float)


def segment_pectoral(a: np.ndarray, breast: np.ndarray, orientation: str, c: Config = Config()) -> np.ndarray:
    """Mask of the muscle in the upper third at the chest wall; without any line, the bright part itself."""
    h, w = a.shape
    out = np.zeros((h, w), np.uint8)
    rh, rw = h // 2, w // 3
    x0 = 0 if orientation == LEFT else w - rw
    roi = to_u8(a)[:rh, x0 : x0 + rw]
    if roi.size == 0:
        return out
    some = roi[roi > 0]
    bright = (roi > (np.percentile(some, 80) if some.size else 128)) & (breast[:rh, x0 : x0 + rw] > 0)
    found = _lines(_edges(bright.astype(np.uint8) * 255), max(1, min(rh, rw) // 4))
    if not len(found):
        out[:rh, x0 : x0 + rw] = bright * np.uint8(255)
        return out
    deg = np.degrees(found[:, 1])
    fit = found[(deg >= c.min_angle) & (deg <= c.max_angle)]
    if len(fit):
        r, t = fit[np.argmax(np.abs(fit[:, 0]))]
        yy, xx = np.mgrid[:rh, :rw]
        out[:rh, x0 : x0 + rw] = (xx * np.cos(t) + yy * np.sin(t) < r + c.pectoral_margin) * np.uint8(255)
    return out


def detect_implant(a: np.ndarray, breast: np.ndarray, c: Config = Config(), known: bool | None = None) -> tuple[bool, np.ndarray | None]:
    inside = breast > 0
    if not inside.any():
        return False, None
    bright = close_open((a > c.implant_level) & inside, 15)
    found = bool(bright.sum() / inside.sum() > 0.10 or known)
    return found, bright.astype(np.uint8) * 255 if found else None


def clahe(a: np.ndarray, clip: float = 2.0, grid: tuple[int, int] = (8, 8)) -> np.ndarray:
    """Contrast-limited adaptive equalisation of 8-bit values, back in 0..1."""
    u8 = to_u8(a)
    h, w = u8.shape
    gy, gx = grid
    p = np.pad(u8, ((0, -h % gy), (0, -w % gx)), mode="reflect" if h > 1 and w > 1 else "edge")
    th, tw = p.shape[0] // gy, p.shape[1] // gx
    limit = max(1, int(clip * th * tw / 256)) if clip > 0 else th * tw
    luts = np.zeros((gy, gx, 256))
    for i in range(gy):
        for j in range(gx):
            hist = np.bincount(p[i * th : (i + 1) * th, j * tw : (j + 1) * tw].ravel(), minlength=256)
            over = int(np.maximum(hist - limit, 0).sum())
            hist = np.minimum(hist, limit) + over // 256
            rest = over % 256
            if rest:
                hist[:: max(1, 256 // rest)][:rest] += 1
            luts[i, j] = np.clip(np.rint(np.cumsum(hist) * 255.0 / (th * tw)), 0, 255)
    y, x = np.arange(h) / th - 0.5, np.arange(w) / tw - 0.5
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    fy, fx = (y - y0)[:, None], (x - x0)[None]
    ya, yb = np.clip(y0, 0, gy - 1)[:, None], np.clip(y0 + 1, 0, gy - 1)[:, None]
    xa, xb = np.clip(x0, 0, gx - 1)[None], np.clip(x0 + 1, 0, gx - 1)[None]
    mixed = (luts[ya, xa, u8] * (1 - fx) + luts[ya, xb, u8] * fx) * (1 - fy) + (luts[yb, xa, u8] * (1 - fx) + luts[yb, xb, u8] * fx) * fy
    return (np.rint(mixed) / 255.0).astype(np.float32)


def crop_to_breast(a: np.ndarray, mask: np.ndarray, padding: int = 10) -> tuple[np.ndarray, tuple[int, int, int, int]]:
    ys, xs = np.nonzero(mask.any(axis=1))[0], np.nonzero(mask.any(axis=0))[0]
    h, w = a.shape
    if not len(ys):
        return a, (0, 0, h, w)
    box = (max(0, ys[0] - padding), max(0, xs[0] - padding), min(h, ys[-1] + 1 + padding), min(w, xs[-1] + 1 + padding))
    return a[box[0] : box[2], box[1] : box[3]], tuple(int(v) for v in box)


def process(a: np.ndarray, laterality: str | None = None, view: str | None = None, implant: bool | None = None, c: Config = Config()) -> tuple[np.ndarray, Analysis]:
    """Turn to one side, mask the breast, find implants and (MLO only) muscle, lift contrast, crop."""
    a = np.squeeze(np.asarray(a, dtype=np.float32))
    if a.ndim != 2:
        raise ValueError("a 2-D image is needed")
    out = Analysis(orientation=c.target, view_position=view.upper() if view and view.upper() in VIEWS else "OTHER")
    a, out.was_flipped = normalise_laterality(a, laterality, c.target, c.auto_detect)
    mask = segment_breast(a, c)
    out.breast_mask, out.breast_area_pixels = mask, int((mask > 0).sum())
    out.breast_area_fraction = out.breast_area_pixels / a.size
    if c.implants:
        out.implant_detected, out.implant_mask = detect_implant(a, mask, c, implant)
    if c.pectoral and out.view_position == "MLO":
        muscle = segment_pectoral(a, mask, c.target, c)
        out.pectoral_mask, out.pectoral_area_fraction = muscle, float((muscle > 0).sum() / max(1, out.breast_area_pixels))
        mask = np.where(muscle > 0, 0, mask).astype(np.uint8)
    a = np.where(mask > 0, a, 0).astype(np.float32)
    if c.clahe:
        a = np.where(mask > 0, clahe(a, c.clip_limit, c.grid), 0).astype(np.float32)
    if c.crop:
        a, out.breast_bbox = crop_to_breast(a, mask, c.padding)
    return a, out
