"""The image stencils as numpy functions (``engine="numpy"``).

Every function takes one image ``(h, w)`` or a stack of same-sized images
``(n, h, w)`` and works on the last two axes, so a whole Arrow batch of
same-sized images is one set of array operations.  They define the same
results as the native expressions in ``corvid.functions.image`` (tests require
equality) and run inside ``mapInPandas``: Spark still partitions the images,
numpy does the per-pixel arithmetic in vectorised form instead of an
interpreted lambda per pixel.
"""

from __future__ import annotations

import numpy as np

from corvid.functions.image import CANNY_SHIFT, CANNY_TG22, LAPLACE_5, LUMA_BGR, SOBEL_X, SOBEL_Y

_NP_BORDER = {"reflect101": "reflect", "replicate": "edge"}


def _hw(a: np.ndarray) -> tuple[int, int]:
    return a.shape[-2], a.shape[-1]


def pad(a: np.ndarray, p: int, border: str = "reflect101", value: float = 0.0) -> np.ndarray:
    """Pad the last two axes by ``p`` with the given border rule."""
    lead = [(0, 0)] * (a.ndim - 2)
    if border == "constant":
        return np.pad(a, lead + [(p, p), (p, p)], mode="constant", constant_values=value)
    out = a
    for axis in (-2, -1):
        # a single row / column reflects onto itself
        mode = "edge" if (border == "reflect101" and a.shape[axis] == 1) else _NP_BORDER[border]
        width = lead + [(0, 0), (0, 0)]
        width[axis] = (p, p)
        out = np.pad(out, width, mode=mode)
    return out


def correlate(a: np.ndarray, kernel, border: str = "reflect101") -> np.ndarray:
    k = np.asarray(kernel, dtype=float)
    p = max(k.shape) // 2
    src = pad(a, p, border)
    h, w = _hw(a)
    out = np.zeros(a.shape)
    for r in range(k.shape[0]):
        for c in range(k.shape[1]):
            if k[r, c] != 0:
                out += k[r, c] * src[..., r:r + h, c:c + w]
    return out


def dilate3x3(a: np.ndarray) -> np.ndarray:
    src = pad(a, 1, "constant", -np.inf)
    h, w = _hw(a)
    out = src[..., 0:h, 0:w]
    for r in range(3):
        for c in range(3):
            out = np.maximum(out, src[..., r:r + h, c:c + w])
    return out


def scale_to_8bit(a: np.ndarray, const_value: float = 0.0) -> np.ndarray:
    """Per image: ``round_half_even(v * k - lo * k)``, k = 255 / (hi - lo); constant -> value."""
    lo = a.min(axis=(-2, -1), keepdims=True)
    hi = a.max(axis=(-2, -1), keepdims=True)
    varies = hi > lo
    k = 255.0 / np.where(varies, hi - lo, 1.0)
    scaled = np.clip(np.round(a * k + (-lo * k)), 0.0, 255.0)  # np.round: half to even
    return np.where(varies, scaled, float(const_value))


def sobel(a: np.ndarray) -> np.ndarray:
    gx, gy = correlate(a, SOBEL_X), correlate(a, SOBEL_Y)
    return scale_to_8bit(np.sqrt(gx * gx + gy * gy))


def laplace(a: np.ndarray, thresh: float = 300.0) -> np.ndarray:
    b = np.where(correlate(a, LAPLACE_5) > thresh, 255.0, 0.0)
    return np.maximum(dilate3x3(b) - b, 0.0)


def canny_classes(a: np.ndarray, low: float, high: float) -> np.ndarray:
    """2 strong, 1 weak, 0 none (same rules as ``image.canny_classes``)."""
    gx, gy = correlate(a, SOBEL_X, "replicate"), correlate(a, SOBEL_Y, "replicate")
    m = gx * gx + gy * gy
    mp = pad(m, 1, "constant", 0.0)
    h, w = _hw(a)
    nb = {(dr, dc): mp[..., 1 + dr:1 + dr + h, 1 + dc:1 + dc + w]
          for dr in (-1, 0, 1) for dc in (-1, 0, 1)}
    xs, ys = np.abs(gx), np.abs(gy)
    y = ys * float(1 << CANNY_SHIFT)
    tg22x = xs * float(CANNY_TG22)
    tg67x = tg22x + xs * float(1 << (CANNY_SHIFT + 1))
    horiz = y < tg22x
    vert = ~horiz & (y > tg67x)
    same = gx * gy >= 0
    keep = np.where(horiz, (m > nb[0, -1]) & (m >= nb[0, 1]),
                    np.where(vert, (m > nb[-1, 0]) & (m >= nb[1, 0]),
                             np.where(same, (m > nb[-1, -1]) & (m > nb[1, 1]),
                                      (m > nb[-1, 1]) & (m > nb[1, -1]))))
    cand = (m > low * low) & keep
    return np.where(cand & (m > high * high), 2, np.where(cand, 1, 0)).astype(np.int8)


def hysteresis(cls: np.ndarray) -> np.ndarray:
    """255 on strong pixels and on weak pixels 8-connected to them, else 0.

    Connected components of the candidate (weak or strong) pixels, vectorised:
    every pair of 8-adjacent candidates in the same image is an edge; roots are
    hooked onto the smaller root and paths are compressed (pointer jumping)
    until every edge joins equal roots.  A component is an edge when it holds a
    strong pixel.  A stack is one graph of disjoint images.
    """
    h, w = _hw(cls)
    flat = cls.reshape(-1)
    out = np.zeros(flat.size)
    idx = np.flatnonzero(flat >= 1)
    if idx.size == 0:
        return out.reshape(cls.shape)
    node = np.full(flat.size, -1, dtype=np.int64)
    node[idx] = np.arange(idx.size)
    img, pos = np.divmod(idx, h * w)
    rows, cols = np.divmod(pos, w)
    us, vs = [], []
    for dr, dc in ((0, 1), (1, -1), (1, 0), (1, 1)):  # each neighbour pair once
        r2, c2 = rows + dr, cols + dc
        ok = (r2 < h) & (c2 >= 0) & (c2 < w)
        tgt = img[ok] * (h * w) + r2[ok] * w + c2[ok]
        both = flat[tgt] >= 1
        us.append(node[idx[ok][both]])
        vs.append(node[tgt[both]])
    u, v = np.concatenate(us), np.concatenate(vs)
    parent = np.arange(idx.size)
    while True:
        pu, pv = parent[u], parent[v]
        differ = pu != pv
        if not differ.any():
            break
        lo, hi = np.minimum(pu[differ], pv[differ]), np.maximum(pu[differ], pv[differ])
        np.minimum.at(parent, hi, lo)
        while True:  # compress to roots
            grand = parent[parent]
            if np.array_equal(grand, parent):
                break
            parent = grand
    strong_root = np.zeros(idx.size, dtype=bool)
    strong_root[parent[flat[idx] == 2]] = True
    out[idx[strong_root[parent]]] = 255.0
    return out.reshape(cls.shape)


def canny(a: np.ndarray, low: float = 100.0, high: float = 250.0) -> np.ndarray:
    return hysteresis(canny_classes(a, low, high))


def resize_nearest(a: np.ndarray, out_h: int, out_w: int) -> np.ndarray:
    h, w = _hw(a)
    rows = np.minimum(np.floor((np.arange(out_h) + 0.5) * h / out_h).astype(int), h - 1)
    cols = np.minimum(np.floor((np.arange(out_w) + 0.5) * w / out_w).astype(int), w - 1)
    return a[..., rows, :][..., :, cols]


def decode_planes(data: bytes, h: int, w: int, c: int) -> np.ndarray | None:
    """Interleaved B, G, R(, A) bytes -> planes ``(c, h, w)``; None unless there are exactly h x w x c bytes."""
    if data is None or h <= 0 or w <= 0 or c <= 0 or len(data) != h * w * c:
        return None
    return np.frombuffer(data, dtype=np.uint8).astype(float).reshape(h, w, c).transpose(2, 0, 1)


def decode_gray(data: bytes, h: int, w: int, c: int) -> np.ndarray | None:
    """The bytes as a 2-D gray image (601 luma), as ``read_images``; None if they do not fit the size."""
    planes = decode_planes(data, h, w, c)
    if planes is None:
        return None
    return luma(planes) if c >= 3 else planes[0]


def luma(planes: np.ndarray) -> np.ndarray:
    """B, G, R planes (on the third axis from the end) -> gray."""
    return sum(planes[..., k, :, :] * LUMA_BGR[k] for k in range(3))


def sobel_colour(planes: np.ndarray) -> np.ndarray:
    """Sobel magnitude per B, G, R plane, one min / max over all of them, scaled to 8 bits, then luma."""
    planes = planes[..., :3, :, :]
    gx, gy = correlate(planes, SOBEL_X), correlate(planes, SOBEL_Y)
    m = np.sqrt(gx * gx + gy * gy)
    lo, hi = m.min(axis=(-3, -2, -1), keepdims=True), m.max(axis=(-3, -2, -1), keepdims=True)
    varies = hi > lo
    k = 255.0 / np.where(varies, hi - lo, 1.0)
    scaled = np.clip(np.round(m * k - lo * k), 0.0, 255.0)
    return luma(np.where(varies, scaled, 0.0))
