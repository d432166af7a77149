"""Image stencils as native Spark array expressions (one image per row).

An image is ``pixels: array<double>`` in row-major order with ``height`` and
``width`` columns.  Every builder returns a ``Column``; nothing leaves the JVM.

Plan rule: a *computed* array must never be indexed from inside a lambda,
because Catalyst inlines the producing expression into every element access
(an 8x8 convolution then re-runs per pixel).  ``let`` binds a computed value
to a lambda variable, which is evaluated once per row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Kernel = Sequence[Sequence[float]]

# Fixed kernels.  Sobel 3x3 first derivatives (x: left to right, y: top to
# bottom); the 5x5 Laplacian is outer(s, d) + outer(d, s) with the 5-tap
# smoothing s = [1, 4, 6, 4, 1] and second derivative d = [1, 0, -2, 0, 1].
SOBEL_X = ((-1.0, 0.0, 1.0), (-2.0, 0.0, 2.0), (-1.0, 0.0, 1.0))
SOBEL_Y = ((-1.0, -2.0, -1.0), (0.0, 0.0, 0.0), (1.0, 2.0, 1.0))
_SMOOTH5 = (1.0, 4.0, 6.0, 4.0, 1.0)
_DERIV2_5 = (1.0, 0.0, -2.0, 0.0, 1.0)
LAPLACE_5 = tuple(tuple(_SMOOTH5[r] * _DERIV2_5[c] + _DERIV2_5[r] * _SMOOTH5[c] for c in range(5))
                  for r in range(5))

# Gray weights for B, G, R byte order (ITU-R 601 luma).
LUMA_BGR = (0.114, 0.587, 0.299)


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(x)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _idiv(a: Column, b: Column) -> Column:
    return (a / b).cast("int")


def reflect101(x: Column, n: Column) -> Column:
    """Border index ``gfedcb|abcdefgh|gfedcba`` (OpenCV BORDER_REFLECT_101)."""
    period = n * 2 - 2
    m = F.pmod(x, F.greatest(period, F.lit(1)))
    return F.when(n <= 1, F.lit(0)).when(m < n, m).otherwise(period - m)


def replicate(x: Column, n: Column) -> Column:
    """Border index ``aaaaaa|abcdefgh|hhhhhhh`` (BORDER_REPLICATE)."""
    return F.least(F.greatest(x, F.lit(0)), n - 1)


_BORDERS = {"reflect101": reflect101, "replicate": replicate}


def pixel_indices(h, w) -> Column:
    """``[0, h*w)``; empty for an empty image."""
    h, w = _c(h), _c(w)
    n = h * w
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def pad(pixels, h, w, p: int, border: str = "reflect101", value: float = 0.0) -> Column:
    """The image with a ``p``-pixel border -> ``(h+2p) x (w+2p)``.

    ``border`` is ``reflect101``, ``replicate`` or ``constant`` (filled with ``value``).
    """
    h, w = _c(h), _c(w)
    pw = w + 2 * p

    def body(a: Column) -> Column:
        def at(j: Column) -> Column:
            r, c = _idiv(j, pw) - p, F.pmod(j, pw) - p
            if border == "constant":
                inside = (r >= 0) & (r < h) & (c >= 0) & (c < w)
                return F.when(inside, F.element_at(a, F.when(inside, r * w + c + 1).otherwise(F.lit(1))))\
                    .otherwise(F.lit(float(value)))
            fold = _BORDERS[border]
            return F.element_at(a, fold(r, h) * w + fold(c, w) + 1)
        return F.transform(pixel_indices(h + 2 * p, pw), at)

    return let(_c(pixels), body)


def _padded_index(i: Column, w: Column, p: int) -> Column:
    """1-based index in the padded image of pixel ``i`` of the unpadded one."""
    return (_idiv(i, w) + p) * (w + 2 * p) + F.pmod(i, w) + p + 1


def convolve(pixels, h, w, kernel: Kernel, border: str = "reflect101") -> Column:
    """2-D correlation with ``kernel`` centred on each pixel (as OpenCV ``filter2D``).

    The image is padded once (border folding per padded pixel, not per tap);
    each non-zero tap is then one ``element_at`` at a fixed offset.
    """
    h, w = _c(h), _c(w)
    kh, kw = len(kernel), len(kernel[0])
    p = max(kh, kw) // 2
    pw = w + 2 * p
    taps = [(r - kh // 2, c - kw // 2, float(kernel[r][c]))
            for r in range(kh) for c in range(kw) if kernel[r][c] != 0]

    def body(a: Column) -> Column:
        def at(i: Column) -> Column:
            base = _padded_index(i, w, p)
            terms = [F.lit(wt) * F.element_at(a, base + (dr * pw + dc)) for dr, dc, wt in taps]
            total = terms[0]
            for t in terms[1:]:
                total = total + t
            return total
        return F.transform(pixel_indices(h, w), at)

    return let(pad(pixels, h, w, p, border), body)


def magnitude(gx: Column, gy: Column) -> Column:
    """Element-wise ``sqrt(gx^2 + gy^2)`` of two aligned arrays."""
    return F.zip_with(gx, gy, lambda x, y: F.sqrt(x * x + y * y))


def scale_to_8bit(pixels, const_value: float = 0.0) -> Column:
    """Min-max scale to 0..255 and round half to even, as ``convertTo(CV_8U, s, -min*s)``.

    A constant image (max == min) has no scale; it maps to ``const_value``.
    """
    def body(s: Column) -> Column:
        lo, hi = s["lo"], s["hi"]
        k = F.lit(255.0) / (hi - lo)
        off = -lo * k
        return F.when(hi > lo, F.transform(s["a"], lambda v: _sat8(F.bround(v * k + off, 0))))\
            .otherwise(F.transform(s["a"], lambda v: F.lit(float(const_value))))
    return let(_c(pixels), lambda arr: let(
        F.struct(arr.alias("a"), F.array_min(arr).alias("lo"), F.array_max(arr).alias("hi")), body))


def _sat8(v: Column) -> Column:
    return F.least(F.lit(255.0), F.greatest(F.lit(0.0), v))


def to_8bit(pixels) -> Column:
    """Saturating round to 0..255 (``convertTo(CV_8U)`` without scaling)."""
    return F.transform(_c(pixels), lambda v: _sat8(F.bround(v, 0)))


def threshold_binary(pixels, thresh: float, maxval: float = 255.0) -> Column:
    """``maxval`` where value > ``thresh`` else 0."""
    return F.transform(_c(pixels), lambda v: F.when(v > F.lit(thresh), F.lit(maxval))
                       .otherwise(F.lit(0.0)))


def dilate3x3(pixels, h, w) -> Column:
    """Grey dilation with a 3x3 square: max over the in-bounds neighbourhood."""
    h, w = _c(h), _c(w)
    pw = w + 2

    def body(a: Column) -> Column:
        def at(i: Column) -> Column:
            base = _padded_index(i, w, 1)
            return F.greatest(*[F.element_at(a, base + (dr * pw + dc))
                                for dr in (-1, 0, 1) for dc in (-1, 0, 1)])
        return F.transform(pixel_indices(h, w), at)

    return let(pad(pixels, h, w, 1, "constant", float("-inf")), body)


def subtract_sat(a, b) -> Column:
    """Element-wise ``max(a - b, 0)`` (8-bit saturating subtraction)."""
    return F.zip_with(_c(a), _c(b), lambda x, y: F.greatest(x - y, F.lit(0.0)))


def resize_nearest(pixels, h, w, out_h: int, out_w: int) -> Column:
    """Nearest-neighbour resize: destination (r, c) samples source
    ``(floor((r + 0.5) * h / out_h), floor((c + 0.5) * w / out_w))``."""
    h, w = _c(h), _c(w)

    def body(a: Column) -> Column:
        def at(j: Column) -> Column:
            r, c = _idiv(j, F.lit(out_w)), F.pmod(j, F.lit(out_w))
            sr = F.least(F.floor((r + 0.5) * h / F.lit(out_h)).cast("int"), h - 1)
            sc = F.least(F.floor((c + 0.5) * w / F.lit(out_w)).cast("int"), w - 1)
            return F.element_at(a, sr * w + sc + 1)
        return F.transform(F.sequence(F.lit(0), F.lit(out_h * out_w - 1)), at)

    return let(_c(pixels), body)


def split_channels(pixels, h, w, channels) -> Column:
    """Interleaved ``[p0c0, p0c1, ...]`` -> ``array<array<double>>`` one plane per channel."""
    h, w, ch = _c(h), _c(w), _c(channels)

    def body(a: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), ch - 1),
                           lambda k: F.transform(pixel_indices(h, w),
                                                 lambda i: F.element_at(a, i * ch + k + 1)))
    return let(_c(pixels), body)


def luma(planes: Column, weights: Sequence[float] = LUMA_BGR) -> Column:
    """Weighted sum of channel planes (B, G, R by default) -> one gray plane."""
    def add(wk: float):
        return lambda x, y: x + y * F.lit(wk)

    def body(p: Column) -> Column:
        out = F.transform(F.element_at(p, 1), lambda v: v * F.lit(weights[0]))
        for k in range(1, len(weights)):
            out = F.zip_with(out, F.element_at(p, k + 1), add(weights[k]))
        return out
    return let(planes, body)


# Fixed values of the Canny definition: direction sectors are split at 22.5 and
# 67.5 degrees using tan(22.5) in 15-bit fixed point, as integer comparisons.
CANNY_SHIFT = 15
CANNY_TG22 = 13573  # round(tan(22.5 deg) * 2**15)


def canny_classes(pixels, h, w, low: float, high: float) -> Column:
    """Per-pixel Canny class before hysteresis: 2 strong, 1 weak, 0 none.

    Sobel 3x3 gradients with replicated borders; L2 magnitude (compared squared);
    non-maximum suppression along the quantised gradient direction against
    zero-padded neighbours, ``m > first`` and ``m >= second`` for horizontal and
    vertical directions, strict for diagonals; weak = suppressed max above
    ``low``, strong = above ``high``.
    """
    h, w = _c(h), _c(w)
    gx = convolve(pixels, h, w, SOBEL_X, border="replicate")
    gy = convolve(pixels, h, w, SOBEL_Y, border="replicate")
    lo2, hi2 = float(low) * float(low), float(high) * float(high)

    pw = w + 2

    def body(s: Column) -> Column:
        ax_, ay_, m2, mp = s["gx"], s["gy"], s["m2"], s["mp"]

        def at(i: Column) -> Column:
            base = _padded_index(i, w, 1)

            def mag(dr: int, dc: int) -> Column:  # zero outside the image
                return F.element_at(mp, base + (dr * pw + dc))

            gxi = F.element_at(ax_, i + 1)
            gyi = F.element_at(ay_, i + 1)
            m = F.element_at(m2, i + 1)
            xs, ys = F.abs(gxi), F.abs(gyi)
            y = ys * F.lit(float(1 << CANNY_SHIFT))
            tg22x = xs * F.lit(float(CANNY_TG22))
            tg67x = tg22x + xs * F.lit(float(1 << (CANNY_SHIFT + 1)))
            same_sign = (gxi * gyi) >= 0
            keep = (F.when(y < tg22x, (m > mag(0, -1)) & (m >= mag(0, 1)))
                    .when(y > tg67x, (m > mag(-1, 0)) & (m >= mag(1, 0)))
                    .when(same_sign, (m > mag(-1, -1)) & (m > mag(1, 1)))
                    .otherwise((m > mag(-1, 1)) & (m > mag(1, -1))))
            cand = (m > F.lit(lo2)) & keep
            return F.when(cand & (m > F.lit(hi2)), F.lit(2)).when(cand, F.lit(1)).otherwise(F.lit(0))
        return F.transform(pixel_indices(h, w), at)

    def with_m2(g: Column) -> Column:
        m2 = F.zip_with(g["gx"], g["gy"], lambda x, y: x * x + y * y)
        return let(m2, lambda m: let(F.struct(g["gx"].alias("gx"), g["gy"].alias("gy"), m.alias("m2"),
                                              pad(m, h, w, 1, "constant", 0.0).alias("mp")), body))

    return let(F.struct(gx.alias("gx"), gy.alias("gy")), with_m2)
