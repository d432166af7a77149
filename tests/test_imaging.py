import numpy as np
import pytest
from pyspark.sql import functions as F

from corvid.functions import image as im
from corvid.operators import imaging


def frame(spark, images):
    rows = [(i, int(a.shape[0]), int(a.shape[1]), [float(x) for x in a.ravel()]) for i, a in enumerate(images)]
    return spark.createDataFrame(rows, "image_id long, height int, width int, pixels array<double>")


def back(df, images):
    got = {r.image_id: np.array(r.pixels) for r in df.collect()}
    return [got[i].reshape(a.shape) if got[i].size == a.size else got[i] for i, a in enumerate(images)]


def np_correlate(a, k, mode="reflect"):
    kh, kw = k.shape
    pad = np.pad(a, ((kh // 2,), (kw // 2,)), mode=mode)  # numpy 'reflect' == reflect-101
    out = np.zeros_like(a, dtype=float)
    for r in range(kh):
        for c in range(kw):
            out += k[r, c] * pad[r:r + a.shape[0], c:c + a.shape[1]]
    return out


def np_dilate(a):
    pad = np.pad(a, 1, mode="constant", constant_values=-np.inf)
    return np.max([pad[r:r + a.shape[0], c:c + a.shape[1]] for r in range(3) for c in range(3)], axis=0)


def np_canny(a, low=100.0, high=250.0):
    kx, ky = np.array(im.SOBEL_X), np.array(im.SOBEL_Y)
    gx, gy = np_correlate(a, kx, "edge"), np_correlate(a, ky, "edge")
    m2 = gx * gx + gy * gy
    h, w = a.shape
    mp = np.pad(m2, 1)
    cls = np.zeros_like(a, dtype=int)
    for r in range(h):
        for c in range(w):
            m = m2[r, c]
            if m <= low * low:
                continue
            nb = lambda dr, dc: mp[r + 1 + dr, c + 1 + dc]
            xs, ys = abs(gx[r, c]), abs(gy[r, c])
            y, tg22x = ys * 32768, xs * im.CANNY_TG22
            tg67x = tg22x + xs * 65536
            if y < tg22x:
                keep = m > nb(0, -1) and m >= nb(0, 1)
            elif y > tg67x:
                keep = m > nb(-1, 0) and m >= nb(1, 0)
            elif gx[r, c] * gy[r, c] >= 0:
                keep = m > nb(-1, -1) and m > nb(1, 1)
            else:
                keep = m > nb(-1, 1) and m > nb(1, -1)
            if keep:
                cls[r, c] = 2 if m > high * high else 1
    edge = cls == 2
    while True:  # flood fill by repeated dilation
        grown = (np_dilate(edge.astype(float)) > 0) & (cls >= 1) | edge
        if (grown == edge).all():
            break
        edge = grown
    return np.where(edge, 255.0, 0.0)


rng = np.random.default_rng(7)
IMAGES = [np.full((8, 8), 77.0),                                  # constant
          np.pad(np.array([[255.0]]), ((3, 4), (2, 5))),          # single bright pixel
          np.hstack([np.zeros((8, 4)), np.full((8, 4), 200.0)]),  # vertical step
          rng.integers(0, 256, (5, 7)).astype(float),             # non-square
          rng.integers(0, 256, (9, 6)).astype(float)]


def test_convolution_matches_numpy(spark):
    df = imaging.convolve(frame(spark, IMAGES), im.SOBEL_X)
    for got, a in zip(back(df, IMAGES), IMAGES):
        assert np.allclose(got, np_correlate(a, np.array(im.SOBEL_X)))
    df5 = imaging.convolve(frame(spark, IMAGES), im.LAPLACE_5)
    for got, a in zip(back(df5, IMAGES), IMAGES):
        assert np.allclose(got, np_correlate(a, np.array(im.LAPLACE_5)))


def test_laplace_kernel_values():
    k = np.array(im.LAPLACE_5)
    assert k.sum() == 0 and k[2, 2] == -24 and k[0, 0] == 2 and (k == k.T).all()


def test_dilate_ge_input_and_matches_numpy(spark):
    df = imaging.dilate(frame(spark, IMAGES))
    for got, a in zip(back(df, IMAGES), IMAGES):
        assert (got >= a).all() and np.allclose(got, np_dilate(a))


def test_sobel_scaled_and_constant_image(spark):
    df = imaging.sobel(frame(spark, IMAGES))
    outs = back(df, IMAGES)
    assert (outs[0] == 0).all()  # constant image: no scale, all zero
    for got, a in zip(outs[1:], IMAGES[1:]):
        mag = np.hypot(np_correlate(a, np.array(im.SOBEL_X)), np_correlate(a, np.array(im.SOBEL_Y)))
        lo, hi = mag.min(), mag.max()
        want = np.clip(np.round(mag * (255 / (hi - lo)) - lo * (255 / (hi - lo))), 0, 255)
        assert np.allclose(got, want) and got.max() == 255 and got.min() == 0


def test_laplace_rim_matches_numpy(spark):
    df = imaging.laplace(frame(spark, IMAGES))
    for got, a in zip(back(df, IMAGES), IMAGES):
        b = np.where(np_correlate(a, np.array(im.LAPLACE_5)) > 300, 255.0, 0.0)
        assert np.allclose(got, np.maximum(np_dilate(b) - b, 0))


def test_canny_matches_numpy_twin(spark):
    imgs = IMAGES + [rng.integers(0, 256, (16, 16)).astype(float) for _ in range(20)]
    df = imaging.canny(frame(spark, imgs))
    edges = 0
    for got, a in zip(back(df, imgs), imgs):
        want = np_canny(a)
        assert np.array_equal(got, want)
        edges += int((want > 0).sum())
    assert edges > 0


def test_resize_nearest(spark):
    a = np.arange(12, dtype=float).reshape(3, 4)
    df = imaging.resize(frame(spark, [a]), 6, 2)
    got = np.array(df.first().pixels).reshape(6, 2)
    rows = np.floor((np.arange(6) + 0.5) * 3 / 6).astype(int)
    cols = np.floor((np.arange(2) + 0.5) * 4 / 2).astype(int)
    assert np.array_equal(got, a[rows][:, cols])
    assert df.first().height == 6 and df.first().width == 2


def test_scale_threshold_subtract(spark):
    a = np.array([[1.0, 2.0], [3.0, 5.0]])
    df = frame(spark, [a])
    assert imaging.scale_8bit(df).first().pixels == [0.0, 64.0, 128.0, 255.0]
    assert imaging.threshold(df, 2.5).first().pixels == [0.0, 0.0, 255.0, 255.0]
    two = df.withColumn("other", F.array(*[F.lit(x) for x in [2.0, 1.0, 9.0, 0.0]]))
    assert imaging.subtract(two, "pixels", "other").first().pixels == [0.0, 1.0, 0.0, 5.0]


def test_colour_sobel_and_gray(spark):
    a = rng.integers(0, 256, (6, 5, 3)).astype(float)
    df = spark.createDataFrame([(0, 6, 5, 3, [float(x) for x in a.ravel()])],
                               "image_id long, height int, width int, channels int, pixels array<double>")
    got = np.array(imaging.sobel(df, channels="channels").first().pixels).reshape(6, 5)
    mags = np.stack([np.hypot(np_correlate(a[..., k], np.array(im.SOBEL_X)),
                              np_correlate(a[..., k], np.array(im.SOBEL_Y))) for k in range(3)], -1)
    lo, hi = mags.min(), mags.max()
    sc = np.clip(np.round(mags * (255 / (hi - lo)) - lo * (255 / (hi - lo))), 0, 255)
    want = sc[..., 0] * 0.114 + sc[..., 1] * 0.587 + sc[..., 2] * 0.299
    assert np.allclose(got, want)
    native = np.array(imaging.sobel(df, channels="channels", engine="native").first().pixels).reshape(6, 5)
    assert np.allclose(native, want)
    # one red/green edge: the featurizer sees the planes, bytes or pixels, not a gray mix
    from corvid.operators.ml import SobelFeaturizer
    from pyspark.ml.functions import vector_to_array
    flat = a.astype(np.uint8).ravel()
    raw = spark.createDataFrame([(6, 5, 3, bytearray(flat.tobytes()))], "height int, width int, channels int, data binary")
    for engine in ("numpy", "native"):
        px = SobelFeaturizer(inputCol="pixels", size=6, engine=engine).transform(df)
        by = SobelFeaturizer(inputCol="data", size=6, engine=engine).transform(raw)
        for out in (px, by):
            v = np.array(out.select(vector_to_array("features")).first()[0]).reshape(6, 6)
            cols = np.minimum(np.floor((np.arange(6) + 0.5) * 5 / 6).astype(int), 4)
            assert np.allclose(v, want[:, cols])



ODD = [rng.integers(0, 256, s).astype(float) for s in [(1, 6), (6, 1), (2, 2), (3, 9), (12, 5), (16, 16)]]


@pytest.mark.parametrize("op", ["sobel", "laplace", "canny", "dilate", "scale_8bit"])
def test_numpy_engine_equals_native(spark, op):
    imgs = IMAGES + ODD + [rng.integers(0, 256, (20, 24)).astype(float) for _ in range(10)]
    df = frame(spark, imgs)
    fn = getattr(imaging, op)
    native = {r.image_id: r.pixels for r in fn(df).collect()}
    numpy_ = {r.image_id: r.pixels for r in fn(df, engine="numpy").collect()}
    assert native == numpy_


def test_numpy_engine_convolve_and_resize(spark):
    imgs = IMAGES + ODD
    df = frame(spark, imgs)
    for border in ("reflect101", "replicate"):
        a = {r.image_id: r.pixels for r in imaging.convolve(df, im.LAPLACE_5, border).collect()}
        b = {r.image_id: r.pixels for r in imaging.convolve(df, im.LAPLACE_5, border, engine="numpy").collect()}
        assert a == b
    a = {r.image_id: (r.height, r.width, r.pixels) for r in imaging.resize(df, 7, 11).collect()}
    b = {r.image_id: (r.height, r.width, r.pixels) for r in imaging.resize(df, 7, 11, engine="numpy").collect()}
    assert a == b


@pytest.mark.parametrize("engine", ["native", "numpy"])
def test_malformed_rows_give_null_not_failure(spark, engine):
    rows = [(0, 2, 2, [1.0, 2.0, 3.0, 4.0]), (1, 3, 3, [1.0, 2.0]), (2, 0, 0, []), (3, 2, 2, None)]
    df = spark.createDataFrame(rows, "image_id long, height int, width int, pixels array<double>")
    for op in (imaging.sobel, imaging.laplace, imaging.canny, imaging.dilate):
        got = {r.image_id: r.pixels for r in op(df, engine=engine).collect()}
        assert got[0] is not None and len(got[0]) == 4
        assert got[1] is None and got[2] is None and got[3] is None


def test_bad_engine_and_classifier_names(spark):
    from corvid.operators import ml
    from corvid.sources.images import read_images
    df = frame(spark, IMAGES[:1])
    for op in (imaging.sobel, imaging.laplace, imaging.canny, imaging.dilate):
        with pytest.raises(ValueError):
            op(df, engine="gpu")
    with pytest.raises(ValueError):
        ml.make_classifier("forest", 4)
    with pytest.raises(ValueError):
        read_images(spark, "/nonexistent", engine="gpu")


def test_hysteresis_long_chain_is_fast_and_complete():
    """A serpentine weak chain across a 600x900 image: one strong pixel lights it all."""
    import time

    from corvid.functions.image_np import hysteresis
    h, w = 600, 900
    cls = np.zeros((h, w), dtype=np.int8)
    cls[::2, :] = 1
    for r in range(1, h, 2):
        cls[r, w - 1 if (r // 2) % 2 == 0 else 0] = 1
    cls[h - 2, w // 2] = 2
    t0 = time.perf_counter()
    out = hysteresis(cls)
    assert time.perf_counter() - t0 < 5.0
    assert np.array_equal(out > 0, cls >= 1)
