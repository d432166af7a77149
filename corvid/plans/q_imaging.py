"""Registered image queries: ``embeddings`` rows read as 8x8 images.

Results are returned one row per pixel ``(image_id, idx, v)`` so that they
compare with the DuckDB oracles, which work on a long pixel table joined to a
kernel table.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from corvid.functions import image as im
from corvid.operators import imaging
from corvid.plans.registry import register
from corvid.plans.standins import (COLOUR_PIXELS_SQL, GRAY_PIXELS_SQL, RAW_PIXELS_SQL, colour_images, gray_images,
                                   raw_images)

SIDE = 8
RESIZE_TO = (12, 10)
RAW_FEATURE_SIDE = 16


def _taps(kernel, *more):
    """VALUES rows (dr, dc, w1[, w2]) for the non-zero taps of one or two kernels."""
    kh, kw = len(kernel), len(kernel[0])
    rows = []
    for r in range(kh):
        for c in range(kw):
            ws = [kernel[r][c]] + [k[r][c] for k in more]
            if any(x != 0 for x in ws):
                vals = ", ".join(f"CAST({x} AS DOUBLE)" for x in ws)
                rows.append(f"({r - kh // 2}, {c - kw // 2}, {vals})")
    names = ", ".join(["dr", "dc"] + [f"w{i}" for i in range(len(more) + 1)])
    return f"(SELECT * FROM (VALUES {', '.join(rows)}) t({names}))"


def _reflect(x: str) -> str:
    p = 2 * SIDE - 2
    return f"(CASE WHEN (({x}) % {p} + {p}) % {p} < {SIDE} THEN (({x}) % {p} + {p}) % {p} " \
           f"ELSE {p} - (({x}) % {p} + {p}) % {p} END)"


def _clamp(x: str) -> str:
    return f"least(greatest({x}, 0), {SIDE - 1})"


def _conv_sql(kernel_sql: str, border=_reflect, sums: str = "sum(k.w0 * s.v) AS v") -> str:
    return f"""SELECT p.image_id, p.idx, p.r, p.c, {sums}
  FROM px p CROSS JOIN {kernel_sql} k
  JOIN px s ON s.image_id = p.image_id AND s.r = {border('p.r + k.dr')} AND s.c = {border('p.c + k.dc')}
  GROUP BY p.image_id, p.idx, p.r, p.c"""


def _dilate_sql(src: str, col: str) -> str:
    return f"""SELECT a.image_id, a.idx, a.r, a.c, max(b.{col}) AS d
  FROM {src} a JOIN {src} b ON a.image_id = b.image_id
   AND b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1
  GROUP BY a.image_id, a.idx, a.r, a.c"""


def _scale_sql(src: str, col: str) -> str:
    k = "(255.0 / (mm.hi - mm.lo))"
    return f"""SELECT x.image_id, x.idx,
    CASE WHEN mm.hi > mm.lo THEN least(255.0, greatest(0.0, round_even(x.{col} * {k} + (-mm.lo) * {k}, 0)))
         ELSE 0.0 END AS v
  FROM {src} x JOIN (SELECT image_id, min({col}) AS lo, max({col}) AS hi FROM {src} GROUP BY image_id) mm
    USING (image_id)"""


_GRAY = f"WITH px AS ({GRAY_PIXELS_SQL})"


@register("img_convolve", sql=_GRAY + ", cv AS (" + _conv_sql(_taps(im.SOBEL_X)) + ")\n"
          "SELECT image_id, idx, v FROM cv")
def img_convolve(spark, sf_dir):
    """3x3 stencil (Sobel dx) with reflect-101 borders, every pixel of every image."""
    out = imaging.convolve(gray_images(spark, sf_dir), im.SOBEL_X)
    return imaging.to_long(out)


@register("img_resize", sql=_GRAY + f""",
  dst AS (SELECT DISTINCT p.image_id, CAST(j AS INTEGER) AS idx,
            CAST(floor(((j // {RESIZE_TO[1]}) + 0.5) * {SIDE} / {RESIZE_TO[0]}) AS INTEGER) AS sr,
            CAST(floor(((j % {RESIZE_TO[1]}) + 0.5) * {SIDE} / {RESIZE_TO[1]}) AS INTEGER) AS sc
          FROM px p, range(0, {RESIZE_TO[0] * RESIZE_TO[1]}) t(j))
SELECT d.image_id, d.idx, s.v FROM dst d JOIN px s
  ON s.image_id = d.image_id AND s.r = least(d.sr, {SIDE - 1}) AND s.c = least(d.sc, {SIDE - 1})""")
def img_resize(spark, sf_dir):
    """Nearest-neighbour resize of every image to 12x10."""
    return imaging.to_long(imaging.resize(gray_images(spark, sf_dir), *RESIZE_TO))


@register("img_raw", sql=_GRAY + f""",
  dst AS (SELECT DISTINCT p.image_id, CAST(j AS INTEGER) AS idx,
            CAST(floor(((j // {RAW_FEATURE_SIDE}) + 0.5) * {SIDE} / {RAW_FEATURE_SIDE}) AS INTEGER) AS sr,
            CAST(floor(((j % {RAW_FEATURE_SIDE}) + 0.5) * {SIDE} / {RAW_FEATURE_SIDE}) AS INTEGER) AS sc
          FROM px p, range(0, {RAW_FEATURE_SIDE * RAW_FEATURE_SIDE}) t(j))
SELECT d.image_id, d.idx, s.v FROM dst d JOIN px s
  ON s.image_id = d.image_id AND s.r = least(d.sr, {SIDE - 1}) AND s.c = least(d.sc, {SIDE - 1})""")
def img_raw(spark, sf_dir):
    """I2+F10: raw-pixel featurizer on the gray images (resize to 16x16, ML vector), read back per pixel."""
    from corvid.operators.ml import RawPixelFeaturizer
    feats = RawPixelFeaturizer(inputCol="pixels", outputCol="features", size=RAW_FEATURE_SIDE) \
        .transform(gray_images(spark, sf_dir))
    return imaging.to_long(feats.select("image_id", vector_to_array("features").alias("pixels")))


@register("img_scale", sql=f"WITH px AS ({RAW_PIXELS_SQL})\n" + _scale_sql("px", "v"))
def img_scale(spark, sf_dir):
    """I8: per-image min-max scaling of the float images to 8 bits (half-even rounding)."""
    return imaging.to_long(imaging.scale_8bit(raw_images(spark, sf_dir)))


@register("img_sobel", sql=_GRAY + ", g AS (" + _conv_sql(
    _taps(im.SOBEL_X, im.SOBEL_Y), sums="sum(k.w0 * s.v) AS gx, sum(k.w1 * s.v) AS gy") + "),\n"
    "m AS (SELECT image_id, idx, sqrt(gx * gx + gy * gy) AS m FROM g)\n" + _scale_sql("m", "m"))
def img_sobel(spark, sf_dir):
    """I4+A14: Sobel magnitude scaled to 8 bits by each image's min and max."""
    return imaging.to_long(imaging.sobel(gray_images(spark, sf_dir)))


@register("img_dilate", sql=_GRAY + ", dl AS (" + _dilate_sql("px", "v") + ")\n"
          "SELECT image_id, idx, d AS v FROM dl")
def img_dilate(spark, sf_dir):
    """3x3 grey dilation of every image."""
    return imaging.to_long(imaging.dilate(gray_images(spark, sf_dir)))


@register("img_laplace", sql=_GRAY + ", lap AS (" + _conv_sql(_taps(im.LAPLACE_5)) + "),\n"
          "bin AS (SELECT image_id, idx, r, c, CAST(CASE WHEN v > 300.0 THEN 255.0 ELSE 0.0 END AS DOUBLE) AS b FROM lap),\n"
          "dl AS (" + _dilate_sql("bin", "b") + ")\n"
          "SELECT dl.image_id, dl.idx, greatest(dl.d - bin.b, CAST(0.0 AS DOUBLE)) AS v FROM dl JOIN bin USING (image_id, idx)")
def img_laplace(spark, sf_dir):
    """5x5 Laplacian -> threshold 300 -> dilate -> minus binary (edge rim)."""
    return imaging.to_long(imaging.laplace(gray_images(spark, sf_dir)))


def _canny_sql() -> str:
    s = 1 << im.CANNY_SHIFT
    nb = lambda dr, dc: f"coalesce(max(CASE WHEN b.r = a.r + ({dr}) AND b.c = a.c + ({dc}) THEN b.m2 END), 0.0)"
    return _GRAY.replace("WITH ", "WITH RECURSIVE ", 1) + ", g AS (" + _conv_sql(
        _taps(im.SOBEL_X, im.SOBEL_Y), border=_clamp,
        sums="sum(k.w0 * s.v) AS gx, sum(k.w1 * s.v) AS gy") + f"""),
gm AS (SELECT image_id, idx, r, c, gx, gy, gx * gx + gy * gy AS m2,
              abs(gy) * {s}.0 AS y, abs(gx) * {im.CANNY_TG22}.0 AS tg22x,
              abs(gx) * {im.CANNY_TG22}.0 + abs(gx) * {2 * s}.0 AS tg67x FROM g),
nbr AS (SELECT a.image_id, a.idx, a.r, a.c, a.gx, a.gy, a.m2, a.y, a.tg22x, a.tg67x,
               {nb(0, -1)} AS m_w, {nb(0, 1)} AS m_e, {nb(-1, 0)} AS m_n, {nb(1, 0)} AS m_s,
               {nb(-1, -1)} AS m_nw, {nb(1, 1)} AS m_se, {nb(-1, 1)} AS m_ne, {nb(1, -1)} AS m_sw
        FROM gm a JOIN gm b ON a.image_id = b.image_id
         AND b.r BETWEEN a.r - 1 AND a.r + 1 AND b.c BETWEEN a.c - 1 AND a.c + 1
        GROUP BY a.image_id, a.idx, a.r, a.c, a.gx, a.gy, a.m2, a.y, a.tg22x, a.tg67x),
cls AS (SELECT image_id, idx, r, c, m2,
          m2 > 10000.0 AND CASE WHEN y < tg22x THEN m2 > m_w AND m2 >= m_e
                                WHEN y > tg67x THEN m2 > m_n AND m2 >= m_s
                                WHEN gx * gy >= 0 THEN m2 > m_nw AND m2 > m_se
                                ELSE m2 > m_ne AND m2 > m_sw END AS cand
        FROM nbr),
reach(image_id, r, c) AS (
  SELECT image_id, r, c FROM cls WHERE cand AND m2 > 62500.0
  UNION
  SELECT n.image_id, n.r, n.c FROM reach x JOIN cls n
    ON n.image_id = x.image_id AND n.cand AND abs(n.r - x.r) <= 1 AND abs(n.c - x.c) <= 1)
SELECT p.image_id, p.idx, CAST(CASE WHEN e.r IS NULL THEN 0.0 ELSE 255.0 END AS DOUBLE) AS v
FROM px p LEFT JOIN (SELECT DISTINCT image_id, r, c FROM reach) e
  ON e.image_id = p.image_id AND e.r = p.r AND e.c = p.c"""


@register("img_canny", sql=_canny_sql())
def img_canny(spark, sf_dir):
    """Canny edges (100 / 250, aperture 3, L2), hysteresis by 8-connectivity."""
    return imaging.to_long(imaging.canny(gray_images(spark, sf_dir)))


# -- more variants of the operators above -----------------------------------------

THRESHOLD = 127.0


@register("img_threshold", sql=_GRAY + f"""
SELECT image_id, idx, CAST(CASE WHEN v > {THRESHOLD} THEN 255.0 ELSE 0.0 END AS DOUBLE) AS v FROM px""")
def img_threshold(spark, sf_dir):
    """Binary threshold of every image."""
    return imaging.to_long(imaging.threshold(gray_images(spark, sf_dir), THRESHOLD))


@register("img_subtract", sql=_GRAY + ", dl AS (" + _dilate_sql("px", "v") + """)
SELECT p.image_id, p.idx, greatest(dl.d - p.v, 0.0) AS v FROM px p JOIN dl USING (image_id, idx)""")
def img_subtract(spark, sf_dir):
    """Saturating difference of every image's dilation and the image."""
    both = imaging.dilate(gray_images(spark, sf_dir), out="dilated")
    return imaging.to_long(imaging.subtract(both, "dilated", "pixels"))


_COLOUR_SOBEL = f"""WITH px AS ({COLOUR_PIXELS_SQL}),
g AS (SELECT p.image_id, p.idx, p.ch, sum(k.w0 * s.v) AS gx, sum(k.w1 * s.v) AS gy
      FROM px p CROSS JOIN {_taps(im.SOBEL_X, im.SOBEL_Y)} k
      JOIN px s ON s.image_id = p.image_id AND s.ch = p.ch AND s.r = {_reflect('p.r + k.dr')}
       AND s.c = {_reflect('p.c + k.dc')}
      GROUP BY p.image_id, p.idx, p.ch),
m AS (SELECT image_id, idx, ch, sqrt(gx * gx + gy * gy) AS m FROM g),
mm AS (SELECT image_id, min(m) AS lo, max(m) AS hi FROM m GROUP BY image_id),
sc AS (SELECT m.image_id, m.idx, m.ch, CASE WHEN mm.hi > mm.lo THEN least(255.0, greatest(0.0, round_even(
         m.m * (255.0 / (mm.hi - mm.lo)) - mm.lo * (255.0 / (mm.hi - mm.lo)), 0))) ELSE 0.0 END AS v
       FROM m JOIN mm USING (image_id)),
edge AS (SELECT image_id, idx, idx // {SIDE} AS r, idx % {SIDE} AS c,
           round(max(CASE WHEN ch = 0 THEN v END) * {im.LUMA_BGR[0]}e0 + max(CASE WHEN ch = 1 THEN v END) * {im.LUMA_BGR[1]}e0
           + max(CASE WHEN ch = 2 THEN v END) * {im.LUMA_BGR[2]}e0, 6) AS v FROM sc GROUP BY image_id, idx)
"""


def _resized_sql(src: str) -> str:
    """``src`` (image_id, r, c, v) resized to the feature side, one row per feature."""
    return f"""SELECT d.image_id, d.idx, s.v FROM (
    SELECT DISTINCT p.image_id, CAST(j AS INTEGER) AS idx,
      CAST(floor(((j // {RAW_FEATURE_SIDE}) + 0.5) * {SIDE} / {RAW_FEATURE_SIDE}) AS INTEGER) AS sr,
      CAST(floor(((j % {RAW_FEATURE_SIDE}) + 0.5) * {SIDE} / {RAW_FEATURE_SIDE}) AS INTEGER) AS sc
    FROM {src} p, range(0, {RAW_FEATURE_SIDE * RAW_FEATURE_SIDE}) t(j)) d JOIN {src} s
  ON s.image_id = d.image_id AND s.r = least(d.sr, {SIDE - 1}) AND s.c = least(d.sc, {SIDE - 1})"""


def _rounded(df):
    return df.withColumn("v", F.round("v", 6))


def _features(featurizer, images):
    feats = featurizer(inputCol="pixels", outputCol="features", size=RAW_FEATURE_SIDE).transform(images)
    return imaging.to_long(feats.select("image_id", vector_to_array("features").alias("pixels")))


@register("img_sobel_colour", sql=_COLOUR_SOBEL + "SELECT image_id, idx, v FROM edge")
def img_sobel_colour(spark, sf_dir):
    """I4+A14 on colour: magnitude per B, G, R plane, one min / max over all planes, then luma."""
    return _rounded(imaging.to_long(imaging.sobel(colour_images(spark, sf_dir), channels="channels")))


@register("img_sobel_colour_native", sql=_COLOUR_SOBEL + "SELECT image_id, idx, v FROM edge")
def img_sobel_colour_native(spark, sf_dir):
    """Colour Sobel with array expressions only."""
    return _rounded(imaging.to_long(imaging.sobel(colour_images(spark, sf_dir), channels="channels", engine="native")))


@register("img_sobel_features", sql=_COLOUR_SOBEL + _resized_sql("edge"))
def img_sobel_features(spark, sf_dir):
    """S7+I4+F10: the Sobel featurizer on colour images (edges, resize to 16x16, ML vector)."""
    from corvid.operators.ml import SobelFeaturizer
    return _rounded(_features(SobelFeaturizer, colour_images(spark, sf_dir)))


def _with_places(sql: str) -> str:
    """A query's pixel rows (image_id, idx, v) with their place."""
    return f"SELECT image_id, idx, idx // {SIDE} AS r, idx % {SIDE} AS c, v FROM ({sql}) e"


def _variants() -> None:
    """The stencils again with array expressions only, and the Laplace and Canny featurizers."""
    from corvid.operators import ml
    from corvid.plans.registry import _REGISTRY
    stencils = {"img_convolve": lambda df: imaging.convolve(df, im.SOBEL_X, engine="native"),
                "img_sobel": lambda df: imaging.sobel(df, engine="native"),
                "img_laplace": lambda df: imaging.laplace(df, engine="native"),
                "img_canny": lambda df: imaging.canny(df, engine="native"),
                "img_dilate": lambda df: imaging.dilate(df, engine="native")}
    for name, op in stencils.items():
        @register(f"{name}_native", sql=_REGISTRY[name].sql)
        def native(spark, sf_dir, op=op):
            """The same stencil as array expressions."""
            return imaging.to_long(op(gray_images(spark, sf_dir)))
    for name, featurizer in (("img_laplace", ml.LaplaceFeaturizer), ("img_canny", ml.CannyFeaturizer)):
        sql = f"WITH edge AS MATERIALIZED ({_with_places(_REGISTRY[name].sql)})\n" + _resized_sql("edge")

        @register(f"{name}_features", sql=sql)
        def features(spark, sf_dir, featurizer=featurizer):
            """The edge featurizer: edges, resize to 16x16, ML vector, read back per value."""
            return _features(featurizer, gray_images(spark, sf_dir))


_variants()
