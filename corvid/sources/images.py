"""File listings and image decoding.

Listing uses the ``binaryFile`` source with only ``path`` selected, so file
contents are pruned and never read.  Decoding uses Spark's ``image`` source
(ImageIO: BMP, PNG, JPEG, GIF) which yields interleaved B, G, R(, A) bytes,
one image per row; the bytes are unpacked with numpy on Arrow batches
(default) or with array expressions.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StringType, StructField, StructType

from corvid.functions import image as im
from corvid.functions.text import strip_scheme

# The numpy byte unpack runs in Python workers: pickle this module by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def list_files(spark: SparkSession, path: str, glob: str | None = None,
               recursive: bool = False, strip: bool = True) -> DataFrame:
    """``(path)`` of every file under ``path`` (contents not read)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    df = reader.load(path).select("path")
    return df.select(strip_scheme(F.col("path")).alias("path")) if strip else df


def _unpack_bytes(data, n):
    """``binary`` of ``n`` bytes -> ``array<double>`` of its unsigned bytes."""
    return F.transform(F.sequence(F.lit(0), n - 1),
                       lambda i: F.conv(F.hex(F.substr(data, i + 1, F.lit(1))), 16, 10).cast("double"))


def read_images(spark: SparkSession, path: str, gray: bool = True, glob: str | None = None,
                drop_invalid: bool = False, strip: bool = True, engine: str = "numpy",
                decode: bool = True) -> DataFrame:
    """Decoded images ``(path, height, width, channels, pixels array<double>)``.

    ``gray=True`` reduces colour to one plane with the 601 luma weights
    (as ``IMREAD_GRAYSCALE``); otherwise pixels stay interleaved B, G, R(, A).
    A file that does not decode, or whose bytes are not height x width x channels, keeps
    its row with null pixels (``drop_invalid=True`` leaves undecodable files out).
    ``engine='numpy'`` unpacks the bytes with ``np.frombuffer`` in
    ``mapInPandas`` (Arrow batches); ``'native'`` uses array expressions
    (several string functions per byte: correct, much slower on photos).
    ``decode=False`` keeps the bytes, ``(path, height, width, channels, data
    binary)``: the featurizers accept that and decode, detect edges and resize
    in one step, so a full-size image never exists as doubles (8 bytes a pixel).
    """
    if engine not in ("numpy", "native"):
        raise ValueError("engine must be 'numpy' or 'native'")
    reader = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    img = reader.load(path).select("image.*")
    origin = strip_scheme(F.col("origin")) if strip else F.col("origin")
    if not decode:
        return img.select(origin.alias("path"), "height", "width",
                          F.col("nChannels").alias("channels"), "data")
    if engine == "numpy":
        raw = img.select(origin.alias("path"), "height", "width", F.col("nChannels").alias("channels"), "data")
        return _unpack_numpy(raw, gray)
    n = F.col("height") * F.col("width") * F.col("nChannels")
    whole = (F.col("nChannels") > 0) & (n > 0) & (F.length("data") == n)
    df = img.select(origin.alias("path"), "height", "width", F.col("nChannels").alias("channels"),
                    F.when(whole, _unpack_bytes(F.col("data"), n)).alias("pixels"))
    if not gray:
        return df
    planes = im.split_channels(F.col("pixels"), F.col("height"), F.col("width"), F.col("channels"))
    return (df.withColumn("pixels", F.when(F.col("channels") < 3, F.col("pixels"))
                          .when(F.col("pixels").isNotNull(), im.luma(F.slice(planes, 1, 3))))
            .withColumn("channels", F.when(F.col("channels") >= 3, F.lit(1)).otherwise(F.col("channels"))))


def _unpack_numpy(raw: DataFrame, gray: bool) -> DataFrame:
    schema = StructType([StructField("path", StringType()), StructField("height", IntegerType()),
                         StructField("width", IntegerType()), StructField("channels", IntegerType()),
                         StructField("pixels", ArrayType(DoubleType()))])
    wb, wg, wr = im.LUMA_BGR

    def unpack(batches):
        for pdf in batches:
            pixels, chans = [], []
            for data, h, w, c in zip(pdf["data"], pdf["height"], pdf["width"], pdf["channels"]):
                if data is None or c <= 0 or len(data) == 0 or len(data) != int(h) * int(w) * int(c):
                    pixels.append(None)
                    chans.append(int(c))
                    continue
                a = np.frombuffer(data, dtype=np.uint8).astype(float)
                if gray and c >= 3:
                    a = a.reshape(-1, int(c))
                    a = a[:, 0] * wb + a[:, 1] * wg + a[:, 2] * wr
                    c = 1
                pixels.append(a)
                chans.append(int(c))
            pdf["pixels"], pdf["channels"] = pixels, chans
            yield pdf[["path", "height", "width", "channels", "pixels"]]

    return raw.mapInPandas(unpack, schema)
