"""Image classification with Spark ML: labeler, featurizers, classifiers, accuracy.

Featurizers are ``Transformer`` stages over image frames ``(height, width,
pixels array<double>)``: edge map at full size, nearest-neighbour resize, then
``array_to_vector``.  With the default numpy engine, edge map and resize are
one ``mapInPandas`` pass over Arrow batches; with ``engine='native'`` they are
array expressions (see ``corvid.operators.imaging``).  The classifiers are MLlib's, trained with
distributed tree aggregates.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, MultilayerPerceptronClassifier, NaiveBayes
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DoubleType, NumericType, StringType, StructField,
                               StructType)

import sys

from pyspark import cloudpickle

from corvid.functions import image as im
from corvid.functions import image_np
from corvid.functions.image_np import sobel as np_sobel
from corvid.functions.image_np import sobel_colour as np_sobel_colour
from corvid.functions.text import basename, label_from_text
from corvid.operators import imaging

# Featurizer steps run in Python workers (numpy engine): pickle by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the reference setup: featurizers resize to 150 x 150; the
# label is 1 when the file name starts with "dog"; LinearSVC runs 10 iterations
# with regParam 0.3; the perceptron has hidden layers 5 and 4, block size 128 and
# 100 iterations; the split keeps 80% for training.
DEFAULT_SIDE = 150
LABEL_WORD = "dog"
SVC_MAX_ITER, SVC_REG = 10, 0.3
MLP_HIDDEN, MLP_BLOCK, MLP_MAX_ITER = (5, 4), 128, 100
TRAIN_PERCENT = 80
SPLIT_MULTIPLIER = 7919  # a prime: id * 7919 mod 100 spreads consecutive ids


class Labeler(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Label 1 when ``substring(basename(path), start, length) == value`` else 0 (int)."""

    start = Param(Params._dummy(), "start", "1-based start of the label slice",
                  typeConverter=TypeConverters.toInt)
    length = Param(Params._dummy(), "length", "length of the label slice",
                   typeConverter=TypeConverters.toInt)
    value = Param(Params._dummy(), "value", "text that means label 1",
                  typeConverter=TypeConverters.toString)
    useBasename = Param(Params._dummy(), "useBasename", "slice the file name, not the full path",
                        typeConverter=TypeConverters.toBoolean)

    def __init__(self, inputCol: str = "path", outputCol: str = "label", start: int = 1,
                 length: int = 3, value: str = LABEL_WORD, useBasename: bool = True):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, start=start, length=length,
                  value=value, useBasename=useBasename)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        col = self.getInputCol()
        dtype = dataset.schema[col].dataType
        if not isinstance(dtype, StringType):
            raise TypeError(f"labels are cut from text, but column {col!r} is {dtype.simpleString()}")
        src = basename(F.col(col)) if self.getOrDefault(self.useBasename) else F.col(col)
        return dataset.withColumn(self.getOutputCol(), label_from_text(
            src, self.getOrDefault(self.start), self.getOrDefault(self.length),
            self.getOrDefault(self.value)))


def _vector_of(values):
    """ML vector of an array column; null for a null array."""
    return F.when(values.isNotNull(), array_to_vector(F.coalesce(values, F.array().cast("array<double>"))))


def _as_is(a):
    return a


def _sobel_planes(planes):
    """Colour Sobel of B, G, R(, A) planes; one or two planes: gray Sobel of the first."""
    return np_sobel_colour(planes) if planes.shape[0] >= 3 else np_sobel(planes[0])


class _ImageFeaturizer(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable,
                       DefaultParamsWritable):
    """Base: edge map at full size, resize to ``size`` x ``size``, ML vector."""

    size = Param(Params._dummy(), "size", "output side in pixels", typeConverter=TypeConverters.toInt)
    engine = Param(Params._dummy(), "engine", "'numpy' (Arrow batches) or 'native' (array expressions)",
                   typeConverter=TypeConverters.toString)
    heightCol = Param(Params._dummy(), "heightCol", "height column", typeConverter=TypeConverters.toString)
    widthCol = Param(Params._dummy(), "widthCol", "width column", typeConverter=TypeConverters.toString)

    _colour = False  # True: edges are found on B, G, R planes

    def __init__(self, inputCol: str = "pixels", outputCol: str = "features",
                 size: int = DEFAULT_SIDE, heightCol: str = "height", widthCol: str = "width",
                 engine: str = imaging.STENCIL_ENGINE):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, size=size,
                  heightCol=heightCol, widthCol=widthCol, engine=engine)

    def _edges(self, df: DataFrame, pixels: str) -> DataFrame:
        """Native engine: the edge map as array expressions."""
        return df

    @staticmethod
    def _np_edges(a):
        """Numpy engine: the edge map of one 2-D image."""
        return a

    def _transform(self, dataset: DataFrame) -> DataFrame:
        col = self.getInputCol()
        dtype = dataset.schema[col].dataType
        if isinstance(dtype, BinaryType):
            return self._transform_bytes(dataset, col)
        if not (isinstance(dtype, ArrayType) and isinstance(dtype.elementType, NumericType)):
            raise TypeError(f"column {col!r} is {dtype.simpleString()}; a featurizer reads pixel arrays "
                            "(array<double>) or image bytes (binary)")
        h, w = self.getOrDefault(self.heightCol), self.getOrDefault(self.widthCol)
        side = self.getOrDefault(self.size)
        tmp = "_feat_px"
        frame = dataset.withColumn(tmp, F.col(col).cast("array<double>"))
        frame = (frame.withColumnRenamed(h, "_h").withColumnRenamed(w, "_w")
                 .withColumn(imaging.H, F.col("_h")).withColumn(imaging.W, F.col("_w"))
                 if (h, w) != (imaging.H, imaging.W) else frame)
        if self.getOrDefault(self.engine) == "numpy":
            edges, resize = self._np_edges, image_np.resize_nearest  # functions, pickled by value
            if self._colour and "channels" in dataset.columns:  # interleaved B, G, R pixels
                frame, edges = imaging.sobel(frame, channels="channels", pixels=tmp, out=tmp), _as_is
            mapped = imaging.map_images(frame, lambda a: resize(edges(a), side, side),
                                        pixels=tmp, out=tmp, stacked=True)
            out = mapped.withColumn(self.getOutputCol(), _vector_of(F.col(tmp))).drop(tmp)
        else:
            edged = self._edges(frame, tmp)
            whole = F.size(F.col(tmp)) == F.col(imaging.H) * F.col(imaging.W)
            resized = im.resize_nearest(F.col(tmp), F.col(imaging.H), F.col(imaging.W), side, side)
            out = edged.withColumn(self.getOutputCol(), _vector_of(F.when(whole, resized))).drop(tmp)
        if (h, w) != (imaging.H, imaging.W):
            out = out.drop(imaging.H, imaging.W).withColumnRenamed("_h", h).withColumnRenamed("_w", w)
        return out


    def _transform_bytes(self, dataset: DataFrame, col: str) -> DataFrame:
        """Image bytes (``read_images(decode=False)``): decode to gray (Sobel: B, G, R planes), edge
        map and resize in one Arrow-batched numpy step; needs a ``channels`` column.
        Bytes that do not fit the size give null features."""
        h, w = self.getOrDefault(self.heightCol), self.getOrDefault(self.widthCol)
        side = self.getOrDefault(self.size)
        edges, resize, decode = self._np_edges, image_np.resize_nearest, image_np.decode_gray
        if self._colour:
            edges, decode = _sobel_planes, image_np.decode_planes
        out = self.getOutputCol()
        names = list(dataset.columns) + ([] if out in dataset.columns else [out])
        fields = {f.name: f for f in dataset.schema.fields}
        tmp_schema = StructType([fields[c] if c != out else StructField(out, ArrayType(DoubleType()))
                                 for c in names])

        def run(batches):
            for pdf in batches:
                rows = []
                for d, hh, ww, cc in zip(pdf[col], pdf[h], pdf[w], pdf["channels"]):
                    image = None if d is None else decode(d, int(hh), int(ww), int(cc))
                    rows.append(None if image is None else resize(edges(image), side, side).ravel())
                pdf[out] = rows
                yield pdf[names]

        mapped = dataset.mapInPandas(run, tmp_schema)
        return mapped.withColumn(out, _vector_of(F.col(out)))


class RawPixelFeaturizer(_ImageFeaturizer):
    """The image plane as is, resized to ``size`` x ``size`` (decode to gray with
    ``corvid.sources.images.read_images``)."""


class SobelFeaturizer(_ImageFeaturizer):
    """Sobel magnitude scaled to 8 bits, then resized.

    Colour images (bytes, or interleaved B, G, R pixels with a ``channels`` column) keep their
    planes: magnitude per plane, one min / max, then luma.
    """

    _colour = True

    def _edges(self, df, pixels):
        channels = "channels" if "channels" in df.columns else None
        return imaging.sobel(df, channels=channels, pixels=pixels, out=pixels, engine="native")

    _np_edges = staticmethod(image_np.sobel)


class LaplaceFeaturizer(_ImageFeaturizer):
    """Laplace edge rim (threshold 300), then resized."""

    def _edges(self, df, pixels):
        return imaging.laplace(df, pixels=pixels, out=pixels, engine="native")

    _np_edges = staticmethod(image_np.laplace)


class CannyFeaturizer(_ImageFeaturizer):
    """Canny edges (100 / 250), then resized."""

    def _edges(self, df, pixels):
        return imaging.canny(df, pixels=pixels, out=pixels, engine="native")

    _np_edges = staticmethod(image_np.canny)


FEATURIZERS = {"raw": RawPixelFeaturizer, "sobel": SobelFeaturizer,
               "laplace": LaplaceFeaturizer, "canny": CannyFeaturizer}


def with_split(df: DataFrame, id_col: str = "image_id", train_percent: int = TRAIN_PERCENT,
               out: str = "is_train") -> DataFrame:
    """Deterministic train/test flag from the id: ``(id * 7919) mod 100 < train_percent``.

    Unlike ``randomSplit`` the result does not depend on partitioning, so a
    re-run (or a lost executor) puts every row on the same side.
    """
    # (id mod 100) * 7919 mod 100 == id * 7919 mod 100, without overflowing a long
    bucket = F.pmod(F.pmod(F.col(id_col), F.lit(100)) * F.lit(SPLIT_MULTIPLIER), F.lit(100))
    return df.withColumn(out, bucket < F.lit(train_percent))


def make_classifier(kind: str, n_features: int, features: str = "features",
                    label: str = "label", seed: int = 1):
    """``nb`` (multinomial, smoothing 1), ``svc`` or ``mlp`` with the reference settings."""
    if kind == "nb":
        return NaiveBayes(featuresCol=features, labelCol=label, smoothing=1.0, modelType="multinomial")
    if kind == "svc":
        return LinearSVC(featuresCol=features, labelCol=label, maxIter=SVC_MAX_ITER, regParam=SVC_REG)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(
            featuresCol=features, labelCol=label, layers=[n_features, *MLP_HIDDEN, 2],
            blockSize=MLP_BLOCK, maxIter=MLP_MAX_ITER, seed=seed)
    raise ValueError(f"unknown classifier {kind!r}")


def build_stages(featurizer: str = "raw", classifier: str = "nb", size: int = DEFAULT_SIDE,
                 path_col: str | None = "path", input_col: str = "pixels") -> Pipeline:
    """Pipeline labeler (when a path column is given) -> featurizer -> classifier.

    ``input_col`` is a pixel array or the image bytes of ``read_images(decode=False)``.
    """
    stages = [] if path_col is None else [Labeler(inputCol=path_col, outputCol="label")]
    stages.append(FEATURIZERS[featurizer](inputCol=input_col, outputCol="features", size=size))
    stages.append(make_classifier(classifier, size * size))
    return Pipeline(stages=stages)


def fit_pipeline(stages: Pipeline, train: DataFrame, cache_train: bool = True) -> PipelineModel:
    """Fit ``stages`` on ``train`` -> a ``PipelineModel`` (savable with ``.write().save``).

    The transformer stages (labeler, featurizer) are applied to the training
    frame once and the resulting features are persisted (memory, spilling to
    disk) while the estimator fits -- iterative estimators read them once per
    iteration -- then released.  Rows without features (malformed images,
    whose featurizer output is null) are left out of the fit.
    """
    all_stages = stages.getStages()
    prep, estimator = all_stages[:-1], all_stages[-1]
    if not all(isinstance(st, Transformer) for st in prep):
        raise TypeError("all stages but the last must be Transformers")
    feats = PipelineModel(stages=list(prep)).transform(train)
    if estimator.hasParam("featuresCol"):  # malformed images have no features: not trained on
        feats = feats.filter(F.col(estimator.getOrDefault("featuresCol")).isNotNull())
    if cache_train:
        feats = feats.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fitted = estimator.fit(feats)
    finally:
        if cache_train:
            feats.unpersist()
    return PipelineModel(stages=[*prep, fitted])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``model.transform(df)`` that keeps rows without features, with null predictions."""
    *prep, last = model.stages
    feats = PipelineModel(stages=list(prep)).transform(df)
    if not last.hasParam("featuresCol"):
        return last.transform(feats)
    col = last.getOrDefault("featuresCol")
    # MLlib cannot score a null vector: such rows are scored as zeros, then their scores are taken away
    zeros = array_to_vector(F.array_repeat(F.lit(0.0), last.numFeatures))
    scored = last.transform(feats.withColumn("_scored", F.col(col).isNotNull())
                            .withColumn(col, F.coalesce(F.col(col), zeros)))
    gone = [c for c in scored.columns if c not in feats.columns and c != "_scored"] + [col]
    return scored.select(*[F.when(F.col("_scored"), F.col(c)).alias(c) if c in gone else F.col(c)
                           for c in scored.columns if c != "_scored"])


def fit_and_predict(stages: Pipeline, train: DataFrame, test: DataFrame,
                    cache_train: bool = True) -> DataFrame:
    """Fit on ``train`` (see ``fit_pipeline``) and score ``test``; rows without features keep a null prediction."""
    return predict(fit_pipeline(stages, train, cache_train), test)


def accuracy(predictions: DataFrame, label: str = "label",
             prediction: str = "prediction") -> DataFrame:
    """One pass: ``(n, correct, accuracy, n_unscored)``; rows without a prediction are only counted as such."""
    hit = (F.col(prediction) == F.col(label).cast("double")).cast("long")
    n = F.count(F.col(prediction))
    return predictions.agg(n.alias("n"), F.sum(hit).alias("correct"),
                           F.try_divide(F.sum(hit).cast("double"), n).alias("accuracy"),
                           F.count_if(F.col(prediction).isNull()).alias("n_unscored"))
