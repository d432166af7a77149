"""Registered ML queries: classify ``embeddings`` images (class >= 5 vs the rest)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from corvid.operators import ml, nb_counts
from corvid.plans.registry import register
from corvid.plans.standins import FEATURE_ROWS_SQL, feature_images, image_files, table

N_FEATURES = 64
PIPELINE_SIDE = 16


def _split_pred(f_cte: str, n_features: int) -> str:
    """SQL: closed-form multinomial naive Bayes (smoothing 1) trained on the split."""
    return f"""WITH f AS ({f_cte}),
sp AS (SELECT DISTINCT image_id, label, (image_id * 7919) % 100 < 80 AS is_train FROM f),
cls AS (SELECT label, count(*) AS nc FROM sp WHERE is_train GROUP BY label),
prior AS (SELECT label, ln(nc + 1.0) - ln((SELECT sum(nc) FROM cls) + (SELECT count(*) FROM cls) * 1.0) AS p
          FROM cls),
fs AS (SELECT f.label, f.i, sum(f.v) AS s FROM f JOIN sp USING (image_id, label) WHERE sp.is_train
       GROUP BY f.label, f.i),
theta AS (SELECT fs.label, fs.i, ln(fs.s + 1.0) - ln(t.st + {n_features}.0) AS t
          FROM fs JOIN (SELECT label, sum(s) AS st FROM fs GROUP BY label) t USING (label)),
te AS (SELECT f.* FROM f JOIN sp USING (image_id, label) WHERE NOT sp.is_train),
sc AS (SELECT te.image_id, te.label, th.label AS cls, sum(te.v * th.t) AS s
       FROM te JOIN theta th ON th.i = te.i GROUP BY te.image_id, te.label, th.label),
post AS (SELECT sc.image_id, sc.label, sc.cls, sc.s + prior.p AS lp FROM sc JOIN prior ON prior.label = sc.cls),
pred AS (SELECT image_id, label, CAST(arg_max(cls, lp) AS DOUBLE) AS prediction
         FROM post GROUP BY image_id, label)
"""


_NB = _split_pred(FEATURE_ROWS_SQL, N_FEATURES)

_UPSAMPLED = f"""
  SELECT d.image_id, d.label, d.i, s.v FROM (
    SELECT DISTINCT p.image_id, p.label, CAST(j AS INTEGER) AS i,
           least(CAST(floor(((j // {PIPELINE_SIDE}) + 0.5) * 8 / {PIPELINE_SIDE}) AS INTEGER), 7) AS sr,
           least(CAST(floor(((j % {PIPELINE_SIDE}) + 0.5) * 8 / {PIPELINE_SIDE}) AS INTEGER), 7) AS sc
    FROM ({FEATURE_ROWS_SQL}) p, range(0, {PIPELINE_SIDE * PIPELINE_SIDE}) t(j)) d
  JOIN ({FEATURE_ROWS_SQL}) s ON s.image_id = d.image_id AND s.r = d.sr AND s.c = d.sc"""


def _labeled_split(spark, sf_dir):
    df = feature_images(spark, sf_dir).select(
        "image_id", "label", array_to_vector("pixels").alias("features"))
    return ml.with_split(df)


def _predict(spark, sf_dir, kind: str):
    df = _labeled_split(spark, sf_dir)
    train, test = df.filter("is_train"), df.filter("NOT is_train")
    stages = Pipeline(stages=[ml.make_classifier(kind, N_FEATURES)])
    out = ml.fit_and_predict(stages, train, test, cache_train=kind != "nb")
    return out.select("image_id", "label", "prediction")


@register("split_8020", sql="""SELECT vec_id AS image_id, (vec_id * 7919) % 100 < 80 AS is_train
    FROM embeddings""")
def split_8020(spark, sf_dir):
    """Deterministic 80/20 train/test split by id."""
    return ml.with_split(table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("image_id")))


@register("nb_predict", sql=_NB + "SELECT image_id, label, prediction FROM pred")
def nb_predict(spark, sf_dir):
    """M1: multinomial naive Bayes fitted on the 80% split, predictions on the 20%."""
    return _predict(spark, sf_dir, "nb")


@register("accuracy", sql=_NB + """SELECT count(*) AS n,
    CAST(sum(CASE WHEN prediction = label THEN 1 ELSE 0 END) AS BIGINT) AS correct,
    round(avg(CASE WHEN prediction = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM pred""")
def accuracy(spark, sf_dir):
    """A13+P9: share of correct naive Bayes predictions, one pass."""
    acc = ml.accuracy(_predict(spark, sf_dir, "nb"))
    return acc.select("n", "correct", F.round("accuracy", 6).alias("accuracy"))


@register("nb_predict_merged", sql=_NB + "SELECT image_id, label, prediction FROM pred")
def nb_predict_merged(spark, sf_dir):
    """M1 from additive counts: three batches of the training split counted apart, added and scored in closed form."""
    df = ml.with_split(feature_images(spark, sf_dir).select("image_id", "label", "pixels"))
    train = df.filter("is_train")
    batches = [nb_counts.nb_counts(train.filter(F.col("image_id") % 3 == k)) for k in range(3)]
    model = nb_counts.nb_model(nb_counts.merge_counts(batches))
    return nb_counts.nb_score(df.filter("NOT is_train"), model).select("image_id", "label", "prediction")


@register("svc_predict")
def svc_predict(spark, sf_dir):
    """M2: linear SVM (10 iterations, regParam 0.3) predictions on the test split."""
    return _predict(spark, sf_dir, "svc")


@register("mlp_predict")
def mlp_predict(spark, sf_dir):
    """M3: perceptron [features, 5, 4, 2], block 128, 100 iterations, seed 1."""
    return _predict(spark, sf_dir, "mlp")


@register("fit_predict", sql=_split_pred(_UPSAMPLED, PIPELINE_SIDE * PIPELINE_SIDE)
          + "SELECT image_id, label, prediction FROM pred")
def fit_predict(spark, sf_dir):
    """M4+M5+F4: Pipeline labeler(file name) -> raw-pixel featurizer (16x16) -> naive Bayes."""
    files = ml.with_split(image_files(spark, sf_dir))
    train, test = files.filter("is_train"), files.filter("NOT is_train")
    stages = ml.build_stages("raw", "nb", size=PIPELINE_SIDE, path_col="path")
    out = ml.fit_and_predict(stages, train, test, cache_train=False)
    return out.select("image_id", "label", "prediction")
