import pytest
from pyspark.ml.functions import array_to_vector

from corvid.operators import ml
from corvid.plans.standins import feature_images, image_files

SF = "/root/testdata/sf0.001"


def test_labeler_checks_type(spark):
    df = spark.createDataFrame([(1,)], "path int")
    with pytest.raises(TypeError):
        ml.Labeler(inputCol="path").transform(df)
    ok = spark.createDataFrame([("/x/1k/dog.3.jpg",), ("cat.1.jpg",)], "path string")
    assert [r.label for r in ml.Labeler().transform(ok).collect()] == [1, 0]


def test_featurizer_checks_type(spark):
    df = spark.createDataFrame([("a", 1, 1)], "pixels string, height int, width int")
    with pytest.raises(TypeError):
        ml.RawPixelFeaturizer().transform(df)


def test_featurizers_produce_vectors(spark):
    imgs = feature_images(spark, SF).limit(5)
    for name, cls in ml.FEATURIZERS.items():
        out = cls(size=12).transform(imgs)
        v = out.first().features
        assert v.size == 144, name
        assert set(out.columns) == set(imgs.columns) | {"features"}


def test_split_is_deterministic(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "image_id")
    a = ml.with_split(df.repartition(7)).filter("is_train").count()
    b = ml.with_split(df.repartition(3)).filter("is_train").count()
    assert a == b == 800


def test_pipeline_and_accuracy(spark):
    files = ml.with_split(image_files(spark, SF))
    for clf in ("nb", "svc", "mlp"):
        stages = ml.build_stages("raw", clf, size=8)
        pred = ml.fit_and_predict(stages, files.filter("is_train"), files.filter("NOT is_train"))
        acc = ml.accuracy(pred).first()
        assert acc.n == files.filter("NOT is_train").count()
        assert 0.0 <= acc.accuracy <= 1.0 and acc.correct <= acc.n


def test_fitted_pipeline_saves_and_loads(spark, tmpdir_path):
    from pyspark.ml import PipelineModel
    files = ml.with_split(image_files(spark, SF))
    model = ml.fit_pipeline(ml.build_stages("sobel", "nb", size=8), files.filter("is_train"))
    path = f"{tmpdir_path}/model"
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    test = files.filter("NOT is_train")
    a = sorted(model.transform(test).select("image_id", "prediction").collect())
    b = sorted(loaded.transform(test).select("image_id", "prediction").collect())
    assert a == b and type(loaded.stages[1]).__name__ == "SobelFeaturizer"


def test_featurizer_detects_edges_before_resizing(spark):
    """The edge map is computed at full size, then resized."""
    import numpy as np

    from corvid.functions import image_np
    a = np.random.default_rng(4).integers(0, 256, (20, 30)).astype(float)
    df = spark.createDataFrame([(0, 20, 30, [float(x) for x in a.ravel()])],
                               "image_id long, height int, width int, pixels array<double>")
    for engine in ("numpy", "native"):
        got = ml.SobelFeaturizer(size=7, engine=engine).transform(df).first().features.toArray()
        want = image_np.resize_nearest(image_np.sobel(a), 7, 7).ravel()
        other = image_np.sobel(image_np.resize_nearest(a, 7, 7)).ravel()
        assert np.array_equal(got, want) and not np.array_equal(got, other)


def _images(spark, rows):
    return spark.createDataFrame(rows, "image_id long, path string, height int, width int, channels int, "
                                       "pixels array<double>, data binary")


def test_malformed_rows_neither_crash_nor_vanish(spark):
    """Too few pixels, null pixels, short or empty bytes: left out of the fit, kept with a null prediction."""
    import numpy as np
    r = np.random.default_rng(0)
    rows = []
    for i in range(40):
        v = r.integers(0, 256, 16)
        rows.append((i, f"{'dog' if i % 2 else 'cat'}.{i}.bmp", 4, 4, 1, [float(x) for x in v], bytearray(v.astype(np.uint8).tobytes())))
    bad = [(100, "dog.100.bmp", 4, 4, 1, [1.0], bytearray(b"x")), (101, "cat.101.bmp", 4, 4, 1, None, None),
           (102, "cat.102.bmp", -1, -1, -1, [], bytearray(b""))]
    df = _images(spark, rows + bad)
    for column in ("pixels", "data"):
        for featurizer in ("raw", "sobel"):
            stages = ml.build_stages(featurizer, "nb", size=4, input_col=column)
            out = ml.fit_and_predict(stages, df, df)
            got = {x.image_id: x.prediction for x in out.select("image_id", "prediction").collect()}
            assert len(got) == 43 and all(got[i] is None for i in (100, 101, 102))
            assert all(got[i] is not None for i in range(40))
            acc = ml.accuracy(out).first()
            assert (acc.n, acc.n_unscored) == (40, 3)


def test_exported_coefficients_give_the_predictions(spark):
    """M2, M3: the linear and the forward formula on the fitted coefficients equal the predictions."""
    import numpy as np
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import array_to_vector, vector_to_array
    r = np.random.default_rng(1)
    x = r.random((120, 6))
    y = (x[:, 0] + 0.3 * x[:, 1] > 0.6).astype(int)
    df = spark.createDataFrame([(int(a), [float(v) for v in b]) for a, b in zip(y, x)], "label int, px array<double>").select(
        "label", array_to_vector("px").alias("features"))

    def predicted(kind):
        model = ml.fit_pipeline(Pipeline(stages=[ml.make_classifier(kind, 6)]), df)
        rows = ml.predict(model, df).select(vector_to_array("features").alias("x"), "prediction").collect()
        return model.stages[-1], np.array([q.x for q in rows]), np.array([q.prediction for q in rows])

    svc, f, p = predicted("svc")
    assert ((f @ svc.coefficients.toArray() + svc.intercept > 0).astype(float) == p).all()
    mlp, f, p = predicted("mlp")
    w, at, layers, a = mlp.weights.toArray(), 0, [6, *ml.MLP_HIDDEN, 2], f
    for k, (n, m) in enumerate(zip(layers, layers[1:])):
        a = a @ w[at:at + n * m].reshape(m, n, order="F").T + w[at + n * m:at + n * m + m]
        at += n * m + m
        a = 1 / (1 + np.exp(-a)) if k < len(layers) - 2 else a
    assert (a.argmax(axis=1) == p).all()
