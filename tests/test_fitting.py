from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

import scorekit as sk
from tests.test_evaluation import physical_plan

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# What a fit must run with when no parameter is given.
FOREST = {
    "bootstrap": True,
    "cacheNodeIds": False,
    "checkpointInterval": 10,
    "featureSubsetStrategy": "auto",
    "featuresCol": "features",
    "impurity": "gini",
    "labelCol": "label",
    "leafCol": "",
    "maxBins": 32,
    "maxDepth": 10,
    "maxMemoryInMB": 256,
    "minInfoGain": 0.0,
    "minInstancesPerNode": 1,
    "minWeightFractionPerNode": 0.0,
    "numTrees": 100,
    "predictionCol": "prediction",
    "probabilityCol": "probability",
    "rawPredictionCol": "rawPrediction",
    "seed": 42,
    "subsamplingRate": 1.0,
}
REGRESSION = {
    "aggregationDepth": 2,
    "elasticNetParam": 0.8,
    "family": "auto",
    "featuresCol": "features",
    "fitIntercept": True,
    "labelCol": "label",
    "maxBlockSizeInMB": 0.0,
    "maxIter": 100,
    "predictionCol": "prediction",
    "probabilityCol": "probability",
    "rawPredictionCol": "rawPrediction",
    "regParam": 0.0,
    "standardization": True,
    "threshold": 0.5,
    "tol": 1e-6,
}


def params(model) -> dict:
    return {p.name: value for p, value in model.stages[0].extractParamMap().items()}


@pytest.fixture
def tiny(spark):
    rows = spark.range(500).selectExpr("CAST(id % 2 AS INT) AS label", "CAST(id AS DOUBLE) AS a")
    return sk.assemble(rows, ["a"])


def test_default_parameters(tiny):
    assert params(sk.fit_random_forest(tiny)) == FOREST
    assert params(sk.fit_logistic_regression(tiny)) == REGRESSION


def test_given_parameters_win(tiny):
    assert params(sk.fit_random_forest(tiny, numTrees=3, seed=1))["numTrees"] == 3


@pytest.mark.parametrize("fit", [sk.fit_random_forest, sk.fit_logistic_regression])
@pytest.mark.parametrize("label", [-1.0, 0.5])
def test_impossible_labels_fail(tiny, fit, label):
    with pytest.raises(PySparkException):
        fit(tiny.withColumn("label", F.lit(label)))


def test_forest_takes_fewer_than_hundred_classes(tiny):
    high = tiny.withColumn("label", F.lit(149))
    with pytest.raises(PySparkException):
        sk.fit_random_forest(high)
    assert sk.fit_logistic_regression(high).stages[0].numClasses == 150


def test_one_class_only(tiny):
    zero = tiny.withColumn("label", F.lit(0))
    for fit in (sk.fit_random_forest, sk.fit_logistic_regression):
        assert {r.prediction for r in sk.score(fit(zero), zero).collect()} == {0.0}


def test_unused_low_labels_are_empty_classes(noisy):
    rows = sk.assemble(noisy, FEATURES)
    model = sk.fit_random_forest(rows, numTrees=2, maxDepth=2).stages[0]
    assert (model.numClasses, model.numFeatures) == (9, 4)


def test_declared_classes_change_nothing_but_the_scan(noisy):
    with sk.fit_input(noisy, FEATURES) as table:
        plain = sk.fit_random_forest(table, numTrees=3, maxDepth=4)
    with sk.fit_input(noisy, FEATURES, num_classes=9) as table:
        declared = sk.fit_random_forest(table, numTrees=3, maxDepth=4)
    assert plain.stages[0].toDebugString.split("\n")[1:] == (
        declared.stages[0].toDebugString.split("\n")[1:]
    )


def test_refit_on_other_files_gives_the_same_trees(spark, noisy, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    noisy.orderBy("l_tax").coalesce(1).write.parquet(one)
    noisy.repartition(7, "l_extendedprice").write.parquet(many)
    trees = []
    for path in (one, many):
        rows = spark.read.parquet(path)
        with sk.fit_input(rows, FEATURES, partitions=5, stable=True) as table:
            assert table.rdd.getNumPartitions() == 5
            model = sk.fit_random_forest(table, numTrees=5, maxDepth=6)
        trees.append(model.stages[0].toDebugString.split("\n")[1:])
    assert trees[0] == trees[1]


@pytest.mark.parametrize(
    "layout", [{}, {"partitions": 4, "stable": True, "cache": True}], ids=["scanned", "stable"]
)
@pytest.mark.parametrize(
    "fit,least", [(sk.fit_random_forest, 0.80), (sk.fit_logistic_regression, 0.75)]
)
def test_learns_a_noisy_target(noisy, fit, least, layout):
    """The commonest class holds under half of the rows, the best possible accuracy is 0.87."""
    train, valid = noisy.randomSplit([0.7, 0.3], seed=3)
    params = {"numTrees": 20} if fit is sk.fit_random_forest else {}
    with sk.fit_input(train, FEATURES, **layout) as table:
        model = fit(table, **params)
    metrics = sk.classification_metrics(sk.score(model, sk.assemble(valid, FEATURES))).first()
    assert least < metrics.accuracy < 0.9


def test_importances_are_named_in_vector_order(spark, noisy):
    model = sk.fit_random_forest(sk.assemble(noisy, FEATURES), numTrees=5)
    rows = sk.feature_importances(spark, model, FEATURES).orderBy("idx").collect()
    assert [r.feature for r in rows] == FEATURES
    assert [r.importance for r in rows] == model.stages[0].featureImportances.toArray().tolist()
    assert max(rows, key=lambda r: r.importance).feature == "l_quantity"
    with pytest.raises(ValueError, match="4 features"):
        sk.feature_importances(spark, model, FEATURES[:2])


def test_training_summary_equals_sparks(noisy):
    rows = sk.assemble(noisy, FEATURES)
    model = sk.fit_logistic_regression(rows)
    ours = sk.training_summary(model, rows).first()
    theirs = model.stages[0].summary
    assert ours.asDict() == pytest.approx(
        {
            "accuracy": theirs.accuracy,
            "weighted_fpr": theirs.weightedFalsePositiveRate,
            "weighted_tpr": theirs.weightedTruePositiveRate,
            "weighted_f_measure": theirs.weightedFMeasure(),
            "weighted_precision": theirs.weightedPrecision,
            "weighted_recall": theirs.weightedRecall,
        },
        abs=1e-12,
    )
    assert 0.6 < ours.accuracy < 0.9


def test_scored_table_shape(spark, noisy):
    rows = sk.assemble(noisy.limit(500), FEATURES)
    scored = sk.score(sk.fit_random_forest(rows, numTrees=2), rows)
    columns = ["label", "features", "rawPrediction", "probability", "prediction"]
    assert scored.columns == columns
    assert dict(scored.dtypes)["label"] == "int"
    names = {"features": FEATURES, "probability": [f"p{i}" for i in range(9)]}
    flat = sk.explode_vectors(scored.select("label", "features", "probability"), names)
    assert flat.columns == ["label", *FEATURES, *names["probability"]]
    assert all(abs(sum(r[5:]) - 1) < 1e-9 for r in flat.collect())
    assert Counter(flat.select("label", *FEATURES).collect()) == Counter(
        noisy.limit(500).collect()
    )


def test_preview(spark):
    df = spark.createDataFrame([(i, 9 - i) for i in range(9)], "a int, b int")
    assert sk.preview(df, 3, ["b"], ["a"]).collect() == [(8,), (7,), (6,)]
    assert sk.preview(df, cols=["a", "b"]).count() == 5
    assert "TakeOrderedAndProject" in physical_plan(sk.preview(df, 3, ["b"], ["a"]))
