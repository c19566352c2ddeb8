import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

import scorekit as sk

SPARK_NAMES = {
    "accuracy": "accuracy",
    "f1": "f1",
    "weighted_precision": "weightedPrecision",
    "weighted_recall": "weightedRecall",
    "weighted_fpr": "weightedFalsePositiveRate",
}
PAIR = "label double, prediction double"


def pairs(spark, rows, schema=PAIR):
    return spark.createDataFrame(rows, schema)


def assert_equals_spark(df):
    ours = sk.classification_metrics(df).first()
    for name, spark_name in SPARK_NAMES.items():
        theirs = MulticlassClassificationEvaluator(metricName=spark_name).evaluate(df)
        assert ours[name] == pytest.approx(theirs, abs=1e-12, nan_ok=True), name


@pytest.mark.parametrize("seed", range(3))
def test_equals_spark_evaluator_on_noise(spark, seed):
    """Class 3 is never predicted, class 9 is never a label, class 5 holds most rows."""
    rng = random.Random(seed)
    rows = [
        (float(rng.choice([3, 4, 5, 5, 5, 5, 8])), float(rng.choice([4, 5, 5, 8, 9])))
        for _ in range(2000)
    ]
    assert_equals_spark(pairs(spark, rows))


@pytest.mark.parametrize(
    "rows",
    [
        [(1.0, 1.0), (1.0, 2.0)],
        [(1.0, 1.0), (1.0, 1.0)],
        [(1.0, 2.0), (2.0, 1.0)],
        [],
    ],
    ids=["one class", "one class, all right", "all wrong", "empty"],
)
def test_equals_spark_evaluator_on_edges(spark, rows):
    assert_equals_spark(pairs(spark, rows))


def test_empty_table_has_no_accuracy(spark):
    row = sk.classification_metrics(pairs(spark, [])).first()
    assert math.isnan(row.accuracy)
    assert row.f1 == 0


def test_confusion_and_per_class_against_counting(spark):
    rng = random.Random(1)
    rows = [(float(rng.randint(0, 3)), float(rng.randint(1, 4))) for _ in range(500)]
    df = pairs(spark, rows)
    cells = {(r.label, r.prediction): r.n for r in sk.confusion_matrix(df).collect()}
    assert cells == {c: rows.count(c) for c in set(rows)}
    for r in sk.per_class_metrics(df).collect():
        support = sum(label == r.label for label, _ in rows)
        predicted = sum(p == r.label for _, p in rows)
        hits = rows.count((r.label, r.label))
        assert (r.support, r.predicted, r.true_positives) == (support, predicted, hits)
        assert r.false_positives == predicted - hits
        assert r.recall == pytest.approx(hits / support)
        assert r.precision == pytest.approx(hits / predicted if predicted else 0)
        assert r.fpr == pytest.approx((predicted - hits) / (len(rows) - support))
    assert sk.per_class_metrics(df).count() == 4  # class 4 is no label


@pytest.mark.parametrize("row", [(None, 1.0), (1.0, None)])
def test_null_fails_the_job(spark, row):
    with pytest.raises(PySparkException, match="null in"):
        sk.classification_metrics(pairs(spark, [row, (1.0, 1.0)])).collect()


def test_text_label_is_rejected(spark):
    with pytest.raises(TypeError, match="label"):
        sk.classification_metrics(pairs(spark, [("a", 1.0)], "label string, prediction double"))


def test_integer_columns_of_other_names(spark):
    df = pairs(spark, [(1, 1), (2, 1)], "truth int, guess bigint")
    assert sk.classification_metrics(df, "truth", "guess").first().accuracy == 0.5


def test_metrics_scan_the_table_once(spark, tmp_path):
    pairs(spark, [(1.0, 1.0)]).write.parquet(str(tmp_path / "p"))
    plan = physical_plan(sk.classification_metrics(spark.read.parquet(str(tmp_path / "p"))))
    assert plan.count("FileScan") == 1
    assert plan.index("partial_count") < plan.index("FileScan")


def test_report_is_long_form(spark):
    report = sk.metric_report(sk.classification_metrics(pairs(spark, [(1.0, 1.0), (2.0, 1.0)])))
    assert report.columns == ["metric", "value"]
    assert {r.metric for r in report.collect()} == set(SPARK_NAMES)


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
