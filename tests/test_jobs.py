import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

import run_job
import scorekit as sk
import scorekit.plans.jobs as jobs
from tests.conftest import CSV_SCHEMA
from tests.test_preparation import cached_tables

SMALL_FOREST = {"numTrees": 20, "maxDepth": 5}


@pytest.fixture
def tables(spark, measurements):
    return [sk.read_csv(spark, path) for path in measurements]


def train(tables, tmp_path, algo, **params):
    paths = str(tmp_path / "model"), str(tmp_path / "predictions")
    return sk.train_job(*tables, algo, *paths, **params)


@pytest.mark.parametrize("algo,params", [("rf", SMALL_FOREST), ("lr", {})])
def test_train_job(spark, tables, tmp_path, algo, params):
    before = cached_tables(spark)
    result = train(tables, tmp_path, algo, **params)
    assert cached_tables(spark) == before
    saved = spark.read.parquet(str(tmp_path / "predictions"))
    columns = ["label", "features", "rawPrediction", "probability", "prediction"]
    assert saved.columns == result.predictions.columns == columns
    assert saved.count() == sk.prepare(tables[1]).count()
    accuracy = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(saved)
    assert result.metrics.first().accuracy == pytest.approx(accuracy)
    majority = max(r["count"] for r in saved.groupBy("label").count().collect()) / saved.count()
    assert majority < accuracy < 1
    assert result.preview.columns == ["features", "label", "prediction"]
    assert result.preview.count() == 5
    again = sk.score(sk.load_model(str(tmp_path / "model")), sk.prepare(tables[1]))
    assert sorted(r.prediction for r in again.collect()) == sorted(
        r.prediction for r in saved.collect()
    )


def test_forest_reports_importances_by_name(tables, tmp_path):
    report = train(tables, tmp_path, "rf", num_classes=9, **SMALL_FOREST).report
    assert [r.feature for r in report.orderBy("idx").collect()] == sk.FEATURES
    assert report.orderBy("importance").tail(1)[0].feature == "alcohol"


def test_regression_reports_the_training_rows(tables, tmp_path):
    result = train(tables, tmp_path, "lr")
    expected = sk.training_summary(result.model, sk.prepare(tables[0])).first()
    assert result.report.first().asDict() == pytest.approx(expected.asDict())
    assert result.report.first().accuracy != result.metrics.first().accuracy


def test_given_schema_layout_and_cache(spark, measurements, tmp_path):
    tables = [sk.read_csv(spark, path, CSV_SCHEMA) for path in measurements]
    layout = {"partitions": 3, "stable": True, "cache": True}
    before = cached_tables(spark)
    result = train(tables, tmp_path, "rf", **layout, **SMALL_FOREST)
    assert cached_tables(spark) == before
    assert result.metrics.first().accuracy > 0.4


@pytest.fixture
def no_fit(monkeypatch):
    """Fails if a job gets as far as fitting."""

    def fail(*_, **__):
        raise AssertionError("a fit was started")

    monkeypatch.setattr(jobs, "FITS", {"rf": fail, "lr": fail})


def unchanged(tmp_path):
    """An old model and old predictions, and a check that they are as they were."""
    for name in ("model", "predictions"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "old").write_text("old")
    return lambda: all(
        [p.name for p in (tmp_path / n).iterdir()] == ["old"] for n in ("model", "predictions")
    )


@pytest.mark.parametrize("which", [0, 1])
@pytest.mark.parametrize("column", ["quality", "alcohol"])
def test_missing_columns_are_refused_before_the_fit(tables, tmp_path, no_fit, which, column):
    same = unchanged(tmp_path)
    tables[which] = tables[which].drop(column)
    with pytest.raises(ValueError, match=column):
        train(tables, tmp_path, "rf")
    assert same()


def test_columns_are_found_in_any_case(tables, tmp_path):
    tables[1] = tables[1].withColumnRenamed("quality", "Quality")
    assert train(tables, tmp_path, "rf", **SMALL_FOREST).metrics.first().accuracy > 0.4


def test_a_mistyped_target_is_refused(tables, tmp_path, no_fit):
    with pytest.raises(ValueError, match="qualty"):
        train(tables, tmp_path, "rf", target="qualty")
    with pytest.raises(ValueError, match="qualty"):
        sk.predict_job(tables[1], "none", str(tmp_path / "p"), target="qualty")


@pytest.mark.parametrize("model,pred", [("a", "a"), ("a/b", "a"), ("a", "a/b")])
def test_model_and_predictions_must_lie_apart(tables, tmp_path, no_fit, model, pred):
    with pytest.raises(ValueError, match="cannot overwrite"):
        sk.train_job(*tables, "rf", str(tmp_path / model), str(tmp_path / pred))


@pytest.mark.parametrize("kept", ["predictions", "model"])
def test_tables_and_results_must_lie_apart(spark, tables, tmp_path, no_fit, kept):
    old = str(tmp_path / kept)
    sk.select_features(tables[1]).write.parquet(old)
    valid = spark.read.parquet(old)
    with pytest.raises(ValueError, match="cannot overwrite"):
        train([tables[0], valid], tmp_path, "rf")
    assert valid.count() == 300


def test_unknown_algorithm(tables, tmp_path):
    with pytest.raises(KeyError):
        train(tables, tmp_path, "svm")


def test_predict_job(spark, tables, tmp_path):
    trained = train(tables, tmp_path, "rf", **SMALL_FOREST)
    path = str(tmp_path / "new")
    labelled = sk.predict_job(tables[1], str(tmp_path / "model"), path)
    assert labelled.metrics.first() == trained.metrics.first()
    bare = tables[1].drop("quality")
    with pytest.raises(ValueError, match="quality"):
        sk.predict_job(bare, trained.model, path + "2")
    unlabelled = sk.predict_job(bare, trained.model, path + "2", labelled=False, partitions=2)
    assert unlabelled.metrics is None
    assert unlabelled.preview.columns == ["features", "prediction"]
    assert unlabelled.predictions.count() == labelled.predictions.count()


def test_tasks_of_a_job_hold_so_many_rows_at_most(tables, tmp_path, monkeypatch):
    seen = []

    def fit(table, **params):
        seen.append(table.rdd.getNumPartitions())
        return sk.fit_random_forest(table, **params)

    monkeypatch.setattr(jobs, "FITS", {"rf": fit})
    layout = {"partitions": 2, "partition_rows": 100}
    trained = train(tables, tmp_path, "rf", stable=True, **layout, **SMALL_FOREST)
    assert seen == [-(-(trained.train_counts.scanned - trained.train_counts.dropped) // 100)] and seen[0] > 2
    path = str(tmp_path / "new")
    result = sk.predict_job(tables[1], trained.model, path, **layout)
    assert result.counts == trained.valid_counts
    assert len(list((tmp_path / "new").glob("part-*"))) == 3
    assert result.metrics.first() == trained.metrics.first()


def test_command_line(spark, measurements, tmp_path, capsys):
    train_path, valid_path = measurements
    paths = ["--model", str(tmp_path / "m"), "--predictions", str(tmp_path / "p")]
    for algo, words in (("rf", "10 fixed acidity"), ("lr", "training metrics")):
        run_job.main(
            ["train", "--train", train_path, "--valid", valid_path, "--algo", algo, *paths]
        )
        printed = capsys.readouterr().out
        assert words in printed and "weighted_recall:" in printed
    run_job.main(["predict", "--input", valid_path, *paths])
    assert "accuracy:" in capsys.readouterr().out
    layout = ["--partitions", "2", "--stable", "--cache", "--param", "numTrees=3"]
    strict = ["--schema", CSV_SCHEMA, "--mode", "FAILFAST"]
    tables = ["--train", train_path, "--valid", valid_path]
    run_job.main(["train", *tables, *paths, *layout, *strict])
    assert "accuracy:" in capsys.readouterr().out


def test_command_line_with_releases(spark, measurements, tmp_path, capsys):
    train_path, valid_path = measurements
    root, scores = str(tmp_path / "r"), str(tmp_path / "s")
    strict = ["--schema", CSV_SCHEMA, "--corrupt", "line"]
    tables = ["--train", train_path, "--valid", valid_path, "--fit-rows", "500"]
    for number in (1, 2):
        run_job.main(["train", *tables, *strict, "--release", root, "--param", "numTrees=3"])
        printed = capsys.readouterr().out
        assert f"release {number} of {root}" in printed and "training rows: 900 read, 0 bad" in printed
    run_job.main(["predict", "--input", valid_path, *strict, "--model", root, "--release", scores])
    assert f"release 1 of {scores}" in capsys.readouterr().out
    assert sk.current_release(spark, scores).facts["model"]["number"] == 2
    for wrong in (["train", *tables], ["predict", "--input", valid_path, "--release", scores]):
        with pytest.raises(SystemExit):
            run_job.main(wrong)


def test_command_line_parameters():
    assert run_job.parameter("numTrees=20") == ("numTrees", 20)
    assert run_job.parameter("regParam=0.5") == ("regParam", 0.5)
    assert run_job.parameter("standardization=false") == ("standardization", False)
    assert run_job.parameter("impurity=gini") == ("impurity", "gini")
