import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import scorekit as sk
from scorekit.sources import models

FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]
FITS = [(sk.fit_random_forest, {"numTrees": 2, "maxDepth": 3}), (sk.fit_logistic_regression, {"maxIter": 3})]


@pytest.fixture(params=FITS, ids=["rf", "lr"])
def model(request, noisy):
    fit, params = request.param
    with sk.fit_input(noisy, FEATURES) as table:
        return fit(table, **params)


def test_a_model_knows_its_features_also_when_loaded(model, tmp_path):
    own = sk.contract_of_model(model)
    assert own.names == tuple(FEATURES) and own.types == ("double",) * 3
    sk.save_model(model, str(tmp_path / "m"))
    assert sk.contract_of_model(sk.load_model(str(tmp_path / "m"))) == own


def job(df, model, tmp_path, **options):
    options = {"target": "label", **options}
    return sk.predict_job(df, model, str(tmp_path / "p"), **options)


@pytest.mark.parametrize(
    "features", [FEATURES[::-1], FEATURES[:2], [*FEATURES, "l_tax"], ["l_quantity", "l_tax", "l_discount"]]
)
def test_other_features_are_refused_before_a_job(noisy, model, tmp_path, features):
    sk.save_model(model, str(tmp_path / "m"))
    for given in (model, str(tmp_path / "m")):
        with pytest.raises(ValueError, match="fitted on l_quantity, l_extendedprice, l_discount"):
            job(noisy, given, tmp_path, features=features)
    assert not (tmp_path / "p").exists()


def test_the_order_of_the_table_does_not_matter(noisy, model, tmp_path):
    straight = job(noisy, model, tmp_path).metrics.first()
    turned = noisy.select(*noisy.columns[::-1])
    assert job(turned, model, tmp_path, features=[f.upper() for f in FEATURES]).metrics.first() == straight


def test_types(noisy, model, tmp_path):
    whole = noisy.withColumn("l_quantity", F.col("l_quantity").cast("int"))
    assert job(whole, model, tmp_path).metrics.first() == job(noisy, model, tmp_path).metrics.first()
    text = noisy.withColumn("l_quantity", F.col("l_quantity").cast("string"))
    with pytest.raises(ValueError, match="l_quantity is string, the model was fitted on double"):
        job(text, model, tmp_path)


def test_a_model_saved_elsewhere(noisy, model, tmp_path):
    path = str(tmp_path / "m")
    model.write().save(path)
    bare = sk.load_model(path)
    assert sk.contract_of_model(bare) is None
    with pytest.raises(ValueError, match="3 features, 2 columns"):
        job(noisy, bare, tmp_path, features=FEATURES[:2])
    assert job(noisy, bare, tmp_path, features=FEATURES).counts.scanned == noisy.count()


def test_a_vector_that_was_not_assembled_has_no_contract(noisy):
    rows = noisy.select("label", array_to_vector(F.array(*FEATURES)).alias("features"))
    assert sk.contract_of(rows) is None
    assert sk.contract_of_model(sk.fit_random_forest(rows, numTrees=2, maxDepth=2)) is None


def test_importances_go_by_the_names_of_the_model(spark, noisy, tmp_path):
    with sk.fit_input(noisy, FEATURES) as table:
        model = sk.fit_random_forest(table, numTrees=3, maxDepth=3)
    assert [r.feature for r in sk.feature_importances(spark, model).orderBy("idx").collect()] == FEATURES
    with pytest.raises(ValueError, match="3 features, l_quantity"):
        sk.feature_importances(spark, model, FEATURES[::-1])
    sk.save_model(model, str(tmp_path / "m"))
    loaded = sk.feature_importances(spark, sk.load_model(str(tmp_path / "m")), FEATURES)
    assert loaded.collect() == sk.feature_importances(spark, model).collect()


def test_a_save_that_fails_keeps_the_old_model(model, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    sk.save_model(model, path)

    def fail(*_):
        raise RuntimeError("injected")

    for step in ("write_small", "put_in_place"):
        with monkeypatch.context() as patch:
            patch.setattr(models, step, fail)
            with pytest.raises(RuntimeError):
                sk.save_model(model, path)
        assert sk.contract_of_model(sk.load_model(path)).names == tuple(FEATURES)
