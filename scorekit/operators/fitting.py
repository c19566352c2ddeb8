from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame, SparkSession

from scorekit.functions.names import FEATURES, LABEL, VECTOR
from scorekit.operators.contract import contract_of, contract_of_model, with_contract
from scorekit.operators.evaluation import classification_metrics
from scorekit.operators.scoring import score

# The parameters a fit starts from.
RANDOM_FOREST = {"numTrees": 100, "maxDepth": 10, "maxBins": 32, "seed": 42}
LOGISTIC_REGRESSION = {"maxIter": 100, "regParam": 0.0, "elasticNetParam": 0.8}


def fit_random_forest(df: DataFrame, **params) -> PipelineModel:
    """Fit a random forest on `(label, features)`; `params` go to `RandomForestClassifier`."""
    return _fit(df, RandomForestClassifier(**_columns(), **{**RANDOM_FOREST, **params}))


def fit_logistic_regression(df: DataFrame, **params) -> PipelineModel:
    """Fit a logistic regression on `(label, features)`; `params` go to `LogisticRegression`."""
    return _fit(df, LogisticRegression(**_columns(), **{**LOGISTIC_REGRESSION, **params}))


def feature_importances(
    spark: SparkSession, model: PipelineModel, names: Sequence[str] | None = None
) -> DataFrame:
    """One row per feature of a fitted forest, named as the model itself knows its features.

    `names`, in the order they were assembled, are for a model that does not know them, one fitted on a
    vector that was not assembled here or saved elsewhere; the default is then the usual columns. For a
    model that does, other names are refused.
    """
    weights = model.stages[0].featureImportances.toArray()
    contract = contract_of_model(model)
    if contract and names is not None and list(names) != list(contract.names):
        raise ValueError(f"the model has {len(weights)} features, {', '.join(contract.names)}")
    names = contract.names if contract else FEATURES if names is None else names
    if len(weights) != len(names):
        raise ValueError(f"the model has {len(weights)} features, {len(names)} names were given")
    rows = [(i, name, float(w)) for i, (name, w) in enumerate(zip(names, weights))]
    return spark.createDataFrame(rows, "idx int, feature string, importance double")


def training_summary(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The six training metrics of `model`, in one row, over the rows `df` it was fitted on."""
    metrics = classification_metrics(score(model, df))
    return metrics.selectExpr(
        "accuracy",
        "weighted_fpr",
        "weighted_recall AS weighted_tpr",
        "f1 AS weighted_f_measure",
        "weighted_precision",
        "weighted_recall",
    )


def _columns() -> dict[str, str]:
    return {"labelCol": LABEL, "featuresCol": VECTOR}


def _fit(df: DataFrame, estimator: Estimator) -> PipelineModel:
    return with_contract(Pipeline(stages=[estimator]).fit(df), contract_of(df))
