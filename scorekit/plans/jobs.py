from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.functions.names import FEATURES, LABEL, TARGET
from scorekit.operators.contract import check_features, contract_of_model
from scorekit.operators.evaluation import classification_metrics
from scorekit.operators.fitting import (
    feature_importances,
    fit_logistic_regression,
    fit_random_forest,
    training_summary,
)
from scorekit.operators.preparation import (
    RowCounts,
    assemble,
    count_rows,
    drop_incomplete,
    fit_input,
    missing_columns,
    partitions_for,
    prepare,
    sample_rows,
)
from scorekit.operators.scoring import preview, score
from scorekit.sources.models import load_model, save_model
from scorekit.sources.releases import (
    Release,
    current_release,
    discard_staged,
    publish_release,
    stage_release,
)
from scorekit.sources.tables import (
    read_predictions,
    refuse_overlap,
    sources,
    write_predictions,
)

FITS = {"rf": fit_random_forest, "lr": fit_logistic_regression}


@dataclass(frozen=True)
class TrainResult:
    model: PipelineModel
    report: DataFrame
    """Feature importances of a forest, training metrics of a logistic regression."""
    predictions: DataFrame
    """The validation predictions, read back from where they were saved."""
    preview: DataFrame
    metrics: DataFrame
    train_counts: RowCounts | None
    """Rows of the training table that were read, bad and dropped; None for a forest with `num_classes`
    and without `fit_rows`, which reads its rows in no query that could count them."""
    valid_counts: RowCounts


@dataclass(frozen=True)
class PredictResult:
    predictions: DataFrame
    """The predictions, read back from where they were saved."""
    preview: DataFrame
    metrics: DataFrame | None
    """None if the table was declared to be without labels."""
    counts: RowCounts
    """Rows of the table that were read, bad and dropped."""


def train_job(
    train_df: DataFrame,
    valid_df: DataFrame,
    algo: str,
    model_path: str,
    pred_path: str,
    target: str = TARGET,
    features: Sequence[str] = FEATURES,
    num_classes: int | None = None,
    partitions: int | None = None,
    stable: bool = False,
    cache: bool = False,
    fit_rows: int | None = None,
    corrupt: str | None = None,
    partition_rows: int | None = None,
    **params,
) -> TrainResult:
    """Fit on one table, validate on another, save the model and then the validation predictions.

    Before anything runs it is checked that both tables have the target (or `label`) and all features,
    and that model, predictions and tables lie apart. Both paths must be on storage that all executors
    share. A failure is raised; predictions are only replaced once the new model is saved, and a model
    only once the new one is whole. `train_release` publishes both at once.

    `fit_rows` fits on that many of the complete training rows, chosen by `sample_rows`; the default is
    all. `corrupt` names the column that tells bad rows. `num_classes`, `partitions`, `stable`, `cache` and
    `partition_rows` are those of `fit_input`, `params` go to the estimator. A forest without `num_classes` needs a pass
    over the labels, a regression's report is one over its training rows, and a sample takes one to be
    drawn: the training rows are counted in the first of these.
    """
    fit = FITS[algo]
    spark = train_df.sparkSession
    for df in (train_df, valid_df):
        _check_columns(df, target, features)
    inputs = [*sources(train_df), *sources(valid_df)]
    refuse_overlap(spark, model_path, [pred_path, *inputs])
    refuse_overlap(spark, pred_path, inputs)
    read, counted = count_rows(train_df, _needed(train_df, target, features), corrupt)
    seen = prepare(read, target, features, vector=False)
    rows = prepare(train_df, target, features, vector=False)
    counts = None
    if algo == "rf" and num_classes is None:
        num_classes = _classes(seen.agg(F.max(LABEL)).first()[0])
        counts = counted()
    if fit_rows is not None:
        rows = sample_rows(rows if counts else seen, fit_rows)
        counts = counts or counted()
    with fit_input(
        rows, features, num_classes, partitions, stable, cache, partition_rows
    ) as table:
        model = fit(table, **params)
        save_model(model, model_path)
        if algo == "rf":
            report = feature_importances(spark, model)
        elif counts:
            report = _settled(training_summary(model, table))
        else:
            report = _settled(training_summary(model, assemble(seen, features)))
            counts = counted()
    scored = predict_job(valid_df, model, pred_path, target, features, corrupt=corrupt)
    return TrainResult(
        model, report, scored.predictions, scored.preview, scored.metrics, counts, scored.counts
    )


def predict_job(
    df: DataFrame,
    model: PipelineModel | str,
    pred_path: str,
    target: str = TARGET,
    features: Sequence[str] | None = None,
    labelled: bool = True,
    partitions: int | None = None,
    corrupt: str | None = None,
    partition_rows: int | None = None,
) -> PredictResult:
    """Score a table with a fitted model, or with the one saved at a path, and save the predictions.

    Without `features` they are those the model was fitted on, in its order; if it does not know, the
    usual columns. Before anything runs it is checked that the table has all features and, unless
    `labelled` is False, the target (or `label`), that the features are the model's, in its order, and
    hold numbers, and that predictions, model and table lie apart. The rows are scored and counted once,
    on their way to `pred_path`, in the splits they are scanned in, or dealt out to `partitions`, or to
    more that hold `partition_rows` rows each at most, for which the table is counted before.
    Preview and metrics read the columns they need from there, so nothing is cached and a lost executor
    costs no more than its own tasks. `corrupt` names the column that tells bad rows.
    """
    _check_columns(df, target, features or (), labelled)
    needed = [model] if isinstance(model, str) else []
    refuse_overlap(df.sparkSession, pred_path, [*needed, *sources(df)])
    if isinstance(model, str):
        model = load_model(model)
    if features is None:
        contract = contract_of_model(model)
        features = contract.names if contract else FEATURES
        _check_columns(df, target, features, labelled)
    check_features(model, df, features)
    read, counted = count_rows(df, _needed(df, target, features, labelled), corrupt)
    if labelled:
        rows = prepare(read, target, features, vector=False)
    else:
        rows = drop_incomplete(read)
    if partitions or partition_rows:
        # Counting `rows` would end the observation, so all rows of the table are.
        rows = rows.repartition(partitions_for(df, partitions, partition_rows))
    scored = score(model, assemble(rows, features))
    write_predictions(scored, pred_path)
    saved = read_predictions(df.sparkSession, pred_path, scored.schema)
    counts = counted()
    if not labelled:
        return PredictResult(saved, preview(saved, cols=("features", "prediction")), None, counts)
    return PredictResult(saved, preview(saved), classification_metrics(saved), counts)


def train_release(
    train_df: DataFrame, valid_df: DataFrame, algo: str, root: str, **options
) -> tuple[TrainResult, Release]:
    """`train_job`, whose model and predictions are published together in `root`.

    Nobody sees either before both are written, and an older release stays readable, whatever step fails.
    `options` are those of `train_job`. What the job has counted and measured goes into the manifest.
    """
    staged = stage_release(root, ["model", "predictions"])
    with _discarded_on_failure(train_df.sparkSession, staged):
        result = train_job(train_df, valid_df, algo, staged["model"], staged["predictions"], **options)
        facts = {"algo": algo, "metrics": _facts(result.metrics), "valid_rows": asdict(result.valid_counts)}
        if result.train_counts:
            facts["train_rows"] = asdict(result.train_counts)
        return result, publish_release(train_df.sparkSession, staged, **facts)


def predict_release(
    df: DataFrame, model_root: str, root: str, **options
) -> tuple[PredictResult, Release]:
    """`predict_job` with the model of the current release in `model_root`, published in `root`.

    `options` are those of `predict_job`. The manifest says which release of the model was used.
    """
    spark = df.sparkSession
    model = current_release(spark, model_root)
    staged = stage_release(root, ["predictions"])
    with _discarded_on_failure(spark, staged):
        result = predict_job(df, model["model"], staged["predictions"], **options)
        facts = {"model": {"root": model.root, "number": model.number}, "rows": asdict(result.counts)}
        if result.metrics is not None:
            facts["metrics"] = _facts(result.metrics)
        return result, publish_release(spark, staged, **facts)


@contextmanager
def _discarded_on_failure(spark: SparkSession, staged: Release) -> Iterator[None]:
    try:
        yield
    except Exception:
        discard_staged(spark, staged)
        raise


def _facts(metrics: DataFrame) -> dict[str, float | None]:
    """One row as what JSON can hold, which has no NaN."""
    row = metrics.first().asDict()
    return {name: None if value != value else value for name, value in row.items()}


def _classes(highest) -> int | None:
    """How many classes there are, None if that is for the estimator to say or to refuse."""
    if highest is None or not 1 <= highest < 100 or highest != int(highest):
        return None
    return int(highest) + 1


def _needed(df: DataFrame, target: str, features: Sequence[str], labelled: bool = True) -> list[str]:
    """The columns that a job reads, its label first; a table that has `label` keeps it."""
    if not labelled:
        return list(features)
    return [LABEL if missing_columns(df, [target]) else target, *features]


def _check_columns(
    df: DataFrame, target: str, features: Sequence[str], labelled: bool = True
) -> None:
    missing = missing_columns(df, features)
    if labelled and len(missing_columns(df, [target, LABEL])) == 2:
        missing.append(target)
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}; there are {', '.join(df.columns)}")


def _settled(one_row: DataFrame) -> DataFrame:
    """A one-row table computed now, while its input is still cached."""
    return one_row.sparkSession.createDataFrame([one_row.first()], one_row.schema)
