"""Table operators: DataFrame in, DataFrame or fitted pipeline out."""

from scorekit.operators.contract import Contract, check_features, contract_of, contract_of_model
from scorekit.operators.evaluation import (
    classification_metrics,
    confusion_matrix,
    metric_report,
    per_class_metrics,
)
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
    deal_out,
    declare_classes,
    drop_incomplete,
    fit_input,
    missing_columns,
    partitions_for,
    prepare,
    sample_rows,
    select_features,
    stable_layout,
)
from scorekit.operators.scoring import explode_vectors, preview, score

__all__ = [
    "Contract",
    "RowCounts",
    "assemble",
    "check_features",
    "classification_metrics",
    "confusion_matrix",
    "contract_of",
    "contract_of_model",
    "count_rows",
    "deal_out",
    "declare_classes",
    "drop_incomplete",
    "explode_vectors",
    "feature_importances",
    "fit_input",
    "fit_logistic_regression",
    "fit_random_forest",
    "metric_report",
    "missing_columns",
    "partitions_for",
    "per_class_metrics",
    "prepare",
    "preview",
    "sample_rows",
    "score",
    "select_features",
    "stable_layout",
    "training_summary",
]
