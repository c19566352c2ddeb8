"""Supervised classification on Spark tables: prepare, fit, score, measure, save."""

from scorekit.functions import FEATURES, TARGET
from scorekit.operators import *  # noqa: F403
from scorekit.operators import __all__ as _operators
from scorekit.plans import (
    PredictResult,
    TrainResult,
    predict_job,
    predict_release,
    train_job,
    train_release,
)
from scorekit.sources import *  # noqa: F403
from scorekit.sources import __all__ as _sources

__all__ = [
    *_operators,
    *_sources,
    "FEATURES",
    "TARGET",
    "PredictResult",
    "TrainResult",
    "predict_job",
    "predict_release",
    "train_job",
    "train_release",
]
