"""Whole jobs put together from the operators."""

from scorekit.plans.jobs import (
    PredictResult,
    TrainResult,
    predict_job,
    predict_release,
    train_job,
    train_release,
)

__all__ = [
    "PredictResult",
    "TrainResult",
    "predict_job",
    "predict_release",
    "train_job",
    "train_release",
]
