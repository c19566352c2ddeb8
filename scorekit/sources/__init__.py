"""Where tables and models are read from and written to."""

from scorekit.sources.models import load_model, save_model
from scorekit.sources.releases import (
    Release,
    current_release,
    discard_staged,
    list_releases,
    publish_release,
    remove_releases,
    stage_release,
)
from scorekit.sources.scratch import scratch_path
from scorekit.sources.tables import read_csv, read_predictions, write_predictions

__all__ = [
    "Release",
    "current_release",
    "discard_staged",
    "list_releases",
    "load_model",
    "publish_release",
    "read_csv",
    "read_predictions",
    "remove_releases",
    "save_model",
    "scratch_path",
    "stage_release",
    "write_predictions",
]
