from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.functions.names import LABEL, PREDICTION, VECTOR


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Append `rawPrediction`, `probability` and `prediction` to every row."""
    return _without_summary(model).transform(df)


def _without_summary(model: PipelineModel) -> PipelineModel:
    """A copy of `model` that does not know how its training went.

    A model of two classes keeps the session with that knowledge, and tasks are sent the whole model.
    Once rows have been counted by `DataFrame.observe`, a session cannot be sent."""
    bare = model.copy()
    for stage in bare.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.active()._jvm.scala.Option.empty())
    return bare


def preview(
    df: DataFrame,
    n: int = 5,
    order: Sequence[str] | None = None,
    cols: Sequence[str] = (VECTOR, LABEL, PREDICTION),
) -> DataFrame:
    """`n` scored rows to look at.

    With `order` they are the first by those columns, which are repeatable but take a scan of the
    table (each task keeps its own `n`); without it they are whatever rows are read first.
    """
    return (df.orderBy(*order) if order else df).limit(n).select(*cols)


def explode_vectors(df: DataFrame, names: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace vector columns by plain double columns: `{"features": ["f0", "f1"], ...}`."""
    plain = [c for c in df.columns if c not in names]
    arrays = df.select(*plain, *[vector_to_array(c).alias(c) for c in names])
    elements = [F.col(c)[i].alias(name) for c, out in names.items() for i, name in enumerate(out)]
    return arrays.select(*plain, *elements)
