from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from scorekit.functions.expressions import or_fail, ratio
from scorekit.functions.names import LABEL, PREDICTION

NAN = float("nan")


def confusion_matrix(
    df: DataFrame, label: str = LABEL, prediction: str = PREDICTION
) -> DataFrame:
    """Rows per `(label, prediction)`, as `n`.

    This is the only step that sees the scored rows. Each task sums its own rows before the shuffle,
    so what travels is at most classes x classes rows per task, however many rows one class has.
    """
    for name in (label, prediction):
        if not isinstance(df.schema[name].dataType, NumericType):
            raise TypeError(f"column {name} must be numeric, it is {df.schema[name].dataType}")
    return (
        df.select(
            or_fail(F.col(label).cast("double"), f"null in {label}").alias(LABEL),
            or_fail(F.col(prediction).cast("double"), f"null in {prediction}").alias(PREDICTION),
        )
        .groupBy(LABEL, PREDICTION)
        .agg(F.count("*").alias("n"))
    )


def per_class_metrics(
    df: DataFrame, label: str = LABEL, prediction: str = PREDICTION
) -> DataFrame:
    """Counts and rates of every class that occurs as a label.

    A class that is predicted but is never a label has no row here; its rows still count as errors
    of the classes they belong to. A rate with nothing to count is 0, but the false-positive rate is
    NaN if all labels are one class.

    There is one row per label value, and the total over these rows is taken in one task: labels are
    meant to be classes, not measurements.
    """
    hit = F.col(LABEL) == F.col(PREDICTION)
    none = F.lit(0).cast("long")
    as_label = F.struct(
        F.col(LABEL),
        F.col("n").alias("support"),
        none.alias("predicted"),
        F.when(hit, F.col("n")).otherwise(none).alias("hits"),
    )
    as_prediction = F.struct(
        F.col(PREDICTION).alias(LABEL),
        none.alias("support"),
        F.col("n").alias("predicted"),
        none.alias("hits"),
    )
    classes = (
        confusion_matrix(df, label, prediction)
        .select(F.inline(F.array(as_label, as_prediction)))
        .groupBy(LABEL)
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    support, hits = F.col("support"), F.col("hits")
    misses = F.col("predicted") - hits
    precision, recall = F.col("precision"), F.col("recall")
    # One row per class is left, so one task can hold them all to get the total.
    total = F.sum("support").over(Window.partitionBy())
    return (
        classes.withColumn("total", total)
        .where(support > 0)
        .select(
            LABEL,
            support,
            F.col("predicted"),
            hits.alias("true_positives"),
            misses.alias("false_positives"),
            ratio(hits, F.col("predicted")).alias("precision"),
            (hits / support).alias("recall"),
            ratio(misses, F.col("total") - support, otherwise=NAN).alias("fpr"),
        )
        .withColumn("f1", ratio(2 * precision * recall, precision + recall))
    )


def classification_metrics(
    df: DataFrame, label: str = LABEL, prediction: str = PREDICTION
) -> DataFrame:
    """Accuracy and the class-weighted rates in one row, from one pass over the scored rows.

    For an empty table the accuracy is NaN and the rates are 0.
    """
    rows = F.sum("support")

    def weighted(rate: str) -> Column:
        return F.coalesce(F.sum(F.col("support") * F.col(rate)) / rows, F.lit(0.0))

    return per_class_metrics(df, label, prediction).agg(
        F.coalesce(F.sum("true_positives") / rows, F.lit(NAN)).alias("accuracy"),
        weighted("f1").alias("f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
        weighted("fpr").alias("weighted_fpr"),
    )


def metric_report(metrics: DataFrame) -> DataFrame:
    """A one-row metric table as one `(metric, value)` row per metric."""
    return metrics.unpivot([], metrics.columns, "metric", "value")
