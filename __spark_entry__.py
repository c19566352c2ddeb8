"""

All queries read whole tables. Labels and predictions are made from `lineitem` by rule:

* `BUCKET` is a class that follows from `l_quantity` alone.
* `TRAIN_LABEL` and `VALID_LABEL` are that class with some rows relabelled, which no feature shows.
* `RULED` is a pair of label and imperfect prediction; it has a label that is never predicted and a
  prediction that is never a label.

A model can only learn `BUCKET` from the features it is given here, even from the relabelled rows, so
SQL can state what it must predict. Whether models learn what is hard to learn is tested in `tests/`.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Callable
from pathlib import Path

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import scorekit as sk  # noqa: E402

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
BUCKET = "CASE WHEN l_quantity <= 17 THEN 3 WHEN l_quantity <= 34 THEN 5 ELSE 8 END"
TRAIN_LABEL = f"CASE WHEN l_orderkey % 5 = 0 THEN 5 ELSE {BUCKET} END"
VALID_LABEL = f"CASE WHEN l_linenumber = 2 THEN 8 WHEN l_returnflag = 'A' THEN 5 ELSE {BUCKET} END"
RULE_LABEL = "CAST(3 + (l_orderkey * 7 + l_linenumber) % 6 AS DOUBLE)"
RULE_PREDICTION = f"""CAST(CASE WHEN l_quantity > 45 THEN 9
    WHEN l_quantity > 20 THEN CASE WHEN {RULE_LABEL} = 3 THEN 4 ELSE {RULE_LABEL} END
    ELSE 5 END AS DOUBLE)"""
STEP_CLASS = "CASE WHEN {step} < -2 THEN 0 WHEN {step} < 2 THEN 1 ELSE 2 END"
STEP_CLASS_SQL = STEP_CLASS.format(step="floor(CAST(embedding[1] AS DOUBLE) * 20)")

# One 0/1 column per class. With these as its only features a logistic regression has one weight per
# cell of the table and predicts the commonest label of the cell.
CELLS = {
    "is_low": "CAST(l_quantity <= 17 AS INT)",
    "is_middle": "CAST(l_quantity > 17 AND l_quantity <= 34 AS INT)",
    "is_high": "CAST(l_quantity > 34 AS INT)",
}

# The test files are one row group each, which one task scans. The queries that fit ask for as many
# partitions as their caller would, and for more where these would hold more rows than that each.
PARTITIONS = 8
PARTITION_ROWS = 250_000
LAYOUT = {"partitions": PARTITIONS, "partition_rows": PARTITION_ROWS}
STABLE = {**LAYOUT, "stable": True, "cache": True}

# A forest that may cut between any two of the 50 quantities and looks at every feature.
EXACT_FOREST = {"numTrees": 20, "maxDepth": 10, "maxBins": 64, "featureSubsetStrategy": "all"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def ruled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).selectExpr(
        "*", f"{RULE_LABEL} AS label", f"{RULE_PREDICTION} AS prediction"
    )


def rounded(df: DataFrame) -> DataFrame:
    """Engines add doubles in different orders, so rates are compared to six digits."""
    return df.select(
        *[
            F.round(f.name, 6).alias(f.name) if f.dataType.typeName() == "double" else f.name
            for f in df.schema
        ]
    )


# Sources and sinks


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_csv(spark, sf_dir, sep=",", quote='"')


def csv_dialect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _through_csv(spark, sf_dir, sep=";", quote="'")


def csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = lineitem(spark, sf_dir).select(*_CSV_COLUMNS).schema
    return _through_csv(spark, sf_dir, sep=",", quote='"', schema=schema)


_CSV_COLUMNS = ["l_orderkey", "l_linenumber", *FEATURES, "l_returnflag", "l_linestatus"]


def csv_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that are no numbers, in rows that the reader tells apart."""
    path = sk.scratch_path(spark, "csv")
    tax = F.when(F.col("l_linenumber") == 3, "n/a").otherwise(F.col("l_tax").cast("string"))
    rows = lineitem(spark, sf_dir).select("l_orderkey", "l_linenumber", tax.alias("l_tax"))
    rows.write.option("header", True).csv(path)
    schema = "l_orderkey bigint, l_linenumber int, l_tax double"
    back = sk.read_csv(spark, path, schema, corrupt="line")
    return back.select("l_orderkey", "l_linenumber", "l_tax", F.isnotnull("line").alias("bad"))


def _through_csv(spark, sf_dir, sep, quote, schema=None) -> DataFrame:
    path = sk.scratch_path(spark, "csv")
    rows = lineitem(spark, sf_dir).select(*_CSV_COLUMNS)
    options = {"header": True, "sep": sep, "quote": quote, "quoteAll": True}
    rows.write.options(**options).csv(path)
    back = sk.read_csv(spark, path, schema=schema, sep=sep, quote=quote)
    return back.withColumn("l_orderkey", F.col("l_orderkey").cast("bigint"))


def predictions_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sk.scratch_path(spark, "predictions")
    rows = ruled(spark, sf_dir).select("l_orderkey", "l_linenumber", "label", "prediction")
    sk.write_predictions(rows.withColumn("prediction", F.lit(0.0)), path)
    sk.write_predictions(rows, path)
    return sk.read_predictions(spark, path)


def model_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _bucketed(spark, sf_dir)
    path = sk.scratch_path(spark, "model")
    with sk.fit_input(rows, FEATURES, **STABLE) as table:
        sk.save_model(sk.fit_random_forest(table, **{**EXACT_FOREST, "maxDepth": 1}), path)
        sk.save_model(sk.fit_random_forest(table, **EXACT_FOREST), path)
    return _predicted(sk.load_model(path), rows)


# Projection, filter, feature vector


def select_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.select_features(lineitem(spark, sf_dir), "l_linenumber", FEATURES)


def _with_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineitem(spark, sf_dir).withColumns(
        {
            "l_discount": F.expr("CASE WHEN l_discount <> 0.05 THEN l_discount END"),
            "l_tax": F.expr("CASE WHEN l_tax = 0.03 THEN double('NaN') ELSE l_tax END"),
        }
    )


def drop_incomplete(spark: SparkSession, sf_dir: str) -> DataFrame:
    cols = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"]
    return sk.drop_incomplete(_with_holes(spark, sf_dir).select(*cols))


def assemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = [*FEATURES, "l_linenumber"]
    rows = lineitem(spark, sf_dir).select("l_orderkey", *features)
    names = {"features": [f"f{i}" for i in range(len(features))]}
    return sk.explode_vectors(sk.assemble(rows, features), names)


def prepare_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.prepare(_with_holes(spark, sf_dir), "l_linenumber", FEATURES, vector=False)


def stable_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few distinct rows with many copies each; every copy must come out again."""
    rows = lineitem(spark, sf_dir).select("l_returnflag", "l_linestatus", "l_tax")
    return sk.stable_layout(rows, sk.partitions_for(rows, **LAYOUT))


# Fitting and scoring


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label and features, with the keys of the row to tell predictions apart."""
    return sk.drop_incomplete(
        lineitem(spark, sf_dir).select(
            "l_orderkey", "l_linenumber", F.expr(BUCKET).alias("label"), *FEATURES
        )
    )


def _predicted(model: PipelineModel, rows: DataFrame) -> DataFrame:
    scored = sk.score(model, sk.assemble(sk.deal_out(rows, **LAYOUT), FEATURES))
    return scored.select("l_orderkey", "l_linenumber", "label", "prediction")


def rf_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _bucketed(spark, sf_dir)
    with sk.fit_input(sk.deal_out(rows, **LAYOUT), FEATURES, cache=True) as table:
        model = sk.fit_random_forest(table, **EXACT_FOREST)
    return _predicted(model, rows)


def rf_score_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees that follow from the rows alone, without a cache: as a large table is fitted."""
    rows = _bucketed(spark, sf_dir)
    with sk.fit_input(rows, FEATURES, 9, stable=True, **LAYOUT) as table:
        model = sk.fit_random_forest(table, **EXACT_FOREST)
    return _predicted(model, rows)


def lr_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _bucketed(spark, sf_dir)
    with sk.fit_input(sk.deal_out(rows, **LAYOUT), FEATURES, cache=True) as table:
        model = sk.fit_logistic_regression(table)
    return _predicted(model, rows)


def lr_score_scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No layout and no cache: the rows are read as they are scanned."""
    rows = _bucketed(spark, sf_dir)
    with sk.fit_input(rows, FEATURES) as table:
        model = sk.fit_logistic_regression(table)
    return _predicted(model, rows)


def rf_importances(spark: SparkSession, sf_dir: str) -> DataFrame:
    with sk.fit_input(_bucketed(spark, sf_dir), FEATURES, **STABLE) as table:
        model = sk.fit_random_forest(table, **EXACT_FOREST)
    return sk.feature_importances(spark, model, FEATURES).agg(
        F.max_by("feature", "importance").alias("top_feature"),
        F.count("*").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"),
    )


def importances_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importances by the names that a saved model brings along."""
    path = sk.scratch_path(spark, "model")
    with sk.fit_input(_bucketed(spark, sf_dir), FEATURES, **STABLE) as table:
        sk.save_model(sk.fit_random_forest(table, **EXACT_FOREST), path)
    report = sk.feature_importances(spark, sk.load_model(path))
    return report.select("idx", "feature", (F.col("importance") > 0.5).alias("decides"))


def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rows as asked for, all of them of the table, and each as often as there at most."""
    rows = lineitem(spark, sf_dir).select("l_linenumber", "l_quantity", "l_tax")
    per_row = rows.groupBy(*rows.columns).agg(F.count("*").alias("there"))
    taken = sk.sample_rows(rows, 5000).groupBy(*rows.columns).agg(F.count("*").alias("taken"))
    both = taken.join(per_row, rows.columns, "left")
    return both.agg(
        F.sum("taken").alias("rows"),
        F.count(F.when(F.col("there").isNull() | (F.col("taken") > F.col("there")), 1)).alias("wrong"),
    )


def rf_score_sampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest fitted on some thousand rows, which hold all there is to learn."""
    rows = _bucketed(spark, sf_dir)
    sample = sk.sample_rows(rows.select("label", *FEATURES), 10_000)
    with sk.fit_input(sample, FEATURES, 9, PARTITIONS, stable=True) as table:
        model = sk.fit_random_forest(table, **EXACT_FOREST)
    return _predicted(model, rows)


def embeddings_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors that come as arrays, in steps of 1/20; the class follows from the first element."""
    steps = F.transform("embedding", lambda x: F.floor(x.cast("double") * 20).cast("double"))
    rows = table(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.expr(STEP_CLASS.format(step="floor(CAST(embedding[0] AS DOUBLE) * 20)")).alias("label"),
        array_to_vector(steps).alias("features"),
    )
    model = sk.fit_random_forest(rows, numTrees=20, featureSubsetStrategy="all")
    return sk.score(model, rows).select("vec_id", "label", "prediction")


# Metrics


def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.confusion_matrix(ruled(spark, sf_dir))


def per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sk.per_class_metrics(ruled(spark, sf_dir)))


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sk.classification_metrics(ruled(spark, sf_dir)))


def metrics_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(sk.classification_metrics(table(spark, sf_dir, "labels"), "quality", "toxic"))


def metric_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sk.metric_report(metrics(spark, sf_dir))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ruled(spark, sf_dir)
    cols = ["l_orderkey", "l_linenumber", *FEATURES, "label", "prediction"]
    order = lineitem(spark, sf_dir).columns
    return sk.preview(rows, 5, order, cols)


def _cells(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    cells = [F.expr(e).alias(name) for name, e in CELLS.items()]
    return lineitem(spark, sf_dir).select(F.expr(label).alias("quality"), *cells)


def lr_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sk.prepare(_cells(spark, sf_dir, TRAIN_LABEL), features=list(CELLS), vector=False)
    rows = sk.deal_out(rows, **LAYOUT)
    with sk.fit_input(rows, list(CELLS), cache=True) as table:
        model = sk.fit_logistic_regression(table)
    return rounded(sk.training_summary(model, sk.assemble(rows, list(CELLS))))


# Jobs


def _train(spark: SparkSession, sf_dir: str, algo: str, **params) -> sk.TrainResult:
    return sk.train_job(
        sk.deal_out(_cells(spark, sf_dir, TRAIN_LABEL), **LAYOUT),
        _cells(spark, sf_dir, VALID_LABEL),
        algo,
        sk.scratch_path(spark, "model"),
        sk.scratch_path(spark, "predictions"),
        features=list(CELLS),
        cache=True,
        **params,
    )


def train_job_rf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_train(spark, sf_dir, "rf", num_classes=9).metrics)


def train_job_lr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_train(spark, sf_dir, "lr").metrics)


def train_job_lr_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_train(spark, sf_dir, "lr").report)


def train_job_rf_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job over real features, whose rows are nearly all different, through the stable layout."""
    rows = lineitem(spark, sf_dir)
    result = sk.train_job(
        rows.select(F.expr(BUCKET).alias("quality"), *FEATURES),
        sk.deal_out(rows.select(F.expr(VALID_LABEL).alias("quality"), *FEATURES), **LAYOUT),
        "rf",
        sk.scratch_path(spark, "model"),
        sk.scratch_path(spark, "predictions"),
        features=FEATURES,
        **STABLE,
        **EXACT_FOREST,
    )
    return rounded(result.metrics)


def _cell_forest(spark: SparkSession, sf_dir: str) -> PipelineModel:
    rows = sk.prepare(_cells(spark, sf_dir, TRAIN_LABEL), features=list(CELLS), vector=False)
    with sk.fit_input(rows, list(CELLS), **STABLE) as table:
        return sk.fit_random_forest(table, numTrees=20)


def predict_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    model_path = sk.scratch_path(spark, "model")
    sk.save_model(_cell_forest(spark, sf_dir), model_path)
    result = sk.predict_job(
        _cells(spark, sf_dir, VALID_LABEL),
        model_path,
        sk.scratch_path(spark, "predictions"),
        features=list(CELLS),
        **LAYOUT,
    )
    return rounded(result.metrics)


def predict_job_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = sk.predict_job(
        _cells(spark, sf_dir, VALID_LABEL).drop("quality"),
        _cell_forest(spark, sf_dir),
        sk.scratch_path(spark, "predictions"),
        features=list(CELLS),
        labelled=False,
        **LAYOUT,
    )
    return sk.explode_vectors(
        result.predictions.select("features", "prediction"), {"features": list(CELLS)}
    )


def train_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as a reader finds them who knows nothing but the folder of the releases."""
    root = sk.scratch_path(spark, "release")
    for params in ({"numTrees": 1, "maxDepth": 1}, {"numTrees": 20}):
        sk.train_release(
            _cells(spark, sf_dir, TRAIN_LABEL),
            _cells(spark, sf_dir, VALID_LABEL),
            "rf",
            root,
            features=list(CELLS),
            **STABLE,
            **params,
        )
    release = sk.current_release(spark, root)
    return rounded(sk.classification_metrics(sk.read_predictions(spark, release["predictions"])))


def predict_release(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a scoring job has read and dropped, from the manifest of what it published."""
    root, model_root = sk.scratch_path(spark, "release"), sk.scratch_path(spark, "model")
    staged = sk.stage_release(model_root, ["model"])
    rows = _bucketed(spark, sf_dir)
    with sk.fit_input(rows, FEATURES, 9, **STABLE) as table:
        sk.save_model(sk.fit_random_forest(table, numTrees=5), staged["model"])
    sk.publish_release(spark, staged)
    holes = _with_holes(spark, sf_dir).withColumn("quality", F.expr(BUCKET))
    sk.predict_release(holes, model_root, root, **LAYOUT)
    release = sk.current_release(spark, root)
    facts = release.facts["rows"]
    written = sk.read_predictions(spark, release["predictions"]).agg(F.count("*").alias("written"))
    counted = [F.lit(facts[n]).cast("bigint").alias(n) for n in ("scanned", "bad", "dropped")]
    return written.select(*counted, "written")


# What SQL expects


def metrics_sql(source: str, columns: str) -> str:
    """Metrics of `source`, a query for doubles `label` and `prediction`, counted the long way."""
    return f"""
    WITH scored AS ({source}),
    size AS (SELECT count(*) AS n FROM scored),
    class AS (
        SELECT label, count(*) AS support,
            count(*) FILTER (WHERE prediction = label) AS hits,
            (SELECT count(*) FROM scored AS o WHERE o.prediction = s.label) AS predicted
        FROM scored AS s GROUP BY label
    ),
    rate AS (
        SELECT label, support, predicted, hits AS true_positives,
            predicted - hits AS false_positives,
            CASE WHEN predicted = 0 THEN 0.0 ELSE CAST(hits AS DOUBLE) / predicted END AS precision,
            CAST(hits AS DOUBLE) / support AS recall,
            CAST(predicted - hits AS DOUBLE) / (n - support) AS fpr
        FROM class, size
    ),
    class_metrics AS (
        SELECT *, CASE WHEN precision + recall = 0 THEN 0.0
            ELSE 2 * precision * recall / (precision + recall) END AS f1
        FROM rate
    ),
    total AS (
        SELECT round(CAST(sum(true_positives) AS DOUBLE) / sum(support), 6) AS accuracy,
            round(sum(support * f1) / sum(support), 6) AS f1,
            round(sum(support * precision) / sum(support), 6) AS weighted_precision,
            round(sum(support * recall) / sum(support), 6) AS weighted_recall,
            round(sum(support * fpr) / sum(support), 6) AS weighted_fpr
        FROM class_metrics
    )
    {columns}
    """


RULED_PAIRS = f"SELECT {RULE_LABEL} AS label, {RULE_PREDICTION} AS prediction FROM lineitem"
BINARY_PAIRS = """SELECT CAST(quality AS DOUBLE) AS label, CAST(toxic AS DOUBLE) AS prediction
    FROM labels"""
TOTAL = "SELECT * FROM total"
SUMMARY = """SELECT accuracy, weighted_fpr, weighted_recall AS weighted_tpr, f1 AS weighted_f_measure,
    weighted_precision, weighted_recall FROM total"""


def learned_pairs(label: str) -> str:
    """What a model that has learned `BUCKET` makes of rows labelled otherwise."""
    return f"""SELECT CAST({label} AS DOUBLE) AS label, CAST({BUCKET} AS DOUBLE) AS prediction
        FROM lineitem"""


LEARNED = f"""SELECT l_orderkey, l_linenumber, {BUCKET} AS label,
    CAST({BUCKET} AS DOUBLE) AS prediction FROM lineitem"""
CSV_ROWS = f"SELECT {', '.join(_CSV_COLUMNS)} FROM lineitem"
LABELLED = f"SELECT l_linenumber AS label, {', '.join(FEATURES)} FROM lineitem"

_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "csv_scan": (csv_scan, CSV_ROWS),
    "csv_dialect": (csv_dialect, CSV_ROWS),
    "csv_schema": (csv_schema, CSV_ROWS),
    "csv_corrupt": (
        csv_corrupt,
        """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_tax END AS l_tax,
            l_linenumber = 3 AS bad FROM lineitem""",
    ),
    "predictions_overwrite": (
        predictions_overwrite,
        f"""SELECT l_orderkey, l_linenumber, {RULE_LABEL} AS label,
            {RULE_PREDICTION} AS prediction FROM lineitem""",
    ),
    "model_round_trip": (model_round_trip, LEARNED),
    "select_features": (select_features, LABELLED),
    "drop_incomplete": (
        drop_incomplete,
        """SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem
            WHERE l_discount <> 0.05 AND l_tax <> 0.03""",
    ),
    "assemble": (
        assemble,
        """SELECT l_orderkey, l_quantity AS f0, l_extendedprice AS f1, l_discount AS f2,
            l_tax AS f3, CAST(l_linenumber AS DOUBLE) AS f4 FROM lineitem""",
    ),
    "prepare_flat": (
        prepare_flat,
        f"{LABELLED} WHERE l_discount <> 0.05 AND l_tax <> 0.03",
    ),
    "stable_layout": (stable_layout, "SELECT l_returnflag, l_linestatus, l_tax FROM lineitem"),
    "rf_score": (rf_score, LEARNED),
    "lr_score": (lr_score, LEARNED),
    "rf_score_stable": (rf_score_stable, LEARNED),
    "lr_score_scanned": (lr_score_scanned, LEARNED),
    "rf_importances": (
        rf_importances,
        "SELECT 'l_quantity' AS top_feature, CAST(4 AS BIGINT) AS features, 1.0::DOUBLE AS total",
    ),
    "importances_named": (
        importances_named,
        """SELECT * FROM (VALUES (0, 'l_quantity', true), (1, 'l_extendedprice', false),
            (2, 'l_discount', false), (3, 'l_tax', false)) AS t(idx, feature, decides)""",
    ),
    "sample_rows": (
        sample_rows,
        """SELECT CAST(least(count(*), 5000) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS wrong
            FROM lineitem""",
    ),
    "rf_score_sampled": (rf_score_sampled, LEARNED),
    "embeddings_rf": (
        embeddings_rf,
        f"""SELECT vec_id, {STEP_CLASS_SQL} AS label, CAST({STEP_CLASS_SQL} AS DOUBLE) AS prediction
            FROM embeddings""",
    ),
    "confusion": (
        confusion,
        f"SELECT label, prediction, count(*) AS n FROM ({RULED_PAIRS}) GROUP BY label, prediction",
    ),
    "per_class": (
        per_class,
        metrics_sql(
            RULED_PAIRS,
            """SELECT label, support, predicted, true_positives, false_positives,
                round(precision, 6) AS precision, round(recall, 6) AS recall,
                round(fpr, 6) AS fpr, round(f1, 6) AS f1 FROM class_metrics""",
        ),
    ),
    "metrics": (metrics, metrics_sql(RULED_PAIRS, TOTAL)),
    "metrics_binary": (metrics_binary, metrics_sql(BINARY_PAIRS, TOTAL)),
    "metric_report": (
        metric_report,
        metrics_sql(
            RULED_PAIRS,
            """SELECT 'accuracy' AS metric, accuracy AS value FROM total
                UNION ALL SELECT 'f1', f1 FROM total
                UNION ALL SELECT 'weighted_precision', weighted_precision FROM total
                UNION ALL SELECT 'weighted_recall', weighted_recall FROM total
                UNION ALL SELECT 'weighted_fpr', weighted_fpr FROM total""",
        ),
    ),
    "preview": (
        preview,
        f"""SELECT l_orderkey, l_linenumber, {", ".join(FEATURES)}, {RULE_LABEL} AS label,
            {RULE_PREDICTION} AS prediction FROM lineitem
            ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
                l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate LIMIT 5""",
    ),
    "lr_summary": (lr_summary, metrics_sql(learned_pairs(TRAIN_LABEL), SUMMARY)),
    "train_job_rf": (train_job_rf, metrics_sql(learned_pairs(VALID_LABEL), TOTAL)),
    "train_job_rf_features": (
        train_job_rf_features,
        metrics_sql(learned_pairs(VALID_LABEL), TOTAL),
    ),
    "train_job_lr": (train_job_lr, metrics_sql(learned_pairs(VALID_LABEL), TOTAL)),
    "train_job_lr_report": (
        train_job_lr_report,
        metrics_sql(learned_pairs(TRAIN_LABEL), SUMMARY),
    ),
    "train_release": (train_release, metrics_sql(learned_pairs(VALID_LABEL), TOTAL)),
    "predict_release": (
        predict_release,
        """SELECT count(*) AS scanned, CAST(0 AS BIGINT) AS bad,
            count(*) FILTER (WHERE l_discount = 0.05 OR l_tax = 0.03) AS dropped,
            count(*) FILTER (WHERE l_discount <> 0.05 AND l_tax <> 0.03) AS written FROM lineitem""",
    ),
    "predict_job": (predict_job, metrics_sql(learned_pairs(VALID_LABEL), TOTAL)),
    "predict_job_unlabelled": (
        predict_job_unlabelled,
        "SELECT "
        + ", ".join(f"CAST({e} AS DOUBLE) AS {name}" for name, e in CELLS.items())
        + f", CAST({BUCKET} AS DOUBLE) AS prediction FROM lineitem",
    ),
}


# The operators for training data are one subpackage with a pipeline, which may both be absent, or lack
# a package they need.
try:
    import corpus_pipeline
    from scorekit.llm.queries import QUERIES as _LLM_QUERIES
except ImportError as _error:
    warnings.warn(f"no queries for training data: {_error}", stacklevel=2)
else:
    _QUERIES.update(_LLM_QUERIES)
    _QUERIES["pipeline"] = (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL)


def entry(spark: SparkSession) -> DataFrame:
    """Fit a forest on sf0.001 `lineitem`, score the table, and measure the predictions."""
    return sk.classification_metrics(rf_score(spark, "/root/testdata/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
