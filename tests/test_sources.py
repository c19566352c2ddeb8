from types import SimpleNamespace

import pytest

import scorekit as sk
from scorekit.sources.tables import hides_sources, sources
from tests.conftest import CSV_HEADER, CSV_SCHEMA


@pytest.fixture
def csv_file(tmp_path):
    def write(text: str) -> str:
        path = tmp_path / "table.csv"
        path.write_text(text)
        return str(path)

    return write


def test_types_are_inferred(spark, measurements):
    df = sk.read_csv(spark, measurements[0])
    assert df.columns == CSV_HEADER.split(",")
    types = dict(df.dtypes)
    assert types.pop("quality") == types.pop("free sulfur dioxide") == "int"
    assert set(types.values()) == {"double"}
    assert df.count() == 900


def test_empty_cells_are_dropped_as_incomplete(spark, measurements):
    df = sk.read_csv(spark, measurements[0])
    complete = [
        line
        for line in open(measurements[0]).read().splitlines()[1:]
        if "" not in line.split(",")
    ]
    assert 0 < len(complete) < 900
    assert sk.prepare(df).count() == len(complete)


def test_schema_gives_the_same_rows_without_inference(spark, measurements):
    given = sk.read_csv(spark, measurements[0], CSV_SCHEMA)
    assert given.dtypes == sk.read_csv(spark, measurements[0]).dtypes
    assert given.collect() == sk.read_csv(spark, measurements[0]).collect()


def test_schema_reads_only_the_columns_asked_for(spark, measurements):
    pruned = sk.read_csv(spark, measurements[0], CSV_SCHEMA).select("alcohol", "quality")
    inferred = sk.read_csv(spark, measurements[0]).select("alcohol", "quality")
    assert pruned.collect() == inferred.collect()


def test_schema_in_another_order_than_the_file_is_refused(spark, csv_file):
    path = csv_file("b,a\n1,2\n")
    with pytest.raises(Exception, match="header does not conform"):
        sk.read_csv(spark, path, "a int, b int").collect()


def test_separator_and_quote(spark, csv_file):
    path = csv_file("'a';'b;c'\n1;'2.5'\n")
    df = sk.read_csv(spark, path, sep=";", quote="'")
    assert df.dtypes == [("a", "int"), ("b;c", "double")]
    assert df.collect() == [(1, 2.5)]
    assert len(sk.read_csv(spark, path).columns) == 1


def test_ragged_rows_are_padded_or_cut(spark, csv_file):
    df = sk.read_csv(spark, csv_file("a,b\n1,2\nx\n3,4,5\n"))
    assert df.collect() == [("1", 2), ("x", None), ("3", 4)]


BAD_ROWS = ["x,1,2\n1,oops,3\n", "x,1,2\n1,2.5,5.0\n", "x,1,2\n1,2.5\n", "x,1,2\n1,2.5,3,4\n"]
SCHEMA = "k string, d double, i int"


@pytest.mark.parametrize("rows", BAD_ROWS)
@pytest.mark.parametrize("cols", [["k", "d", "i"], ["k"]])
def test_bad_rows_fail_under_a_schema(spark, csv_file, rows, cols):
    df = sk.read_csv(spark, csv_file("k,d,i\n" + rows), SCHEMA)
    with pytest.raises(Exception, match="(?i)malformed"):
        df.select(*cols).collect()


def test_bad_cells_become_null_on_request(spark, csv_file):
    df = sk.read_csv(spark, csv_file("k,d,i\n" + BAD_ROWS[0]), SCHEMA, mode="PERMISSIVE")
    assert df.collect() == [("x", 1.0, 2), ("1", None, 3)]


def test_good_rows_pass_under_a_schema(spark, csv_file):
    df = sk.read_csv(spark, csv_file("k,d,i\nx,1,2\n,,\n"), SCHEMA)
    assert df.collect() == [("x", 1.0, 2), (None, None, None)]


def test_nan_is_read_as_a_number(spark, csv_file):
    df = sk.read_csv(spark, csv_file("quality,a\n1,NaN\n2,0.5\n"))
    assert df.dtypes == [("quality", "int"), ("a", "double")]
    assert sk.prepare(df, features=["a"], vector=False).collect() == [(2, 0.5)]


def test_predictions_replace_older_ones(spark, tmp_path):
    path = str(tmp_path / "p")
    sk.write_predictions(spark.range(10), path)
    sk.write_predictions(spark.range(3), path)
    assert sk.read_predictions(spark, path).count() == 3
    assert sk.read_predictions(spark, path, spark.range(1).schema).count() == 3


@pytest.mark.parametrize("form", ["{}/a b", "file:{}/a b", "{}/a b/", "{}"])
def test_a_table_is_not_written_over_itself(spark, tmp_path, form):
    spark.range(10).write.parquet(str(tmp_path / "a b"))
    df = spark.read.parquet(str(tmp_path / "a b"))
    with pytest.raises(ValueError, match="cannot overwrite"):
        sk.write_predictions(df.selectExpr("id + 1 AS id"), form.format(tmp_path))
    assert df.count() == 10


def _cached(df):
    return df.cache()


def _persisted_and_used(df):
    df.persist().count()
    return df


@pytest.mark.parametrize("change", [_cached, _persisted_and_used])
def test_a_cached_table_is_not_written_over_itself(spark, tmp_path, change):
    path = str(tmp_path / "a")
    spark.range(1000).write.parquet(path)
    df = change(spark.read.parquet(path))
    with pytest.raises(ValueError, match="cannot overwrite"):
        sk.write_predictions(df, path)
    df.unpersist()
    assert spark.read.parquet(path).count() == 1000


def test_a_table_read_in_a_subquery_is_not_overwritten(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(10).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("read_in_a_subquery")
    df = spark.sql("SELECT (SELECT max(id) FROM read_in_a_subquery) AS id")
    with pytest.raises(ValueError, match="cannot overwrite"):
        sk.write_predictions(df, path)
    assert spark.read.parquet(path).count() == 10


def test_rows_of_unknown_origin_are_written_aside_first(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(1000).write.parquet(path)
    df = spark.read.parquet(path).rdd.map(lambda r: (r.id + 1,)).toDF(["id"])
    sk.write_predictions(df, path)
    assert spark.read.parquet(path).agg({"id": "sum"}).first()[0] == 500500
    assert [p.name for p in tmp_path.iterdir()] == ["a"]


@pytest.fixture
def second_source(spark):
    """Parquet is read through the second source interface."""
    old = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.sources.useV1SourceList", "")
    yield
    spark.conf.set("spark.sql.sources.useV1SourceList", old)


def test_a_table_of_the_second_source_is_not_written_over_itself(spark, tmp_path, second_source):
    path = str(tmp_path / "a")
    spark.range(1000).write.parquet(path)
    df = spark.read.parquet(path)
    assert sources(df) and not hides_sources(df)
    with pytest.raises(ValueError, match="cannot overwrite"):
        sk.write_predictions(df.selectExpr("id + 1 AS id"), path)
    with pytest.raises(ValueError, match="cannot overwrite"):
        sk.write_predictions(df.union(spark.range(5)), path)
    assert spark.read.parquet(path).count() == 1000


def test_a_table_of_the_catalog_is_not_written_over_itself(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.sql("DROP TABLE IF EXISTS guarded_rows")
    spark.sql(f"CREATE TABLE guarded_rows (id BIGINT) USING parquet LOCATION '{path}'")
    spark.sql("INSERT INTO guarded_rows SELECT id FROM range(1000)")
    try:
        for df in (spark.table("guarded_rows"), spark.table("guarded_rows").union(spark.range(3))):
            with pytest.raises(ValueError, match="cannot overwrite"):
                sk.write_predictions(df, path)
        assert spark.read.parquet(path).count() == 1000
    finally:
        spark.sql("DROP TABLE guarded_rows")


def test_leaves_that_are_not_known_are_written_aside(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "a")
    spark.range(1000).write.parquet(path)
    df = spark.read.parquet(path)
    monkeypatch.setattr("scorekit.sources.tables._roots", lambda leaf: None)  # it does not tell
    assert hides_sources(df)
    sk.write_predictions(df.selectExpr("id + 1 AS id"), path)
    assert spark.read.parquet(path).agg({"id": "sum"}).first()[0] == 500500
    assert [p.name for p in tmp_path.iterdir()] == ["a"]


@pytest.mark.parametrize("rows", ["range(3)", "(VALUES (1), (2))", "(SELECT 1 AS id)"])
def test_rows_that_come_from_nowhere(spark, rows):
    df = spark.sql(f"SELECT * FROM {rows}")
    assert sources(df) == [] and not hides_sources(df)
    assert hides_sources(df.rdd.toDF())


def test_a_failed_write_keeps_what_was_there(spark, tmp_path):
    path = str(tmp_path / "a")
    spark.range(10).write.parquet(path)
    df = spark.read.parquet(path).rdd.map(lambda r: (1 // (r.id - 5),)).toDF(["id"])
    with pytest.raises(Exception, match="ZeroDivisionError"):
        sk.write_predictions(df, path)
    assert spark.read.parquet(path).count() == 10
    assert [p.name for p in tmp_path.iterdir()] == ["a"]


def test_a_table_may_be_written_next_to_itself(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "a"))
    for _ in range(2):
        sk.write_predictions(spark.read.parquet(str(tmp_path / "a")), str(tmp_path / "ab"))
    assert spark.read.parquet(str(tmp_path / "ab")).count() == 10


@pytest.mark.parametrize("fit", [sk.fit_random_forest, sk.fit_logistic_regression])
def test_saved_model_predicts_the_same(spark, noisy, tmp_path, fit):
    rows = sk.assemble(noisy, ["l_quantity", "l_extendedprice"])
    path = str(tmp_path / "model")
    small = {"numTrees": 3} if fit is sk.fit_random_forest else {"maxIter": 10}
    sk.save_model(fit(rows.limit(100), **small), path)
    model = fit(rows, **small)
    sk.save_model(model, path)
    before = sk.score(model, rows).select("probability", "prediction").collect()
    after = sk.score(sk.load_model(path), rows).select("probability", "prediction").collect()
    assert before == after


def session(master: str, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key.replace(".", "_"), default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_scratch_lies_in_the_shared_folder():
    spark = session("spark://host:7077", spark_checkpoint_dir="hdfs:///shared/")
    first, second = sk.scratch_path(spark, "x"), sk.scratch_path(spark, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_scratch_on_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sk.scratch_path(session("spark://host:7077"), "x")
    assert sk.scratch_path(session("local[2]"), "x")
