from collections import Counter

import pytest
from pyspark.errors import AnalysisException, IllegalArgumentException
from pyspark.sql import functions as F

import scorekit as sk
from tests.test_evaluation import physical_plan

NAN = float("nan")


def test_select_renames_orders_and_drops(spark):
    df = spark.createDataFrame([(1, 2.0, 3, "x")], "a int, b double, quality int, c string")
    assert sk.select_features(df, features=["b", "a"]).columns == ["label", "b", "a"]


def test_select_keeps_a_table_that_has_label(spark):
    df = spark.createDataFrame([(7, 2.0)], "label int, a double")
    assert sk.select_features(df, features=["a"]).first() == (7, 2.0)


def test_select_without_any_label_fails(spark):
    with pytest.raises(AnalysisException):
        sk.select_features(spark.createDataFrame([(2.0,)], "a double"), features=["a"])


def test_default_features_in_vector_order(spark):
    flat = spark.createDataFrame([tuple(range(12))], ["quality", *reversed(sk.FEATURES)])
    row = sk.prepare(flat).first()
    assert row.label == 0
    assert row.features.toArray().tolist() == [float(i) for i in range(11, 0, -1)]


ROWS = [
    (1, 1.0, 1.0, "a"),
    (None, 1.0, 1.0, "b"),
    (2, None, 1.0, "c"),
    (3, NAN, 1.0, "d"),
    (4, 1.0, NAN, "e"),
    (5, 1.0, None, "f"),
    (6, 1.0, 1.0, None),
    (7, 0.0, -1.0, "g"),
]


@pytest.mark.parametrize("cols", [None, ["d"], ["f", "i"]])
def test_drop_incomplete_keeps_what_na_drop_keeps(spark, cols):
    df = spark.createDataFrame(ROWS, "i int, d double, f float, s string")
    kept = sk.drop_incomplete(df, cols).select("i", "s").collect()
    assert Counter(kept) == Counter(df.na.drop("any", subset=cols).select("i", "s").collect())


def test_null_tests_reach_the_parquet_reader(spark, tmp_path):
    spark.createDataFrame(ROWS, "quality int, d double, f float, s string").write.parquet(
        str(tmp_path / "t")
    )
    plan = physical_plan(sk.prepare(spark.read.parquet(str(tmp_path / "t")), features=["d", "f"]))
    assert "IsNotNull(quality), IsNotNull(d), IsNotNull(f)" in plan
    assert "ReadSchema: struct<quality:int,d:double,f:float>" in plan
    assert "Exchange" not in plan


def test_assemble_widens_integers_and_keeps_other_columns(spark):
    df = spark.createDataFrame([("k", 3, 2, 0.5)], "key string, label int, a int, b double")
    out = sk.assemble(df, ["b", "a"])
    assert out.columns == ["key", "label", "features"]
    assert out.first().features.toArray().tolist() == [0.5, 2.0]


def test_assemble_rejects_text(spark):
    df = spark.createDataFrame([(3, "x")], "label int, a string")
    with pytest.raises(IllegalArgumentException):
        sk.assemble(df, ["a"])


def test_assemble_fails_on_null(spark):
    df = spark.createDataFrame([(3, None)], "label int, a double")
    with pytest.raises(Exception, match="null"):
        sk.assemble(df, ["a"]).collect()


def test_prepare_drops_before_it_assembles(spark):
    df = spark.createDataFrame([(1, NAN), (2, 3.0), (None, 1.0)], "quality int, a double")
    assert [r.label for r in sk.prepare(df, features=["a"]).collect()] == [2]
    assert sk.prepare(df, features=["a"], vector=False).collect() == [(2, 3.0)]


def partitions(df):
    return df.select(F.spark_partition_id().alias("p"), "*").collect()


@pytest.fixture
def skewed(spark):
    """A third of the rows are one and the same row."""
    return spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS a", "id % 3 = 0 AS b")


def test_stable_layout_keeps_every_copy(skewed):
    laid_out = sk.stable_layout(skewed, 5)
    assert Counter(laid_out.collect()) == Counter(skewed.collect())
    assert laid_out.rdd.getNumPartitions() == 5


def test_stable_layout_splits_a_hot_row(skewed):
    hot = sk.stable_layout(skewed, 5).where("b").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) > 1
    assert max(r["count"] for r in hot) < 1000


@pytest.mark.parametrize("row_blocks", [1, 1000])
def test_stable_layout_bounds_the_blocks_of_a_row(skewed, row_blocks):
    laid_out = sk.stable_layout(skewed, 5, block_rows=7, row_blocks=row_blocks)
    assert Counter(laid_out.collect()) == Counter(skewed.collect())


def test_stable_layout_forgets_the_files(spark, skewed, tmp_path):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    skewed.orderBy(F.desc("a")).coalesce(1).write.parquet(one)
    skewed.repartition(7, "a").write.parquet(many)
    first, second = (sk.stable_layout(spark.read.parquet(p), 4) for p in (one, many))
    assert partitions(first) == partitions(second)


def test_rows_are_read_as_scanned_unless_asked(noisy):
    with sk.fit_input(noisy, ["l_quantity", "l_tax"]) as table:
        assert table.columns == ["label", "features"]
        plan = physical_plan(table)
    assert "Exchange" not in plan and "InMemoryTableScan" not in plan and "Coalesce" not in plan


def test_partitions_merge_splits_without_a_shuffle(noisy, tmp_path):
    noisy.repartition(12).write.parquet(str(tmp_path / "t"))
    rows = noisy.sparkSession.read.parquet(str(tmp_path / "t"))
    with sk.fit_input(rows, ["l_quantity"], partitions=3) as table:
        assert table.rdd.getNumPartitions() == 3
        assert "Exchange" not in physical_plan(table)
        assert table.count() == noisy.count()


@pytest.mark.parametrize("stable", [True, False])
@pytest.mark.parametrize("copies", [1, 4])
def test_partitions_grow_with_the_rows(skewed, stable, copies):
    """Were the number fixed, what a task of a fit reads would grow with the table."""
    rows = skewed.selectExpr("CAST(b AS INT) AS label", "a", f"explode(sequence(1, {copies})) AS c")
    layout = {"partitions": 2, "partition_rows": 500, "stable": stable}
    with sk.fit_input(rows, ["a", "c"], **layout) as table:
        held = table.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert table.rdd.getNumPartitions() == 6 * copies
    assert sum(r["count"] for r in held) == 3000 * copies
    assert max(r["count"] for r in held) < 1000


def test_partitions_are_no_fewer_than_asked_for(skewed):
    assert sk.partitions_for(skewed, 7, 1000) == 7
    assert sk.partitions_for(skewed, 7, None) == 7
    assert sk.partitions_for(skewed.where("a < 0"), None, 1000) == 1
    assert sk.deal_out(skewed, 2, 1000).rdd.getNumPartitions() == 3
    with pytest.raises(ValueError, match="one row"):
        sk.partitions_for(skewed, 7, 0)


def test_a_stable_layout_needs_partitions(noisy):
    with pytest.raises(ValueError, match="partitions"):
        with sk.fit_input(noisy, ["l_quantity"], stable=True):
            pass


def test_cache_is_released_even_on_failure(spark, noisy):
    before = cached_tables(spark)
    with pytest.raises(RuntimeError):
        with sk.fit_input(noisy, ["l_quantity"], cache=True) as table:
            table.count()
            assert cached_tables(spark) == before + 1
            raise RuntimeError
    assert cached_tables(spark) == before


def test_missing_columns_are_found_as_the_session_finds_them(spark):
    df = spark.createDataFrame([(1, 2)], "Quality int, b int")
    assert sk.missing_columns(df, ["quality", "B", "c"]) == ["c"]
    spark.conf.set("spark.sql.caseSensitive", True)
    try:
        assert sk.missing_columns(df, ["quality", "b"]) == ["quality"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def cached_tables(spark) -> int:
    return spark.sparkContext._jsc.getPersistentRDDs().size()
