"""Counting and choosing rows, and what the reader finds bad."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import scorekit as sk
from tests.test_jobs import SMALL_FOREST, tables, train  # noqa: F401


def holes(spark, rows=40, parts=3):
    data = [(i % 3, float(i), None if i % 5 == 0 else float(i)) for i in range(rows)]
    return spark.createDataFrame(data, "quality int, a double, b double").repartition(parts)


def test_rows_are_counted_while_they_are_read(spark):
    df, counted = sk.count_rows(holes(spark), ["quality", "a", "b"])
    assert df.columns == ["quality", "a", "b"]
    assert sk.drop_incomplete(df).count() == 32
    assert counted() == sk.RowCounts(scanned=40, bad=0, dropped=8)
    empty, counted = sk.count_rows(holes(spark).limit(0), ["a"])
    assert empty.count() == 0 and counted() == sk.RowCounts(0, 0, 0)


def test_bad_rows_are_kept_and_counted(spark, tmp_path):
    file = tmp_path / "t.csv"
    file.write_text("quality,a,b\n1,2,3\n1,x,3\n2,4\n2,5,\n0,1,1\n")
    with pytest.raises(ValueError, match="without a schema"):
        sk.read_csv(spark, str(file), corrupt="line")
    df = sk.read_csv(spark, str(file), "quality int, a double, b double", corrupt="line")
    lines = {r.line for r in df.collect()}
    assert lines == {None, "1,x,3", "2,4"}
    read, counted = sk.count_rows(df, ["quality", "a", "b"], "line")
    assert sk.drop_incomplete(read).count() == 2
    assert counted() == sk.RowCounts(scanned=5, bad=2, dropped=3)


@pytest.mark.parametrize("algo", ["rf", "lr"])
@pytest.mark.parametrize("layout", [{}, {"cache": True}, {"partitions": 3, "stable": True}])
def test_jobs_count_their_rows(tables, tmp_path, algo, layout):  # noqa: F811
    params = SMALL_FOREST if algo == "rf" else {"maxIter": 5}
    result = train(tables, tmp_path, algo, **layout, **params)
    for table, counts in zip(tables, (result.train_counts, result.valid_counts)):
        complete = sk.prepare(table).count()
        assert counts == sk.RowCounts(table.count(), 0, table.count() - complete)


def test_a_forest_that_needs_no_pass_over_the_labels_counts_nothing(tables, tmp_path):  # noqa: F811
    result = train(tables, tmp_path, "rf", num_classes=9, **SMALL_FOREST)
    assert result.train_counts is None and result.valid_counts.scanned == 300


def test_the_bad_rows_of_a_job(spark, tmp_path):
    rng = random.Random(3)
    lines = [f"{i % 2},{(i % 2) + rng.random() / 2}" for i in range(60)] + ["1,x", "0,y", "1,"]
    for name in ("train", "valid"):
        (tmp_path / f"{name}.csv").write_text("quality,a\n" + "\n".join(lines) + "\n")
    dfs = [sk.read_csv(spark, str(tmp_path / f"{n}.csv"), "quality int, a double", corrupt="line") for n in ("train", "valid")]
    result = sk.train_job(
        *dfs, "rf", str(tmp_path / "m"), str(tmp_path / "p"), features=["a"], corrupt="line", numTrees=3
    )
    assert result.train_counts == result.valid_counts == sk.RowCounts(63, 2, 3)
    assert result.predictions.count() == 60


def unsigned(value):
    return value % (1 << 64)


@pytest.mark.parametrize("n", [0, 1, 7, 250, 399, 400, 1000])
def test_sampled_rows_are_those_of_the_smallest_hashes(spark, n):
    rng = random.Random(5)
    data = [(rng.randrange(3), rng.randrange(40), None if i % 9 == 0 else 0.5) for i in range(270)]
    data += [(7, 7, 7.0)] * 130  # one row a third of the table
    df = spark.createDataFrame(data, "a int, b long, c double")
    hashed = df.select(F.xxhash64("a", "b", "c").alias("h"), "*").collect()
    key = lambda r: (unsigned(r.h), r.a, r.b, (r.c is not None, r.c or 0))
    wanted = Counter((r.a, r.b, r.c) for r in sorted(hashed, key=key)[:n])
    for parts in (1, 5):
        found = sk.sample_rows(df.repartition(parts), n)
        assert found.dtypes == df.dtypes
        assert Counter(map(tuple, found.collect())) == wanted


def test_samples_of_odd_tables(spark):
    df = spark.createDataFrame([], "`a b` int, `c.d` string")
    assert sk.sample_rows(df, 5).collect() == []
    one = spark.createDataFrame([(1, "x")] * 9, df.schema)
    assert sk.sample_rows(one, 5).collect() == [(1, "x")] * 5
    with pytest.raises(ValueError):
        sk.sample_rows(one, -1)


def test_a_fit_on_a_sample_does_not_depend_on_the_files(spark, tables, tmp_path):  # noqa: F811
    found = []
    for i, parts in enumerate((1, 6)):
        shuffled = [tables[0].repartition(parts), tables[1]]
        paths = str(tmp_path / f"m{i}"), str(tmp_path / f"p{i}")
        layout = {"partitions": 2, "stable": True, "fit_rows": 200}
        result = sk.train_job(*shuffled, "rf", *paths, **layout, **SMALL_FOREST)
        found.append((result.metrics.first(), result.model.stages[0].toDebugString.split("\n")[1:]))
        assert result.train_counts.scanned == 900
    assert found[0] == found[1]
