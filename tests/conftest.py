import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

LINEITEM = "/root/testdata/sf0.01/lineitem.parquet"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def noisy(spark):
    """Three classes that follow from `l_quantity`, one row in five relabelled as the middle one."""
    bucket = "CASE WHEN l_quantity <= 17 THEN 3 WHEN l_quantity <= 34 THEN 5 ELSE 8 END"
    return spark.read.parquet(LINEITEM).selectExpr(
        f"CASE WHEN l_orderkey % 5 = 0 THEN 5 ELSE {bucket} END AS label",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
    )


@pytest.fixture(scope="session")
def measurements(tmp_path_factory):
    """Two CSV files in the shape of the default columns, grades 3 to 8, a few cells left empty."""
    folder = tmp_path_factory.mktemp("measurements")
    rng = random.Random(7)
    paths = []
    for name, rows in (("train", 900), ("valid", 300)):
        path = folder / f"{name}.csv"
        path.write_text("\n".join([CSV_HEADER, *(_measurement(rng) for _ in range(rows))]) + "\n")
        paths.append(str(path))
    return paths


# The header of an input file. Its order is not the order of the feature vector.
CSV_HEADER = (
    "fixed acidity,volatile acidity,citric acid,residual sugar,chlorides,free sulfur dioxide,"
    "total sulfur dioxide,density,pH,sulphates,alcohol,quality"
)
CSV_SCHEMA = ", ".join(
    f"`{name}` {'int' if name in ('free sulfur dioxide', 'quality') else 'double'}"
    for name in CSV_HEADER.split(",")
)


def _measurement(rng: random.Random) -> str:
    alcohol = round(rng.uniform(8.4, 13.4), 1)
    grade = min(8, max(3, int(3 + (alcohol - 8.4) + rng.gauss(0, 0.4))))
    cells = [
        round(rng.uniform(4.7, 15.6), 1),
        round(rng.uniform(0.2, 1.0), 2),
        round(rng.uniform(0.0, 0.7), 2),
        round(rng.uniform(1.2, 15.5), 1),
        round(rng.uniform(0.05, 0.4), 3),
        rng.randint(1, 52),
        round(rng.uniform(10, 150), 1),
        round(rng.uniform(0.99, 1.0), 4),
        round(rng.uniform(2.9, 3.8), 2),
        round(rng.uniform(0.4, 1.9), 2),
        alcohol,
        grade,
    ]
    if rng.random() < 0.02:
        cells[rng.randrange(11)] = ""
    return ",".join(map(str, cells))
