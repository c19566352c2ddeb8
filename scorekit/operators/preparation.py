from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from scorekit.functions.expressions import complete_case
from scorekit.functions.names import FEATURES, LABEL, TARGET, VECTOR
from scorekit.operators.contract import note_features


def select_features(
    df: DataFrame, target: str = TARGET, features: Sequence[str] = FEATURES
) -> DataFrame:
    """Label first, then the features in the given order; a table that has `label` keeps it."""
    return df.withColumnRenamed(target, LABEL).select(LABEL, *features)


def drop_incomplete(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop the rows that hold a null or a NaN in any of `cols` (default: in any column)."""
    return df.where(complete_case(df.select(*(cols or df.columns)).schema))


def missing_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """Those of `names` that `df` has no column for, compared as the session compares names."""
    same = str if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true" else str.lower
    present = {same(c) for c in df.columns}
    return [n for n in names if same(n) not in present]


def assemble(df: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Pack the features into one vector column and drop the flat ones; other columns stay.

    The vector column notes the names and types of what it was made from, for models fitted on it."""
    vector = VectorAssembler(inputCols=list(features), outputCol=VECTOR).transform(df)
    packed = vector.select(*[f"`{c}`" for c in df.columns if c not in features], VECTOR)
    return note_features(packed, df, features)


def prepare(
    df: DataFrame,
    target: str = TARGET,
    features: Sequence[str] = FEATURES,
    vector: bool = True,
) -> DataFrame:
    """Complete rows as `(label, features)`, or as label and flat features when not `vector`."""
    flat = drop_incomplete(select_features(df, target, features))
    return assemble(flat, features) if vector else flat


@dataclass(frozen=True)
class RowCounts:
    """What became of the rows of a table that was read for a job."""

    scanned: int
    bad: int
    """Rows with a cell that could not be read; 0 if the table has no column that tells."""
    dropped: int
    """Rows left out as incomplete, bad ones included if that made them so."""


def count_rows(
    df: DataFrame, cols: Sequence[str], corrupt: str | None = None
) -> tuple[DataFrame, Callable[[], RowCounts]]:
    """`df`, reduced to `cols`, and a function that says what was counted while it was read.

    The rows are counted by the first query that reads the returned table, without a pass of their own;
    the function waits for it. A row is dropped if one of `cols` is null or NaN. `corrupt` names the
    column that tells bad rows, see `read_csv`. Incomplete rows have to be seen to be counted, so null
    tests are not handed to the reader here.
    """
    seen = Observation()
    complete = complete_case(df.select(*[f"`{c}`" for c in cols]).schema)
    bad = F.col(f"`{corrupt}`").isNotNull() if corrupt else F.lit(False)
    needed = [*cols, corrupt] if corrupt and corrupt not in cols else list(cols)
    observed = df.select(*[f"`{c}`" for c in needed]).observe(
        seen,
        F.count(F.lit(1)).alias("scanned"),
        F.count(F.when(bad, 1)).alias("bad"),
        F.count(F.when(~complete, 1)).alias("dropped"),
    )

    def counted() -> RowCounts:
        found = seen.get
        return RowCounts(*[int(found.get(name) or 0) for name in ("scanned", "bad", "dropped")])

    return observed.select(*[f"`{c}`" for c in cols]), counted


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """`n` rows of `df` that follow from the rows alone, whatever files and partitions they lie in.

    They are those whose hashes over all columns are smallest, of equal hashes the first in the order of
    the columns; of equal rows as many are taken as there is room for. A table of fewer rows is returned
    whole. The table is counted twice by 65,536 stretches of hashes, which finds the one in four
    billion that holds the n-th row; rows before it are only filtered, and only its own, of which equal
    ones are counted first, are put in order. So nothing grows with the table or with copies of a row
    but the two counts, which each task makes for itself.
    """
    if n < 0:
        raise ValueError("a number of rows is not negative")
    cols = [F.col(f"`{c}`") for c in df.columns]
    place = F.xxhash64(*cols)
    room, stretch = n, None
    for level in (0, 1):
        within = df if stretch is None else df.where(F.shiftrightunsigned(place, 48) == stretch)
        bits = F.pmod(F.shiftrightunsigned(place, 48 - 16 * level), F.lit(1 << 16))
        counts = {r["bits"]: r["count"] for r in within.groupBy(bits.alias("bits")).count().collect()}
        for bits_, count in sorted(counts.items()):
            if count > room:
                break
            room -= count
        else:
            return df
        stretch = bits_ if stretch is None else stretch << 16 | bits_
    prefix = F.shiftrightunsigned(place, 32)
    edge = df.where(prefix == stretch).groupBy(*cols).agg(F.count("*").alias("_copies"))
    before = Window.orderBy(place, *cols).rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(room) - F.coalesce(F.sum("_copies").over(before), F.lit(0))
    taken = edge.withColumn("_taken", F.least("_copies", left)).where("_taken > 0")
    copies = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_taken")))
    return df.where(prefix < stretch).unionByName(copies.select(*cols))


def declare_classes(df: DataFrame, num_classes: int) -> DataFrame:
    """Note on the label column that labels are below `num_classes`.

    Without the note an estimator scans the table for the highest label before it fits.
    """
    note = {"ml_attr": {"type": "nominal", "num_vals": num_classes}}
    return df.withMetadata(LABEL, note)


def partitions_for(df: DataFrame, partitions: int | None, partition_rows: int | None) -> int | None:
    """How many partitions the rows of `df` are to lie in: `partitions`, or as many more as it takes that
    they hold `partition_rows` rows each at most, on average.

    The rows are counted for that, so the number follows from them and not from files, sizes or cores.
    Without `partition_rows` nothing is counted, and `partitions` is the number whatever the table.
    """
    if partition_rows is None:
        return partitions
    if partition_rows < 1:
        raise ValueError("a partition holds one row at least")
    return max(partitions or 1, -(-df.count() // partition_rows))


def deal_out(df: DataFrame, partitions: int | None, partition_rows: int | None = None) -> DataFrame:
    """`df` dealt out evenly, with a shuffle, to the partitions that `partitions_for` says."""
    return df.repartition(partitions_for(df, partitions, partition_rows))


@contextmanager
def fit_input(
    rows: DataFrame,
    features: Sequence[str] = FEATURES,
    num_classes: int | None = None,
    partitions: int | None = None,
    stable: bool = False,
    cache: bool = False,
    partition_rows: int | None = None,
) -> Iterator[DataFrame]:
    """Prepared flat rows as `(label, features)`, laid out for a fit inside the `with` block.

    What is done follows from the arguments alone. Without any, the rows are read as they are scanned.

    * `partitions` merges the splits of the scan, without a shuffle, down to that number. A forest sends
      the statistics of its open tree nodes from every partition, to `spark.default.parallelism` ones.
    * `stable=True` lays the rows out anew in `partitions`, so that trees follow from rows, seed and
      that number (see `stable_layout`). A logistic regression has no use for it.
    * `cache=True` keeps the rows for the length of the block. A forest reads its input four times, a
      logistic regression twice; then both iterate over a compact copy they keep themselves.
    * `num_classes`, if known, saves a forest one of the reads.
    * `partition_rows` is how many rows a partition may hold: there are as many more than `partitions` as
      that takes, see `partitions_for`, which counts the rows once. A forest keeps about
      `100 + 4 x (features + trees)` bytes of each row, and a task reads all of its partition's at once.
      Without `stable`, rows are then dealt out with a shuffle.
    """
    if stable and not (partitions or partition_rows):
        raise ValueError("a stable layout needs a number of partitions")
    rows = rows.select(LABEL, *features)
    if stable:
        rows = stable_layout(rows, partitions_for(rows, partitions, partition_rows))
    elif partition_rows:
        rows = deal_out(rows, partitions, partition_rows)
    elif partitions:
        rows = rows.coalesce(partitions)
    if num_classes:
        rows = declare_classes(rows, num_classes)
    if cache:
        rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield assemble(rows, features)
    finally:
        if cache:
            rows.unpersist()


def stable_layout(
    df: DataFrame, partitions: int, block_rows: int = 100, row_blocks: int = 1000
) -> DataFrame:
    """The same rows in an order and partitioning that depend on nothing but the rows.

    A forest draws its bootstrap by partition and position, so this makes a fit repeatable whatever
    files the rows came from. It takes flat columns: apply it before `assemble`. It costs two
    shuffles; without a need for repeatable trees leave a table as it is scanned.

    Rows are spread by all their columns. Equal rows would all meet in one partition that way, so
    they are counted first and then spread in blocks of `block_rows`, or in larger ones if they would
    make more than `row_blocks` blocks for each partition.
    """
    cols = df.columns
    copies, size, start = F.col("_copies"), F.col("_size"), F.col("_start")
    counted = df.groupBy(*cols).agg(F.count("*").alias("_copies"))
    largest = F.ceil(copies / (row_blocks * partitions))
    sized = counted.withColumn("_size", F.greatest(F.lit(block_rows), largest))
    blocks = sized.withColumn("_start", F.explode(F.sequence(F.lit(1).cast("long"), copies, size)))
    return (
        blocks.withColumn("_end", F.least(copies, start + size - 1))
        .select(*cols, "_start", "_end")
        .repartition(partitions, *cols, "_start")
        .sortWithinPartitions(*cols)
        .withColumn("_copy", F.explode(F.sequence("_start", "_end")))
        .select(*cols)
    )
