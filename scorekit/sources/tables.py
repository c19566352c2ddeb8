from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from scorekit.sources.files import beside, exists, location, put_in_place, remove


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    sep: str = ",",
    quote: str = '"',
    mode: str | None = None,
    corrupt: str | None = None,
) -> DataFrame:
    """Read a CSV table whose first line names the columns, from any path Hadoop can open.

    Without a `schema` the types are inferred, which reads the whole input once more, and the types
    may differ between two files of one table. With a `schema` nothing is read ahead, and the names
    in each header are checked against it, so a file with its columns in another order is refused.

    `mode` is Spark's: what becomes of a row with a cell that does not fit its type, or with too few or
    too many cells. It is FAILFAST by default if a schema is given, which fails the job, also where the
    bad cell is in a column that is not selected; PERMISSIVE makes such cells null, and a later step
    that drops incomplete rows then drops the row. Without a schema the types fit all cells, and the
    default is PERMISSIVE.

    `corrupt` names a further column that holds the whole line of a row with a bad cell among the columns
    that are read, and null for all other rows, so that bad rows can be counted or kept; it takes a
    `schema` and makes PERMISSIVE the default.
    """
    if corrupt:
        if schema is None:
            raise ValueError("without a schema no cell is bad, so there is nothing to keep")
        schema, mode = _as_schema(schema).add(corrupt, StringType()), mode or "PERMISSIVE"
    reader = spark.read.option("header", True).option("sep", sep).option("quote", quote)
    if schema is None:
        return reader.option("inferSchema", True).option("mode", mode or "PERMISSIVE").csv(path)
    mode = mode or "FAILFAST"
    if corrupt:
        reader = reader.option("columnNameOfCorruptRecord", corrupt)
    df = reader.schema(schema).option("enforceSchema", False).option("mode", mode).csv(path)
    if mode.upper() != "FAILFAST":
        return df
    # A cell that is not parsed cannot fail. This is true of every row, but takes all its cells.
    return df.where(F.hash(*[f"`{c}`" for c in df.columns]) <= 2**31 - 1)


def _as_schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else StructType(list(schema))


def write_predictions(df: DataFrame, path: str) -> None:
    """Write `df` as parquet, replacing what `path` holds.

    Overwriting deletes first, so a table that is read from `path` itself, from below it or from a
    folder around it is refused. That can be told only of plans whose leaves are all known: files that
    the plan names, and rows that come from nowhere. With any other leaf, such as an RDD, a table of
    another source or of a metastore, `df` is written to a new folder beside `path`, which takes its place
    when that has succeeded.
    """
    spark = df.sparkSession
    refuse_overlap(spark, path, sources(df))
    if not (hides_sources(df) and exists(spark, path)):
        df.write.mode("overwrite").parquet(path)
        return
    aside = beside(path)
    try:
        df.write.parquet(aside)
    except Exception:
        remove(spark, aside)
        raise
    put_in_place(spark, aside, path)


def read_predictions(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read a table written by `write_predictions`; a known `schema` saves opening file footers."""
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def refuse_overlap(spark: SparkSession, path: str, others: Sequence[str]) -> None:
    """Raise if `path` is one of `others`, lies in one or contains one."""
    own = location(spark, path)
    for other in others:
        place = location(spark, other)
        if own == place or own.startswith(place + "/") or place.startswith(own + "/"):
            raise ValueError(f"cannot overwrite {path}: {other} is still needed")


def sources(df: DataFrame) -> list[str]:
    """The folders and files that the plan of `df` names, cached or not."""
    return [root for leaf in _leaves(df) for root in _roots(leaf) or ()]


def hides_sources(df: DataFrame) -> bool:
    """Whether a leaf of the plan may read what the plan does not name."""
    return any(_roots(leaf) is None for leaf in _leaves(df))


# Leaves that read nothing: rows in the plan itself, ranges, and what a command has answered.
_READS_NOTHING = ("LocalRelation", "OneRowRelation", "Range", "CommandResult")


def _roots(leaf) -> list[str] | None:
    """The folders and files a leaf of a plan reads, None if it does not tell."""
    kind = leaf.getClass().getSimpleName()
    if kind in _READS_NOTHING:
        return []
    if kind == "LogicalRelation" and _is(leaf.relation(), "HadoopFsRelation"):
        return [str(r) for r in _each(leaf.relation().location().rootPaths())]
    if kind == "DataSourceV2Relation" and _is(leaf.table(), "FileTable"):
        return [str(r) for r in _each(leaf.table().fileIndex().rootPaths())]
    return None


def _is(thing, name: str) -> bool:
    """Whether a Java object is of a class of that name, or of one made from it."""
    kind = thing.getClass()
    while kind is not None:
        if kind.getSimpleName() == name:
            return True
        kind = kind.getSuperclass()
    return False


def _leaves(df: DataFrame) -> Iterator:
    """The leaves of the analysed plan and of its subqueries. Cached tables are put in later, so that
    what they were made of still shows."""
    plan = df._jdf.queryExecution().analyzed()
    for part in (plan, *_each(plan.subqueriesAll())):
        yield from _each(part.collectLeaves())


def _each(seq) -> Iterator:
    return (seq.apply(i) for i in range(seq.size()))
