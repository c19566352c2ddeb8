"""What several operators of this subpackage share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekit.sources.scratch import scratch_path

# Fixed value: the white space between words, as a regular expression class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """`df` computed once and written to the shared checkpoint folder, so that its lineage ends there.

    The folder is the one the cluster names in `spark.checkpoint.dir`; a folder of this machine is
    used only where that is unset and Spark runs on this machine alone.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_path(df.sparkSession, "checkpoint"))
    return df.checkpoint(eager=True)


def whole_text(column: str = "text") -> Column:
    """A text column in which null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def whole_row(df: DataFrame) -> Column:
    """All columns as one, so that columns an operator adds cannot clash with them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def store(df: DataFrame, folder: str, name: str) -> DataFrame:
    """`df` written as Parquet in a scratch folder and read again: for loops, in which what a plan
    knows of a checkpoint's rows would add up until planning takes longer than the work."""
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder, wherever it is stored."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
