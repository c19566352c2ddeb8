import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has used, below the shared folder that `spark.checkpoint.dir` names.

    The setting belongs to the cluster and is only read. A temporary folder of this machine stands in
    for it when Spark itself runs on this machine alone.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="scorekit-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
