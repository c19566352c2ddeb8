"""What is done to files and folders through Hadoop, wherever they are stored."""

import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str):
    """The file system of `path`, and the path as that takes it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def location(spark: SparkSession, path: str) -> str:
    """`path` in full, so that two spellings of one place are equal."""
    fs, target = file_system(spark, path)
    parts = urlparse(fs.makeQualified(target).toString())
    return f"{parts.scheme}://{parts.netloc}{unquote(parts.path).rstrip('/')}"


def beside(path: str) -> str:
    """A path nobody has used, next to `path`."""
    return f"{path.rstrip('/')}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = file_system(spark, path)
    return fs.exists(target)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = file_system(spark, path)
    fs.delete(target, True)


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Move what was written at `staged` to `path`. What `path` holds is moved aside and deleted last;
    if the new one cannot be moved in, it is put back."""
    fs, target = file_system(spark, path)
    new, old = file_system(spark, staged)[1], file_system(spark, beside(path))[1]
    replaced = fs.exists(target)
    if replaced and not fs.rename(target, old):
        raise OSError(f"could not move {path} aside")
    try:
        moved = fs.rename(new, target)
    except Exception:
        if replaced:
            fs.rename(old, target)
        raise
    if not moved:
        if replaced:
            fs.rename(old, target)
        raise OSError(f"could not move {staged} to {path}")
    if replaced:
        fs.delete(old, True)


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A new file with a short text. A path that exists is an error, so that nothing is replaced."""
    fs, target = file_system(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    fs, target = file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    fs, target = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []
