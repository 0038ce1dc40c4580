"""Small helpers on the session's own Hadoop file system (any scheme Spark can read)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in store.listStatus(target)] if store.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def tree(spark: SparkSession, path: str) -> list[str]:
    """Paths of all data files below a folder, with their scheme; none if it is not there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    files = store.listFiles(target, True) if store.exists(target) else None
    while files is not None and files.hasNext():
        one = files.next().getPath()
        if not one.getName().startswith(("_", ".")):
            found.append(one.toString())
    return found


def is_empty(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).getLen() == 0


def file_path(spark: SparkSession, path: str) -> str:
    """A path without its scheme and host."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()


def address(spark: SparkSession, path: str) -> str:
    """A path as Spark's readers report it, with escapes, but for the slashes of an empty host."""
    return spark._jvm.org.apache.hadoop.fs.Path(path).toUri().toString()


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move one file, making the folder it goes to."""
    source, target = spark._jvm.org.apache.hadoop.fs.Path(path), spark._jvm.org.apache.hadoop.fs.Path(to)
    store = target.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(target.getParent())
    if not store.rename(source, target):
        raise OSError(f"{path} cannot be moved to {to}")


def move(spark: SparkSession, folder: str, to: str) -> int:
    """Move the data files of a folder into another one, one by one; returns how many went."""
    gone = [n for n in names(spark, folder) if not n.startswith(("_", "."))]
    for name in gone:
        rename(spark, f"{folder}/{name}", f"{to}/{name}")
    return len(gone)
