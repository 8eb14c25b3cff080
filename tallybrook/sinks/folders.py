"""What a folder of numbered batches holds, and taking away what nobody reads any more."""

import re

from pyspark.sql import SparkSession

_NUMBERED = re.compile(r"batch_id=(\d+)")


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def complete_batches(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the batches below ``path`` that are written to the end."""
    where, files = _file_system(spark, f"{path}/batch_id=*/_SUCCESS")
    found = files.globStatus(where) or []
    return sorted(int(_NUMBERED.search(f.getPath().toString())[1]) for f in found)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders below ``path``, finished or not."""
    where, files = _file_system(spark, f"{path}/*")
    return sorted(f.getPath().getName() for f in files.globStatus(where) or [] if f.isDirectory())


def data_files(spark: SparkSession, path: str) -> int:
    """How many files of rows lie right below ``path``."""
    where, files = _file_system(spark, f"{path}/part-*")
    return len(files.globStatus(where) or [])


def mark_complete(spark: SparkSession, folder: str) -> None:
    where, files = _file_system(spark, f"{folder}/_SUCCESS")
    files.create(where, True).close()


def delete(spark: SparkSession, path: str) -> None:
    where, files = _file_system(spark, path)
    files.delete(where, True)
