"""Files below a folder of any store that Spark can reach: listing, records, removal."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
#: Removals that run at the same time.
THREADS = 16


class DataFile(NamedTuple):
    path: str
    size: int

    def part(self, name: str) -> str | None:
        """Value of a partition folder in the path; None for the null partition."""
        for folder in self.path.split("/"):
            if folder.startswith(f"{name}="):
                value = unquote(folder.partition("=")[2])
                return None if value == NO_VALUE else value
        raise KeyError(name)


def list_files(spark: SparkSession, path: str) -> list[DataFile]:
    """Parquet files below a folder with their sizes; no file is opened.

    Spark lists a large folder in parallel. A missing folder is an error.
    """
    rows = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(path).select("path", "length").collect())
    return sorted(DataFile(*row) for row in rows)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path):
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path is on a disk of the machine, by its scheme or the default one."""
    return _system(spark, _path(spark, path)).getUri().getScheme() == "file"


def exists(spark: SparkSession, path: str) -> bool:
    path = _path(spark, path)
    return _system(spark, path).exists(path)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if it does not exist."""
    path = _path(spark, folder)
    system = _system(spark, path)
    return sorted(x.getPath().getName() for x in system.listStatus(path)) if system.exists(
        path) else []


def read_text(spark: SparkSession, path: str) -> str:
    path = _path(spark, path)
    stream = _system(spark, path).open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must not exist yet, whole or not at all; False if it does."""
    target, hidden = _path(spark, path), _path(spark, f"{path}.{id(text):x}.tmp")
    system = _system(spark, target)
    stream = system.create(hidden, True)
    stream.write(text.encode())
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(
        spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(hidden, target, plain)
    except Py4JJavaError as taken:
        if "FileAlreadyExists" not in taken.java_exception.getClass().getName():
            raise
        system.delete(hidden, False)
        return False
    return True


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove files or folders, and the folders above them that became empty."""
    def one(path: str):
        path = _path(spark, path)
        system = _system(spark, path)
        system.delete(path, True)
        return path.getParent()

    with ThreadPoolExecutor(THREADS) as pool:
        parents = {parent.toString(): parent for parent in pool.map(one, paths)}
    while parents:
        above = {}
        for parent in parents.values():
            system = _system(spark, parent)
            if "=" in parent.getName() and system.exists(parent) and not system.listStatus(parent):
                system.delete(parent, False)
                above[parent.getParent().toString()] = parent.getParent()
        parents = above
