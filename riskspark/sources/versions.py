"""Publication of whole versions: a reader sees all of one version or all of another, never a mixture or an empty folder.

A version's rows are written to a folder of their own under ``<root>/data``. When that has ended, an empty marker is made under
``<root>/versions`` whose name holds the version's number and folder: making it is the publication, a single step on any
file system, object stores included, as there is nothing to rename and nothing to write into it. The marker that sorts last
counts. A publication that fails or is lost before that leaves a folder that no marker names, and the version before stands.

Two publications at the same time may take one number. Both are whole; the one whose folder's name sorts last counts, for
every reader alike. Readers keep the files they resolved: ``drop_versions`` leaves the newest ``keep`` versions, so choose as
many as there are publications while the longest reader runs.
"""

from __future__ import annotations

import time
import uuid
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, types as T


class Version(NamedTuple):
    number: int
    folder: str


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    system = _system(spark, path)
    if not system.exists(_path(spark, path)):
        return []
    return sorted(s.getPath().getName() for s in system.listStatus(_path(spark, path)))


def versions(spark: SparkSession, root: str) -> list[Version]:
    """The published versions, oldest first."""
    marked = (name.partition("-") for name in _names(spark, f"{root.rstrip('/')}/versions") if not name.startswith((".", "_")))
    return [Version(int(number), folder) for number, _, folder in marked]


def publish_version(df: DataFrame, root: str, partition_by: str | None = None) -> Version:
    """Write ``df`` as the next version and make it the one that counts."""
    spark, root = df.sparkSession, root.rstrip("/")
    folder = f"{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:12]}"
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(f"{root}/data/{folder}")
    # Numbered when the rows are there, so that a long publication does not take the number of a shorter one before it.
    before = versions(spark, root)
    made = Version(before[-1].number + 1 if before else 1, folder)
    marker = f"{root}/versions/{made.number:012d}-{folder}"
    if not _system(spark, marker).createNewFile(_path(spark, marker)):
        raise FileExistsError(marker)
    return made


def current_version(spark: SparkSession, root: str) -> Version | None:
    return next(reversed(versions(spark, root)), None)


def read_version(spark: SparkSession, root: str, number: int | None = None, schema: T.StructType | None = None) -> DataFrame:
    """The rows of the version that counts now, or of version ``number``; later publications do not change them."""
    known = versions(spark, root)
    wanted = [v for v in known if number is None or v.number == number]
    if not wanted:
        raise FileNotFoundError(f"no version {number} at {root}" if number is not None else f"nothing is published at {root}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root.rstrip('/')}/data/{wanted[-1].folder}")


def drop_versions(spark: SparkSession, root: str, keep: int = 2, lost_after_hours: float | None = None) -> list[Version]:
    """Delete all but the newest ``keep`` versions, markers first, and return the deleted ones.

    With ``lost_after_hours``, folders that were begun longer ago than that and have no marker go as well; it has to be
    longer than any publication takes.
    """
    if keep < 1:
        raise ValueError("the version that counts has to stay")
    root, known = root.rstrip("/"), versions(spark, root)
    old = known[:-keep]
    system = _system(spark, root)
    for version in old:
        system.delete(_path(spark, f"{root}/versions/{version.number:012d}-{version.folder}"), False)
    gone = [v.folder for v in old]
    if lost_after_hours is not None:
        named, limit = {v.folder for v in known}, (time.time() - 3600 * lost_after_hours) * 1000
        gone += [f for f in _names(spark, f"{root}/data") if f not in named and int(f.partition("-")[0]) < limit]
    for folder in gone:
        system.delete(_path(spark, f"{root}/data/{folder}"), True)
    return old
