"""Tables that are replaced as a whole.

A version is a folder of its own, and a log of one line per version says which is current. The line is added after all tables of the
version are written, by one rename of Spark's commit; so readers see the old version or the new one, and a write that dies
leaves the old one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

LOG_SCHEMA = "version bigint, folder string, written_at string"


def _log(path: str) -> str:
    return f"{path.rstrip('/')}/versions"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, folder, written_at) of all versions at ``path``; of two writers that took one number, the later one counts."""
    try:
        return spark.read.schema(LOG_SCHEMA).json(_log(path))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG_SCHEMA)


def _newest_first(spark: SparkSession, path: str) -> DataFrame:
    return versions(spark, path).orderBy(F.desc("version"), F.desc("written_at"), "folder")


def current_folder(spark: SparkSession, path: str) -> str | None:
    """Folder of the current version, null if nothing was ever written this way."""
    row = _newest_first(spark, path).first()
    return None if row is None else f"{path.rstrip('/')}/{row['folder']}"


def replace(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Make what ``write`` puts into the folder that it is given the current version at ``path``."""
    last = _newest_first(spark, path).first()
    folder = f"data/{uuid.uuid4().hex}"
    write(f"{path.rstrip('/')}/{folder}")
    row = (1 if last is None else last["version"] + 1, folder, datetime.now(timezone.utc).isoformat())
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").json(_log(path))


def forget(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the data of all but the newest ``keep`` versions; how many were deleted. Readers of those must have ended."""
    if keep < 1:
        raise ValueError("the current version has to stay")
    jvm = spark._jvm
    gone = 0
    for row in _newest_first(spark, path).collect()[keep:]:  # one row per version
        folder = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{row['folder']}")
        gone += bool(folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True))
    return gone
