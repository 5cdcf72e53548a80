"""Tables that cut lineage, in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_folders: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application under spark.checkpoint.dir; a local one only where that is unset, as in tests."""
    app = spark.sparkContext.applicationId
    if app not in _folders:
        base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if base is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="goldweave-")
        _folders[app] = f"{base.rstrip('/')}/goldweave-{app}"
        atexit.register(_forget, spark, _folders[app])
    return _folders[app]


def _forget(spark: SparkSession, path: str) -> None:
    try:
        if spark.sparkContext._jsc is not None:
            remove(spark, path)
    except Exception:  # the JVM may be gone when the interpreter ends
        pass


def remove(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def written(df: DataFrame, replaces: DataFrame | None = None) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends here, and a lost executor takes nothing with it.

    replaces: an earlier result of this function that nothing needs any more; its files go."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    if replaces is not None:
        drop(replaces)
    return out


def drop(df: DataFrame | None) -> None:
    """Delete the files of a table from written() that nothing reads any more."""
    if path := getattr(df, "_scratch_path", None):
        remove(df.sparkSession, path)


#: Rows of a few columns that a table with no known bound may have to be broadcast; beyond it the join shuffles.
FEW_ROWS = 100_000


def few(df: DataFrame, rows: int = FEW_ROWS) -> DataFrame:
    """df marked for broadcast if it has at most so many rows, which are counted up to that number first."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
