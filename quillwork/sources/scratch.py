"""Tables in the shared folder that cut lineage, and joins whose plan follows checked sizes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_BYTES = 4 << 20  # that a task reads at least, before tables are written
_own: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def scratch(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir; a folder of this process only where that is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="quillwork-")
            atexit.register(shutil.rmtree, _own[app], ignore_errors=True)
        base = f"file://{_own[app]}"
    path = f"{base.rstrip('/')}/quillwork-{uuid.uuid4().hex}"
    _made.setdefault(app, []).append(path)
    return path


def release(spark: SparkSession) -> None:
    """Delete what operators have written for this application. Frames that they returned can't be read any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for x in _made.pop(spark.sparkContext.applicationId, []):
        path = jvm.org.apache.hadoop.fs.Path(x)
        path.getFileSystem(conf).delete(path, True)


def gathered(df: DataFrame) -> DataFrame:
    """df in fewer partitions where they are many for its bytes: one for each FILE_BYTES of the tables that it reads, two
    for each core and a sixteenth of the shuffle partitions are left at least. No row moves, a task only takes several
    partitions in turn. Hadoop starts three processes for each file that an executor writes to a local folder.
    """
    spark = df.sparkSession
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return df.coalesce(max(size // FILE_BYTES + 1, 2 * spark.sparkContext.defaultParallelism, partitions(spark) // 16)) if size < FILE_BYTES << 20 else df


def stash(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df as Parquet to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = f"{scratch(df.sparkSession)}/{name}"
    gathered(df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def listed(df: DataFrame, name: str = "files") -> DataFrame:
    """stash for what tasks tell of files that they have written themselves, a row or so each: all rows go to one file.
    The tasks themselves are not gathered, so that each partition is a task and its id can name a file.
    """
    return stash(df.repartition(1), name)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_enough(df: DataFrame, limit: int, size: Column | None = None, most: int = 32 << 20) -> bool:
    """True if df has at most limit rows, and the sizes of its rows add up to most at most; reads no more than limit + 1."""
    got = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.lit(0) if size is None else size), F.lit(0)).alias("size")).first()
    return got["n"] <= limit and got["size"] <= most


def maybe_broadcast(df: DataFrame, limit: int, size: Column | None = None) -> DataFrame:
    """Broadcast hint behind a check of the row count, and of the rows' sizes where they vary; a shuffled join beyond it."""
    return F.broadcast(df) if small_enough(df, limit, size) else df
