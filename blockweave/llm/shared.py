"""Session helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a folder of our own only on a local master where none is set, as in tests."""
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isEmpty():
        named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="blockweave-"))
        have = sc._jsc.sc().getCheckpointDir()
    return have.get()


#: Most bytes of an Arrow batch that goes to a Python worker, and most rows.
BATCH_BYTES, BATCH_ROWS = 2 << 20, 4000


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session, so that a worker's memory doesn't follow the length of its texts.

    Shuffle files go when the query that wrote them has ended, since what is read again is stored as a table.
    """
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        spark.conf.set(key, str(most))
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


_paths: dict[str, list[str]] = {}


def written(df: DataFrame, name: str = "t") -> DataFrame:
    """Cuts the lineage through a Parquet table in the shared folder; later reads take only the columns they use."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored = path
    _paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    return out


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def release(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` made and that nothing reads any more."""
    for df in tables:
        path = getattr(df, "_stored", None)
        mine = _paths.get(df.sparkSession.sparkContext.applicationId, [])
        if path in mine:
            mine.remove(path)
            _delete(df.sparkSession, path)


def clean_up(spark: SparkSession) -> None:
    """Deletes all tables that ``written`` made in this application: for its end, when results are stored elsewhere."""
    for path in _paths.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)
