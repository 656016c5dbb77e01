"""Small files and folders of a store, through Hadoop's file systems, so that any storage Spark reads will do."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    fs, place = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _open(spark, path)
    fs.delete(place, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, place = _open(spark, path)
    out = fs.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
