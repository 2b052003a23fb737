"""Folders and small files of any file system Spark knows, moved and written from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _system(spark, path).exists(_path(spark, path))


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none when there is no such folder."""
    if not exists(spark, path):
        return []
    return sorted(found.getPath().getName() for found in _system(spark, path).listStatus(_path(spark, path)))


def delete(spark: SparkSession, path: str) -> None:
    _system(spark, path).delete(_path(spark, path), True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; fails when the target exists."""
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _system(spark, source).getUri(), spark._jsc.hadoopConfiguration()
    )
    context.rename(_path(spark, source), _path(spark, target), options)


def replace(spark: SparkSession, source: str, target: str, aside: str) -> None:
    """Put the folder `source` in the place of `target`, whose old content passes through `aside`.

    When the second move fails, the old content comes back.
    """
    if not exists(spark, target):
        _system(spark, target).mkdirs(_path(spark, target).getParent())
        move(spark, source, target)
        return
    move(spark, target, aside)
    try:
        move(spark, source, target)
    except Exception:
        move(spark, aside, target)
        raise
    delete(spark, aside)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written beside its place and moved there whole; fails when the file exists."""
    beside = f"{path}.tmp-{spark._jvm.java.util.UUID.randomUUID()}"
    out = _system(spark, path).create(_path(spark, beside), False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    try:
        move(spark, beside, path)
    except Exception:
        delete(spark, beside)
        raise


def read_text(spark: SparkSession, path: str) -> str:
    found = spark.read.text(path, wholetext=True).first()
    return found[0] if found else ""
