"""Questions about shared storage that need no Spark job."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Of the files of all layers. The second version of Parquet's encodings keeps keys and texts that are no dictionary's as
# differences; a dictionary that has become this large would be of nearly as many entries as there are rows.
FILES = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.dictionary.page.size": str(64 * 1024),
}


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = _folder(spark, path)
    return files.exists(folder)


def make_folder(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.mkdirs(folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder, files = _folder(spark, path)
    files.delete(folder, True)


def move_folder(spark: SparkSession, path: str, place: str) -> None:
    """Move a folder where it exists; a move that broke off, as one by copies can, is carried on file by file."""
    source, files = _folder(spark, path)
    if not files.exists(source):
        return
    target, _ = _folder(spark, place)
    if not files.exists(target):
        files.mkdirs(target.getParent())
        if files.rename(source, target):
            return
    found = files.listFiles(source, True)
    root = files.makeQualified(source).toUri().getPath()
    while found.hasNext():
        file = found.next().getPath()
        part, _ = _folder(spark, place + file.toUri().getPath().removeprefix(root))
        files.mkdirs(part.getParent())
        files.delete(part, False)
        if not files.rename(file, part):
            raise OSError(f"{file} cannot be moved to {part}")
    files.delete(source, True)


def partition_values(spark: SparkSession, path: str, column: str) -> list[int]:
    """Whole-number values of ``column`` that the folders directly under ``path`` are named after."""
    folder, files = _folder(spark, path)
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    prefix = f"{column}="
    return sorted(int(name.removeprefix(prefix)) for name in names if name.startswith(prefix))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a Parquet table can be read at ``path``; any failure to do so counts as no."""
    if not path_exists(spark, path):
        return False
    try:
        return bool(spark.read.parquet(path).columns)
    except AnalysisException:
        return False
