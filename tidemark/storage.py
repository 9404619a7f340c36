"""The shared folder jobs write to, and the few file operations they need.

Everything goes through the Hadoop file system of the path, so local folders,
HDFS and object stores behave alike.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession
from py4j.protocol import Py4JJavaError

from tidemark.errors import CommitConflict, TidemarkError
from tidemark.sizing import sized_shuffles

_FOLDER_SETTING = "spark.checkpoint.dir"
_LOCAL_FOLDERS: WeakKeyDictionary = WeakKeyDictionary()
_OWNED: ContextVar[list[str] | None] = ContextVar("owned folders", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees, as named by ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder is used in local mode only;
    on a cluster a machine-local folder would lose data, so that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get(_FOLDER_SETTING, None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise TidemarkError(f"set {_FOLDER_SETTING} to a folder all executors share")
    if context not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[context] = tempfile.mkdtemp(prefix="tidemark-")
    return _LOCAL_FOLDERS[context]


def new_folder(spark: SparkSession, purpose: str) -> str:
    return os.path.join(shared_folder(spark), "tidemark", f"{purpose}-{uuid.uuid4().hex}")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables materialized in this block go at its end: write or collect the result inside.

    Outside of any such block they stay until the driver ends.
    """
    owned: list[str] = []
    token = _OWNED.set(owned)
    try:
        yield
    finally:
        _OWNED.reset(token)
        for folder in owned:
            remove(spark, folder)


def materialize(df: DataFrame, purpose: str = "table") -> DataFrame:
    """``df`` written once to the shared folder and read back.

    Cuts lineage, and pins values that a recomputation could change (partition
    ids, row order), so a lost executor cannot make two passes disagree.
    """
    spark = df.sparkSession
    folder = new_folder(spark, purpose)
    with sized_shuffles(spark, df):
        df.write.parquet(folder)
    owned = _OWNED.get()
    if owned is None:
        remove_at_exit(spark, folder)
    else:
        owned.append(folder)
    return spark.read.schema(df.schema).parquet(folder)


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _open(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def count_files(spark: SparkSession, folder: str, ending: str) -> int:
    """Files below a folder whose name ends so."""
    fs, path = _open(spark, folder)
    files, count = fs.listFiles(path, True), 0
    while files.hasNext():
        count += files.next().getPath().getName().endswith(ending)
    return count


def remove(spark: SparkSession, folder: str) -> None:
    fs, path = _open(spark, folder)
    fs.delete(path, True)


def remove_at_exit(spark: SparkSession, folder: str) -> None:
    """Scratch data goes when the driver does."""
    fs, path = _open(spark, folder)
    fs.deleteOnExit(path)


def read_text(spark: SparkSession, file: str) -> str:
    fs, path = _open(spark, file)
    stream = fs.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, file: str, text: str) -> None:
    """Make ``file`` appear with its whole content, or fail if it already exists."""
    draft = os.path.join(os.path.dirname(file), f".draft-{uuid.uuid4().hex}")
    fs, draft_path = _open(spark, draft)
    stream = fs.create(draft_path, False)
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()
    jvm = spark._jvm
    final_path = jvm.org.apache.hadoop.fs.Path(file)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.makeQualified(draft_path).toUri(), spark._jsc.hadoopConfiguration()
    )
    no_overwrite = spark.sparkContext._gateway.new_array(
        getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0
    )
    try:
        context.rename(fs.makeQualified(draft_path), fs.makeQualified(final_path), no_overwrite)
    except Py4JJavaError as error:
        fs.delete(draft_path, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise CommitConflict(f"{file} was published by another writer") from None
        raise
