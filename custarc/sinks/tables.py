"""Tables and views the models are materialised as."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from custarc.functions.keys import packed_key, unpacked_key


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Expose a model as a temporary view; it is recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df


def table_path(location: str, name: str) -> str:
    return f"{location.rstrip('/')}/{name}"


def write_table(df: DataFrame, location: str, name: str, **options: str) -> DataFrame:
    """Write the Parquet folder ``location/name`` and return it as read back, so what is built on
    it starts from stored files. For scratch folders, which nobody else reads: surrogate keys are packed in the
    files. ``options`` are those of the writer."""
    path = table_path(location, name)
    keys = [c for c, kind in df.dtypes if kind == "string" and c.endswith("_sk")]
    packed = df.withColumns({c: packed_key(F.col(c)) for c in keys})
    packed.write.mode("overwrite").options(**options).parquet(path)
    stored = df.sparkSession.read.schema(packed.schema).parquet(path)
    return stored.withColumns({c: unpacked_key(F.col(c)) for c in keys})


VERSIONS, POINTER = "_versions", "_current"


def _files(spark: SparkSession, path: str):
    """(the driver's view of the file system of a path, the class of paths)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = jvm.org.apache.hadoop.fs.Path
    return jvm.org.apache.hadoop.fs.FileContext.getFileContext(Path(path).toUri(), conf), Path


def current_version(spark: SparkSession, location: str, name: str) -> str | None:
    """The folder that a table's pointer names, None where there is no pointer."""
    path = table_path(location, name)
    files, Path = _files(spark, path)
    pointer = Path(f"{path}/{POINTER}")
    if not files.util().exists(pointer):
        return None
    stream = files.open(pointer)
    try:
        version = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()
    return f"{path}/{VERSIONS}/{version}"


def _point_at(spark: SparkSession, path: str, version: str) -> None:
    """Write the pointer beside the old one and move it over, which is one step of the file system."""
    files, Path = _files(spark, path)
    jvm = spark.sparkContext._jvm
    new = Path(f"{path}/{POINTER}-{version}")
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE, jvm.org.apache.hadoop.fs.CreateFlag.OVERWRITE)
    stream = files.create(new, flags, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$CreateOpts"), 0))
    try:
        stream.write(bytearray(version, "utf-8"))
    finally:
        stream.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    files.rename(new, Path(f"{path}/{POINTER}"), how)


def replace_table(df: DataFrame, location: str, name: str) -> DataFrame:
    """Replace the Parquet table ``location/name`` in one step and return it as read back.

    The rows go into a version folder of their own; only when all are written does the table's pointer
    move. A job that dies before leaves the old table as it was. The version before stays for those who
    are still reading it, older ones and those of died jobs are deleted. A table has one writer at a time.
    """
    spark, path = df.sparkSession, table_path(location, name)
    before = current_version(spark, location, name)
    version = uuid.uuid4().hex
    folder = f"{path}/{VERSIONS}/{version}"
    df.write.parquet(folder)
    _point_at(spark, path, version)
    files, Path = _files(spark, path)
    kept = {version, before and before.rsplit("/", 1)[1]}
    for status in files.util().listStatus(Path(f"{path}/{VERSIONS}")):
        if status.getPath().getName() not in kept:
            files.delete(status.getPath(), True)
    return spark.read.schema(df.schema).parquet(folder)


def read_table(spark: SparkSession, location: str, name: str) -> DataFrame:
    """A table as it is now; also a plain Parquet folder."""
    return spark.read.parquet(current_version(spark, location, name) or table_path(location, name))


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, if it is there."""
    files, Path = _files(spark, path)
    if files.util().exists(Path(path)):
        files.delete(Path(path), True)


def scratch_folder(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir, where every executor can read it again.

    A session without that setting keeps such data in its warehouse, which is shared as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/custarc-{uuid.uuid4().hex}"


def cut_into(location: str):
    """A ``cut(df, name)`` that stores a table read more than once under ``location``."""
    return lambda df, name: write_table(df, location, name, compression="zstd")
