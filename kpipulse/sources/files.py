"""Small file-system helpers over the Hadoop FileSystem API, so the same code
works on local disk, HDFS and object stores (whatever the path names)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, hp = hadoop_fs(spark, path)
    return bool(fs.exists(hp))


def child_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, hp = hadoop_fs(spark, path)
    if not fs.exists(hp):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hp) if st.isDirectory()]


def child_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path`` (empty when it does not exist)."""
    fs, hp = hadoop_fs(spark, path)
    if not fs.exists(hp):
        return []
    return [st.getPath().getName() for st in fs.listStatus(hp) if st.isFile()]


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under ``path`` (0 when it does not exist)."""
    fs, hp = hadoop_fs(spark, path)
    return fs.getContentSummary(hp).getLength() if fs.exists(hp) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, hp = hadoop_fs(spark, path)
    fs.delete(hp, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, hp = hadoop_fs(spark, path)
    if not fs.exists(hp):
        return None
    stream = fs.open(hp)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream))
        return reader.readLine()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> None:
    fs, hp = hadoop_fs(spark, path)
    out = fs.create(hp, overwrite)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def mkdirs(spark: SparkSession, path: str) -> None:
    fs, hp = hadoop_fs(spark, path)
    fs.mkdirs(hp)
