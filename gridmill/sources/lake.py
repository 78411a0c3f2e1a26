"""Reads of the lake, of tables and of record files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Column that a pandas writer leaves behind after a row filter.
PANDAS_INDEX = "__index_level_0__"


def data_path(lake: str, feed: str = "") -> str:
    return f"{lake.rstrip('/')}/data/{feed}".rstrip("/")


def meta_path(lake: str, feed: str, kind: str) -> str:
    return f"{lake.rstrip('/')}/meta/{feed.strip('/')}/{kind}"


def _filesystem(spark: SparkSession, path: str):
    """Hadoop file system of a path, so that any store Spark can reach is handled alike."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def escaped(value: str) -> str:
    """A partition value as Spark writes it into a folder name."""
    return "".join(f"%{ord(c):02X}" if c in '"#%\'*/:=?\\{[]^' or ord(c) < 32 or ord(c) == 127 else c for c in value)


def qualified(spark: SparkSession, path: str) -> str:
    """A path as Spark's readers name it."""
    filesystem, jpath = _filesystem(spark, path)
    return filesystem.makeQualified(jpath).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, jpath = _filesystem(spark, path)
    return bool(filesystem.exists(jpath))


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries directly below a path."""
    filesystem, jpath = _filesystem(spark, path)
    if not filesystem.exists(jpath):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(jpath)]


def make_folder(spark: SparkSession, path: str) -> None:
    filesystem, jpath = _filesystem(spark, path)
    filesystem.mkdirs(jpath)


def delete_folder(spark: SparkSession, path: str) -> None:
    filesystem, jpath = _filesystem(spark, path)
    filesystem.delete(jpath, True)


def delete_matching(spark: SparkSession, glob: str) -> None:
    filesystem, jpath = _filesystem(spark, glob)
    for status in filesystem.globStatus(jpath) or []:
        filesystem.delete(status.getPath(), True)


def _under(lake: str, prefix: str) -> str:
    return f"{data_path(lake)}/{prefix.lstrip('/')}*"


def read_lake(spark: SparkSession, lake: str, prefix: str = "", schema: T.StructType | None = None,
              days: tuple[str, str] | None = None) -> DataFrame:
    """All Parquet objects whose key starts with ``prefix``, with their file path.

    ``days`` (first and last, as yyyy-MM-dd) reads a feed's folders of these days only.
    """
    if days is not None:
        # The feed's folder is the base, so its periods are partitions and the scan prunes them.
        reader = spark.read.option("basePath", data_path(lake, prefix))
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField("period", T.StringType()), T.StructField("batch_id", T.StringType())]))
        df = reader.parquet(data_path(lake, prefix))
        chosen = df.filter(F.col("period").cast("string").between(*days))
        return chosen.drop(PANDAS_INDEX).select("*", F.col("_metadata.file_path").alias("file_path")).drop("period", "batch_id")
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(_under(lake, prefix))
    return df.drop(PANDAS_INDEX).select("*", F.col("_metadata.file_path").alias("file_path"))


def _any_match(spark: SparkSession, glob: str) -> bool:
    filesystem, jpath = _filesystem(spark, glob)
    found = filesystem.globStatus(jpath)
    return found is not None and any(not f.getPath().getName().startswith(("_", ".")) for f in found)


def list_objects(spark: SparkSession, lake: str, prefix: str = "") -> DataFrame:
    """Objects under a prefix: path, size, time. File contents are not read."""
    if not _any_match(spark, _under(lake, prefix)):
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(_under(lake, prefix))
        .select("path", "length", "modificationTime")
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A whole warehouse table, by catalog name or by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def read_records_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Record files with a header line; typed while parsing."""
    return spark.read.schema(schema).option("header", "true").csv(path)
