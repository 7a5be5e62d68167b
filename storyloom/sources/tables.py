"""Stored tables as versioned Parquet folders.

Path-based Parquet has no MERGE, so an update is a new version of the table built
by joins; readers take the newest complete version.
"""

from __future__ import annotations

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storyloom.session import new_workspace, path_exists


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage durably."""
    spark = df.sparkSession
    path = path or new_workspace(spark, "stage")
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_once(df: DataFrame, path: str) -> DataFrame:
    """Like ``stage``, but a complete earlier write at that path is used as it is."""
    if path_exists(df.sparkSession, f"{path}/_SUCCESS"):
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return stage(df, path)


def stage_by_article(
    df: DataFrame, path: str | None = None, partition_by: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Stage a table bucketed by ``id``, so that later joins and groupings on it need no shuffle.

    Meant for the large term and vector tables. One file per bucket (and partition);
    a complete earlier write at that path is used as it is. Rows hashed on ``id`` into as many
    tasks as there are ``buckets`` are written without a shuffle.
    """
    spark = df.sparkSession
    path = path or new_workspace(spark, "stage")
    name = "storyloom_" + hashlib.md5(path.encode()).hexdigest()
    if path_exists(spark, f"{path}/_SUCCESS"):
        return spark.table(name) if spark.catalog.tableExists(name) else spark.read.schema(df.schema).parquet(path)
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.repartition(buckets, "id").write.mode("overwrite").option("compression", "zstd").option("path", path).bucketBy(buckets, "id").sortBy("id")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(name)
    return spark.table(name)


def upsert(target: DataFrame, source: DataFrame, keys: str | list[str]) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with the same key."""
    keys = [keys] if isinstance(keys, str) else keys
    return target.join(source.select(*keys), keys, "left_anti").unionByName(source.select(*target.columns))


def replace_by_key(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """All rows of ``target`` whose key occurs in ``source`` go; the new rows come."""
    return target.join(source.select(key).distinct(), key, "left_anti").unionByName(source.select(*target.columns))


def concat(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def latest_version(spark: SparkSession, folder: str, up_to: int | None = None) -> int | None:
    """Number of the newest version with a success marker, not above ``up_to``."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(jvm_path):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(jvm_path)]
    numbers = sorted((int(n[2:]) for n in names if n.startswith("v=")), reverse=True)
    numbers = numbers if up_to is None else [n for n in numbers if n <= up_to]
    return next((n for n in numbers if path_exists(spark, f"{folder}/v={n}/_SUCCESS")), None)


def read_table(spark: SparkSession, folder: str, schema: T.StructType, version: int | None = None) -> DataFrame:
    """A version of a table, the newest by default; empty if there is none yet."""
    version = latest_version(spark, folder) if version is None else version
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{folder}/v={version}")


def write_version(df: DataFrame, folder: str, version: int) -> DataFrame:
    """Write (or rewrite) one version; writing the same version twice is harmless."""
    return stage(df, f"{folder}/v={version}")


def claim_version(spark: SparkSession, root: str, writer: str, newest: int | None) -> int:
    """Version that ``writer`` may write: its own from before, or one that nobody wrote or claimed.

    The claim is written before the tables, so a batch that is replayed finds its version
    again however far it came, and no other writer takes it meanwhile.
    """
    schema = "version bigint, writer string"
    claimed = None
    if path_exists(spark, f"{root}/claims"):
        claims = spark.read.schema(schema).parquet(f"{root}/claims/v=*")
        own = F.max(F.when(F.col("writer") == writer, F.col("version")))
        mine, claimed = claims.agg(own, F.max("version")).first()
        if mine is not None:
            return mine
    version = max(-1 if v is None else v for v in (newest, claimed)) + 1
    write_version(spark.createDataFrame([(version, writer)], schema), f"{root}/claims", version)
    return version


def take_version(spark: SparkSession, root: str, writer: str, last_table: str) -> tuple[int | None, int | None]:
    """Version to write and the complete one to build on; no version when ``writer`` is done already.

    ``last_table`` is the one whose version makes all others complete. A writer that failed and
    was overtaken by others takes a new version on top of theirs. One writer works at a time.
    """
    newest = latest_version(spark, f"{root}/{last_table}")
    version = claim_version(spark, root, writer, newest)
    if path_exists(spark, f"{root}/{last_table}/v={version}/_SUCCESS"):
        return None, newest
    if newest is not None and newest > version:
        version = claim_version(spark, root, f"{writer} after {newest}", newest)
    return version, newest


def read_json_articles(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """File data set with nested arrays, with an explicit schema."""
    return spark.read.schema(schema).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def first_rows(df: DataFrame, limit: int | None, key: str = "id") -> DataFrame:
    """Row cap for a trial load; the lowest keys, so that it can be repeated."""
    return df.orderBy(F.col(key)).limit(limit) if limit else df
