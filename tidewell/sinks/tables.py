"""Tables that are replaced as a whole or appended to."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidewell.session import materialize


def _hadoop(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _hadoop(spark, path)
    return fs.exists(target)


def is_complete(spark: SparkSession, path: str) -> bool:
    """True if a finished Spark write lies at ``path``."""
    return exists(spark, f"{path}/_SUCCESS")


def build_if_missing(spark: SparkSession, path: str, build: Callable[[], None]) -> bool:
    """Run ``build`` unless ``path`` is complete; tells whether it ran."""
    if is_complete(spark, path):
        return False
    build()
    return True


def append(df: DataFrame, path: str) -> None:
    """Add rows. A repeated run adds them again."""
    df.write.mode("append").parquet(path)


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _hadoop(spark, source)
    if not fs.rename(source_path, _hadoop(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def _delete(spark: SparkSession, path: str) -> None:
    fs, target = _hadoop(spark, path)
    fs.delete(target, True)


def recover(spark: SparkSession, path: str) -> None:
    """Undo a replacement that stopped between its two renames."""
    if not exists(spark, path) and exists(spark, f"{path}.previous"):
        _rename(spark, f"{path}.previous", path)


def replace(df: DataFrame, path: str) -> None:
    """Replace the table at ``path`` by ``df``, which may read that table.

    All rows are written beside the target first: an error on the way leaves the
    target as it was, and only renames stand between the old and the new table.
    """
    spark = df.sparkSession
    recover(spark, path)
    staged, previous = f"{path}.staged", f"{path}.previous"
    df.write.mode("overwrite").parquet(staged)
    _delete(spark, previous)
    if exists(spark, path):
        _rename(spark, path, previous)
    _rename(spark, staged, path)
    _delete(spark, previous)


def create_table(spark: SparkSession, schema: str, table: str, columns: T.StructType) -> str:
    """Drop and create an empty typed table in the catalog."""
    name = f"{schema}.{table}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.createDataFrame([], columns).write.format("parquet").saveAsTable(name)
    return name


def recreate(df: DataFrame, schema: str, table: str, columns: T.StructType) -> None:
    """Drop a catalog table and create it typed, with the rows of ``df``.

    A second table is created and filled first; only then does it take the name of the old one, so
    whatever fails on the way leaves the old table as it was.
    """
    spark = df.sparkSession
    name, fresh = f"{schema}.{table}", create_table(spark, schema, f"{table}_fresh", columns)
    df.select(*columns.names).write.insertInto(fresh, overwrite=True)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def merge_partitions(
    incoming: DataFrame, path: str, part: Column, name: str, merge: Callable[[DataFrame, DataFrame], DataFrame]
) -> None:
    """Merge rows into a table stored by the partition column ``name`` = ``part`` of a row.

    Only the partitions that ``incoming`` falls into are read and written again. The merged
    rows are staged first and the partitions are exchanged when the write commits, so an
    error on the way leaves the table as it was.
    """
    spark = incoming.sparkSession
    incoming = materialize(incoming.withColumn(name, part.cast("string")), "merge-incoming")
    if exists(spark, path):
        schema = incoming.schema  # not inferred: names such as 2024-01 stay text
        touched = incoming.select(name).distinct()
        stored = spark.read.schema(schema).parquet(path).join(touched, name, "left_semi").select(*incoming.columns)
    else:
        stored = incoming.limit(0)
    merged = materialize(merge(stored, incoming), "merge-staged")
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(name).parquet(path)


def full_refresh(df: DataFrame, schema: str, table: str) -> None:
    """Replace all rows of a catalog table.

    The rows are staged first, so an error while making them leaves it untouched.
    """
    spark = df.sparkSession
    staged = materialize(df, f"refresh-{table}")
    name = f"{schema}.{table}"
    if spark.catalog.tableExists(name):
        staged.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
        staged.write.format("parquet").saveAsTable(name)


def with_default_now(df: DataFrame, column: str) -> DataFrame:
    """Fill a timestamp column that is missing or NULL with the load time."""
    now = F.current_timestamp()
    given = F.coalesce(F.col(column), now) if column in df.columns else now
    return df.withColumn(column, given)
