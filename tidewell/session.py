"""Session construction and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: a batch is in memory several times, and so are files that are read by several threads
LARGE_VALUES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m", "parquet.hadoop.vectored.io.enabled": "false",
                "spark.sql.unionOutputPartitioning": "false"}


def get_session(
    app_name: str = "tidewell",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build or reuse a session; ``conf`` carries connector and cluster settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in {**settings, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session that names none gets a temporary folder; a
    cluster session without the setting is an error, since a folder on one
    machine would be lost with that machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tidewell-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the scratch folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder, with ``options`` of the writer, and read it back.

    Cuts the lineage, survives lost executors, and gives later joins true
    sizes so that the planner's own broadcast limit applies to them.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_paths(table: DataFrame) -> set[str]:
    """The folders of a materialised table."""
    return {name.rsplit("/", 1)[0] for name in table.inputFiles()}


def for_large_values(df: DataFrame) -> DataFrame:
    """``df`` in a clone of its session whose tasks hold few large values at a time; the session keeps its settings."""
    spark = df.sparkSession
    clone = type(spark)(spark.sparkContext, spark._jsparkSession.cloneSession())
    for key, value in LARGE_VALUES.items():
        clone.conf.set(key, value)
    plan = df._jdf.logicalPlan()
    return DataFrame(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(clone._jsparkSession, plan), clone)


def read_in_turn(tasks: list[list[DataFrame]]) -> DataFrame:
    """A partition for each list of tables of equal columns: the rows of its first table, then of the next.

    Where ``spark.sql.unionOutputPartitioning`` is on, lists may follow one another in one partition.
    """
    parts = []
    for tables in tasks:
        rows = tables[0]
        for table in tables[1:]:
            rows = rows.union(table)
        parts.append(rows.coalesce(1))
    while len(parts) > 1:
        parts = [one.union(two) for one, two in zip(parts[::2], parts[1::2])] + parts[len(parts) - len(parts) % 2 :]
    return parts[0]


def materialize_with(table: DataFrame, made, label: str) -> DataFrame:
    """Write ``made(table)`` in a session for large values, and read it in that of ``table``."""
    found = materialize(made(for_large_values(table)), label)
    return table.sparkSession.read.schema(found.schema).parquet(*stored_paths(found))


def discard(table: DataFrame) -> None:
    """Delete a materialised table that nothing reads any more.

    Shuffle files go with the objects of their jobs, so a garbage collection keeps a loop of many jobs from filling the disks.
    """
    spark = table.sparkSession
    for path in stored_paths(table):
        if "/" + scratch_dir(spark).split(":", 1)[-1].strip("/") + "/" in path:
            hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    gc.collect()
    spark._jvm.System.gc()
