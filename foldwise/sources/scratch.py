"""Where intermediate tables go: the shared folder the cluster names, never a machine-local one."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_LOCAL: dict[str, str] = {}
SHUFFLED_TASKS = 200  # of a pass planned once, at most


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session without one gets a temporary folder."""
    found = spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {_SETTING} to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL:
        _LOCAL[application] = tempfile.mkdtemp(prefix="foldwise-")
    return _LOCAL[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nothing else uses."""
    return f"{scratch_dir(spark)}/foldwise/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage, and survives the loss of any executor.

    The schema is given to the reader, so partition columns keep their types.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def spread(rows: DataFrame, rows_per_task: int, name: str) -> DataFrame:
    """Rows that many passes read: stored once, dealt evenly to as many tasks as run at once (more if the rows have more already), fewer for few rows."""
    running = max(rows.rdd.getNumPartitions(), rows.sparkSession.sparkContext.defaultParallelism)
    return stored(rows.repartition(max(1, min(running, -(-rows.count() // rows_per_task)))), name)


def planned_once(written: DataFrame, tasks: int) -> DataFrame:
    """What was written, read in a session of its own that runs a pass as one job; planned adaptively it is three, for few rows mostly waiting."""
    own = written.sparkSession.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.shuffle.partitions", str(max(1, min(tasks, SHUFFLED_TASKS))))
    own.conf.set("spark.sql.files.maxPartitionBytes", written.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))
    return own.read.schema(written.schema).parquet(*written.inputFiles())


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Let estimators that cut their own lineage (boosting, k-means) use the shared folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{scratch_dir(spark)}/foldwise/lineage")


def add_partition(spark: SparkSession, rows: list, schema, table: str) -> None:
    """Add a handful of rows as partitions of their own: writers of one table, each with partitions nobody else has, do not meet.

    Only writes that replace partitions by name have a staging folder for each job, and ``insertInto`` takes that mode from the session. A
    session of its own shares the catalog and leaves the caller's settings, and those of other writers, alone.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    own.createDataFrame(rows, schema).coalesce(1).write.insertInto(table, overwrite=True)
    spark.catalog.refreshTable(table)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the file system it is in; False if there was none."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return bool(where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True))


def discard_scratch(spark: SparkSession) -> bool:
    """Delete every intermediate table written here; call it when no frame that reads them is used any more."""
    return remove(spark, f"{scratch_dir(spark)}/foldwise")
