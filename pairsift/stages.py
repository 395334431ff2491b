"""Where intermediate tables are kept."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"

# Clusters whose machines may share a folder by mounting it; others bring a file system.
MOUNTING = ("spark://", "k8s://")
TRIAL_FILES = 64
TRIED: dict[tuple[str, str], bool] = {}  # by session and folder


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as Hadoop's own."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def mounted(spark: SparkSession, folder: str) -> bool:
    """Whether the driver finds what tasks write to a folder that is a path of the machines themselves.

    It does if all machines mount the folder. That is tried once per session and folder,
    by a small table with a file from each of many tasks.
    """
    context = spark.sparkContext
    if not context.master.startswith(MOUNTING):
        return False
    tried = (context.applicationId, folder)
    if tried not in TRIED:
        files, trial = max(TRIAL_FILES, context.defaultParallelism), f"{folder}/trial-{uuid.uuid4().hex}"
        spark.range(0, files, 1, files).write.parquet(trial)
        TRIED[tried] = spark.read.schema("id long").parquet(trial).count() == files
        removed(spark, trial)
    return TRIED[tried]


def shared_folder(spark: SparkSession) -> str:
    """The folder for stage tables that all machines share.

    It is the one the session names in ``spark.checkpoint.dir``, or else one in its
    warehouse. In a cluster session it must not be in the machines' own file systems,
    unless all of them are seen to have it there (:func:`mounted`).
    """
    context = spark.sparkContext
    named = spark.conf.get(SETTING, None) or context.getCheckpointDir()
    folder = named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_stages"
    if context.master.startswith("local") or file_system(spark, folder)[0].getUri().getScheme() != "file":
        return folder
    if mounted(spark, folder):
        return folder
    if named is None:
        raise ValueError(f"set {SETTING} to a folder that all executors share")
    raise ValueError(f"{SETTING} names a folder of a single machine: {folder}")


def new_folder(spark: SparkSession, name: str) -> str:
    """The path of a folder in the shared one that nobody else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@dataclass(frozen=True)
class Buckets:
    """How a stage table is laid out: rows dealt out to files by a hash of columns, and sorted by them.

    A join on exactly these columns finds both tables dealt out alike, if their numbers
    of buckets are equal, and shuffles neither. A bucket is read by one task, which
    cannot be split: choose so many that the largest one fits.
    """

    columns: tuple[str, ...]
    number: int


def staged(df: DataFrame, folder: str, buckets: Buckets | None = None) -> DataFrame:
    """``df`` written as a Parquet table and read back.

    What follows starts from the table: it has one set of rows for good, and a
    lost executor costs a re-read, not a re-run.
    """
    if buckets is None:
        df.write.mode("overwrite").parquet(folder)
    else:
        # Dealt out by the same hash before, so every bucket is one file.
        rows = df.repartition(buckets.number, *buckets.columns).sortWithinPartitions(*buckets.columns)
        removed(df.sparkSession, folder)
        written = rows.write.mode("overwrite").bucketBy(buckets.number, *buckets.columns)
        name = table_name()
        written.sortBy(*buckets.columns).option("path", folder).format("parquet").saveAsTable(name)
        df.sparkSession.sql(f"DROP TABLE {name}")
    return stored(df.sparkSession, folder, df, buckets)


def table_name() -> str:
    return f"stage_{uuid.uuid4().hex}"


def stored(spark: SparkSession, folder: str, like: DataFrame, buckets: Buckets | None = None) -> DataFrame:
    """The stage table in ``folder``, which has the columns of ``like`` and was laid out in ``buckets``.

    Only a table of the catalog can tell Spark its buckets. It is entered for the
    moment in which the DataFrame is made, which then knows them itself.
    """
    if buckets is None:
        return spark.read.schema(like.schema).parquet(folder)
    name, columns = table_name(), ", ".join(buckets.columns)
    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in like.schema)
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY ({columns}) SORTED BY ({columns})"
        f" INTO {buckets.number} BUCKETS LOCATION '{folder}'"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")  # its files stay


def complete(spark: SparkSession, folder: str) -> bool:
    """Whether a stage table was written to its end."""
    files, path = file_system(spark, f"{folder}/_SUCCESS")
    return files.exists(path)


def removed(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of stage tables."""
    files, path = file_system(spark, folder)
    files.delete(path, True)


def discarded(df: DataFrame) -> None:
    """Deletes the folder of a stage table that nobody needs any more."""
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        removed(df.sparkSession, folder)
