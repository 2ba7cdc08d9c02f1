"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

# Most rows, of a few short columns, that may be broadcast.
FEW_ROWS = 1_000_000

# Settings that results depend on; safe to set on a session somebody else started.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
}

# Settings only plans depend on.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "lorebase", master: str | None = None, **settings) -> SparkSession:
    """Build a session; `settings` use `__` for the dots of a Spark setting's name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**PLAN_SETTINGS, **RESULT_SETTINGS}.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Pin what results depend on and make sure checkpoints have somewhere to go."""
    for name, value in RESULT_SETTINGS.items():
        spark.conf.set(name, value)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{_scratch_folder(spark)}/checkpoints")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="lorebase-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path for a table that only this application needs."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to a scratch table and read them back: what follows does not compute them again, also after executors are lost."""
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _dealt_name(path: str) -> str:
    return f"dealt_{uuid.uuid5(uuid.NAMESPACE_URL, path).hex}"


def write_dealt(rows: DataFrame, path: str, by: str, parts: int, folders: list[str] | None = None) -> None:
    """Write rows as a table of `parts` buckets of column `by`: what reads it groups and joins by that column without a shuffle.

    `rows` should be dealt by `by` into as many parts already, so that each task writes one bucket.
    """
    writer = rows.write.mode("overwrite").format("parquet").option("path", path).bucketBy(parts, by)
    (writer.partitionBy(*folders) if folders else writer).saveAsTable(_dealt_name(path))


def read_dealt(spark: SparkSession, path: str, schema: str, by: str, parts: int, folders: list[str] | None = None) -> DataFrame:
    """The table that `write_dealt` has put there, perhaps in another application."""
    held = f"PARTITIONED BY ({', '.join(folders)}) " if folders else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_dealt_name(path)} ({schema}) USING parquet {held}CLUSTERED BY ({by}) INTO {parts} BUCKETS LOCATION '{path}'")
    return spark.table(_dealt_name(path))


def kept_path(spark: SparkSession, name: str, of: str) -> str:
    """The path of a table that this application keeps, the same for the same `name` and `of`."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid5(uuid.NAMESPACE_URL, of).hex}"


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of the folders in a folder, but for those that start with _ or a dot; none where it does not exist."""
    if not exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    names = [f.getPath().getName() for f in found if f.isDirectory()]
    return [n for n in names if n[0] not in "_."]


def delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _scratch_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/lorebase-{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Delete one scratch table, or all of this application once no result needs them any more."""
    path = path or _scratch_folder(spark)
    if not path.startswith(_scratch_folder(spark)):
        raise ValueError("not a scratch table of this application")
    delete(spark, path)


def broadcast_if_few(rows: DataFrame, limit: int = FEW_ROWS) -> DataFrame:
    """Mark rows for broadcast if there are few. They are counted, so they should be a stored table."""
    return F.broadcast(rows) if rows.limit(limit + 1).count() <= limit else rows
