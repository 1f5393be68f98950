"""Session helpers: the shared folder, and tables written there to cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_written: list[tuple[SparkSession, str]] = []


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests, examples and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("granary")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir of the session.

    Where it is unset, a local master gets a temporary folder; any other master is refused,
    since a folder of one machine would not survive the loss of that machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="granary-shared-")
    spark.conf.set("spark.checkpoint.dir", f"file://{own}")
    context.setCheckpointDir(f"file://{own}")
    _written.append((spark, f"file://{own}"))
    return f"file://{own}"


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there is deleted when the process ends."""
    path = f"{shared_dir(spark)}/granary-{label}-{uuid.uuid4().hex}"
    _written.append((spark, path))
    return path


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    The lineage ends at the files, so a lost executor costs no recomputation upstream. Column names
    and types stay; the table is deleted when the process ends.
    """
    path = shared_path(df.sparkSession, label)
    writer = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release() -> None:
    """Delete every table that `materialize` wrote."""
    while _written:
        spark, path = _written.pop()
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001 - the session may have ended
            pass


atexit.register(release)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
