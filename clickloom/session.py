"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are tuned for. Results do not depend on them.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def start(app: str = "clickloom", master: str | None = None, **settings: str) -> SparkSession:
    """Build (or fetch) a session with the recommended settings; ``settings`` win over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster in ``spark.checkpoint.dir``.

    Where that is not set, a folder below the warehouse serves, unless executors on other machines
    could not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    on_this_machine = warehouse.startswith(("file:", "/"))
    if on_this_machine and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    return f"{warehouse}/_scratch"


def written(df: DataFrame, name: str, made: list[DataFrame] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends here.

    Used where a result is read many times (training rows, encoder classes) or must not be
    computed twice (row numbers given by position). The table outlives lost executors; ``discard``
    deletes it once nothing reads it any more. It is added to ``made``, for those who count on that.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/clickloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    if made is not None:
        made.append(back)
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made; whatever still reads them would fail."""
    for df in tables:
        remove(df.sparkSession, df.scratch_path)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder below the shared one, if it is there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
