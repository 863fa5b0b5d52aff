"""Session helpers: one place for the settings every operator relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. UTC makes day boundaries match the
# reference (it truncates to UTC days); AQE re-plans joins from runtime
# sizes and splits skewed shuffle partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}
# Static settings, only applied when this helper creates the session.
BUILDER_CONF = {"spark.ui.showConsoleProgress": "false"}


def get_session(master: str | None = None, app: str = "tidings",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf.update(BUILDER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_settings(spark)
    return spark


def apply_settings(spark: SparkSession) -> None:
    """Set BASE_CONF, and let Python workers import this package from where
    the driver has it (a cluster ships it with --py-files instead)."""
    for k, v in BASE_CONF.items():
        spark.conf.set(k, v)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if os.path.isdir(root) and root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is set by the deployment (a shared file system
    every executor can reach); without it this raises. Only a local master,
    as in tests, gets a fresh temporary folder when it is unset.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="tidings-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss, unlike a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "tables", name)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: lineage is cut, the files outlive any executor, and the size on
    disk lets Catalyst choose between broadcast and shuffle joins."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A fixed table as a local relation: its size is known to the planner,
    which broadcasts it in joins without a hint or a job."""
    fields = spark.createDataFrame([], schema).schema
    frame = pd.DataFrame({f.name: pd.Series([r[i] for r in rows], dtype=object) for i, f in enumerate(fields)})
    return spark.createDataFrame(frame, fields)
