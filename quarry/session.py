"""Session helpers: a local session for tests and benches, and checkpoint-folder resolution.

Library operators never build their own session; they take the caller's. The only session state they
read is the checkpoint folder (``spark.checkpoint.dir``), used to cut lineage in iterative operators.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours runs with. AQE re-plans joins from measured sizes (this is the size
# check behind every data-dependent broadcast) and splits skewed join partitions.
ENGINE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of superseded rounds are removed once their RDDs are garbage-collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quarry",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and benches (never used by library code)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**ENGINE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    builder = (
        builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(64 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    Reads ``spark.checkpoint.dir`` (or a folder already set on the context). Only a local-mode session
    with neither gets a fresh scratch folder, as in tests; a cluster session without the setting is an
    error, because a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative operators")
        conf = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for operator outputs that must be written."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
