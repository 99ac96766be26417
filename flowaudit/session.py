"""SparkSession construction and lineage helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_spark(master: str | None = None, app: str = "flowaudit",
              shuffle_partitions: int | None = None, extra_conf: dict | None = None) -> SparkSession:
    """Session tuned for the operators in this package.

    AQE re-plans joins and coalesces shuffle partitions at run time; skew-join
    splitting guards the joins on feature vectors, where one vector may hold
    a large share of the rows.  Master and sizes come from ``spark-submit`` or
    the defaults file unless given here: settings made in code would override
    them.  ``master`` is for local runs and tests; a local master given here
    gets one shuffle partition per core.
    """
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
        if shuffle_partitions is None and master.startswith("local["):
            cores = master[len("local["):].split("]")[0].split(",")[0]
            shuffle_partitions = os.cpu_count() if cores == "*" else int(cores)
        builder = builder.config("spark.driver.memory", os.environ.get("FLOWAUDIT_DRIVER_MEMORY", "16g"))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; create a local one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is.  Only local sessions (tests, bench) without the setting get a
    fresh scratch folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current.removeprefix("file:")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="flowaudit-ckpt-")
    sc.setCheckpointDir(path)
    try:
        spark.conf.set("spark.checkpoint.dir", path)
    except Exception:  # noqa: BLE001 - some deployments reject core confs at run time
        pass
    return sc.getCheckpointDir() or path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over ``defaultParallelism`` partitions before a
    row-multiplying step (explode over iterations, permutations, coalitions).

    The shuffle moves the narrow rows, before they are multiplied; the plan is
    the same whatever the deployment.  ``spark.flowaudit.spread`` set to
    ``never`` leaves the partitioning alone, for inputs that are known to be
    split well."""
    if df.sparkSession.conf.get("spark.flowaudit.spread", "always") == "never":
        return df
    return df.repartition(min_partitions or df.sparkSession.sparkContext.defaultParallelism)
