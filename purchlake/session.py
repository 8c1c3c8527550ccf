"""Session helpers.

Only SQL confs that are safe to set at runtime are touched here; cluster
sizing (executors, memory) belongs to the launcher.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

# Confs the library relies on.  AQE re-plans joins from runtime sizes: a
# lookup side is broadcast only when its measured size is under
# ``autoBroadcastJoinThreshold``; otherwise the join stays sort-merge.
# Skew join splits a hot key's partition on the streamed side.
RUNTIME_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app: str = "purchlake",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Local / test session.  On a cluster the launcher passes master and sizing."""
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**RUNTIME_CONFS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared, durable
    location there).  Where it is unset, a local master gets a folder of its
    own, as driver and executors are one process on one machine; on a cluster
    that is an error, because executors would not see each other's files.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    path = path or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        local = spark.conf.get("spark.local.dir", "/tmp").split(",")[0]
        path = f"file://{local}/purchlake-{sc.applicationId}"
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path
