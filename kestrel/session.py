"""SparkSession configuration used by the engine.

Wall-clock timestamps are TIMESTAMP_NTZ everywhere, so the session zone only
matters for the one true instant (Quote.createdAt); it is pinned to UTC.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The size check behind every dimension broadcast: the planner broadcasts a
    # join side only when its estimated size is below this, else sort-merge.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    # Parquet holds about a quarter of what a table takes in memory: 32 MB of it
    # were some 6 million rows of two keys, on the driver and in every executor.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # What a task holds (the sorts of up to eight joins, partial aggregates) is many
    # times its compressed input: bounded for scans and for shuffles alike.
    "spark.sql.files.maxPartitionBytes": str(16 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
    # Split a skewed partition of a big join side even if the aggregation above
    # then needs its own (map-side combined) shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A JSON payload may name a key twice; the last value counts, as in Postgres.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Literal timestamps in shared SQL text are wall-clock values.
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the models rely on to an existing session."""
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``; only when it is unset on a local master (tests)
    set a scratch folder of our own. On a cluster executors share no such folder,
    so there it is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="kestrel-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


# FAIR-scheduler pools "w1".."w8" (weight = the number), used by the
# publisher to run models many others depend on ahead of leaf marts.
POOL_WEIGHTS = range(1, 9)


def fair_pool_file() -> str:
    """Write a FAIR-scheduler allocation file with the weighted pools."""
    d = tempfile.mkdtemp(prefix="kestrel-pools-")
    body = "".join(f'<pool name="w{w}"><schedulingMode>FIFO</schedulingMode><weight>{w}</weight>'
                   f"<minShare>0</minShare></pool>" for w in POOL_WEIGHTS)
    path = os.path.join(d, "pools.xml")
    with open(path, "w") as fh:
        fh.write(f'<?xml version="1.0"?><allocations>{body}</allocations>')
    return path


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "kestrel",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session for tests and the bench (UI off, no servers)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.scheduler.mode", "FAIR")
        .config("spark.scheduler.allocation.file", fair_pool_file())
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("KESTREL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**ENGINE_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
