"""SparkSession construction and checkpoint-directory handling."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Scan splits of 256 MB: at 100 TB that is ~400k scan tasks instead of
    # ~1.6M at 64 MB (scheduling overhead), still far inside executor memory
    # for the column-pruned reads the operators do.  Post-shuffle partitions
    # are coalesced / split by AQE towards the same advisory size.
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tabkit", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on.

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[N]`` with ``N`` from ``BENCH_CPUS`` (or all cores).
    """
    builder = SparkSession.builder.appName(app_name)
    if master is None and "SPARK_MASTER" not in os.environ and "spark.master" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


#: Arrow batches between Spark and its Python workers, where the session has
#: no bound of its own.  Spark's default of 64 MB lets a batch hold a whole
#: partition, once or twice in the JVM and in every Python worker of a task.
BATCH_KEY, BATCH_SIZE = "spark.sql.execution.arrow.maxBytesPerBatch", "2m"


def bound_batches(spark: SparkSession) -> None:
    """Set ``BATCH_SIZE`` for this session, unless it says otherwise."""
    if spark.conf.get(BATCH_KEY, None) is None:
        spark.conf.set(BATCH_KEY, BATCH_SIZE)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``tabkit`` importable in the executors' Python workers (the
    pandas functions of the kNN search and the dense scorer run there): the
    package is zipped once per process and distributed with ``addPyFile``,
    the programmatic form of ``--py-files``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="tabkit-pkg-"), "tabkit.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def prepare(spark: SparkSession) -> str:
    """Everything a session needs before running tabkit queries: the
    checkpoint folder and the package on the executors."""
    ship_package(spark)
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory the cluster names in
    ``spark.checkpoint.dir``.  Only when none is configured and the master is
    local (tests) a fresh scratch folder is created and set; on a cluster a
    missing setting is an error."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tabkit-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table, placed in the shared checkpoint
    folder so every executor (and a restarted job) can read it."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
