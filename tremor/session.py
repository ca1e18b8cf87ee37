"""Session helpers: session set-up, shared scratch space, table loading.

Time columns are UTC wall clock (TIMESTAMP_NTZ) derived from epoch
milliseconds, so no result depends on the session time zone; sessions we
build still use UTC so that instants print as UTC. Intermediate outputs that must survive executor loss (landed Bronze
documents, a written Silver table, streaming checkpoints) go under the
shared folder the cluster names in ``spark.checkpoint.dir``; a private
folder is created only when the session names none (local tests).
"""

from __future__ import annotations

import hashlib
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "tremor") -> SparkSession:
    """Session used by tests and the benchmark; a cluster passes its own."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Set the session time zone to UTC (display of instants only)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_dir(spark: SparkSession, *parts: str) -> str:
    """A folder under the session's checkpoint dir (shared on a cluster).

    ``SparkContext.getCheckpointDir`` already carries an application-unique
    suffix, so concurrent applications never collide. The checkpoint dir is
    set here only when the session has none, which happens in local tests.
    """
    root = ensure_checkpoint_dir(spark)
    return "/".join([root.rstrip("/"), "tremor", *parts])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint dir; a private one is set only when none is configured."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root is None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="tremor-ckpt-"))
        root = sc.getCheckpointDir()
    return root


def dataset_tag(sf_dir: str) -> str:
    """Stable short folder name for outputs derived from one input folder."""
    return hashlib.sha1(sf_dir.encode()).hexdigest()[:12]


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of ``path``."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables; column pruning happens downstream."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty marker file (overwrites)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(hpath, True).close()
