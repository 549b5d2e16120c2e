"""Session helpers.

The library never creates a session on its own inside an operator: every
operator takes DataFrames and uses ``df.sparkSession``.  These helpers are for
tests, the bench and the command-line jobs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cpus: int | None = None, app: str = "dichot") -> SparkSession:
    """A local session configured the way the tests and bench expect."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.default.parallelism", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("DICHOT_DRIVER_MEMORY", "12g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder and is
    only read here.  A private temporary folder is created only when the
    setting is absent and the master is local (tests, bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster"
        )
    path = tempfile.mkdtemp(prefix="dichot-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the checkpoint folder that no later plan reads."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict:
    """Read the test tables of one scale-factor folder as DataFrames."""
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_package(spark: SparkSession) -> None:
    """Make ``dichot`` importable in the Python workers (``mapInPandas``, pandas
    UDFs) wherever the driver was started: zip the package once and hand it to
    ``SparkContext.addPyFile``, which distributes it with the job, as
    ``spark-submit --py-files`` does."""
    sc = spark.sparkContext
    if getattr(sc, "_dichot_shipped", False):
        return
    import zipfile

    import dichot
    pkg_dir = os.path.dirname(os.path.abspath(dichot.__file__))
    root = os.path.dirname(pkg_dir)
    path = os.path.join(tempfile.mkdtemp(prefix="dichot-pyfiles-"), "dichot.zip")
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._dichot_shipped = True
