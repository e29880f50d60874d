"""Session set-up and lineage cutting."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

#: Settings that may be changed on a running session; none depends on the size of the data.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 << 20),
}


def build(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests, the bench and single machines."""
    b = SparkSession.builder.master(master).appName("tamarack")
    fixed = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    for k, v in (fixed | RUNTIME | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME` to a session that something else has built."""
    for k, v in RUNTIME.items():
        spark.conf.set(k, v)
    return ship(spark)


def ship(spark: SparkSession) -> SparkSession:
    """Give the package to Python workers that neither PYTHONPATH nor the working directory leads to it; once a session."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    found = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    if getattr(spark, "_tamarack_shipped", False) or any(p and os.path.realpath(p) == os.path.realpath(root) for p in found):
        return spark
    to = os.path.join(tempfile.mkdtemp(prefix="tamarack-"), "tamarack.zip")
    with zipfile.ZipFile(to, "w") as z:
        for folder, _, files in os.walk(os.path.join(root, "tamarack")):
            for f in files:
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    z.write(path, os.path.relpath(path, root))
    spark.sparkContext.addPyFile(to)  # Spark sends it to every executor
    spark._tamarack_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``. Where it is unset, a temporary one on a single machine, and an error on a cluster."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found is None:
        found = getattr(spark, "_tamarack_dir", None)
    if found is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="tamarack-")
        spark._tamarack_dir = found
    return found.rstrip("/")


def stored(df: DataFrame, name: str, *by: str) -> str:
    """Write ``df`` as a table in the shared folder, in folders by the columns named, and return its path. The table is removed when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tamarack-{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    atexit.register(_remove, spark, path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage without keeping anything on an executor, so a lost executor
    costs only the tasks it ran. The table is removed when the driver ends.
    """
    return df.sparkSession.read.schema(df.schema).parquet(stored(df, name))


def _remove(spark: SparkSession, path: str) -> None:
    if path.startswith("file://"):
        import shutil

        shutil.rmtree(path.removeprefix("file://"), ignore_errors=True)
        return
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session may be gone already
        pass


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its input has fewer partitions than that (a few small files); large inputs stay as they are, without a shuffle."""
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
