"""Session helpers shared by tests, bench and queries."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, app: str = "tickloom") -> SparkSession:
    """A local session with the settings that tests and bench share. A cluster brings its own session."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the provided tables. Spark's own reader takes any path that the cluster can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def work_dir(spark: SparkSession, name: str) -> str:
    """A new folder for state that all machines share: in spark.checkpoint.dir, or where that is unset, as in tests, in the
    system's temporary folder."""
    import tempfile
    import uuid

    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = tempfile.mkdtemp(prefix="tickloom-")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def checkpointed(rows: DataFrame) -> DataFrame:
    """Rows written to the checkpoint folder that the session names; only where none is named on one machine, as in tests, to
    a folder of our own."""
    context = rows.sparkSession.sparkContext
    if rows.sparkSession.conf.get("spark.checkpoint.dir", None) is None and context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(work_dir(rows.sparkSession, "checkpoints"))
    return rows.checkpoint()


def kept(rows: DataFrame) -> DataFrame:
    """Rows written once as Parquet in the folder that all machines share, for what reads them more than once: readers take only
    the columns they need, in as many tasks as the files' size asks for."""
    path = work_dir(rows.sparkSession, "kept")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def find_package(spark: SparkSession) -> None:
    """Python workers on this machine find the package wherever the driver was started; a cluster gets it with the job."""
    from pathlib import Path

    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
