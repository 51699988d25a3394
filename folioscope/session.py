"""Session defaults and locations shared by the operators."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


#: Temporary folders by application.
_OWN: dict[str, str] = {}


def local_session(app: str = "folioscope", cores: str = "*", partitions: int = 8, memory: str = "4g") -> SparkSession:
    """A local session for tests and benchmarks; on a cluster, bring your own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def importable(spark: SparkSession) -> None:
    """Lets the session's Python workers import this package from where the driver has it."""
    root = str(Path(__file__).resolve().parents[1])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH", ""), root]))


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the driver's parquet tables; the path may be in any store that Spark reads."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``. Where that is unset (tests, one machine) a
    temporary folder is made once for the session; on a cluster that is an error.
    """
    importable(spark)
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _OWN:
            _OWN[app] = "file://" + tempfile.mkdtemp(prefix=f"folioscope-{os.getpid()}-")
        at = _OWN[app]
    return at.rstrip("/")
