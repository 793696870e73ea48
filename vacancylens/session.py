"""Session settings and the folder that jobs may use for intermediate tables."""

import functools
import hashlib
import pathlib
import tempfile
import uuid
import zipfile

from pyspark import SparkContext
from pyspark.sql import SparkSession

#: What the engine relies on. Cluster sizing (executors, memory, shuffle
#: partitions) is left to the deployment; AQE resizes shuffles at run time.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session someone else built."""
    for name, value in ENGINE_CONF.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", app: str = "vacancylens", **conf: str) -> SparkSession:
    """A single-JVM session for tests and ``bench.py``."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        # Call sites of single expressions: half of the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for name, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return named.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below :func:`shared_dir`; nothing is created yet."""
    return f"{shared_dir(spark)}/{purpose}-{uuid.uuid4().hex}"


@functools.cache
def _package_zip() -> str:
    """This package's sources as a zip file on the driver, named by its content."""
    root = pathlib.Path(__file__).parent
    files = sorted(root.rglob("*.py"))
    digest = hashlib.sha256(b"".join(str(f.relative_to(root)).encode() + f.read_bytes() for f in files)).hexdigest()
    path = pathlib.Path(tempfile.mkdtemp()) / f"{root.name}_{digest[:12]}.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for f in files:
            archive.write(f, f.relative_to(root.parent))
    return str(path)


@functools.cache
def _shipped(context: SparkContext) -> None:
    context.addPyFile(_package_zip())


def ship_package(spark: SparkSession) -> None:
    """Let Spark send this package to its Python workers, once per application.

    Workers on other machines need not have it installed.
    """
    _shipped(spark.sparkContext)
