"""Spark session factory and the shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "vellum", master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with the engine's defaults; ``conf`` overrides them (use ``**{"spark.x": "y"}``)."""
    builder = SparkSession.builder.appName(app).master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The folder for checkpoints and cut-off tables.

    It is the one the session names in ``spark.checkpoint.dir``.  Only where that is unset (tests,
    one machine) a temporary folder is made, and removed when the process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = tempfile.mkdtemp(prefix="vellum-")
        atexit.register(shutil.rmtree, named, True)
        spark.conf.set("spark.checkpoint.dir", named) if _settable(spark) else None
    return named


def _settable(spark: SparkSession) -> bool:
    try:
        return bool(spark.conf.isModifiable("spark.checkpoint.dir"))
    except Exception:
        return False


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, where its scan has fewer partitions than that (a few small files).

    Before a heavy stage only.  Inputs with more partitions than cores come back as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_LOCAL: dict[str, str] = {}


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint in the shared folder; cuts the lineage and survives lost executors."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(_scratch_once(df.sparkSession))
    return df.checkpoint(eager=True)


def _scratch_once(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = scratch_dir(spark)
    return _LOCAL[app]


def materialize(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` once as compressed Parquet in the shared folder and read it back.

    Unlike ``checkpoint`` the files are columnar and compressed, so several passes over some of
    the columns stay cheap.  The tables of a session are removed when its process ends.
    """
    spark = df.sparkSession
    path = f"{_scratch_once(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    _forget_at_exit(spark, path)
    return spark.read.parquet(path)


def _forget_at_exit(spark: SparkSession, path: str) -> None:
    def remove() -> None:
        try:
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            target = jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(conf).delete(target, True)
        except Exception:
            pass

    atexit.register(remove)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once per application."""
    import os
    import zipfile
    from pathlib import Path

    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="vellum-code-")
    atexit.register(shutil.rmtree, folder, True)
    archive = os.path.join(folder, f"vellum-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, f"{root.name}/{path.relative_to(root)}")
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)
