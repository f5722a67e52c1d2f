"""Session creation and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings every session of this library wants; none of them depends on the size of the data.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int | str = 8, partitions: int | None = None, memory: str = "8g", name: str = "corpusloom") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name).config("spark.driver.memory", memory)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    n = partitions or (int(cpus) if str(cpus).isdigit() else 8)
    return builder.config("spark.sql.shuffle.partitions", str(n)).getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder of its own; on a cluster the setting is required,
    since a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir")
    if folder:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(folder)
        return folder
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="corpusloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(f"file://{folder}")
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, tag: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark).rstrip('/')}/corpusloom-{tag}-{uuid.uuid4().hex}"


def store(df: DataFrame, tag: str) -> DataFrame:
    """Compute ``df`` once and go on from a reliable copy in the shared folder, a Parquet table: later stages survive a lost executor, and the planner knows its size."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*stored: DataFrame | None) -> None:
    """Delete tables made by :func:`store` that no plan reads any more; anything else is left alone."""
    from corpusloom.sources.paths import remove

    for df in stored:
        path = getattr(df, "_stored_at", None)
        if path:
            remove(df.sparkSession, path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that workers can import it wherever they run."""
    import os
    import zipfile

    import corpusloom

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(corpusloom.__file__))
    folder = tempfile.mkdtemp(prefix="corpusloom-ship-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "corpusloom.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for base, _, files in os.walk(root):
            for name in sorted(files):
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    out.write(path, os.path.join("corpusloom", os.path.relpath(path, root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)
