"""Session set-up for local runs, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


# Of a JSON key that occurs twice the last value counts; a cluster's session needs this setting, too.
LAST_KEY_COUNTS = ("spark.sql.variant.allowDuplicateKeys", "true")


def local_session(cores: int | str = "*", **conf) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("haulwright")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config(*LAST_KEY_COUNTS)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Rows that a task of a costly step takes at most on average.
ROWS_PER_PART = 500_000


def spread(rows: DataFrame, *keys: str, count: int = 0) -> DataFrame:
    """Hash-partition by keys into `spark.sql.shuffle.partitions` parts, more for many rows.

    For steps that cost far more time than their bytes suggest, which adaptive
    execution would pack into too few tasks by size. `count` is the number of rows.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(max(parts, -(-count // ROWS_PER_PART)), *keys)


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder named in `spark.checkpoint.dir`.

    Without that setting a local session gets a folder of its own; a cluster
    must name a shared one, as executors may be lost together with their disks.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="haulwright-checkpoint-")
    context.setCheckpointDir(folder)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per application."""
    context = spark.sparkContext
    if getattr(context, "_haulwright_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="haulwright-")) / "haulwright.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._haulwright_shipped = True
